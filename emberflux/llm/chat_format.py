"""Operator 4: chat formatting with tool-call linking, in DataFrame and SQL functions only.

A message is plain text, or a JSON object: an assistant's may have `tool_calls` (id, name, arguments,
and `after`, ids of calls that it builds on), a tool's has `tool_call_id` and `content`. Calls and
results are joined by (conv_id, id); calls are ordered topologically, level by level; arguments are
checked against a table of parameters; each message becomes one line of canonical JSON (keys sorted,
no white space). No step gathers a conversation, so a hot one is no different from many.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from . import common as C

#: What names a message: of several with one conv_id and turn, `message` (64 bits of role and text) tells which.
MESSAGE = ["conv_id", "turn", "message"]
CALL = [*MESSAGE, "place"]
BODY = "content string, tool_call_id string, tool_calls array<struct<id:string,name:string,arguments:string,after:array<string>>>"
PARAMETERS = "name string, parameter string, type string, required boolean"
#: JSON kinds by what schema_of_variant says of a value.
TYPES = {"string": "^STRING", "integer": "^(BIGINT|TINYINT|SMALLINT|INT)", "number": "^(BIGINT|TINYINT|SMALLINT|INT|DOUBLE|FLOAT|DECIMAL)", "boolean": "^BOOLEAN", "object": "^OBJECT", "array": "^ARRAY"}


def _parsed(messages: DataFrame) -> DataFrame:
    body = F.when(F.col("text").rlike(r"^\s*\{"), F.from_json("text", BODY))
    rows = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")).where("conv_id is not null and turn is not null")
    return rows.withColumn("body", body).withColumn("message", F.xxhash64("role", "text"))


def _calls(rows: DataFrame) -> DataFrame:
    """One row for each call; of calls that repeat an id within a conversation the first owns it."""
    asking = rows.where("role = 'assistant' and body.tool_calls is not null").dropDuplicates(MESSAGE)
    calls = asking.select(*MESSAGE, F.posexplode("body.tool_calls").alias("place", "call")).select(*MESSAGE, "place", "call.*").where("id is not null")
    first = Window.partitionBy("conv_id", "id").orderBy("turn", "place", "name", "arguments", "message")
    return calls.withColumn("nth", F.row_number().over(first)).withColumn("repeated", F.col("nth") > 1).drop("nth")


def _levels(calls: DataFrame) -> DataFrame:
    """conv_id, id and level: 0 without known predecessors, else one more than the highest of them; none on a cycle."""
    own = calls.where("not repeated").select("conv_id", "id", "after")
    edges = own.select("conv_id", "id", F.explode(F.array_distinct("after")).alias("before")).where("before <> id")
    edges = C.materialize(edges.join(own.select("conv_id", F.col("id").alias("before")), ["conv_id", "before"], "left_semi").select("conv_id", "id", "before"), "edges")
    placed = own.join(edges, ["conv_id", "id"], "left_anti").select("conv_id", "id", F.lit(0).alias("level"))
    open_edges, level = edges, 0
    while not open_edges.isEmpty():
        level += 1
        placed = C.materialize(placed, "levels")
        waiting = open_edges.join(placed.select("conv_id", F.col("id").alias("before")), ["conv_id", "before"], "left_anti").select("conv_id", "id").distinct()
        ready = open_edges.select("conv_id", "id").distinct().join(waiting, ["conv_id", "id"], "left_anti")
        ready = C.materialize(ready, "ready")
        if ready.isEmpty():
            break
        placed = placed.unionByName(ready.withColumn("level", F.lit(level)))
        open_edges = C.materialize(open_edges.join(ready, ["conv_id", "id"], "left_anti"), "edges")
    return placed


def _problems(calls: DataFrame, parameters: DataFrame) -> DataFrame:
    """CALL, canonical arguments and the sorted problems of each call, those that repeat an id too."""
    calls = calls.select(*CALL, "name", F.try_parse_json("arguments").alias("args"))
    calls = calls.withColumn("canonical", F.to_json("args"))
    given = calls.where("args is not null").lateralJoin(calls.sparkSession.tvf.variant_explode(F.col("args").outer())).select(*CALL, "name", F.col("key").alias("parameter"), F.schema_of_variant("value").alias("kind")).where("parameter is not null")
    matches = F.coalesce(*(F.when(F.col("type") == t, F.col("kind").rlike(p)) for t, p in TYPES.items()), F.lit(True))
    known = parameters.withColumn("known", F.lit(True))
    wrong = given.join(known, ["name", "parameter"], "left").select(*CALL, F.when(F.col("known").isNull(), F.concat(F.lit("unknown parameter "), "parameter")).when(~matches, F.concat(F.lit("wrong type of "), "parameter")).alias("problem"))
    needed = calls.join(parameters.where("required"), "name").select(*CALL, "parameter")
    missing = needed.join(given.select(*CALL, "parameter"), [*CALL, "parameter"], "left_anti").select(*CALL, F.concat(F.lit("missing "), "parameter").alias("problem"))
    unnamed = calls.join(parameters.select("name").distinct(), "name", "left_anti").select(*CALL, F.lit("unknown tool").alias("problem"))
    broken = calls.where("args is null").select(*CALL, F.lit("arguments are not JSON").alias("problem"))
    all_ = wrong.where("problem is not null").unionByName(missing).unionByName(unnamed).unionByName(broken)
    return calls.select(*CALL, "canonical").join(all_.groupBy(*CALL).agg(F.array_sort(F.collect_set("problem")).alias("problems")), CALL, "left")


def format_chat(messages: DataFrame, parameters: DataFrame | None = None) -> DataFrame:
    """One row for each message: conv_id, turn, json, n_calls, n_linked, n_invalid.

    A message's calls stand in topological order (level, place); each carries its canonical arguments,
    its level (null on a cycle), the turn of its first result (null: none), and its problems. A tool
    message tells in `linked` whether a call with its id exists. Defined cases: null role or text is a
    JSON null; text that isn't a JSON object is content; a call without id is dropped from the calls;
    of calls with one id in a conversation the first owns it; later ones are marked `repeated`, keep their own
    name, arguments and problems, have neither level nor result, and stand last in their message; rows
    that repeat conv_id and turn each give a row with their own calls, equal rows the same line; texts of
    any length are content as they are; rows without conv_id or turn are left out; other
    columns are ignored; an empty table gives an empty result.
    """
    spark = messages.sparkSession
    if parameters is None:
        parameters = spark.range(0).select(*(F.lit(None).cast(kind).alias(name) for name, kind in (x.split() for x in PARAMETERS.split(", "))))
    rows = _parsed(messages)
    calls = C.materialize(_calls(rows), "calls")
    asks = rows.select(*MESSAGE, "role", "text", (F.col("role").eqNullSafe("assistant") & F.col("body.tool_calls").isNotNull()).alias("asks"), (F.col("role").eqNullSafe("tool") & F.col("body.tool_call_id").isNotNull()).alias("answers"), "body")
    plain = asks.where("not asks and not answers").select("conv_id", "turn", F.to_json(F.struct(F.col("text").alias("content"), "role"), {"ignoreNullFields": "false"}).alias("json"), *(F.lit(0).cast("long").alias(c) for c in ("n_calls", "n_linked", "n_invalid")))
    results = rows.where("role = 'tool' and body.tool_call_id is not null").groupBy("conv_id", F.col("body.tool_call_id").alias("id")).agg(F.min("turn").alias("result_turn"))
    owned = F.col("id").alias("owned")
    linked = calls.withColumn("owned", F.when(~F.col("repeated"), F.col("id"))).join(_levels(calls).select("conv_id", owned, "level"), ["conv_id", "owned"], "left").join(results.select("conv_id", owned, "result_turn"), ["conv_id", "owned"], "left").join(_problems(calls, parameters), CALL, "left")
    one = F.struct(F.col("level").isNull().alias("cyclic"), "level", "place", F.coalesce("canonical", F.to_json(F.struct("arguments"))).alias("arguments"), "id", "name", "problems", "repeated", "result_turn")
    per_message = linked.groupBy(*MESSAGE).agg(F.array_sort(F.collect_list(one)).alias("calls"), F.count("*").alias("n_calls"), F.count("result_turn").alias("n_linked"), F.sum((F.size(F.coalesce("problems", F.array())) > 0).cast("long")).alias("n_invalid"))
    ordered = F.expr("transform(calls, c -> struct(c.arguments, c.id, c.level, c.name, coalesce(c.problems, cast(array() as array<string>)) as problems, c.repeated, c.result_turn))")
    asked = asks.where("asks").join(per_message, MESSAGE, "left").select("conv_id", "turn", F.to_json(F.struct(F.col("body.content").alias("content"), "role", F.coalesce(ordered, F.array().cast("array<struct<arguments:string,id:string,level:int,name:string,problems:array<string>,repeated:boolean,result_turn:bigint>>")).alias("tool_calls")), {"ignoreNullFields": "false"}).alias("json"), *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_calls", "n_linked", "n_invalid")))
    owners = calls.where("not repeated").select("conv_id", "id", F.lit(True).alias("linked"))
    answered = asks.where("answers").withColumn("id", F.col("body.tool_call_id")).join(owners, ["conv_id", "id"], "left").select("conv_id", "turn", F.to_json(F.struct(F.col("body.content").alias("content"), F.coalesce("linked", F.lit(False)).alias("linked"), "role", F.col("id").alias("tool_call_id")), {"ignoreNullFields": "false"}).alias("json"), *(F.lit(0).cast("long").alias(c) for c in ("n_calls", "n_linked", "n_invalid")))
    return plain.unionByName(asked).unionByName(answered)


#: Parameters of the tool that `tool_traffic` calls.
ASK = [("ask", "chars", "integer", True), ("ask", "lang", "string", False), ("ask", "text", "string", True)]


def tool_traffic(conversations: DataFrame) -> DataFrame:
    """A table of conversations as tool traffic: each user turn is a call, the assistant turn after it its result.

    A call has the id `c<turn>`, builds on the call two turns before (but every eighth turn starts anew),
    and is in part faulty, by its turn and length: no `chars`, `chars` as a string, an unknown parameter,
    an unknown tool. Every thirteenth by length is followed by a second call of its id, with other arguments. Other turns stay as they are.
    """
    turn, n = F.col("turn"), F.length(F.coalesce("text", F.lit("")))
    id_of = lambda t: F.concat(F.lit("c"), t.cast("string"))
    chars = F.when(n % 5 == 0, F.lit("")).when(n % 5 == 1, F.concat(F.lit('"chars":"'), n.cast("string"), F.lit('",'))).otherwise(F.concat(F.lit('"chars":'), n.cast("string"), F.lit(",")))
    arguments = F.concat(F.lit("{"), chars, F.when(n % 7 == 0, F.lit('"mood":1,')).otherwise(""), F.lit('"text":'), F.to_json(F.struct(F.coalesce("text", F.lit("")).alias("t"))).substr(F.lit(6), F.lit(1 << 30)))
    call = F.struct(id_of(turn).alias("id"), F.when(n % 11 == 0, F.lit("seek")).otherwise(F.lit("ask")).alias("name"), arguments.alias("arguments"), F.when(turn % 8 >= 2, F.array(id_of(turn - 2))).otherwise(F.array().cast("array<string>")).alias("after"))
    again = F.struct(id_of(turn).alias("id"), F.lit("ask").alias("name"), F.concat(F.lit('{"chars":'), (n + 1).cast("string"), F.lit(',"lang":"de"}')).alias("arguments"), F.array().cast("array<string>").alias("after"))
    asked = F.to_json(F.struct(F.lit("").alias("content"), F.when(n % 13 == 0, F.array(call, again)).otherwise(F.array(call)).alias("tool_calls")))
    answered = F.to_json(F.struct(F.coalesce("text", F.lit("")).alias("content"), id_of(turn - 1).alias("tool_call_id")))
    user, assistant = F.col("role").eqNullSafe("user"), F.col("role").eqNullSafe("assistant")
    role = F.when(user, F.lit("assistant")).when(assistant, F.lit("tool")).otherwise(F.col("role"))
    return conversations.select("conv_id", "turn", role.alias("role"), F.when(user, asked).when(assistant, answered).otherwise(F.col("text")).alias("text"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table, which holds no call itself, seen as tool traffic, so that linking, order and checks have work."""
    names = [x.split()[0] for x in PARAMETERS.split(", ")]
    parameters = spark.range(1).select(F.inline(F.array(*(F.struct(*(F.lit(v).alias(name) for v, name in zip(row, names))) for row in ASK))))
    return format_chat(tool_traffic(spark.read.parquet(f"{sf_dir}/conversations.parquet")), parameters)


#: States links, levels, order and problems of the tool traffic straight from the turns.
ORACLE = """
WITH RECURSIVE m AS (
    SELECT conv_id, turn, role, text, length(text) AS n, 'c' || turn AS id, role = 'user' AS asks, role = 'assistant' AS answers FROM conversations
), linked AS (
    SELECT m.*, EXISTS (SELECT 1 FROM m o WHERE o.conv_id = m.conv_id AND o.asks AND o.turn = m.turn - 1) AS known,
        (SELECT min(o.turn) FROM m o WHERE o.conv_id = m.conv_id AND o.answers AND o.turn = m.turn + 1) AS result_turn,
        m.asks AND m.turn % 8 >= 2 AND EXISTS (SELECT 1 FROM m o WHERE o.conv_id = m.conv_id AND o.asks AND o.turn = m.turn - 2) AS builds
    FROM m
), levels AS (
    SELECT conv_id, turn, 0 AS level FROM linked WHERE asks AND NOT builds
    UNION ALL
    SELECT l.conv_id, l.turn, levels.level + 1 FROM levels JOIN linked l ON l.conv_id = levels.conv_id AND l.turn = levels.turn + 2 AND l.builds
), checked AS (
    SELECT linked.*, level,
        '{' || CASE WHEN n % 5 = 0 THEN '' WHEN n % 5 = 1 THEN '"chars":"' || n || '",' ELSE '"chars":' || n || ',' END || CASE WHEN n % 7 = 0 THEN '"mood":1,' ELSE '' END || '"text":' || CAST(to_json(text) AS VARCHAR) || '}' AS arguments,
        CASE WHEN n % 11 = 0 THEN CASE WHEN n % 5 <> 0 THEN ['unknown parameter chars'] ELSE CAST([] AS VARCHAR[]) END || CASE WHEN n % 7 = 0 THEN ['unknown parameter mood'] ELSE CAST([] AS VARCHAR[]) END || ['unknown parameter text', 'unknown tool']
            ELSE CASE WHEN n % 5 = 0 THEN ['missing chars'] ELSE CAST([] AS VARCHAR[]) END || CASE WHEN n % 7 = 0 THEN ['unknown parameter mood'] ELSE CAST([] AS VARCHAR[]) END || CASE WHEN n % 5 = 1 THEN ['wrong type of chars'] ELSE CAST([] AS VARCHAR[]) END END AS problems
    FROM linked LEFT JOIN levels USING (conv_id, turn)
)
SELECT conv_id, turn,
    CASE WHEN asks THEN CAST(to_json({content: '', role: 'assistant', tool_calls: [{arguments: arguments, id: id, level: level, name: CASE WHEN n % 11 = 0 THEN 'seek' ELSE 'ask' END, problems: problems, repeated: false, result_turn: result_turn}]
            || CASE WHEN n % 13 = 0 THEN [{arguments: '{"chars":' || (n + 1) || ',"lang":"de"}', id: id, level: NULL, name: 'ask', problems: ['missing text'], repeated: true, result_turn: NULL}] ELSE [] END}) AS VARCHAR)
        WHEN answers THEN CAST(to_json({content: text, linked: known, role: 'tool', tool_call_id: 'c' || (turn - 1)}) AS VARCHAR)
        ELSE CAST(to_json({content: text, role: role}) AS VARCHAR) END AS json,
    CASE WHEN asks AND n % 13 = 0 THEN 2 WHEN asks THEN 1 ELSE 0 END::BIGINT AS n_calls, CASE WHEN asks AND result_turn IS NOT NULL THEN 1 ELSE 0 END::BIGINT AS n_linked, (CASE WHEN asks AND len(problems) > 0 THEN 1 ELSE 0 END + CASE WHEN asks AND n % 13 = 0 THEN 1 ELSE 0 END)::BIGINT AS n_invalid
FROM checked
"""
