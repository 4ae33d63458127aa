"""Operator 5: personal data, by patterns and by what terms disclose, in DataFrame functions only.

Base spans come from four patterns. Beyond them, corpus co-occurrence estimates how strongly a term
discloses a protected value e (any valid address or number of a base span): once the term t is known,
-log2 P(e|t) bits about e are left, P(e|t) being n_te / n_t. n_t counts documents with t, n_te those with t near e, on
one line. Nothing else enters, so documents that hold neither t nor e change no verdict. Every value
and every term near it is judged; thin evidence is shrunk and not left out: P(e|t) is the lower Wilson bound of its
share, with as many trials as different lines support, so that copies prove nothing and a word seen
three times or less has always more than a bit left. Terms that leave `remove` bits or fewer are removed, those that
leave `generalise` or fewer replaced by their class (a name if written with a capital, else a
term), where they stand in a document that holds e.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from . import common as C

KINDS = ("email", "ip", "card", "phone", "term", "general", "name")
#: The patterns of the contract; atomic and anchored forms that match the same spans without quadratic retries.
PATTERNS = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    r"[0-9](?:[\x20-]?+[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
TERM = r"\p{L}{3,}"
#: What names a row: see common.keyed.
ROW = ["doc_id", "row_key"]
SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    digits = F.reverse(_digits(value))

    def term(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int") * (F.lit(2) - i % 2)
        return d - F.when(d > 9, 9).otherwise(0)

    total = F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), term), F.lit(0), lambda a, b: a + b)
    return F.length(digits).between(12, 19) & F.when(F.length(digits).between(12, 19), total % 10 == 0).otherwise(False)


_VALID = (
    lambda v: F.lit(True),
    lambda v: v.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"),
    _luhn,
    lambda v: F.length(_digits(v)).between(9, 15),
)
_NEEDS = (r"@", r"[0-9]\.[0-9]", r"[0-9][\x20-]?[0-9]", r"\+[0-9]")


def _of_kind(k: int):
    return lambda x: x.kind == k


def _holds_private() -> Column:
    """Whether a text has a valid match of some pattern."""
    each = [F.when(F.col("text").rlike(need), F.exists(F.regexp_extract_all("text", F.lit(p), F.lit(0)), valid)).otherwise(F.lit(False)) for p, need, valid in zip(PATTERNS, _NEEDS, _VALID)]
    return F.coalesce(each[0] | each[1] | each[2] | each[3], F.lit(False))


def _matches(rows: DataFrame, pattern: str, kind: int) -> DataFrame:
    """Rows of ROW, kind, start, end, value, and the text before and after, of every match of a pattern.

    What lies between matches gives their places, by a running sum over the text's own matches.
    """
    both = F.arrays_zip(F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("m"), F.split("text", pattern, -1).alias("s"))
    each = rows.select(*ROW, F.posexplode(both).alias("i", "x")).select(*ROW, "i", "x.m", "x.s")
    order = Window.partitionBy(*ROW).orderBy("i")
    end = F.sum(F.length("s") + F.coalesce(F.length("m"), F.lit(0))).over(order).cast("int")
    placed = each.select(*ROW, F.lit(kind).alias("kind"), end.alias("end"), F.col("m").alias("value"), F.col("s").alias("before"), F.lead("s").over(order).alias("after"))
    return placed.where(F.col("value").isNotNull()).withColumn("start", F.col("end") - F.length("value"))


def base_spans(rows: DataFrame, reach: int) -> DataFrame:
    """The valid base spans of rows with ROW and text, one a row, with their entity and what stands near."""
    out = None
    for k, (pattern, need) in enumerate(zip(PATTERNS, _NEEDS)):
        mine = _matches(rows.where(F.col("text").rlike(need)), pattern, k).where(_VALID[k](F.col("value")))
        out = mine if out is None else out.unionByName(mine)
    near = F.concat_ws(" ", F.right(F.substring_index("before", "\n", -1), F.lit(reach)), F.left(F.substring_index("after", "\n", 1), F.lit(reach)))
    return out.select(*ROW, "start", "kind", "end", "value", F.lower("value").alias("entity"), F.regexp_replace(F.lower(near), PATTERNS[0], " ").alias("near"))


def _written(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x.kind), x.start.cast("string"), x.end.cast("string"))), ",")


def mentions(base: DataFrame) -> DataFrame:
    """doc_id, row_key, entity, near_id and terms of each mention of a protected value."""
    return base.select(*ROW, "entity", F.xxhash64("near").alias("near_id"), F.array_distinct(F.regexp_extract_all("near", F.lit(TERM), F.lit(0))).alias("terms"))


def judged_terms(told: DataFrame, docs: DataFrame, z: float, most_bits: float) -> DataFrame:
    """entity, term and bits left of each term near a protected value that leaves `most_bits` or fewer. `told` is what `mentions` gives."""
    pairs = told.select("doc_id", "entity", "near_id", F.explode("terms").alias("term"))
    pairs = pairs.groupBy("entity", "term").agg(F.countDistinct("doc_id").alias("n_te"), F.countDistinct("near_id").alias("n_lines"))
    # With n of n trials the bound is n / (n + z^2), and further trials only lower it: fewer can't be enough.
    share = 2.0**-most_bits
    pairs = pairs.where(F.least("n_te", "n_lines") >= z * z * share / (1 - share))
    words = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(TERM), F.lit(0)))).alias("term"))
    totals = words.groupBy("term").agg(F.count("*").alias("n_t"))
    p = F.least(F.col("n_te") / F.col("n_t"), F.lit(1.0))
    trials = F.least("n_te", "n_lines") / p
    low = (p + z * z / 2 / trials - z * F.sqrt(p * (1 - p) / trials + z * z / 4 / trials / trials)) / (1 + z * z / trials)
    return pairs.join(totals, "term").select("entity", "term", (-F.log2(low)).alias("bits")).where(F.col("bits") <= most_bits)


def disclosing_terms(rows: DataFrame, base: DataFrame, docs: DataFrame, remove: float, generalise: float, z: float) -> DataFrame:
    """The spans of the terms to remove and to generalise, in rows that hold the value they tell of."""
    told = mentions(base)
    bits = judged_terms(told, docs, z, generalise)
    # What each row is to lose, by row and term, so that a common term is no hot key.
    here = told.select(*ROW, "entity").distinct().join(bits, "entity").groupBy(*ROW, "term").agg(F.min("bits").alias("bits"))
    words = _matches(rows, TERM, 0).select(*ROW, "start", "end", "value", F.lower("value").alias("term"))
    return words.join(here, [*ROW, "term"]).select(*ROW, "start", F.when(F.col("bits") <= remove, 4).when(F.col("value").rlike(r"^\p{Lu}"), 6).otherwise(5).alias("kind"), "end", "value")


def _arrays(base: DataFrame, terms: DataFrame, block: int = 512) -> DataFrame:
    """ROW with the arrays base and spans, and blocks of cuts: the spans that start after the ends of all before.

    A term span that overlaps a base span is left out.
    """
    rows = base.select(*terms.columns).unionByName(terms)
    order = Window.partitionBy(*ROW).orderBy("start", "kind")
    own = F.col("kind") < 4
    before = F.max(F.when(own, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(own, F.col("start"))).over(Window.partitionBy(*ROW).orderBy(F.desc("start"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1))
    clear = own | (F.coalesce(before, F.lit(0)) <= F.col("start")) & (F.coalesce(after, F.col("end")) >= F.col("end"))
    rows = rows.withColumn("clear", clear).where("clear")
    # In blocks, so that a cut of the text is taken from its block's part and not from the whole text each time.
    rows = rows.withColumn("at", F.coalesce(F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("block", F.floor(F.row_number().over(order) / block).cast("int"))
    span, cut = F.struct("start", "kind", "end", "value"), F.when(F.col("start") >= F.col("at"), F.struct("start", "at", "kind"))
    blocks = rows.groupBy(*ROW, "block").agg(F.collect_list(F.when(own, span)).alias("base"), F.collect_list(span).alias("spans"), F.sort_array(F.collect_list(cut)).alias("cuts"))
    flat = lambda c: F.sort_array(F.flatten(F.collect_list(c))).alias(c)
    cuts = F.filter(F.transform(F.sort_array(F.collect_list(F.struct("block", "cuts"))), lambda x: x.cuts), lambda x: F.size(x) > 0)
    return blocks.groupBy(*ROW).agg(flat("base"), flat("spans"), cuts.alias("cuts"))


def find_private(documents: DataFrame, *keep: str, remove: float = 0.3, generalise: float = 1.0, z: float = 1.96, reach: int = 200) -> DataFrame:
    """doc_id, text, the columns `keep`, base spans, all spans, and cuts (see `sanitized`) of each document.

    A span has start, kind (place in KINDS), end (code points, end exclusive) and value; arrays are
    ordered by start, then kind. A term is near a value if it stands on the value's line, at most `reach`
    characters away, with no other match of the value's pattern in between. Defined cases: a null or empty
    text has no spans; rows that repeat a doc_id each give a row, with the terms that its own text's
    values disclose; very long texts take work in proportion to their length and spans; rows without
    doc_id are left out; an empty table gives an empty result.
    """
    docs = C.keyed(C.documents(documents, *keep))
    rows = C.materialize(docs.select(*ROW, "text").where(_holds_private()), "private").dropDuplicates(ROW)
    base = C.materialize(base_spans(rows, reach), "base_spans")
    known = _arrays(base, disclosing_terms(rows, base, docs, remove, generalise, z))
    none = F.array().cast(SPAN)
    return docs.join(known, ROW, "left").select("doc_id", "text", *keep, F.coalesce("base", none).alias("base"), F.coalesce("spans", none).alias("spans"), "cuts")


def sanitized() -> Column:
    """The text of a find_private row, base spans and generalised terms replaced by their kind, other terms removed."""
    text = F.coalesce("text", F.lit(""))
    names = F.array(*(F.lit(x) for x in ("<EMAIL>", "<IP>", "<CARD>", "<PHONE>", "", "<TERM>", "<NAME>")))

    def pieces(block: Column) -> Column:
        first, last = F.get(block, F.lit(0)), F.element_at(block, -1)
        part = F.substring(text, first["at"] + 1, last["start"] - first["at"])
        return F.flatten(F.transform(F.array(part), lambda t: F.transform(block, lambda x: F.concat(F.substring(t, x["at"] - first["at"] + 1, x.start - x["at"]), F.get(names, x.kind)))))

    end = F.array_max(F.transform("spans", lambda x: x.end))
    whole = F.concat(F.array_join(F.flatten(F.transform("cuts", pieces)), ""), F.substring(text, end + 1, F.length(text)))
    return F.when(F.size("spans") == 0, F.col("text")).otherwise(whole)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_private(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    counts = [F.size(F.filter("base", _of_kind(k))).cast("long").alias(f"n_{KINDS[k]}") for k in range(4)]
    return found.select("doc_id", *counts, F.sha2(_written(F.col("base")), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"), sanitized().alias("sanitized"))
