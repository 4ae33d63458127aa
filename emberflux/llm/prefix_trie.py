"""Operator 12: the trie of conversation prefixes, by mergeable partial tries.

A node is the sequence of the first d turns. Its key is a sum over these turns of 4 x 31 bits of
(role, text, place), so keys along a conversation are running sums, and a prefix needs no list of its turns.

1. Each partition combines the nodes of its rows; two hash-keyed merges, by (node, one of 32 groups of
   partitions), then by node, sum members and keep the smallest.
2. End lists are merged as ordered runs: ids sorted by (node, conv_id) over all partitions, packed into
   chunks of bounded size, and one pass over a node's chunks takes their digest.
3. Along a conversation c the smallest member grows up to c; so the nodes whose smallest member is c are one
   path, a chain, that hangs on a node of another chain. Totals of chains are rolled up over doubling
   distances in the tree of chains, those of nodes by running sums from the ends of the chains.

Running sums (`running`) work on ranges of sorted rows, with one row a range carried over, so a conversation
that holds a third of all rows is spread over many tasks as well.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

LANES = ["v0", "v1", "v2", "v3"]
#: Ids of an end list that travel as one row.
CHUNK = 50_000
ROOT = "0.0.0.0"


def running(rows: DataFrame, order: list, sums: list[str], tag: str) -> DataFrame:
    """`rows`, written out, with pos (0, 1, ... in each conv_id) and s_<x>, the sum of x up to the row, for each of `sums`."""
    place = F.monotonically_increasing_id()
    names = [*rows.columns, "block", "pos", *(f"s_{x}" for x in sums)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, last, at, total = TaskContext.get().partitionId(), None, 0, [0] * len(sums)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            key, i = batch.column("conv_id").to_numpy(), np.arange(n)
            new = np.append(key[0] != last, key[1:] != key[:-1])
            first = np.maximum.accumulate(np.where(new, i, -1))
            pos = i - np.where(first < 0, -1 - at, first)
            out = [pa.array(np.full(n, block, np.int32)), pa.array(pos)]
            for k, x in enumerate(sums):
                c = np.append(0, np.cumsum(batch.column(x).to_numpy()))
                s = c[1:] - np.where(first < 0, -total[k], c[first])
                total[k] = int(s[-1])
                out.append(pa.array(s))
            last, at = key[-1], int(pos[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, *out], names=names)

    kinds = ", ".join([*(f"`{c}` {t}" for c, t in rows.dtypes), "block int", "pos long", *(f"s_{x} long" for x in sums)])
    ordered = rows.withColumn("place", place)
    keys = ["conv_id", *order, "place"]
    local = C.materialize(ordered.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("place").mapInArrow(run, kinds), tag)
    # What a range's last conversation brings to the next range that has rows: a row for each range.
    counted = ["pos", *(f"s_{x}" for x in sums)]
    tails = local.groupBy("block").agg(F.max(F.struct("conv_id", *counted)).alias("x")).select("block", "x.*").withColumn("pos", F.col("pos") + 1)
    so_far = Window.partitionBy("conv_id").orderBy("block")
    carried = tails.select("conv_id", F.lead("block").over(Window.orderBy("block")).alias("block"), *(F.sum(c).over(so_far).alias(f"c_{c}") for c in counted))
    joined = local.join(F.broadcast(carried), ["conv_id", "block"], "left")
    return joined.select(*rows.columns, "block", *((F.col(c) + F.coalesce(f"c_{c}", F.lit(0))).alias(c) for c in counted))


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, depth, size, v0 to v3) and conversations (conv_id) with shared beginnings: the first h turns of
    c - c % 5 stand for the first h of c, h being crc32(c) % 9."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    half = lambda k: F.conv(F.substring(digest, k, 16), 16, -10).cast("long")
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.left(role, F.lit(32)).alias("role"), F.left(text, F.lit(32)).alias("text"), half(1).alias("c0"), half(17).alias("c1"), F.octet_length(text).cast("long").alias("size")).where("conv_id is not null")
    turns = running(turns, ["turn", "role", "text", "c0", "c1"], [], "turns").select("conv_id", "pos", "c0", "c1", "size")
    base, h = F.col("conv_id") - F.col("conv_id") % 5, F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    convs = C.materialize(turns.groupBy("conv_id").agg((F.max("pos") + 1).alias("n")).withColumn("base", base).withColumn("h", F.when(F.col("conv_id") == base, 0).otherwise(h)), "conversations")
    others = convs.where("h > 0")
    head = turns.where((F.col("pos") < 8) & (F.col("conv_id") == base)).withColumnRenamed("conv_id", "base")
    taken = others.select("conv_id", "base", "h").join(head, "base").where("pos < h").select("conv_id", "pos", "c0", "c1", "size")
    # Conversations whose beginnings are shorter than h, a row for each 65,536 of their turns, so that none is hot.
    short = others.join(convs.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base")), "base", "left").where("coalesce(n_base, 0) < h and n > h")
    short = short.select("conv_id", (F.col("h") - F.coalesce("n_base", F.lit(0))).alias("less"), F.explode(F.sequence(F.lit(0), F.shiftright("n", 16).cast("int"))).alias("part"))
    own = turns.where(F.col("pos") >= F.when(F.col("conv_id") == base, 0).otherwise(h)).withColumn("part", F.shiftright("pos", 16).cast("int"))
    own = own.join(short, ["conv_id", "part"], "left").select("conv_id", (F.col("pos") - F.coalesce("less", F.lit(0))).alias("pos"), "c0", "c1", "size")
    both = own.unionByName(taken)
    a, b = F.xxhash64("c0", "c1", "pos", F.lit(1)), F.xxhash64("c1", "c0", "pos", F.lit(2))
    values = [F.shiftrightunsigned(a, 33), a.bitwiseAND(0x7FFFFFFF), F.shiftrightunsigned(b, 33), b.bitwiseAND(0x7FFFFFFF)]
    return both.select("conv_id", (F.col("pos") + 1).alias("depth"), "size", *(v.alias(x) for v, x in zip(values, LANES))), convs.select("conv_id")


def nodes_and_ends(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (node, depth, parent, conv_id, n_convs, size), the root too, and ends (node, conv_id)."""
    sums = running(turns, ["depth"], LANES, "prefixes")
    node = F.concat_ws(".", *(f"s_{x}" for x in LANES))
    parent = F.concat_ws(".", *(F.col(f"s_{x}") - F.col(x) for x in LANES))
    rows = sums.select("conv_id", "depth", "size", "block", node.alias("node"), parent.alias("parent"))
    tables = rows.select("node", "depth", "parent", "size", (F.col("block") % 32).alias("part"), "conv_id", F.lit(1).cast("long").alias("n_convs"))
    for keys in (["node", "depth", "part"], ["node", "depth"]):
        tables = tables.groupBy(*keys).agg(F.min("parent").alias("parent"), F.min("size").alias("size"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"))
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(F.lit(ROOT).alias("node"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("string").alias("parent"), "conv_id", "n_convs", F.lit(0).cast("long").alias("size"))
    ends = rows.groupBy("conv_id").agg(F.max_by("node", "depth").alias("node"))
    ends = convs.join(ends, "conv_id", "left").select(F.coalesce("node", F.lit(ROOT)).alias("node"), "conv_id")
    return C.materialize(tables.select(*root.columns).unionByName(root), "nodes"), ends


def end_digests(ends: DataFrame) -> DataFrame:
    """node and ends_sha256 of each node that conversations end in."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []

        def done():
            return pa.RecordBatch.from_arrays([pa.array([node]), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])], names=["node", "first", "ids"])

        for batch in batches:
            for x, c in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()):
                if ids and (x != node or len(ids) == CHUNK):
                    yield done()
                    ids = []
                node = x
                ids.append(c)
        if ids:
            yield done()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            names, found = [], []
            for x, ids in zip(batch.column("node").to_pylist(), batch.column("ids")):
                if x == node:
                    state.update(b",")
                else:
                    if state:
                        names.append(node)
                        found.append(state.hexdigest())
                    node, state = x, hashlib.sha256()
                state.update(ids.as_buffer())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(found, pa.string())], names=["node", "ends_sha256"])
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([state.hexdigest()])], names=["node", "ends_sha256"])

    chunks = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id").mapInArrow(pack, "node string, first long, ids string")
    return chunks.repartition("node").sortWithinPartitions("node", "first").mapInArrow(digest, "node string, ends_sha256 string")


def _chain_totals(chains: DataFrame) -> DataFrame:
    """conv_id, n_leaves and saved of each chain with all chains below it. `chains` has conv_id, above, n_leaves and saved.

    Round r adds what lies 2^r to 2^(r+1) - 1 chains below; a chain without one that far above leaves the table `links`.
    """
    totals = chains.select("conv_id", "n_leaves", "saved")
    links = chains.where("above is not null").select("conv_id", "above")
    while not links.isEmpty():
        below = links.join(totals, "conv_id").groupBy(F.col("above").alias("conv_id")).agg(F.sum("n_leaves").alias("l"), F.sum("saved").alias("s"))
        totals = C.materialize(totals.join(below, "conv_id", "left").select("conv_id", (F.col("n_leaves") + F.coalesce("l", F.lit(0))).alias("n_leaves"), (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved")), "totals")
        up = links.select(F.col("conv_id").alias("above"), F.col("above").alias("next"))
        links = C.materialize(links.join(up, "above").select("conv_id", F.col("next").alias("above")), "links")
    return totals


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row for each node of the trie: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns are ordered by turn (null first); ties by the first 32 characters of role, then of text, then by
    the halves of md5 of `<characters of role>:<role><text>` as signed numbers. Defined cases: null role or text
    is empty; equal rows count each; rows without conv_id are left out; a negative c has c - c % 5 nearer to
    zero; texts of any length count by digest and size; conversations of up to 2^32 turns; other columns are
    ignored; an empty table gives no node, not even the root.
    """
    turns, convs = rebuilt(conversations)
    nodes, ends = nodes_and_ends(turns, convs)
    tops = nodes.groupBy("conv_id").agg(F.min(F.struct("depth", "parent")).alias("top"), F.max("depth").alias("deepest")).select("conv_id", "top.*", "deepest")
    hung = tops.join(nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("above")), "parent", "left")
    hung = C.materialize(hung.select("conv_id", "depth", "above", "deepest"), "chains")
    below = hung.where("above is not null").groupBy(F.col("above").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("hanging"))
    known = nodes.join(hung.select("conv_id", F.col("depth").alias("top"), "above", "deepest"), "conv_id").join(below, ["conv_id", "depth"], "left")
    children = F.coalesce("hanging", F.lit(0)) + (F.col("depth") < F.col("deepest")).cast("long")
    known = known.select("conv_id", "depth", "node", F.when(F.col("depth") == F.col("top"), F.col("above")).otherwise(F.col("conv_id")).alias("parent_conv_id"), "n_convs", children.alias("n_children"), (children == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("size")).alias("saved"))
    known = C.materialize(known, "known")
    chains = known.groupBy("conv_id").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved")).join(hung.select("conv_id", "above", (F.col("depth") - 1).alias("at")), "conv_id")
    chains = C.materialize(chains, "chain_sums")
    under = _chain_totals(chains).join(chains.where("above is not null").select("conv_id", "above", "at"), "conv_id").groupBy(F.col("above").alias("conv_id"), F.col("at").alias("depth")).agg(F.sum("n_leaves").alias("l"), F.sum("saved").alias("s"))
    full = known.join(under, ["conv_id", "depth"], "left").withColumn("n_leaves", F.col("n_leaves") + F.coalesce("l", F.lit(0))).withColumn("saved", F.col("saved") + F.coalesce("s", F.lit(0))).drop("l", "s").withColumn("back", -F.col("depth"))
    rolled = running(full, ["back"], ["n_leaves", "saved"], "rolled")
    nobody = F.sha2(F.lit("").cast("binary"), 256)
    return rolled.join(end_digests(ends), "node", "left").select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("s_n_leaves").alias("n_leaves"), F.col("s_saved").alias("saved_tokens"), F.coalesce("ends_sha256", nobody).alias("ends_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


#: States rebuilding, nodes and sums of subtrees straight from paths of digests, 33 characters a turn.
ORACLE = f"""
WITH {C.CRC_TABLE}, m AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT conv_id, conv_id - conv_id % 5 AS base, n, CASE WHEN conv_id % 5 = 0 THEN 0 ELSE {C.crc32_sql("CAST(conv_id AS VARCHAR)")} % 9 END AS h
    FROM (SELECT conv_id, count(*) AS n FROM m GROUP BY conv_id), tab
), turns AS (
    SELECT c.conv_id, m.pos, role, text FROM convs c JOIN m ON m.conv_id = c.base AND m.pos < c.h
    UNION ALL
    SELECT c.conv_id, m.pos - c.h + least(c.h, coalesce(b.n, 0)), role, text FROM convs c JOIN m ON m.conv_id = c.conv_id AND m.pos >= c.h LEFT JOIN convs b ON b.conv_id = c.base
), paths AS (
    SELECT conv_id, pos + 1 AS depth, string_agg(md5(length(role) || ':' || role || text), ',') OVER (PARTITION BY conv_id ORDER BY pos) AS path, octet_length(encode(text)) AS size FROM turns
    UNION ALL
    SELECT conv_id, 0, '', 0 FROM convs
), nodes AS (
    SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(size) AS saved, left(path, greatest(33 * (depth - 1) - 1, 0)) AS above FROM paths GROUP BY path, depth
), children AS (
    SELECT p.path, p.depth, count(c.path) AS n_children FROM nodes p LEFT JOIN nodes c ON c.above = p.path AND c.depth = p.depth + 1 GROUP BY p.path, p.depth
), below AS (
    SELECT left(path, greatest(33 * d - 1, 0)) AS path, d AS depth, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved_tokens
    FROM (SELECT nodes.path, nodes.saved, n_children, unnest(range(nodes.depth + 1)) AS d FROM nodes JOIN children ON children.path = nodes.path AND children.depth = nodes.depth)
    GROUP BY 1, 2
), ends AS (
    SELECT path, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids FROM (SELECT conv_id, arg_max(path, depth) AS path FROM paths GROUP BY conv_id) GROUP BY path
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes n JOIN children c ON c.path = n.path AND c.depth = n.depth JOIN below b ON b.path = n.path AND b.depth = n.depth
LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.above AND p.depth = n.depth - 1 LEFT JOIN ends e ON e.path = n.path
"""
