"""Operator 13: spelling variants, by errata-trie merging over heavy paths.

The words form a trie. At each node the heavy child has the most words; the others, and a word that ends at
the node, are light, so a word is light at a logarithmic number of nodes at most. Two words that differ
by one edit part at one node v, where at least one of them is light, and the edit can be read there. So the light
subtrees are merged with one character skipped or replaced, small into large:

- y t of a light subtree, y replaced by the heavy h: does v h t stand in the heavy subtree?
- y skipped: does v t stand anywhere below v (and not below y, where the two would part later)?
- h put before y t, or before the end: does v h y t stand in the heavy subtree?
- light among light: terminals of one v * t coincide; there are no more of them than letters.

Each pair is met once. The trie is a table of (prefix, next letter, words): a node's row is known by a hash
of its prefix, which only chooses the heavy letter. Lookups compare whole words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

#: Words are maximal runs of these; only A-Z are lower-cased.
LETTERS = "A-Za-zÀ-ÿ"
#: Up to this depth a trie has at most 1 + 90 + 90 * 90 nodes, as there are 26 + 64 letters.
SHALLOW = 2
#: Doublings that follow any sequence of forms: n grows five times at each of them, below 2^63.
DOUBLINGS = 5


def _counted(docs: DataFrame, least: int, drop: int | None, most: int = 400_000) -> DataFrame:
    """(word, n) as each partition counts them; a word may come several times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, total = re.compile(f"[{LETTERS}]{{{least},}}").findall, Counter()

        def done():
            return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

        for batch in C.slices(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                start = zlib.crc32(b"%d:" % doc_id)
                for run, n in Counter(find((text.as_py() or "").encode().lower().decode())).items():
                    if drop:
                        h = zlib.crc32(run.encode(), start)
                        if h % drop == 0:
                            k = h % len(run)
                            run = run[:k] + run[k + 1 :]
                            if len(run) < least:
                                continue
                    total[run] += n
            if len(total) > most:
                yield done()
                total.clear()
        if total:
            yield done()

    return docs.mapInArrow(run, "word string, n long")


def _branches(words: DataFrame) -> DataFrame:
    """(prefix, depth, letter, id) of each place of each word; letter 0 is its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slices(batches, "word", 1 << 18):
            raw = "".join(batch.column("word").to_pylist()).encode("utf-32-le")
            letters, sizes = np.frombuffer(raw, np.uint32), np.array([len(x) for x in batch.column("word").to_pylist()])
            sums = C.prefix_sums(C.mix(letters.astype(np.uint64) + np.uint64(1)), 0)
            first, n = np.cumsum(sizes) - sizes, sizes + 1
            depth = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            start = np.repeat(first, n)
            ends = depth == np.repeat(sizes, n)
            letter = np.where(ends, 0, letters.take(start + depth, mode="clip")).astype(np.int32)
            prefix = C.range_hash(sums, start, start + depth, 0).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(prefix), pa.array(depth.astype(np.int32)), pa.array(letter), pa.array(np.repeat(batch.column("id").to_numpy(), n))], names=["prefix", "depth", "letter", "id"])

    return words.select("id", "word").mapInArrow(run, "prefix long, depth int, letter int, id long")


def _light_places(words: DataFrame) -> DataFrame:
    """(id, at, heavy): the nodes on the way of a word where it is light, by depth, and their heavy letters."""
    branches = _branches(words)
    sizes = branches.groupBy("prefix", "depth", "letter").agg(F.count("*").alias("n"))
    nodes = sizes.groupBy("prefix", "depth").agg(F.count("*").alias("kinds"), F.max(F.struct(F.col("letter") > 0, "n", -F.col("letter"))).alias("x"))
    heavy = C.materialize(nodes.where("kinds > 1").select("prefix", "depth", (-F.col("x.col3")).alias("heavy")), "heavy")
    near, far = F.broadcast(heavy.where(F.col("depth") <= SHALLOW)), heavy.where(F.col("depth") > SHALLOW)
    both = branches.where(F.col("depth") <= SHALLOW).join(near, ["prefix", "depth"]).unionByName(branches.where(F.col("depth") > SHALLOW).join(far, ["prefix", "depth"]))
    return both.where("letter <> heavy").select("id", F.col("depth").alias("at"), "heavy")


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best): how many words are one edit away, and the one of largest n, as (-n, word).

    `words` has id, word and n; words without near ones give no row.
    """
    light = C.materialize(_light_places(words).join(words, "id").select("word", "n", "at", F.chr("heavy").alias("h")), "light")
    v, y, rest, t = F.expr("left(word, at)"), F.expr("substring(word, at + 1, 1)"), F.expr("substring(word, at + 1)"), F.expr("substring(word, at + 2)")
    keys = F.array(
        F.when(y != "", F.concat(v, "h", t)),
        F.when((y != "") & (F.left(t, F.lit(1)) != y), F.concat(v, t)),
        F.concat(v, "h", rest),
    )
    probes = light.select("word", "n", F.explode(F.array_compact(keys)).alias("other"))
    pairs = probes.join(words.select(F.col("word").alias("other"), F.col("n").alias("m")), "other")
    one = F.lit(1).cast("long").alias("n_near")
    met = pairs.select(F.explode(F.array(F.struct("word", one, F.struct((-F.col("m")).alias("m"), F.col("other").alias("w")).alias("best")), F.struct(F.col("other").alias("word"), one, F.struct((-F.col("n")).alias("m"), F.col("word").alias("w")).alias("best")))).alias("x")).select("x.*")
    groups = light.where(y != "").groupBy(F.concat(v, F.lit("*"), t).alias("key")).agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("m"), F.col("word").alias("w")))).alias("all")).where(F.size("all") > 1)
    same = groups.select(F.explode("all").alias("own"), "all").select(F.col("own.w").alias("word"), (F.size("all") - 1).cast("long").alias("n_near"), F.when(F.col("all")[0]["w"] != F.col("own.w"), F.col("all")[0]).otherwise(F.col("all")[1]).alias("best"))
    return met.unionByName(same).groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form)."""
    at = C.materialize(forms.select("word", F.col("form").alias("root")), "forms")
    for _ in range(DOUBLINGS):
        at = C.materialize(at.join(at.select(F.col("word").alias("root"), F.col("root").alias("next")), "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
    return at


def spelling_variants(documents: DataFrame, least_letters: int = 6, least_n: int = 5, times: int = 5, drop: int | None = 199) -> DataFrame:
    """One row for each word: word, form, root, n, n_near, form_n.

    Words are runs of letters, A-Z lower-cased, of `least_letters` code points and `least_n` occurrences at least;
    a word's form is the word one edit away that is most frequent (ties: the smallest by code points), if it is `times`
    times as frequent or more. `drop`: of a run whose crc32 of `<doc_id>:<run>` it divides, the code point at crc32
    modulo its length is deleted first (None: never). Defined cases: a null or empty text has no words; rows that
    repeat a doc_id or a text count each; very long texts and words take work in proportion to their length (times the
    places where a word is light); rows without doc_id are left out; other columns are ignored; an
    empty table gives an empty result. `times` below 5 would need more doublings and is refused.
    """
    if times < 5:
        raise ValueError("a form is at least 5 times as frequent")
    counted = _counted(C.documents(documents), least_letters, drop).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_n)
    words = C.materialize(counted.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "words")
    known = words.join(near_words(words), "word", "left")
    known = C.materialize(known.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(-F.col("best.m") >= times * F.col("n"), F.col("best")).alias("best")), "near")
    roots = _roots(known.where("best is not null").select("word", F.col("best.w").alias("form")))
    return known.join(roots, "word", "left").select("word", F.col("best.w").alias("form"), F.coalesce("root", "word").alias("root"), "n", "n_near", (-F.col("best.m")).alias("form_n"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: States words, all pairs by what one deletion leaves, and chains of forms.
ORACLE = f"""
WITH RECURSIVE {C.CRC_TABLE}, runs AS (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[{LETTERS}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents WHERE doc_id IS NOT NULL
), hashed AS (
    SELECT run, n, {C.crc32_sql("doc_id || ':' || run")} AS h FROM (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY doc_id, run), tab
), words AS (
    SELECT word, CAST(sum(n) AS BIGINT) AS n
    FROM (SELECT CASE WHEN h % 199 = 0 THEN left(run, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word, n FROM hashed)
    WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), less AS (
    SELECT word, n, i, left(word, i) || substr(word, i + 2) AS part FROM (SELECT word, n, CAST(unnest(range(length(word))) AS INT) AS i FROM words)
), near AS (
    SELECT a.word, b.word AS other, b.n AS m FROM less a JOIN less b ON a.part = b.part AND a.i = b.i AND a.word <> b.word
    UNION
    SELECT a.word, b.word, b.n FROM less a JOIN words b ON b.word = a.part
    UNION
    SELECT b.word, a.word, a.n FROM less a JOIN words b ON b.word = a.part
), best AS (
    SELECT word, count(*) AS n_near, arg_min(other, (-m, other)) AS other, max(m) AS m FROM near GROUP BY word
), forms AS (
    SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * n THEN other END AS form, CASE WHEN m >= 5 * n THEN m END AS form_n FROM words LEFT JOIN best ON best.word = words.word
), steps AS (
    SELECT word, word AS root, 0 AS k FROM forms
    UNION ALL
    SELECT steps.word, forms.form, k + 1 FROM steps JOIN forms ON forms.word = steps.root AND forms.form IS NOT NULL
)
SELECT forms.word, form, root, n, n_near, form_n FROM forms JOIN (SELECT word, arg_max(root, k) AS root FROM steps GROUP BY word) AS ends ON ends.word = forms.word
"""
