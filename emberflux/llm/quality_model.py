"""Operator 2: quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or abstain on every document. Expectation-maximisation
over the counts of vote patterns (at most 3^labellers rows, whatever the corpus) estimates each
labeller's accuracy and a posterior for each pattern. Posteriors of a bounded sample label the
training of a hashed linear scorer, which then scores every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

#: What the labellers measure, per document, all over its whole text.
MEASURES = ("n_words", "symbols", "upper", "repeats", "dup_lines", "word_length", "exclaims", "digits")
_CLASS = np.zeros(256, np.uint8)
_CLASS[ord("a") : ord("z") + 1] = 1
_CLASS[128:] = 1
_CLASS[ord("A") : ord("Z") + 1] = 2
_CLASS[ord("0") : ord("9") + 1] = 4
_CLASS[[ord(c) for c in ".,;:?!'\"()-"]] = 8
_CLASS[[ord(c) for c in "#*$%&|<>@^~_=+{}[]\\/`"]] = 16
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def votes() -> list[Column]:
    """1 good, 0 bad, -1 abstains. A text without words earns no good vote and a bad one."""
    bad = lambda condition: F.when(condition, 0).otherwise(-1)
    return [
        bad((F.col("symbols") > 0.05) | (F.col("n_words") == 0)),
        bad(F.col("symbols") > 0.01 * F.col("word_length")),
        bad(F.col("upper") > 0.4),
        bad(F.col("exclaims") > 0.1),
        bad(F.col("repeats") > 0.15),
        bad(F.col("dup_lines") > 0.2),
        bad(F.col("digits") > 0.3),
        F.when((F.col("n_words") > 0) & (F.col("symbols") < 0.02) & (F.col("upper") < F.when(F.col("n_words") < 20, 0.4).otherwise(0.15)) & (F.col("repeats") < 0.1) & (F.col("exclaims") < 0.05), 1).otherwise(-1),
    ]


#: What is expected of a labeller before any data: shares of good, bad and abstaining votes, given a good and a bad document.
EXPECTED = np.array([[0.45, 0.03, 0.52], [0.1, 0.4, 0.5]])


def _scan(raw: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Measures of each document, and its hashed features as (index, value)."""
    starts, ends, first = C.word_bounds(raw, offsets)
    low = _LOWER[raw]
    words = C.word_hashes(low, starts, ends, 0)
    kinds = _CLASS[raw]
    sizes = (ends - starts).astype(np.int64)
    at = np.stack([starts, ends], 1).ravel()
    # the extra 0 lets reduceat take an end at the end of the buffer
    shape = np.bitwise_or.reduceat(np.append(kinds, np.uint8(0)), at)[::2] if len(at) else np.zeros(0, np.uint8)
    count = lambda k: np.concatenate(([0], np.cumsum(kinds == k)))
    lower, upper, digit, symbol = (count(k) for k in (1, 2, 4, 16))
    loud = np.concatenate(([0], np.cumsum(low == 33)))
    measures, features = np.zeros((len(offsets) - 1, len(MEASURES))), []
    for i, (a, b, x, y) in enumerate(zip(first[:-1], first[1:], offsets[:-1], offsets[1:])):
        n, chars = int(b - a), max(1, int(y - x))
        if n:
            own = words[a:b]
            grams = C.mix(own[:-4] + np.uint64(3) * own[1:-3] + np.uint64(5) * own[2:-2] + np.uint64(7) * own[3:-1] + np.uint64(11) * own[4:]) if n > 4 else own[:0]
            lines = [s for s in raw[x:y].tobytes().split(b"\n") if s.strip()]
            letters = max(1, int(lower[y] - lower[x] + upper[y] - upper[x]))
            measures[i] = (n, (symbol[y] - symbol[x]) / n, (upper[y] - upper[x]) / letters, 1 - len(np.unique(grams)) / max(1, len(grams)), 1 - len(set(lines)) / max(1, len(lines)), sizes[a:b].mean(), (loud[y] - loud[x]) / n, (digit[y] - digit[x]) / chars)
        mask = np.uint64((1 << bits) - 1)
        shapes = C.mix((shape[a:b].astype(np.uint64) << np.uint64(8)) + np.minimum(sizes[a:b], 20).astype(np.uint64) + np.uint64(1 << 40)) & mask
        m = measures[i]
        levels = np.array([*(int(min(20, 40 * v)) for v in m[1:5]), int(min(20, m[5])), int(min(20, 60 * m[6])), int(min(20, 40 * m[7]))], np.uint64)
        levels = C.mix(levels + np.arange(1, 8, dtype=np.uint64) * np.uint64(1 << 50)) & mask
        idx, times = np.unique(np.concatenate((words[a:b] & mask, shapes)), return_counts=True)
        features.append((np.concatenate((idx, levels)).astype(np.int32), np.concatenate((times / (n + 30.0), np.ones(len(levels)))).astype(np.float32)))
    return measures, features


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, text and MEASURES."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slices(batches):
            found = _scan(*C.flat(batch.column("text")), 12)[0]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), *(pa.array(x) for x in found.T)], names=["doc_id", "text", *MEASURES])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, text string, " + ", ".join(f"{x} double" for x in MEASURES))


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, strength: float = 0.05, rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """Posterior that a pattern's documents are good, and each labeller's vote shares given good and bad.

    patterns: one row of votes (1, 0, -1) for each pattern. Labellers are taken as independent given
    the class; `strength` times the number of documents is the weight of EXPECTED in the estimates,
    which also fixes which class is the good one.
    """
    good, bad = (patterns == 1).sum(1), (patterns == 0).sum(1)
    post = (good + 0.5) / (good + bad + 1.0)
    for _ in range(rounds):
        mass = np.stack([post * counts, (1 - post) * counts])
        prior = (mass.sum(1) + 1) / (mass.sum() + 2)
        shares = np.stack([[(mass[c][:, None] * (patterns == v)).sum(0) + strength * counts.sum() * EXPECTED[c][k] for k, v in enumerate((1, 0, -1))] for c in (0, 1)])
        shares /= shares.sum(1, keepdims=True)
        log = [np.log(prior[c]) + sum((patterns == v) @ np.log(shares[c][k]) for k, v in enumerate((1, 0, -1))) for c in (0, 1)]
        new = 1 / (1 + np.exp(np.clip(log[1] - log[0], -500, 500)))
        done = np.abs(new - post).max() < 1e-9
        post = new
        if done:
            break
    return post, shares


def weak_labels(docs: DataFrame) -> tuple[DataFrame, int]:
    """votes and posterior of every pattern that occurs (at most 3^8), from all documents, and the number of those."""
    rows = measured(docs).select(F.array(*votes()).alias("votes")).groupBy("votes").agg(F.count("*").alias("n")).collect()  # at most 3^8 patterns
    schema = "votes array<int>, posterior double"
    if not rows:
        return docs.sparkSession.createDataFrame([], schema), 0
    post, _ = expectation_maximisation(np.array([r["votes"] for r in rows]), np.array([r["n"] for r in rows], float))
    return docs.sparkSession.createDataFrame([(r["votes"], float(p)) for r, p in zip(rows, post)], schema), sum(r["n"] for r in rows)


def train(sample: DataFrame, bits: int, rounds: int = 30, rate: float = 0.5) -> tuple[np.ndarray, float]:
    """Weights and bias by AdaGrad on the soft labels of (text, posterior) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slices(batches):
            found = _scan(*C.flat(batch.column("text")), bits)[1]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([x[0] for x in found], pa.list_(pa.int32())), pa.array([x[1] for x in found], pa.list_(pa.float32())), batch.column("posterior")], names=["doc_id", "idx", "val", "posterior"])

    weights, bias, sums, own = np.zeros(1 << bits), 0.0, np.full(1 << bits, 1e-6), 1e-6
    rows = sorted(sample.mapInArrow(run, "doc_id long, idx array<int>, val array<float>, posterior double").collect())
    rows = [(np.array(r["idx"], np.int64), np.array(r["val"]), r["posterior"]) for r in rows]
    order = np.random.default_rng(7)
    for _ in range(rounds if rows else 0):
        for i in order.permutation(len(rows)):
            idx, val, target = rows[i]
            slope = 1 / (1 + np.exp(-np.clip(bias + weights[idx] @ val, -30, 30))) - target
            step = slope * val
            sums[idx] += step * step
            weights[idx] -= rate * step / np.sqrt(sums[idx])
            own += slope * slope
            bias -= rate * slope / np.sqrt(own)
    return weights, bias


def score(docs: DataFrame, weights: np.ndarray, bias: float, bits: int) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast((weights, bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, b = sent.value
        for batch in C.slices(batches):
            found = _scan(*C.flat(batch.column("text")), bits)[1]
            margin = np.array([b + w[i] @ v for i, v in found])
            words = np.array([len(v) > 7 for _, v in found])  # beyond the seven levels that every text has
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.where(words, 1 / (1 + np.exp(-np.clip(margin, -30, 30))), 0.0))], names=["doc_id", "score"])

    return docs.mapInArrow(run, "doc_id long, score double")


def quality_model(documents: DataFrame, sample_rows: int = 4000, bits: int = 15, keep_at: float = 0.5) -> DataFrame:
    """doc_id, score (0 to 1) and kept of each document.

    The scorer is fitted on at most `sample_rows` documents, those with the smallest hashes of doc_id and
    text. Defined cases: null and empty texts have zero measures, a bad vote, and score 0; very long texts
    are scored whole; rows that repeat a doc_id each give a row by their own text; rows without doc_id are
    left out; other columns are ignored; an empty table gives an empty result.
    """
    docs = C.documents(documents)
    patterns, total = weak_labels(docs)
    order = F.xxhash64("doc_id", "text")
    likely = docs.where(F.pmod(order, F.lit(1 << 20)) <= 2.0 * sample_rows / max(1, total) * (1 << 20))
    chosen = likely.select("doc_id", "text", order.alias("h")).orderBy("h", "doc_id").limit(sample_rows)
    sample = measured(chosen).withColumn("votes", F.array(*votes())).join(F.broadcast(patterns), "votes").select("doc_id", "text", "posterior")
    weights, bias = train(sample, bits)
    return score(docs, weights, bias, bits).select("doc_id", "score", (F.col("score") >= keep_at).alias("kept"))


def op2_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model(spark.read.parquet(f"{sf_dir}/documents.parquet"))
