"""Super-k-mers: exact repeats of fixed-length windows, over words or bytes.

A window is `k` consecutive units (words or bytes) of one document. Its minimiser is the
`m`-unit gram with the smallest hash in it, leftmost on ties; neighbouring windows that have the
same minimiser occurrence form one super-k-mer. Equal windows have equal minimisers, so a repeat
can only lie in super-k-mers that share an anchor (the minimiser's hash):

1. every row gives its super-k-mers as (anchor, 128-bit key of the content, doc_id, row_key, start, n);
   doc_id and row_key (64 bits of the text) name a row, so rows that share a doc_id are told apart;
2. anchors that occur once are dropped by a count that combines on the map side;
3. equal super-k-mers are aggregated, so a group of copies is one row from here on;
4. where an anchor has several different super-k-mers, one copy of each is cut from its document
   and travels as one packed string to the anchor's bucket, where sorting settles its windows;
5. an anchor with more than `bucket_limit` different super-k-mers would make one bucket too large:
   its windows are dealt out one by one by a 128-bit key instead and counted by aggregation;
6. verdicts are joined back to all occurrences and come to documents as unit ranges.

Nothing is capped: every window is settled in step 3, 4 or 5.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

OCCURRENCES = "anchor long, k1 long, k2 long, doc_id long, row_key long, start int, n int, pos int"
PACKED = "anchor long, k1 long, k2 long, n int, pos int, first_doc long, total long, packed binary"
#: Runs of windows [a, b) of a super-k-mer: the smallest doc_id they start in, and how often they start anywhere.
VERDICT = "anchor long, k1 long, k2 long, runs array<struct<a:int,b:int,first_doc:long,total:long>>"


@dataclass(frozen=True)
class Windows:
    """k units to a window, m to a minimiser gram; unit is 'word' or 'byte'."""

    unit: str
    k: int
    m: int

    @property
    def slice(self) -> int:
        """Bytes of text to work on at once: arrays hold a value for each byte, or for each word, which is several bytes."""
        return 1 << 19 if self.unit == "byte" else 1 << 20

    def units(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Start and end byte of each unit, first unit of each document, and two values per unit."""
        if self.unit == "byte":
            at = np.arange(len(raw))
            return at, at + 1, offsets, C.byte_values(raw, 0), C.byte_values(raw, 1)
        starts, ends, first = C.word_bounds(raw, offsets)
        return starts, ends, first, C.word_hashes(raw, starts, ends, 0), C.word_hashes(raw, starts, ends, 1)

    def cut(self, first: np.ndarray, u1: np.ndarray, u2: np.ndarray) -> tuple[np.ndarray, ...]:
        """Super-k-mers of some documents: document index, first unit, windows, anchor and its place, key."""
        n, sizes = len(u1), np.diff(first)
        s1, s2 = C.prefix_sums(u1, 0), C.prefix_sums(u2, 1)
        windows = np.maximum(sizes - self.k + 1, 0)
        total = int(windows.sum())
        empty = np.zeros(0, np.int64)
        if not total:
            return empty, empty, empty, empty.astype(np.uint64), empty, empty.astype(np.uint64), empty.astype(np.uint64)
        gram_at = np.arange(n - self.m + 1)
        gram = C.range_hash(s1, gram_at, gram_at + self.m, 0)
        bits = np.uint64(32)  # for places; a fixed width, so that the same window has the same minimiser in any company
        least = ((gram >> bits) << bits) | gram_at.astype(np.uint64)
        span, wide = self.k - self.m + 1, 1
        while wide * 2 <= span:
            least = np.minimum(least[:-wide], least[wide:])
            wide *= 2
        if span > wide:
            least = np.minimum(least[: len(least) - (span - wide)], least[span - wide :])
        at = np.repeat(first[:-1], windows) + (np.arange(total) - np.repeat(np.cumsum(windows) - windows, windows))
        chosen = (least[at] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        cut = np.flatnonzero(np.concatenate(([True], (chosen[1:] != chosen[:-1]))))
        start, count = at[cut], np.diff(np.append(cut, total))
        end = start + count + self.k - 1
        doc = np.searchsorted(first, start, side="right") - 1
        return doc, start, count, gram[chosen[cut]], chosen[cut] - start, C.range_hash(s1, start, end, 0), C.range_hash(s2, start, end, 1)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def occurrences(docs: DataFrame, w: Windows) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slices(batches, limit=w.slice):
            raw, offsets = C.flat(batch.column("text"))
            ids, keys = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "row_key"))
            _, _, first, u1, u2 = w.units(raw, offsets)
            doc, start, count, anchor, pos, k1, k2 = w.cut(first, u1, u2)
            if len(doc):
                yield pa.RecordBatch.from_arrays([pa.array(_signed(anchor)), pa.array(_signed(k1)), pa.array(_signed(k2)), pa.array(ids[doc]), pa.array(keys[doc]), pa.array((start - first[doc]).astype(np.int32)), pa.array(count.astype(np.int32)), pa.array(pos.astype(np.int32))], names=["anchor", "k1", "k2", "doc_id", "row_key", "start", "n", "pos"])

    return docs.mapInArrow(run, OCCURRENCES)


def _pieces(batches: Iterator[pa.RecordBatch], w: Windows) -> Iterator[tuple]:
    """Of each document with requests: doc_id, raw bytes, unit bounds, its sums, and the requests."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            raw, offsets = C.flat(row.column("text"))
            starts, ends, first, u1, u2 = w.units(raw, offsets)
            wanted = row.column("wanted")[0].as_py()
            yield row.column("doc_id")[0].as_py(), raw, starts, ends, C.prefix_sums(u1, 0), C.prefix_sums(u2, 1), wanted


def packed(requests: DataFrame, w: Windows) -> DataFrame:
    """One packed string for each requested super-k-mer: its bytes, words joined by one space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_id, raw, starts, ends, _, _, wanted in _pieces(batches, w):
            rows = []
            for r in wanted:
                a, b = r["start"], r["start"] + r["n"] + w.k - 1
                if b > len(starts):
                    continue
                if w.unit == "byte":
                    text = raw[a:b].tobytes()
                else:
                    text = b" ".join(raw[starts[a] : ends[b - 1]].tobytes().split())
                rows.append((r["anchor"], r["k1"], r["k2"], r["n"], r["pos"], doc_id, r["total"], text))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))], names=["anchor", "k1", "k2", "n", "pos", "first_doc", "total", "packed"])

    return requests.mapInArrow(run, PACKED)


def single_windows(requests: DataFrame, w: Windows) -> DataFrame:
    """A row for each window of the requested super-k-mers, with a 128-bit key of its content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_id, _, starts, _, s1, s2, wanted in _pieces(batches, w):
            for r in wanted:
                at = r["start"] + np.arange(r["n"])
                if len(at) and at[-1] + w.k <= len(starts):
                    full = lambda x, t=None: pa.array(np.full(len(at), x, np.int64))
                    yield pa.RecordBatch.from_arrays([full(r["anchor"]), full(r["k1"]), full(r["k2"]), pa.array(np.arange(r["n"], dtype=np.int32)), pa.array(_signed(C.range_hash(s1, at, at + w.k, 0))), pa.array(_signed(C.range_hash(s2, at, at + w.k, 1))), full(doc_id), full(r["total"])], names=["anchor", "k1", "k2", "at", "h1", "h2", "first_doc", "total"])

    return requests.mapInArrow(run, "anchor long, k1 long, k2 long, at int, h1 long, h2 long, first_doc long, total long")


def settle_buckets(rows: DataFrame, settle: Callable[[list[tuple]], Iterator[tuple]], most: int = 4 << 20) -> DataFrame:
    """Deal packed strings to their anchors' buckets, sorted by anchor and content.

    Rows of one super-k-mer come next to each other then, and count once.
    `settle` gets the rows (as PACKED) of some whole buckets, `most` bytes of them or one larger
    bucket, and gives (anchor, k1, k2, runs) for each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def done():
            out = [(anchor, k1, k2, [{"a": int(a), "b": int(b), "first_doc": int(d), "total": int(t)} for a, b, d, t in runs]) for anchor, k1, k2, runs in settle(held)]
            kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("first_doc", pa.int64()), ("total", pa.int64())]))
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), kind))], names=["anchor", "k1", "k2", "runs"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "k1", "k2", "n", "pos", "first_doc", "total", "packed"))):
                if held and row[:3] == held[-1][:3]:
                    continue  # of rows that are equal in doc_id and text one has answered
                if size >= most and row[0] != held[-1][0]:
                    yield done()
                    held, size = [], 0
                held.append(row)
                size += len(row[-1])
        if held:
            yield done()

    return rows.repartition("anchor").sortWithinPartitions("anchor", "packed").mapInArrow(run, VERDICT)


def verdicts(docs: DataFrame, found: DataFrame, w: Windows, settle: Callable, bucket_limit: int) -> DataFrame:
    """(anchor, k1, k2, runs) of every different super-k-mer in `found`."""
    keys, row = ["anchor", "k1", "k2"], ["doc_id", "row_key"]
    # Tables of their own: with aggregations right under the join, Spark could not split a hot anchor.
    different = C.materialize(found.groupBy(*keys, "n", "pos").agg(F.min(F.struct(*row, "start")).alias("at"), F.count("*").alias("total")), "different")
    per_anchor = C.materialize(different.groupBy("anchor").agg(F.count("*").alias("n_different")), "anchors")
    different = different.join(per_anchor, "anchor")
    one_run = F.array(F.struct(F.lit(0).alias("a"), F.col("n").alias("b"), F.col("at.doc_id").alias("first_doc"), F.col("total")))
    alone = different.where("n_different = 1").select(*keys, one_run.alias("runs"))

    def wanted(which: str) -> DataFrame:
        asked = different.where(which).groupBy(*(F.col(f"at.{c}").alias(c) for c in row)).agg(F.collect_list(F.struct(*keys, "n", "pos", "total", F.col("at.start").alias("start"))).alias("wanted"))
        return asked.join(docs, row).select("doc_id", "text", "wanted")

    bucketed = settle_buckets(packed(wanted(f"n_different between 2 and {bucket_limit}"), w), settle)
    windows = single_windows(wanted(f"n_different > {bucket_limit}"), w)
    counted = windows.groupBy("h1", "h2").agg(F.min("first_doc").alias("first_doc"), F.sum("total").alias("total"))
    dealt = windows.drop("first_doc", "total").join(counted, ["h1", "h2"]).groupBy(*keys).agg(F.collect_list(F.struct(F.col("at").alias("a"), (F.col("at") + 1).alias("b"), "first_doc", "total")).alias("runs"))
    return alone.unionByName(bucketed).unionByName(dealt)


def covered_ranges(docs: DataFrame, w: Windows, settle: Callable, repeated: str, bucket_limit: int = 2000) -> DataFrame:
    """doc_id, row_key and `ranges` of units covered by a window for which `repeated` holds.

    `docs` has doc_id, text and row_key (see common.keyed). `repeated` is a SQL condition on doc_id and
    on a run's r.first_doc and r.total.
    """
    every = occurrences(docs, w)
    shared = C.materialize(every.groupBy("anchor").agg(F.count("*").alias("times")).where("times > 1").select("anchor"), "anchors")
    found = C.materialize(every.join(shared, "anchor"), "superkmers")
    runs = verdicts(docs, found, w, settle, bucket_limit)
    ranges = F.expr(f"transform(filter(runs, r -> {repeated}), r -> struct(start + r.a as a, start + r.b + {w.k - 1} as b))")
    hits = found.join(runs, ["anchor", "k1", "k2"]).select("doc_id", "row_key", ranges.alias("ranges")).where("size(ranges) > 0")
    return hits.groupBy("doc_id", "row_key").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))
