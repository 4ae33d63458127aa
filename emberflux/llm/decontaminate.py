"""Operator 8: benchmark decontamination by pigeonhole edit matching.

A test item that may differ from a passage by k edits is cut into k+1 pieces, one of which must then
occur unchanged. An Aho-Corasick automaton over all pieces scans every whole text once; around each
hit Myers' bit-parallel algorithm decides whether the item lies within its budget. The test items
are a stated query set: they are processed in blocks of bounded size, each block against all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

HIT = "array<struct<item_id:bigint,distance:int,start:int,end:int>>"


def normalize(text: str | None) -> str:
    """Lower case, runs of white space as one space."""
    return " ".join((text or "").lower().split())


def budget(length: int, rate: float, least_piece: int) -> int:
    """Edits allowed for an item: its length times rate, but pieces keep `least_piece` characters."""
    return max(0, min(int(length * rate), length // least_piece - 1))


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    cuts = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:]) if b > a]


class Myers:
    """Best semi-global edit distance of a pattern within a text, whole-pattern bit vectors in one integer."""

    def __init__(self, pattern: str):
        self.m, self.peq = len(pattern), {}
        for i, c in enumerate(pattern):
            self.peq[c] = self.peq.get(c, 0) | (1 << i)

    def best(self, text: str, k: int) -> tuple[int, int] | None:
        """(distance, end) of the best place within k edits, the first of equals."""
        mask, top = (1 << self.m) - 1, 1 << (self.m - 1)
        pv, mv, score, found = mask, 0, self.m, None
        for j, c in enumerate(text):
            eq = self.peq.get(c, 0)
            xv = eq | mv
            xh = (((eq & pv) + pv) ^ pv) | eq
            ph, mh = mv | ~(xh | pv) & mask, pv & xh
            if ph & top:
                score += 1
            elif mh & top:
                score -= 1
            ph, mh = (ph << 1) & mask, (mh << 1) & mask
            pv, mv = mh | ~(xv | ph) & mask, ph & xv
            if score <= k and (found is None or score < found[0]):
                found = (score, j + 1)
        return found


class Matcher:
    """All items of one block."""

    def __init__(self, items: list[tuple[int, str]], rate: float, least_piece: int):
        import ahocorasick

        self.items, self.automaton, by_piece = [], ahocorasick.Automaton(), {}
        for item_id, text in items:
            k = budget(len(text), rate, least_piece)
            self.items.append((item_id, text, k, Myers(text)))
            for at, piece in pieces(text, k):
                by_piece.setdefault(piece, []).append((len(self.items) - 1, at))
        for piece, places in by_piece.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.any = bool(by_piece)
        if self.any:
            self.automaton.make_automaton()

    def find(self, text: str) -> list[dict]:
        if not self.any:
            return []
        tried, best = {}, {}
        for end, (size, places) in self.automaton.iter(text):
            for i, at in places:
                origin = end + 1 - size - at
                item_id, item, k, myers = self.items[i]
                if item_id in best and best[item_id]["distance"] == 0 or origin in (seen := tried.setdefault(i, set())):
                    continue
                seen.add(origin)
                if text.startswith(item, origin) if origin >= 0 else False:
                    got = (0, origin + len(item))
                elif not k:
                    continue
                else:
                    a = max(0, origin - k)
                    got = myers.best(text[a : origin + len(item) + k], k)
                    got = got and (got[0], got[1] + a)
                if got and (item_id not in best or got[0] < best[item_id]["distance"]):
                    best[item_id] = {"item_id": item_id, "distance": got[0], "start": max(0, got[1] - len(item)), "end": got[1]}
        return sorted(best.values(), key=lambda x: x["item_id"])


def blocks(benchmark: DataFrame, limit: int) -> Iterator[list[tuple[int, str]]]:
    """The items with text, normalised, in blocks of about `limit` characters."""
    held, size = [], 0
    for row in benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("item_id is not null").toLocalIterator():
        if text := normalize(row[1]):
            held.append((row[0], text))
            size += len(text)
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def _scan(docs: DataFrame, items: list[tuple[int, str]], rate: float, least_piece: int, hits: str) -> DataFrame:
    """All columns of docs, and HITS."""
    sent = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(sent.value, rate, least_piece)
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in C.slices(batches, limit=1 << 22):
            found = [matcher.find(normalize(x.as_py())) for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], names=[*batch.schema.names, hits])

    kinds = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)
    return docs.mapInArrow(run, f"{kinds}, `{hits}` {HIT}")


def leaks(documents: DataFrame, benchmark: DataFrame, rate: float = 0.05, least_piece: int = 12, block_chars: int = 16 << 20) -> DataFrame:
    """A row for each document and test item that it holds within the edit budget.

    Returns doc_id, item_id, distance, start and end (of the passage, in the normalised text).
    Defined cases: null or empty texts and items match nothing; an item shorter than two pieces must
    occur exactly; of several places the one with fewest edits counts, then the first; rows that
    repeat a doc_id each give their hits; a very long text is scanned whole, in one row's work, with memory
    in proportion to it; rows without doc_id or item_id are left out; other columns
    are ignored; empty tables give an empty result.
    """
    docs = C.documents(documents)
    out = docs.sparkSession.createDataFrame([], "doc_id long, item_id long, distance int, start int, end int")
    for items in blocks(benchmark, block_chars):
        out = out.union(_scan(docs, items, rate, least_piece, "leaks").select("doc_id", F.inline("leaks")))
    return out


def decontaminate(documents: DataFrame, benchmark: DataFrame, rate: float = 0.05, least_piece: int = 12, block_chars: int = 16 << 20) -> DataFrame:
    """The documents, all columns, that hold no test item; same matching as `leaks`."""
    for items in blocks(benchmark, block_chars):
        hits = C.free_name(documents.columns, "leaks")
        documents = _scan(documents, items, rate, least_piece, hits).where(F.size(hits) == 0).drop(hits)
    return documents


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
