"""Operator 1: substring dedup over words by super-k-mer partitioning (see superkmers)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import common as C
from . import superkmers as S

OUT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"


def sort_windows(k: int):
    """Settle a bucket by sorting its windows as strings: equal ones meet, the smallest doc_id wins."""

    def settle(held: list[tuple]) -> Iterator[tuple]:
        for _, bucket in groupby(held, key=lambda row: row[0]):
            yield from one(list(bucket))

    def one(held: list[tuple]) -> Iterator[tuple]:
        rows = []
        for i, (_, _, _, n, _, first, total, text) in enumerate(held):
            at = [0, *(np.flatnonzero(np.frombuffer(text, np.uint8) == 32) + 1).tolist(), len(text) + 1]
            rows += [(text[at[j] : at[j + k] - 1], first, i, j, total) for j in range(n)]
        rows.sort(key=lambda r: r[:2])
        firsts, totals = [[0] * h[3] for h in held], [[0] * h[3] for h in held]
        a = 0
        while a < len(rows):
            b, total = a, 0
            while b < len(rows) and rows[b][0] == rows[a][0]:
                total += rows[b][4]
                b += 1
            for _, _, i, j, _ in rows[a:b]:
                firsts[i][j], totals[i][j] = rows[a][1], total
            a = b
        for (anchor, k1, k2, n, *_), first, total in zip(held, firsts, totals):
            runs, j = [], 0
            while j < n:
                e = j
                while e < n and first[e] == first[j] and total[e] == total[j]:
                    e += 1
                runs.append((j, e, first[j], total[j]))
                j = e
            yield anchor, k1, k2, runs

    return settle


def substring_dedup(documents: DataFrame, k: int = 50, m: int = 8, bucket_limit: int = 2000) -> DataFrame:
    """Drop each word covered by a k-word window that also starts in a document with a smaller doc_id.

    Returns doc_id, n_words, n_removed, kept_sha256 and kept_text (kept words joined by one space).
    Defined cases: a null or empty text has no words and keeps an empty text; a text of fewer than k
    words keeps all; equal texts are ties that the smallest doc_id wins; rows that repeat a doc_id,
    with equal or different texts, each give a row, judged by its own text, and never make each other's
    words go; a text of any length is one row's work, in memory in proportion to it; rows without doc_id
    are left out; other columns are ignored; an empty table gives an empty result.
    """
    docs = C.keyed(C.documents(documents))
    ranges = S.covered_ranges(docs, S.Windows("word", k, m), sort_windows(k), "r.first_doc < doc_id", bucket_limit)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slices(batches):
            raw, offsets = C.flat(batch.column("text"))
            starts, ends, first = C.word_bounds(raw, offsets)
            out, ids, ranges = [], batch.column("doc_id").to_pylist(), batch.column("ranges").to_pylist()
            for i, doc_id in enumerate(ids):
                a, b = int(first[i]), int(first[i + 1])
                if not ranges[i]:
                    kept = b" ".join(raw[starts[a] : ends[b - 1]].tobytes().split()) if b > a else b""
                    removed = 0
                else:
                    gone = np.zeros(b - a + 1, np.int64)
                    for r in ranges[i]:
                        if r["b"] <= b - a:
                            gone[r["a"]] += 1
                            gone[r["b"]] -= 1
                    gone = np.cumsum(gone[:-1]) > 0
                    removed = int(gone.sum())
                    words = raw[starts[a] : ends[b - 1]].tobytes().split()
                    kept = b" ".join([words[j] for j in np.flatnonzero(~gone)])
                out.append((doc_id, b - a, removed, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace")))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()))], names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    return docs.join(ranges, ["doc_id", "row_key"], "left").mapInArrow(keep, OUT)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("kept_text")
