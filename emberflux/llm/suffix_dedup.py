"""Operator 6: substring dedup over bytes by induced suffix sorting.

Candidate regions come from byte-level super-k-mers (see superkmers): a repeated window of k bytes lies in
regions with a common anchor. Regions are dealt to shards by anchor; Spark's sort, which spills to
disk, is the queue that brings each shard's regions in order, shard size being no matter of memory.
Within a shard the suffixes at the anchors are sorted first, with their common prefixes. Every
further suffix is induced: the order of the suffixes one byte to the left is the stable order by
(that byte, rank), and their common prefix is one more than the least in between. A window is
repeated where neighbours share k bytes. Steps run over all regions of the shard at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from . import superkmers as S

OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _matrix(strings: list[bytes]) -> np.ndarray:
    """Strings as rows of a matrix, padded with 0."""
    lengths = np.fromiter(map(len, strings), np.int64, len(strings))
    out = np.zeros((len(strings), int(lengths.max(initial=0)) + 1), np.uint8)
    out[np.arange(out.shape[1]) < lengths[:, None]] = np.frombuffer(b"".join(strings), np.uint8)
    return out


def _least(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minimum of values[a:b] for many ranges at once."""
    width = b - a
    level = np.zeros(len(a), np.int64)
    np.log2(width, out=(float_level := np.empty(len(a))), where=width > 0)
    level[:] = float_level
    tables = [values]
    for k in range(int(level.max(initial=0))):
        last = tables[-1]
        tables.append(np.minimum(last[: max(0, len(last) - (1 << k))], last[1 << k :]))
    out = np.empty(len(a), values.dtype)
    for k, table in enumerate(tables):
        mine = level == k
        out[mine] = np.minimum(table[a[mine]], table[b[mine] - (1 << k)])
    return out


def induced_repeats(k: int):
    """Settle whole buckets of regions (PACKED rows, ordered by anchor)."""

    def settle(held: list[tuple]) -> Iterator[tuple]:
        anchors = np.array([h[0] for h in held])
        windows, pos, totals = (np.array([h[c] for h in held], np.int64) for c in (3, 4, 6))
        first_window = np.cumsum(windows) - windows
        times = np.repeat(totals, windows)
        rights = [h[7][p:] for h, p in zip(held, pos.tolist())]
        order = np.array(sorted(range(len(held)), key=lambda i: (held[i][0], rights[i])), np.int64)
        right = _matrix(rights)[order]
        lengths = np.array([len(x) for x in rights])[order]
        lcp = np.zeros(len(order), np.int64)
        differ = right[1:] != right[:-1]
        lcp[1:] = np.minimum(np.where(differ.any(1), differ.argmax(1), right.shape[1]), np.minimum(lengths[1:], lengths[:-1]))
        group = np.concatenate(([0], np.cumsum(anchors[order][1:] != anchors[order][:-1])))
        lcp[1:][group[1:] != group[:-1]] = 0
        del right, differ
        left = _matrix([h[7][:p][::-1] for h, p in zip(held, pos.tolist())])
        g = 0
        while len(order):
            joined = lcp >= k
            if joined.any():
                run = np.cumsum(~joined) - 1
                sums = np.bincount(run, totals[order]).astype(np.int64)[run]
                at = pos[order] - g
                real = (at >= 0) & (at < windows[order]) & (joined | np.append(joined[1:], False))
                times[first_window[order[real]] + at[real]] = sums[real]
            keep = np.flatnonzero(pos[order] > g)
            if not len(keep):
                break
            byte = left[order[keep], g].astype(np.int64)
            key = group[keep] * 256 + byte
            again = np.argsort(key, kind="stable")
            old, key = keep[again], key[again]
            same = np.concatenate(([False], key[1:] == key[:-1]))
            new = np.zeros(len(old), np.int64)
            new[same] = 1 + _least(lcp, old[np.flatnonzero(same) - 1] + 1, old[same] + 1)
            company = same | np.append(same[1:], False)
            order, lcp = order[old[company]], new[company]
            group = np.cumsum(~same)[company]
            g += 1
        repeated = times > 1
        for i, (anchor, k1, k2, n, *_) in enumerate(held):
            mine = repeated[first_window[i] : first_window[i] + n]
            edges = np.flatnonzero(np.diff(np.concatenate(([0], mine.view(np.int8), [0]))))
            yield anchor, k1, k2, [(a, b, 0, 2) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())]

    return settle


def suffix_dedup(documents: DataFrame, k: int = 400, m: int = 32, bucket_limit: int = 4000) -> DataFrame:
    """Drop each byte covered by a k-byte string that also starts anywhere else.

    Returns doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept. Defined cases: a null or empty text
    has no bytes; a text shorter than k bytes keeps all; of equal texts all copies lose what repeats;
    rows that repeat a doc_id, with equal or different texts, each give a row, judged by its own text,
    and are copies like others; a text of any length is one row's work, in memory in proportion to it;
    rows without doc_id are left out; other columns are ignored; an empty table gives an empty result.
    Kept bytes may not be valid UTF-8.
    """
    docs = C.keyed(C.documents(documents))
    ranges = S.covered_ranges(docs, S.Windows("byte", k, m), induced_repeats(k), "r.total > 1", bucket_limit)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slices(batches):
            raw, offsets = C.flat(batch.column("text"))
            out = []
            for doc_id, a, b, gone in zip(batch.column("doc_id").to_pylist(), offsets.tolist(), offsets[1:].tolist(), batch.column("ranges").to_pylist()):
                text, removed, spans = raw[a:b], 0, 0
                if gone:
                    edge = np.zeros(b - a + 1, np.int64)
                    for r in gone:
                        if r["b"] <= b - a:
                            edge[r["a"]] += 1
                            edge[r["b"]] -= 1
                    mask = np.cumsum(edge[:-1]) > 0
                    removed, spans = int(mask.sum()), int(mask[:1].sum() + (mask[1:] & ~mask[:-1]).sum())
                    text = text[~mask]
                text = text.tobytes()
                out.append((doc_id, b - a, removed, spans, hashlib.sha256(text).hexdigest(), text))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return docs.join(ranges, ["doc_id", "row_key"], "left").mapInArrow(keep, OUT)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operator's result; kept_text has U+FFFD for bytes that no longer make a character."""
    found = suffix_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.withColumn("kept_text", F.make_valid_utf8(F.col("kept").cast("string"))).drop("kept")
