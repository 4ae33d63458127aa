"""Shared helpers of the corpus operators: shared-folder tables, Arrow text access, vectorised hashing.

The numpy helpers see one slice of an Arrow batch at a time (a few MB of text, or one
document if that is longer), so a task's memory follows the longest document and not
the partition.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs of anything but these bytes (space, tab, LF, VT, FF, CR).
WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_MASK = (1 << 64) - 1
_BASES = (0x9E3779B97F4A7C13 | 3, 0xC2B2AE3D27D4EB4B | 3)
_TABLES = tuple(np.random.default_rng(20_240_101 + i).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for i in range(2))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only on a local master, and only where the session names none."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("name a folder that driver and executors share in spark.checkpoint.dir")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="emberflux-"))
        found = sc.getCheckpointDir()
    return found.rstrip("/")


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Cut the lineage: write a Parquet table into the shared folder and read it back."""
    path = f"{shared_dir(df.sparkSession)}/emberflux/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(df: DataFrame, *more: str) -> DataFrame:
    """doc_id and text (and the named columns) of rows that have a doc_id; further columns are ignored.

    A row without doc_id has no identity to report on and is left out.
    """
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more).where(F.col("doc_id").isNotNull())


def free_name(columns: list[str], name: str) -> str:
    """The name, with as many underscores as it takes to be no column's, whatever the case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def keyed(df: DataFrame) -> DataFrame:
    """Adds row_key, 64 bits of the text: rows that share a doc_id are told apart by it."""
    return df.withColumn("row_key", F.xxhash64("text"))


def text_bytes(docs: DataFrame) -> int:
    """Bytes of all texts, by which the numbers of buckets are chosen."""
    return int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)


def n_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a slice holds about `limit` bytes of text, or one longer text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        block = (np.cumsum(lengths) - 1).clip(0) // limit
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its n+1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string()
    column = pc.fill_null(column.cast(kind), b"" if kind == pa.large_binary() else "")
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_bounds(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte start and end of each word, and of each document the index of its first word (n+1 values)."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~WHITE[raw]
    before, after = np.empty_like(inside), np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    after[-1], after[:-1] = False, inside[1:]
    real = np.diff(offsets) > 0
    before[offsets[:-1][real]] = False
    after[offsets[1:][real] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, so that sums of mixed values don't cancel in patterns."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@lru_cache(4)
def _powers(size: int, which: int) -> tuple[np.ndarray, np.ndarray]:
    base = _BASES[which]
    up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def powers(n: int, which: int) -> tuple[np.ndarray, np.ndarray]:
    """B^0.. and B^-0.. modulo 2^64, at least n of them."""
    return _powers(1 << max(12, int(n).bit_length()), which)


def byte_values(raw: np.ndarray, which: int) -> np.ndarray:
    return _TABLES[which][raw]


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int) -> np.ndarray:
    """64 bits of each word's bytes; which=0 and 1 are independent."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    exponent = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    at = exponent + np.repeat(starts, lengths)
    values = _TABLES[which][raw[at]] * powers(int(lengths.max()) + 1, which)[0][exponent]
    return mix(np.add.reduceat(values, first))


def prefix_sums(units: np.ndarray, which: int) -> np.ndarray:
    """Running polynomial sums of n unit values (n+1 of them), for range_hash."""
    out = np.zeros(len(units) + 1, np.uint64)
    np.cumsum(units * powers(len(units) + 1, which)[0][: len(units)], out=out[1:], dtype=np.uint64)
    return out


def range_hash(sums: np.ndarray, a: np.ndarray, b: np.ndarray, which: int) -> np.ndarray:
    """64 bits of the units from a to b (exclusive), independent of where they stand."""
    return mix(((sums[b] - sums[a]) * powers(len(sums), which)[1][a]) + (b - a).astype(np.uint64))


def hex_sha256(column) -> "F.Column":
    return F.sha2(column, 256)


#: SQL: a table `tab` of one row, the list of what crc32 makes of each byte, for crc32_sql.
CRC_TABLE = "tab AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS tab FROM range(256) AS r(i))"


def crc32_sql(text: str) -> str:
    """SQL of the unsigned crc32 of a string's UTF-8 bytes, where CRC_TABLE is joined."""
    octets = f"list_transform(range(octet_length(encode({text}))), lambda i: CAST('0x' || substr(hex(encode({text})), 2 * i + 1, 2) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {octets}), lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295)"
