"""Operator 10: byte-level BPE encoding and decoding through a global distinct-word shuffle.

1. Whole documents are split into pre-tokens and packed into compressed chunks: the distinct words by
   first position, and each pre-token as the index of its word. A digest of its content is a chunk's key.
2. A chunk's words are dealt out by hash to word buckets, one packed row for each chunk and bucket;
   the number of buckets follows the size of the texts.
3. A bucket encodes each of its distinct words once and sends the ids back to the chunks.
4. A chunk joins its ids by digest and puts them in place by position.
5. Decoding joins ids with the token-byte table, whose size is the vocabulary's.

A word comes to its bucket at most once for each chunk, so no word is hot; a chunk holds
`chunk_bytes` of text, or one longer document. The chunks are shuffled once: both readers of that
exchange see the same bytes, and a chunk whose ids don't come back fails the job.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

IDS = "doc_id long, ids array<int>"


class _Index(dict):
    def __missing__(self, word):
        n = self[word] = len(self)
        return n


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a `.tiktoken` file."""
    import base64

    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


@lru_cache(2)
def _encoder(ranks: tuple) -> object:
    """Encodes a word as one piece, as its pattern takes any text whole."""
    import tiktoken

    return tiktoken.Encoding("own", pat_str=r"(?s:.+)", mergeable_ranks=dict(ranks), special_tokens={})


def _pack(*arrays: np.ndarray) -> bytes:
    sizes = np.array([len(arrays), *(x.nbytes for x in arrays)], np.int64)
    return zstandard.compress(sizes.tobytes() + b"".join(x.tobytes() for x in arrays), 3)


def _unpack(packed: bytes, *types: type) -> list[np.ndarray]:
    raw = zstandard.decompress(packed)
    n = len(types)
    ends = np.cumsum(np.frombuffer(raw, np.int64, n, 8)) + 8 * (n + 1)
    return [np.frombuffer(raw[a:b], t) for a, b, t in zip([8 * (n + 1), *ends.tolist()], ends.tolist(), types)]


def _chunks(docs: DataFrame, pattern: str, chunk_bytes: int) -> DataFrame:
    """(chunk, packed): doc_ids, pre-tokens of each, their word indices, and the distinct words.

    Whole documents, about `chunk_bytes` of text to a row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        find = regex.compile(pattern).findall
        ids, counts, at, index, size = [], [], [], _Index(), 0

        def done():
            words = [x.encode() for x in index]
            packed = _pack(np.concatenate(ids), np.array(counts, np.int64), np.concatenate([np.zeros(0, np.uint32), *at]), np.fromiter(map(len, words), np.int32, len(words)), np.frombuffer(b"".join(words), np.uint8))
            return pa.RecordBatch.from_arrays([pa.array([hashlib.sha256(packed).hexdigest()[:32]]), pa.array([packed], pa.binary())], names=["chunk", "packed"])

        for batch in C.slices(batches):
            ids.append(batch.column("doc_id").to_numpy(zero_copy_only=False))
            for text in batch.column("text"):
                words = find(text.as_py() or "")
                at.append(np.fromiter(map(index.__getitem__, words), np.uint32, len(words)))
                counts.append(len(words))
            size += batch.column("text").nbytes
            if size >= chunk_bytes:
                yield done()
                ids, counts, at, index, size = [], [], [], _Index(), 0
        if ids:
            yield done()

    return docs.mapInArrow(run, "chunk string, packed binary")


def _tokens(packed: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """doc_ids, pre-tokens of each, their word indices, and the distinct words by first position."""
    ids, counts, at, sizes, raw = _unpack(packed, np.int64, np.int64, np.uint32, np.int32, np.uint8)
    raw, ends = raw.tobytes(), np.cumsum(sizes)
    return ids, counts, at, [raw[a:b] for a, b in zip((ends - sizes).tolist(), ends.tolist())]


def _buckets(words: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the words by bucket, stable, and the n+1 cuts between buckets."""
    bucket = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % n
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(n + 1))


def _deal_words(chunks: DataFrame, n_buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, packed in zip(batch.column("chunk").to_pylist(), batch.column("packed")):
                words = _tokens(packed.as_py())[3]
                order, cuts = _buckets(words, n_buckets)
                for k in range(n_buckets):
                    mine = [words[i] for i in order[cuts[k] : cuts[k + 1]]]
                    if mine:
                        sizes = np.fromiter(map(len, mine), np.int32, len(mine))
                        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([chunk]), pa.array([_pack(sizes, np.frombuffer(b"".join(mine), np.uint8))], pa.binary())], names=["bucket", "chunk", "words"])

    return chunks.mapInArrow(run, "bucket int, chunk string, words binary")


def _encode_words(words: DataFrame, ranks: Broadcast) -> DataFrame:
    """Each distinct word of a bucket is encoded once; its ids go to every chunk that has it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tuple(ranks.value.items())).encode_ordinary
        now, known = None, {}
        for batch in batches:
            for bucket, chunk, packed in zip(batch.column("bucket").to_pylist(), batch.column("chunk").to_pylist(), batch.column("words")):
                if bucket != now:
                    now, known = bucket, {}
                sizes, raw = _unpack(packed.as_py(), np.int32, np.uint8)
                raw, ends, lists = raw.tobytes(), np.cumsum(sizes), []
                for a, b in zip((ends - sizes).tolist(), ends.tolist()):
                    word = raw[a:b]
                    if (ids := known.get(word)) is None:
                        ids = known[word] = np.array(encode(word.decode()), np.int32).tobytes()
                    lists.append(ids)
                lengths = np.fromiter(map(len, lists), np.int32, len(lists)) // 4
                yield pa.RecordBatch.from_arrays([pa.array([chunk]), pa.array([bucket], pa.int32()), pa.array([_pack(lengths, np.frombuffer(b"".join(lists), np.int32))], pa.binary())], names=["chunk", "bucket", "ids"])

    return words.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "chunk string, bucket int, ids binary")


def _assemble(both: DataFrame, n_buckets: int) -> DataFrame:
    """(chunk, packed, encoded) -> ids of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed, encoded in zip(batch.column("packed"), batch.column("encoded")):
                doc_ids, counts, at, words = _tokens(packed.as_py())
                n = len(words)
                order, cuts = _buckets(words, n_buckets)
                del words
                lengths, starts, ids, size = np.full(n, -1, np.int64), np.zeros(n, np.int64), [np.zeros(0, np.int32)], 0
                for x in encoded if encoded.is_valid else ():
                    k = x["bucket"].as_py()
                    own, flat = _unpack(x["ids"].as_py(), np.int32, np.int32)
                    mine = order[cuts[k] : cuts[k + 1]]
                    lengths[mine], starts[mine] = own, np.cumsum(own) - own + size
                    ids.append(flat)
                    size += len(flat)
                if n and lengths.min() < 0:
                    raise RuntimeError("a chunk's words were not all encoded: its rows changed between two readings")
                ids, ends = np.concatenate(ids), np.concatenate(([0], np.cumsum(counts)))
                cuts = [0, *(np.flatnonzero(np.diff(ends[1:] // 100_000)) + 1).tolist(), len(doc_ids)]
                for a, b in zip(cuts, cuts[1:]):
                    if b > a:
                        mine = at[ends[a] : ends[b]]
                        take = lengths[mine]
                        total = np.concatenate(([0], np.cumsum(take)))
                        own = ids[np.repeat(starts[mine] - total[:-1], take) + np.arange(total[-1])]
                        yield pa.RecordBatch.from_arrays([pa.array(doc_ids[a:b], pa.int64()), pa.ListArray.from_arrays(pa.array(total[ends[a : b + 1] - ends[a]].astype(np.int32)), pa.array(own))], names=["doc_id", "ids"])

    return both.mapInArrow(run, IDS)


def encode(documents: DataFrame, ranks_path: str, pattern: str, chunk_bytes: int = 24 << 20, bucket_bytes: int = 64 << 20, most_buckets: int = 20_000) -> DataFrame:
    """doc_id and ids of each document's whole text, without special tokens.

    There is a word bucket for every `bucket_bytes` of text, at least four for each shuffle partition and
    not more than `most_buckets`, as distinct words grow far slower than texts. Defined cases: a null or
    empty text has no ids; a very long text is a chunk of its own; rows that repeat a doc_id each give a
    row (equal chunks are joined as often as they occur); rows without doc_id are left out; other columns
    are ignored; an empty table gives an empty result.
    """
    docs = C.documents(documents)
    spark = docs.sparkSession
    n_buckets = max(4 * C.n_partitions(spark), min(most_buckets, C.text_bytes(docs) // bucket_bytes))
    ranks = spark.sparkContext.broadcast(load_ranks(ranks_path))
    chunks = _chunks(docs, pattern, chunk_bytes).repartition("chunk")
    ids = _encode_words(_deal_words(chunks, n_buckets), ranks)
    back = ids.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "ids")).alias("encoded"))
    return _assemble(chunks.join(back, "chunk", "left").select("packed", "encoded"), n_buckets)


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """Adds `decoded` (binary) to rows with `ids`; null ids decode to no bytes, unknown ids fail."""
    table = encoded.sparkSession.sparkContext.broadcast({i: b for b, i in load_ranks(ranks_path).items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = table.value.__getitem__
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                out = pa.array([b"".join(map(look, x.as_py() or ())) for x in part.column("ids")], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, out], names=[*part.schema.names, "decoded"])

    kinds = ", ".join(f"`{c}` {t}" for c, t in encoded.dtypes)
    return encoded.mapInArrow(run, f"{kinds}, decoded binary")


def digests(documents: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Per document: doc_id, n_tokens, and digests of its ids and of the bytes decoded from them."""
    both = decode(encode(documents, ranks_path, pattern), ranks_path)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
