"""Operator 11: token ids in files of independently reset, checksummed blocks, coded by context mixing.

A file set is a Parquet table of segments, so that any store that Spark writes to can hold it and its commit
protocol guards it: shard (range partitions of doc_id in ascending order), segment (order in the shard),
start (ids of the shard before it), n_docs, n_tokens, and data, the segment's bytes. These are:

    "EFT1", then as uint32: what all ids are below, documents, blocks, and crc32 of these and of the tables that follow
    doc_id int64 of each document | ids int64 of each document
    ids, lanes and 16-bit words of each block and crc32 of its ids as uint32: four tables of uint32
    words of each lane of each block, uint16
    the words, lane by lane

All numbers are little-endian. A block holds `BLOCK` ids, the last of a segment the rest; each is coded by
`range_coder` from a fresh state. A segment holds whole documents: `segment_tokens` ids, or one longer document.
"""

from __future__ import annotations

import unicodedata
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import compress, pairwise, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C
from . import range_coder

MAGIC = b"EFT1"
BLOCK = 1 << 21
#: A lane of a block has about so many ids.
LANE = 128
SEGMENTS = "shard int, segment int, start long, n_docs long, n_tokens long, data binary"
#: Kinds of bytes and of characters below U+0250. Texts of others (_OTHER) go to the tokenizer whole.
_MARK, _LETTER, _NUMBER, _SPACE, _WHITE, _OTHER = range(6)


@lru_cache(1)
def _tokenizer(path: str) -> "_Tokenizer":
    """One for all tasks of a worker."""
    return _Tokenizer(path)


def _kind(char: str) -> int:
    if not ("\x20" <= char <= "\x7e" or char >= "\xa0" or char in "\t\n\r"):
        return _OTHER
    return _SPACE if char == " " else _WHITE if char.isspace() else {"L": _LETTER, "N": _NUMBER}.get(unicodedata.category(char)[0], _MARK)


_CHARS = np.array([_kind(chr(c)) for c in range(0x250)], np.uint8)
_BYTES = _CHARS[:128].tobytes() + bytes([_OTHER]) * 128


def _kinds(raw: np.ndarray) -> np.ndarray:
    """The kind of the character that each byte of UTF-8 is of."""
    kinds = np.frombuffer(bytearray(raw.tobytes().translate(_BYTES)), np.uint8)
    lead = np.flatnonzero(raw >= 0xC2)
    lead = lead[raw.take(lead) < 0xCA]
    chars = (raw.take(lead).astype(np.int64) & 31) << 6 | raw.take(lead + 1) & 63
    lead, chars = lead[chars < 0x250], chars[chars < 0x250]
    kinds[lead] = kinds[lead + 1] = _CHARS.take(chars)
    return kinds


def _words(raw: np.ndarray, kinds: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where words start, which are the matches of byte-level vocabularies, one after the other without gaps:

    '(?:[sdmt]|ll|ve|re)| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+
    """
    n = len(raw)
    fresh = np.zeros(n + 3, bool)
    fresh[offsets] = fresh[n:] = True
    white = kinds >= _SPACE
    start = fresh[:n].copy()
    # Of white characters before others the last stands alone, and a space goes to the word that follows.
    last = np.append(~white[1:], False) & ~fresh[1 : n + 1]
    wide = np.flatnonzero(white & (raw == 0xC2))
    last[wide], last[wide + 1] = last[wide + 1], False
    start[1:] |= np.where(white[1:], ~white[:-1] | last[1:], (kinds[1:] != kinds[:-1]) & (kinds[:-1] != _SPACE))
    at = np.flatnonzero((raw == ord("'")) & start)
    at = at[~fresh[at + 1]]
    one, two = raw.take(at + 1), np.where(fresh[at + 2], 0, np.append(raw, 0).take(at + 2))
    short = np.isin(one, np.frombuffer(b"sdmt", np.uint8))
    long = (one == ord("l")) & (two == ord("l")) | ((one == ord("v")) | (one == ord("r"))) & (two == ord("e"))
    ends = np.concatenate([at[short] + 2, at[long] + 3])
    start[at[short | long] + 1] = False
    start[ends[ends < n]] = True
    return np.flatnonzero(start)


class _Tokenizer:
    """Whole texts to ids by the tokenizers library; a byte-level vocabulary meets a word of plain texts anew only if
    it was forgotten: of `most` words those that came once go, or all if that isn't half of them."""

    def __init__(self, path: str, most: int = 500_000):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.own, self.most = Tokenizer.from_file(path), most
        self.special = [t.content.encode() for t in self.own.get_added_tokens_decoder().values()]
        step = self.own.pre_tokenizer
        self.by_words = self.own.normalizer is None and isinstance(step, pre_tokenizers.ByteLevel) and step.use_regex and not step.add_prefix_space and self.own.truncation is None and self.own.padding is None
        self._forget()

    def _forget(self):
        self.index, self.size, self.flat = {}, 0, np.zeros(1 << 16, np.uint32)
        self.starts, self.lengths, self.uses = (np.zeros(0, np.int64) for _ in range(3))

    def _prune(self):
        often = self.uses > 1
        if 2 * often.sum() > len(often):
            return self._forget()
        lengths = self.lengths[often]
        ends = np.cumsum(lengths)
        self.flat = self.flat.take(np.repeat(self.starts[often] - ends + lengths, lengths) + np.arange(lengths.sum()))
        self.index = dict(zip(compress(self.index, often.tolist()), range(len(lengths))))
        self.starts, self.lengths, self.uses, self.size = ends - lengths, lengths, self.uses[often] // 2, len(self.flat)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, np.uint32) for x in self.own.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: list[str], together: int = 50) -> None:
        """Words are encoded some at a time, each followed by a line feed, which is a word and an id of its own there."""
        lengths, joined, alone = np.zeros(len(new), np.int64), [], []
        for i, w in enumerate(new):
            (alone if w.isspace() or "\n" in w else joined).append(i)
        line = self._whole(["\n"])[0]
        if len(line) != 1:
            joined, alone = [], list(range(len(new)))
        lists, order = self._whole([new[i] for i in alone]), np.array(alone + joined, np.int64)
        texts = ["\n".join([new[i] for i in joined[k : k + together]]) + "\n" for k in range(0, len(joined), together)]
        flat = np.concatenate([*lists, *(more := self._whole(texts)), np.zeros(0, np.uint32)])
        n = sum(map(len, lists))
        feeds = np.flatnonzero(flat[n:] == line[0]) if more else np.zeros(0, np.int64)
        if len(feeds) != len(joined):
            raise RuntimeError("a word holds the id of a line feed")
        own = np.concatenate([np.fromiter(map(len, lists), np.int64, len(lists)), np.diff(feeds, prepend=-1) - 1])
        starts = np.concatenate([np.cumsum([0, *map(len, lists)])[:-1].astype(np.int64), n + feeds - own[len(lists) :]])
        size = self.size + len(flat)
        if size > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(size, np.uint32)])
        self.flat[self.size : size] = flat
        placed = np.empty(len(new), np.int64)
        placed[order], lengths[order] = starts + self.size, own
        self.starts, self.lengths = np.concatenate([self.starts, placed]), np.concatenate([self.lengths, lengths])
        self.uses = np.concatenate([self.uses, np.zeros(len(new), np.int64)])
        self.size = size

    def ids(self, texts: pa.Array | list[str]) -> list[np.ndarray]:
        out: list = [None] * len(texts)
        raw, offsets = C.flat(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string()))
        kinds, plain = _kinds(raw), np.full(len(texts), self.by_words)
        plain[np.searchsorted(offsets, np.flatnonzero(kinds == _OTHER), "right") - 1] = False
        data = raw.tobytes()
        if special := [s for s in self.special if s in data]:
            for i, (a, b) in enumerate(pairwise(offsets.tolist())):
                plain[i] &= not any(s in data[a:b] for s in special)
        other, own = np.flatnonzero(~plain).tolist(), np.flatnonzero(plain).tolist()
        for i, x in zip(other, self._whole([data[offsets[i] : offsets[i + 1]].decode() for i in other])):
            out[i] = x
        if len(self.index) > self.most:
            self._prune()
        if other:
            sizes = np.diff(offsets)
            mine = np.repeat(plain, sizes)
            raw, kinds, offsets = raw[mine], kinds[mine], np.append(0, np.cumsum(sizes[plain]))
        starts = _words(raw, kinds, offsets)
        words = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(np.append(starts, len(raw))), pa.py_buffer(raw)]).dictionary_encode()
        known, names = len(self.index), words.dictionary.to_numpy(zero_copy_only=False).tolist()
        numbers = np.fromiter(map(self.index.get, names, repeat(-1)), np.int64, len(names))
        new = np.flatnonzero(numbers < 0)
        if len(new):
            numbers[new] = np.arange(known, known + len(new))
            added = [names[i] for i in new.tolist()]
            self.index.update(zip(added, range(known, known + len(new))))
            self._learn(added)
        at = numbers.take(words.indices.to_numpy())
        self.uses += np.bincount(at, minlength=len(self.uses))
        take = self.lengths.take(at)
        total = np.append(0, np.cumsum(take))
        ids = self.flat.take(np.repeat(self.starts.take(at) - total[:-1], take) + np.arange(total[-1]))
        cuts = total.take(np.searchsorted(starts, offsets)).tolist()
        for i, a, b in zip(own, cuts, cuts[1:]):
            out[i] = ids[a:b]
        return out


def _lanes(n: int) -> tuple[np.ndarray, int]:
    """Ids of each lane of a block of n ids, and of the longest."""
    lanes = max(1, n // LANE)
    steps = -(-n // lanes)
    return np.minimum(steps, np.maximum(0, n - steps * np.arange(lanes))), steps


def _pack_block(ids: np.ndarray, limit: int) -> list[np.ndarray]:
    lengths, steps = _lanes(len(ids))
    rows = np.zeros(len(lengths) * steps, np.uint32)
    rows[: len(ids)] = ids
    coder = range_coder.Writer(len(lengths))
    range_coder.run(coder, lengths, limit, np.ascontiguousarray(rows.reshape(len(lengths), steps).T))
    return coder.words()


def pack_segment(doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """The bytes of a segment; ids have 28 bits at most."""
    limit = int(ids.max(initial=0)) + 1
    if limit > 1 << 28:
        raise ValueError("ids of more than 28 bits")
    ids = np.ascontiguousarray(ids, "<u4")
    parts = [ids[a : a + BLOCK] for a in range(0, len(ids), BLOCK)]
    words = [_pack_block(x, limit) for x in parts]
    numbers = np.array([[len(x) for x in parts], [len(w) for w in words], [sum(map(len, w)) for w in words], [zlib.crc32(x) for x in parts]], "<u4")
    tables = b"".join([np.asarray(doc_ids, "<i8").tobytes(), np.asarray(lengths, "<i8").tobytes(), numbers.tobytes(), np.array([len(x) for w in words for x in w], "<u2").tobytes()])
    head = np.array([limit, len(doc_ids), len(parts)], "<u4").tobytes()
    crc = np.array([zlib.crc32(tables, zlib.crc32(head))], "<u4").tobytes()
    return b"".join([MAGIC, head, crc, tables, *(x.tobytes() for w in words for x in w)])


def unpack_segment(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc_ids, ids of each, and all ids; fails if they aren't what was written."""
    if data[:4] != MAGIC or len(data) < 20:
        raise ValueError("not a token segment")
    limit, n_docs, n_blocks, crc = np.frombuffer(data, "<u4", 4, 4).tolist()
    at = 20 + 16 * n_docs
    if len(data) < at + 16 * n_blocks:
        raise ValueError("a token segment that is cut short")
    sizes, lanes, counts, sums = (x.tolist() for x in np.frombuffer(data, "<u4", 4 * n_blocks, at).reshape(4, n_blocks))
    end = at + 16 * n_blocks + 2 * sum(lanes)
    if len(data) != end + 2 * sum(counts) or zlib.crc32(data[20:end], zlib.crc32(data[4:16])) != crc:
        raise ValueError("damaged tables of a token segment")
    doc_ids, lengths = np.frombuffer(data, "<i8", 2 * n_docs, 20).reshape(2, n_docs)
    of_lane = np.frombuffer(data, "<u2", sum(lanes), at + 16 * n_blocks)
    words, out, lane, word, done = np.frombuffer(data, "<u2", -1, end), np.zeros(sum(sizes), "<u4"), 0, 0, 0
    for n, k, m, total in zip(sizes, lanes, counts, sums):
        own = np.split(words[word : word + m], np.cumsum(of_lane[lane : lane + k], dtype=np.int64)[:-1])
        ids = np.ascontiguousarray(range_coder.run(range_coder.Reader(own), _lanes(n)[0], limit).T).ravel()[:n]
        if zlib.crc32(ids) != total:
            raise ValueError("damaged block of a token segment")
        out[done : done + n] = ids
        lane, word, done = lane + k, word + m, done + n
    return doc_ids, lengths, out


def write_tokens(documents: DataFrame, tokenizer: str, path: str, end_id: int | None = 0, segment_tokens: int = 2 * BLOCK) -> None:
    """Encode each whole text with the tokenizer of a JSON file and write the ids to `path`, in ascending doc_id order.

    Each document gets `end_id` appended (None: nothing). Defined cases: a null or empty text has the end id
    alone; rows that repeat a doc_id are documents of their own, in order of 64 bits of their texts, so that
    copies lie in any order; a very long text is a segment of its own; rows without doc_id are left
    out; other columns are ignored; an empty table gives an empty file set. Rows are dealt out by ranges
    of doc_id, those bits and the row's place, so no doc_id is hot.
    """
    docs = C.keyed(C.documents(documents)).withColumn("place", F.monotonically_increasing_id())
    order = ["doc_id", "row_key", "place"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, shard = _tokenizer(tokenizer), TaskContext.get().partitionId()
        end = np.array([] if end_id is None else [end_id], np.uint32)
        names, lists, size, start, segment = [], [], 0, 0, 0

        def done():
            ids, lengths = np.concatenate(lists), np.fromiter(map(len, lists), np.int64, len(lists))
            packed = pack_segment(np.array(names, np.int64), lengths, ids)
            row = (shard, segment, start, len(names), len(ids), packed)
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=["shard", "segment", "start", "n_docs", "n_tokens", "data"])

        for batch in C.slices(batches, limit=4 << 20):
            for name, ids in zip(batch.column("doc_id").to_pylist(), own.ids(batch.column("text"))):
                if lists and size + len(ids) + len(end) > segment_tokens:
                    yield done()
                    names, lists, start, segment, size = [], [], start + size, segment + 1, 0
                names.append(name)
                lists.append(np.concatenate([ids, end]))
                size += len(lists[-1])
        if lists:
            yield done()

    docs.repartitionByRange(*order).sortWithinPartitions(*order).drop("row_key", "place").mapInArrow(run, SEGMENTS).write.option("compression", "none").option("parquet.block.size", str(16 << 20)).parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, and ids (uint32, little-endian) of each document.

    Every checksum is checked; a damaged segment fails the query. An empty file set gives no row.
    """
    segments = spark.read.schema(SEGMENTS).parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, start, data in zip(batch.column("shard").to_pylist(), batch.column("start").to_pylist(), batch.column("data")):
                doc_ids, lengths, ids = unpack_segment(data.as_py())
                ends = np.cumsum(lengths)
                cuts = np.concatenate([[0], 4 * ends])
                for a in range(0, len(doc_ids), 4096):
                    b = min(a + 4096, len(doc_ids))
                    raw = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer((cuts[a : b + 1] - cuts[a]).astype(np.int32)), pa.py_buffer(ids[cuts[a] // 4 : cuts[b] // 4])])
                    columns = [pa.array(np.full(b - a, shard, np.int32)), pa.array(doc_ids[a:b]), pa.array(start + ends[a:b] - lengths[a:b]), pa.array(lengths[a:b]), raw]
                    yield pa.RecordBatch.from_arrays(columns, names=["shard", "doc_id", "start", "n_tokens", "ids"])

    rows = segments.select("shard", "start", "data").mapInArrow(run, "shard int, doc_id long, start long, n_tokens long, ids binary")
    # One row for each shard: as many as the writer had partitions, whatever the number of rows.
    totals = segments.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = totals.select("shard", F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return rows.join(F.broadcast(before), "shard").select("doc_id", (F.col("before") + F.col("start")).alias("start"), "n_tokens", "ids")


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = f"{C.shared_dir(spark)}/emberflux/tokens-{uuid.uuid4().hex}"
    write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"), path)
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
