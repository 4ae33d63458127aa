"""Operator 3: exact Jaccard similarity join of word n-gram sets by universe partitioning.

Sets x and y (the larger) with Jaccard similarity of at least t differ in at most
H = (1-t)/(1+t) (|x|+|y|) <= 2 |y| (1-t)/(1+t) shingles. Hashing deals the universe into m segments, m
fixed by a size band [2^b, 2^(b+1)) and shared by the band's y and all x that can match them. If
some segments of y with thresholds e (0: equal; 1: equal after one deletion on either side) have
sum(e+1) > H, one of them must match within its threshold, as each other uses up e+1 differences.

1. Every set gives signatures of its non-empty segments, in small bands of their one-deletion
   neighbourhoods too, packed by signature bucket; equal sets count as one from the bucket on.
2. Cost-based allocation: a signature's cost is the number of sets that share it. Each y pays its
   H+1 units from the cheapest segments; units with signatures of its own alone cost nothing, and
   most sets are done with those: they have no partner as the larger side.
3. Each set is verified against the two sets that most of its paid signatures name as their smallest
   row; this joins most copies. Of signatures whose sets are not all joined yet, those that have the same
   smallest row make a family, whose pairs that are not joined yet are verified, in blocks. A family
   holds sets that share a paid signature with that row itself; nothing is closed over chains.
4. A set whose segments can't pay H+1 units is compared with the sets of fitting size that hold one of
   its rarest shingles: |x| - ceil(t |x|) + 1 of them, of which every similar set has one at least.

Rows are numbered by doc_id; where a doc_id stands on different texts, the further ones get numbers of
their own (see `_numbered`).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from . import common as C
from .components import components

#: Bands up to this one (sets under 64) use one-deletion neighbourhoods.
DEEP = 5
OWN, DELETED, PAIRED = 1, 2, 4
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_U = np.uint64


def shingles(raw: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Document index and hash of each distinct shingle, ordered by both."""
    low = _LOWER[raw]
    starts, ends, first = C.word_bounds(low, offsets)
    sizes = np.diff(first)
    count = np.where(sizes >= n, sizes - n + 1, (sizes > 0).astype(np.int64))
    total = int(count.sum())
    if not total:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    doc = np.repeat(np.arange(len(sizes)), count)
    a = np.repeat(first[:-1], count) + np.arange(total) - np.repeat(np.cumsum(count) - count, count)
    b = np.minimum(a + n, first[1:][doc])
    h = C.range_hash(C.prefix_sums(C.word_hashes(low, starts, ends, 0), 0), a, b, 0)
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])))
    return doc[new], h[new]


def _segments(band: np.ndarray) -> np.ndarray:
    """m of each band: 4 shingles to a segment at the top of deep bands, 2.5 elsewhere."""
    top = np.left_shift(1, band + 1)
    return np.maximum(1, np.where(band <= DEEP, top // 4, (top * 2) // 5)).astype(np.uint64)


def signatures(doc: np.ndarray, h: np.ndarray, size: np.ndarray, own: bool, percent: int = 75) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Signature, document index and flags (segment in bits 3 on, for deep bands), and each document's units.

    own: in the band of the set's size; else in the next band, for the sets that can match there (`percent`
    is over 50, so no set can match beyond it).
    """
    band = np.floor(np.log2(np.maximum(size, 1))).astype(np.int64)
    if not own:
        band = band + 1
        takes = 100 * size >= percent * np.left_shift(1, band)
        keep = takes[doc]
        doc, h = doc[keep], h[keep]
    empty = np.zeros(0, np.int64)
    if not len(doc):
        return np.zeros(0, np.uint64), empty, empty, np.zeros(len(size), np.int64)
    at = band[doc]
    seg = ((C.mix(h ^ (at.astype(_U) * _U(0x9E3779B97F4A7C15))) >> _U(32)) * _segments(at)) >> _U(32)
    order = np.argsort((doc.astype(_U) << _U(32)) | seg, kind="stable")
    doc, seg, value = doc[order], seg[order], C.mix(h[order] + _U(0x51ED270B))
    cut = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (seg[1:] != seg[:-1]))))
    sums, count = np.add.reduceat(value, cut), np.diff(np.append(cut, len(doc)))
    salt = C.mix((seg << _U(8)) + band[doc].astype(_U) + _U(1 << 60))
    g_doc, deep = doc[cut], band[doc[cut]] <= DEEP
    paired = deep & (count >= 2)
    place = np.where(deep, seg[cut].astype(np.int64) << 3, 0) | (OWN if own else 0) | np.where(paired, PAIRED, 0)
    units = np.bincount(g_doc, 1 + paired, len(size)).astype(np.int64)
    one = np.repeat(paired, count)
    gone = C.mix(np.repeat(sums, count)[one] - value[one] + salt[one])
    return np.concatenate((C.mix(sums + salt[cut]), gone)), np.concatenate((g_doc, doc[one])), np.concatenate((place, np.repeat(place, count)[one] | DELETED)), units


PACK = "bucket int, packed binary"
#: Documents of a flush (their places are 16-bit), sets that a task remembers as sent, and entries that a bucket holds before it compacts.
FLUSH, SENT, HELD = 20_000, 200_000, 1_000_000
ENTRY = "sig long, doc_id long, size int, flags int, cost int, hub long, hub_size int, k1 long, k2 long, units int"


def _first(*columns: np.ndarray) -> np.ndarray:
    """Where sorted rows differ from the row before."""
    if not len(columns[0]):
        return np.zeros(0, bool)
    return np.concatenate(([True], np.any([x[1:] != x[:-1] for x in columns], axis=0)))


def _emit(docs: DataFrame, n: int, percent: int, n_buckets: int) -> DataFrame:
    """Packed signatures of a slice of documents for each bucket, and their sizes and set keys.

    Equal sets send the signatures of their smallest doc_id only, as far as the task remembers them.
    """

    def pack(sig, idx, flags, ids, size, k1, k2, units) -> bytes:
        used, idx = np.unique(idx, return_inverse=True)
        arrays = [(sig & _U((1 << 40) - 1)).view(np.uint8).reshape(-1, 8)[:, :5].T.copy(), idx.astype(np.uint16), flags.astype(np.uint16), ids[used], size[used].astype(np.int32), k1[used], k2[used], units[used].astype(np.int32)]
        return zstandard.compress(np.array([len(sig), len(used)], np.int64).tobytes() + b"".join(x.tobytes() for x in arrays), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ready, sent = [], 0, {}

        def done():
            shift = np.cumsum([0, *(len(x[3]) for x in held)])
            sig, idx, flags = np.concatenate([x[0] for x in held]), np.concatenate([x[1] + s for x, s in zip(held, shift)]), np.concatenate([x[2] for x in held])
            ids, size, k1, k2, units = (np.concatenate([x[k] for x in held]) for k in range(3, 8))
            order = np.lexsort((ids, size, k2, k1))
            first = order[_first(k1[order], k2[order], size[order])]
            sends = np.zeros(len(ids), bool)
            if len(sent) > SENT:
                sent.clear()
            for i, key, own in zip(first.tolist(), zip(k1[first].tolist(), k2[first].tolist(), size[first].tolist()), ids[first].tolist()):
                if (before := sent.get(key)) is None or own < before:
                    sent[key], sends[i] = own, True
            sig, idx, flags = (x[sends[idx]] for x in (sig, idx, flags))
            bucket = ((sig >> _U(40)) % _U(n_buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
            rows = [(int(k), pack(sig[o], idx[o], flags[o], ids, size, k1, k2, units)) for k in range(n_buckets) if len(o := order[cuts[k] : cuts[k + 1]])]
            every = np.arange(len(ids))
            # rows of sets go anywhere, evenly
            rows.append((-1 - int(C.mix(ids[:1].view(_U))[0] % _U(n_buckets)), pack(np.zeros(len(ids), _U), every, np.zeros(len(ids)), ids, size, k1, k2, units)))
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["bucket", "packed"])

        for batch in (b.slice(a, FLUSH) for b in C.slices(batches) for a in range(0, b.num_rows, FLUSH)):
            raw, offsets = C.flat(batch.column("text"))
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            doc, h = shingles(raw, offsets, n)
            size = np.bincount(doc, minlength=len(ids)).astype(np.int64)
            sums = np.zeros((2, len(ids)), np.uint64)
            if len(doc):
                cut = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
                for k in (0, 1):
                    sums[k][doc[cut]] = np.add.reduceat(C.mix(h * _U(2 * k + 3) + _U(k + 1)), cut)
            a, b = signatures(doc, h, size, True), signatures(doc, h, size, False, percent)
            held.append((np.concatenate((a[0], b[0])), np.concatenate((a[1], b[1])), np.concatenate((a[2], b[2])), ids, size, sums[0].view(np.int64), sums[1].view(np.int64), a[3]))
            ready += len(raw)
            if ready >= 6 << 20 or sum(len(x[3]) for x in held) > FLUSH:
                yield done()
                held, ready = [], 0
        if held:
            yield done()

    return docs.mapInArrow(run, PACK)


def _bucket_entries(packs: DataFrame) -> DataFrame:
    """Entries of signatures that several different sets share, and one row for each document (sig null)."""

    def unpack(raw: bytes) -> list[np.ndarray]:
        raw = zstandard.decompress(raw)
        n, m = np.frombuffer(raw, np.int64, 2)
        out, at = [], 16
        for kind, size in ((np.uint8, 5 * n), (np.uint16, n), (np.uint16, n), (np.int64, m), (np.int32, m), (np.int64, m), (np.int64, m), (np.int32, m)):
            out.append(np.frombuffer(raw, kind, size, at))
            at += out[-1].nbytes
        sig = np.zeros((n, 8), np.uint8)
        sig[:, :5] = out[0].reshape(5, n).T
        out[0] = sig.view(np.uint64).ravel()
        return out

    def batch(columns: list) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32()]
        n = next(len(x) for x in columns if x is not None)
        return pa.RecordBatch.from_arrays([pa.nulls(n, t) if x is None else pa.array(x, t) for x, t in zip(columns, kinds)], names=["sig", "doc_id", "size", "flags", "cost", "hub", "hub_size", "k1", "k2", "units"])

    def compact(held: list, last: bool = False) -> list:
        """The entries of all packs as one, the one of the smallest doc_id for each signature, flags and set.

        At last, signatures that occur once are left out before.
        """
        shift = np.cumsum([0, *(len(x[3]) for x in held)])
        sig, idx, flags = np.concatenate([x[0] for x in held]), np.concatenate([x[1] + s for x, s in zip(held, shift)]), np.concatenate([x[2] for x in held])
        if last:
            order = np.argsort(sig, kind="stable")
            new = _first(sig[order])
            some = order[~(new & np.append(new[1:], True))]
            sig, idx, flags = sig[some], idx[some], flags[some]
        ids, size, k1, k2 = (np.concatenate([x[k] for x in held])[idx] for k in (3, 4, 5, 6))
        order = np.lexsort((ids, k2, k1, flags, sig))
        order = order[_first(sig[order], flags[order], k1[order], k2[order])]
        return [sig[order], np.arange(len(order)), *(x[order] for x in (flags, ids, size, k1, k2))]

    def settle(bucket: int, held: list) -> pa.RecordBatch | None:
        s, d, f, ids, size, *_ = compact(held, True)
        if not len(s):
            return None
        cut = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
        count = np.diff(np.append(cut, len(s)))
        who = ids[d]
        hub = np.repeat(np.minimum.reduceat(who, cut), count)
        # the hub's size: its entry is the one that equals the minimum
        hub_size = np.repeat(np.maximum.reduceat(np.where(who == hub, size[d], 0), cut), count)
        cost = np.repeat(count, count)
        keep = cost > 1
        if not keep.any():
            return None
        # bucket numbers are part of a signature's identity
        name = (np.int64(bucket) << np.int64(40)) | s.view(np.int64)
        return batch([x[keep] for x in (name, who, size[d].astype(np.int32), f.astype(np.int32), np.minimum(cost, 1 << 30).astype(np.int32), hub, hub_size.astype(np.int32))] + [None, None, None])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, kept = None, [], 0
        for b in batches:
            for bucket, packed in zip(b.column("bucket").to_pylist(), b.column("packed")):
                if bucket != now:
                    if held and (out := settle(now, held)) is not None:
                        yield out
                    now, held, kept = bucket, [], 0
                got = unpack(packed.as_py())
                if bucket < 0:
                    yield batch([None, got[3], got[4], None, None, None, None, got[5], got[6], got[7]])
                else:
                    held.append(got)
                    if len(held) > 1 and sum(len(x[0]) for x in held) > max(HELD, 2 * kept):
                        held = [compact(held)]
                        kept = len(held[0][0])
        if held and (out := settle(now, held)) is not None:
            yield out

    return packs.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, ENTRY)


def _verified(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The (u, v) of pairs whose sets are similar. u's copy goes once to every 64 or so of its v."""
    # Tables of their own, here and below: what is read several times would stand as often in one plan, which the driver holds and plans anew after every stage.
    pairs = C.materialize(pairs, "pairs")
    busy = pairs.groupBy("u").agg(F.ceil(F.count("*") / 64).cast("int").alias("parts"))
    dealt = C.materialize(pairs.join(busy, "u").select("u", "v", F.pmod(F.xxhash64("v"), F.col("parts")).cast("int").alias("part")), "pairs")
    one = dealt.select("u", "part").distinct().join(texts.withColumnRenamed("doc_id", "u"), "u").select("u", "part", F.lit(None).cast("long").alias("v"), "text")
    other = dealt.join(texts.withColumnRenamed("doc_id", "v"), "v").select("u", "part", "v", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, mine = None, None
        for batch in batches:
            for part in C.slices(iter([batch])):
                doc, h = shingles(*C.flat(part.column("text")), n)
                cuts, out = np.searchsorted(doc, np.arange(part.num_rows + 1)), []
                for i, (u, p, v) in enumerate(zip(*(part.column(c).to_pylist() for c in ("u", "part", "v")))):
                    own = h[cuts[i] : cuts[i + 1]]
                    if v is None:
                        now, mine = (u, p), own
                    elif now == (u, p):
                        both = len(np.intersect1d(mine, own, assume_unique=True))
                        if both and 100 * both >= percent * (len(mine) + len(own) - both):
                            out.append((u, v))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], names=["u", "v"])

    return one.union(other).repartition("u", "part").sortWithinPartitions("u", "part", F.col("v").asc_nulls_first()).mapInArrow(run, "u long, v long")


def _within(families: DataFrame, texts: DataFrame, n: int, percent: int, block: int = 128) -> DataFrame:
    """Links that connect a family's members, from (family, doc_id, root): all pairs of different roots are looked at.

    A large family is cut into blocks, and each pair of blocks is one unit of work: a member's text goes
    to as many units as there are blocks. Only links that join parts of a unit come out.
    """
    families = C.materialize(families, "families")
    sizes = families.groupBy("family").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    dealt = families.join(sizes, "family").withColumn("own", own).select("family", "doc_id", "root", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select("family", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "doc_id", "root").join(texts, "doc_id")

    def links(ids: list, roots: list, own: list, sets: list) -> list:
        h, who = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        size = np.array([len(x) for x in sets])
        _, column, count = np.unique(h, return_inverse=True, return_counts=True)
        used = count[column] > 1
        who, column = who[used], np.unique(column[used], return_inverse=True)[1]
        order = np.argsort(column, kind="stable")
        who, column = who[order], column[order]
        both = np.zeros((len(sets), len(sets)), np.float32)
        for a in range(0, int(column.max(initial=-1)) + 1, 4096):
            x, y = np.searchsorted(column, (a, a + 4096))
            part = np.zeros((len(sets), 4096), np.float32)
            part[who[x:y], column[x:y] - a] = 1
            both += part @ part.T
        near = 100 * both >= percent * (size[:, None] + size[None, :] - both)
        own, roots = np.array(own), np.array(roots)
        near &= (both > 0) & (roots[:, None] != roots[None, :])
        if own.min() != own.max():
            near &= own[:, None] != own[None, :]
        parent = {r: r for r in roots.tolist()}

        def top(r):
            while parent[r] != r:
                parent[r] = r = parent[parent[r]]
            return r

        out = []
        for a, b in zip(*(x.tolist() for x in np.nonzero(np.triu(near)))):
            r, t = top(int(roots[a])), top(int(roots[b]))
            if r != t:
                parent[r] = t
                out.append((ids[a], ids[b]))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, ([], [], [], [])

        def done():
            out = links(*held) if len(held[0]) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], names=["u", "v"])

        for batch in batches:
            for part in C.slices(iter([batch])):
                doc, h = shingles(*C.flat(part.column("text")), n)
                cuts = np.searchsorted(doc, np.arange(part.num_rows + 1))
                for k, (family, i, j, own, doc_id, root) in enumerate(zip(*(part.column(c).to_pylist() for c in ("family", "i", "j", "own", "doc_id", "root")))):
                    if (family, i, j) != now:
                        yield done()
                        now, held = (family, i, j), ([], [], [], [])
                    for x, y in zip(held, (doc_id, root, own, h[cuts[k] : cuts[k + 1]])):
                        x.append(y)
        yield done()

    return dealt.repartition("family", "i", "j").sortWithinPartitions("family", "i", "j", "doc_id").mapInArrow(run, "u long, v long")


def _paid(entries: DataFrame, needs: DataFrame) -> DataFrame:
    """Signatures that each larger side pays for: (doc_id, size, sig, hub, hub_size)."""
    own = entries.where(F.col("flags").bitwiseAND(OWN) != 0)
    deep = F.col("flags").bitwiseAND(~(OWN | DELETED | PAIRED)) + F.lit(0)
    paired, deleted = F.col("flags").bitwiseAND(PAIRED) != 0, F.col("flags").bitwiseAND(DELETED) != 0
    own = own.select("*", F.when(paired, deep.cast("long")).otherwise(F.col("sig")).alias("unit"), paired.alias("paired"), deleted.alias("deleted"))
    plain = own.where("not deleted").select("doc_id", "unit", F.lit(0).alias("level"), "cost")
    second = own.where("paired").groupBy("doc_id", "unit").agg(F.max("cost").alias("cost")).select("doc_id", "unit", F.lit(1).alias("level"), "cost")
    units = plain.union(second)
    dear = units.groupBy("doc_id").agg(F.count("*").alias("n"))
    open_ = needs.join(dear, "doc_id").select("doc_id", (F.col("h") + 1 - (F.col("units") - F.col("n"))).alias("need")).where("need > 0")
    open_ = C.materialize(open_, "needs")
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy("cost", "level", "unit"))
    chosen = units.join(open_, "doc_id").select("doc_id", "unit", "level", "need", rank.alias("k")).where("k <= need").select("doc_id", "unit", "level")
    return own.withColumn("level", F.when(F.col("deleted"), 1).otherwise(0)).join(chosen, ["doc_id", "unit", "level"]).select("doc_id", "size", "sig", "hub", "hub_size")


def _band(size) -> "F.Column":
    """Sizes in bands of ratio 2: sets of at least half similarity lie in one band or in neighbouring ones."""
    return F.floor(F.log2(F.greatest(size, F.lit(1)))).cast("int")


def _fallback(docs: DataFrame, sizes: DataFrame, n: int, percent: int) -> DataFrame:
    """Links of sets whose segments can't pay, by their rarest shingles. One row stands for all of equal sets."""
    poor = C.materialize(sizes.where("size > 0 and units <= h"), "poor")
    bands = sorted({b + k for r in poor.select(_band(F.col("size")).alias("b")).distinct().collect() for b in [r["b"]] for k in (-1, 0, 1)})  # of ratio 2, so some tens
    if not bands:
        return docs.sparkSession.createDataFrame([], "u long, v long")
    first = sizes.where("size > 0").where(_band(F.col("size")).isin(bands)).groupBy("k1", "k2", "size").agg(F.min("doc_id").alias("doc_id"))
    texts = C.materialize(docs.join(first.select("doc_id"), "doc_id", "left_semi").dropDuplicates(["doc_id"]), "fitting")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slices(batches):
            doc, h = shingles(*C.flat(batch.column("text")), n)
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            size = np.bincount(doc, minlength=len(ids))[doc]
            yield pa.RecordBatch.from_arrays([pa.array(ids[doc]), pa.array(h.view(np.int64)), pa.array(size.astype(np.int32))], names=["doc_id", "h", "size"])

    every = C.materialize(texts.mapInArrow(run, "doc_id long, h long, size int"), "shingles")
    mine = every.join(poor.select("k1", "k2", "size").distinct().join(first, ["k1", "k2", "size"]).select("doc_id"), "doc_id", "left_semi")
    times = every.groupBy("h").agg(F.count("*").alias("times"))
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy("times", "h"))
    chosen = mine.join(times, "h").withColumn("k", rank).where(f"k <= size - ceil(size * {percent} / 100) + 1")
    # the size is part of the key, so that a frequent shingle meets sets of fitting size only
    sized = chosen.select(F.col("doc_id").alias("u"), "h", F.explode(F.sequence(F.ceil(F.col("size") * percent / 100).cast("int"), F.floor(F.col("size") * 100 / percent).cast("int"))).alias("size"))
    pairs = sized.join(every.select(F.col("doc_id").alias("v"), "h", "size"), ["h", "size"]).where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    return C.materialize(_verified(pairs, texts, n, percent), "links")


def _numbered(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Rows with a number as their doc_id: doc_id itself, but of a doc_id's different texts all but one get others.

    The second table has doc_id, row_key and row of all texts of such doc_ids; it is None if there are none.
    """
    first = docs.groupBy("doc_id").agg(F.min("row_key").alias("least"), F.max("row_key").alias("most"))
    several = C.materialize(first.where("least <> most"), "several")
    if several.isEmpty():
        return docs, None
    rest = docs.join(several, "doc_id").select("doc_id", "row_key", "least").distinct()
    for salt in range(100):
        number = F.when(F.col("row_key") == F.col("least"), F.col("doc_id")).otherwise(F.xxhash64(F.lit(salt), "doc_id", "row_key"))
        further = C.materialize(rest.select("doc_id", "row_key", number.alias("row")), "further")
        every = further.select("row").union(first.join(several, "doc_id", "left_anti").select("doc_id"))
        if every.groupBy("row").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
            named = docs.join(further, ["doc_id", "row_key"], "left")
            return named.select(F.coalesce("row", "doc_id").alias("doc_id"), "text", "row_key"), further
    raise RuntimeError("no free numbers for the rows of repeated doc_ids")


def jaccard_join(documents: DataFrame, n: int = 5, percent: int = 75, bucket_bytes: int = 16 << 20) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable by links) of each document, row_key and root.

    row_key (64 bits of the text, see common.keyed) is there where a doc_id has several texts, else null;
    root numbers the components.

    Links join sets of distinct n-word shingles (A-Z lower-cased) with 100 * intersection >= percent *
    union. Defined cases: null, empty and blank texts have no shingles and link with nothing; a text of
    fewer than n words has one shingle, all of it; equal texts are linked; rows that repeat a doc_id each give
    a row, linked by its own text only; a very long text is one slice's work; rows without doc_id are left
    out; other columns are ignored; an empty table gives an empty result. A signature bucket is made for
    every `bucket_bytes` of text, and two at least for each shuffle partition.
    """
    docs, further = _numbered(C.keyed(C.documents(documents)))
    docs = docs.select("doc_id", "text")
    n_buckets = max(2 * C.n_partitions(docs.sparkSession), C.text_bytes(docs) // bucket_bytes)
    entries = C.materialize(_bucket_entries(_emit(docs, n, percent, n_buckets)), "signatures")
    sizes = entries.where("sig is null").select("doc_id", "size", "k1", "k2", "units", F.floor(F.col("size") * (2 * (100 - percent)) / F.lit(100 + percent)).alias("h"))
    shared = entries.where("sig is not null").select("sig", "doc_id", "size", "flags", "cost", "hub", "hub_size")
    first = sizes.where("size > 0").groupBy("k1", "k2", "size").agg(F.min("doc_id").alias("rep"))
    copies = sizes.where("size > 0").join(first, ["k1", "k2", "size"]).where("doc_id <> rep").select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))
    paid = C.materialize(_paid(shared, sizes.select("doc_id", "units", "h").dropDuplicates(["doc_id"])), "paid")
    fits = lambda a, b: f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b})"
    best = F.row_number().over(Window.partitionBy("v").orderBy(F.desc("n"), "u"))
    near = paid.where(F.col("doc_id") != F.col("hub")).where(fits("size", "hub_size")).groupBy(F.col("hub").alias("u"), F.col("doc_id").alias("v")).agg(F.count("*").alias("n"))
    near = near.withColumn("k", best).where("k <= 2").select("u", "v")
    members = C.materialize(shared.select("sig", "doc_id", "size").distinct().join(paid.select("sig").distinct(), "sig"), "members")
    involved = members.select("doc_id").distinct()
    texts = C.materialize(docs.join(involved, "doc_id", "left_semi").dropDuplicates(["doc_id"]), "texts")
    links = C.materialize(_verified(near, texts, n, percent), "links")
    label = C.materialize(components(links), "labels")
    named = lambda df: df.join(label.select(F.col("node").alias("doc_id"), "root"), "doc_id", "left").withColumn("root", F.coalesce("root", "doc_id"))
    placed = C.materialize(named(members), "placed")
    mixed = placed.groupBy("sig").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.min("doc_id").alias("v")).where("least <> most").select("sig", "v")
    families = placed.join(mixed, "sig").select(F.col("v").alias("family"), "doc_id", "root").distinct()
    more = C.materialize(_within(families, texts, n, percent), "links")
    roots = components(links.union(more).union(copies).union(_fallback(docs, sizes, n, percent)))
    out = sizes.join(roots.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    out = out.select("doc_id", F.col("size").cast("long").alias("n_shingles"), F.coalesce("root", "doc_id").alias("component_id"))
    if further is None:
        return out.select("*", F.lit(None).cast("long").alias("row_key"), F.col("component_id").alias("root"))
    real = out.join(further.select(F.col("row").alias("doc_id"), F.col("doc_id").alias("real"), "row_key"), "doc_id", "left").select(F.coalesce("real", "doc_id").alias("doc_id"), "n_shingles", F.col("component_id").alias("root"), "row_key")
    least = real.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return real.join(least, "root").select("doc_id", "n_shingles", "component_id", "row_key", "root")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("row_key", "root")
