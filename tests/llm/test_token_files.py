"""Operator 11: the coder, the file format, and the operator against the tokenizers library."""

import random
import re
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import pytest

from emberflux.llm import range_coder, token_files


def coded(ids, lengths, limit):
    writer = range_coder.Writer(len(lengths))
    range_coder.run(writer, lengths, limit, ids.copy())
    words = writer.words()
    return words, range_coder.run(range_coder.Reader(words), lengths, limit)


@pytest.mark.parametrize("kind", ["even", "few", "one", "wide", "runs"])
def test_coder_gives_back_every_id(kind):
    rng = np.random.default_rng(5)
    shape = (700, 9)
    ids = {"even": rng.integers(0, 65536, shape), "few": rng.zipf(1.4, shape) % 50257, "one": np.zeros(shape), "wide": rng.integers(0, 1 << 28, shape), "runs": np.repeat(rng.integers(0, 65536, (70, 9)), 10, 0)}[kind].astype(np.uint32)
    limit = 1 << 28 if kind == "wide" else 1 << 16
    lengths = np.array([700, 700, 650, 300, 2, 1, 1, 1, 0])
    words, back = coded(ids, lengths, limit)
    assert all((back[:n, k] == ids[:n, k]).all() for k, n in enumerate(lengths))
    spent = sum(map(len, words)) * 16 / lengths.sum()
    assert spent < {"even": 16.9, "few": 9, "one": 0.4, "wide": 29.5, "runs": 4}[kind]


def test_models_learn_from_both_orders():
    """Ids that the id before tells, ids that only the two before tell, and ids that neither does."""
    rng = np.random.default_rng(6)
    spent = {}
    for order in (0, 1, 2):
        table = rng.integers(0, 50257, (40, 40))
        ids = np.zeros((400, 50), np.uint32)
        for t in range(400):
            a, b = ids[t - 1] % 40, ids[t - 2] % 40
            ids[t] = table[0, a] if order == 1 else table[b, a] if order == 2 else rng.integers(0, 50257, 50)
            ids[t] = np.where(rng.random(50) < 0.1, rng.integers(0, 50257, 50), ids[t])
        words, back = coded(ids, np.full(50, 400), 50257)
        assert (back == ids).all()
        spent[order] = sum(map(len, words)) * 16 / ids.size
    assert spent[0] > 15 and spent[1] < 4.5 and spent[2] < 6


def test_segments_are_checked(monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK", 200)
    monkeypatch.setattr(token_files, "LANE", 16)
    rng = np.random.default_rng(7)
    lengths = np.array([0, 1, 500, 0, 333, 64])
    ids = (rng.zipf(1.3, lengths.sum()) % 50257).astype(np.uint32)
    data = token_files.pack_segment(np.arange(6) - 3, lengths, ids)
    names, n, back = token_files.unpack_segment(data)
    assert names.tolist() == [-3, -2, -1, 0, 1, 2] and n.tolist() == lengths.tolist() and (back == ids).all()
    for at in (0, 5, 40, 150, len(data) - 40):
        with pytest.raises(ValueError):
            token_files.unpack_segment(data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :])
    for cut in (2, len(data) - 30, len(data) - 10):
        with pytest.raises(ValueError):
            token_files.unpack_segment(data[:-cut])
    # Each block is coded alone: the bytes of one are those of a segment that holds nothing else.
    for k in range(0, len(ids), 200):
        own = ids[k : k + 200]
        assert b"".join(w.tobytes() for w in token_files._pack_block(own, int(ids.max()) + 1)) in data
        assert (token_files.unpack_segment(token_files.pack_segment(np.array([1]), np.array([len(own)]), own))[2] == own).all()
    with pytest.raises(ValueError):
        token_files.pack_segment(np.arange(1), np.array([1]), np.array([1 << 28], np.uint32))
    assert token_files.unpack_segment(token_files.pack_segment(np.arange(2), np.zeros(2, int), np.zeros(0, np.uint32)))[1].tolist() == [0, 0]


def test_words_give_the_ids_of_whole_texts():
    tokenizers = pytest.importorskip("public_tokenizers")
    own = token_files._Tokenizer(tokenizers.path("byte_bpe_50k.json"), most=500)
    assert own.by_words
    rng = random.Random(8)
    letters = "ab'stlvreE1²¼ \t\n\r\xa0.,-<>|_éßɏ×÷ªµ" + "\x00\x1c\x85 中😀"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(2000)] + ["a <|endoftext|> b", "it's we'll  they'Re   x\n\n y \n"]
    for k in range(0, len(texts), 100):
        some = texts[k : k + 100]
        plain = own.own.encode_batch(some, add_special_tokens=False)
        assert [x.tolist() for x in own.ids(some)] == [x.ids for x in plain]


def test_words_are_split_as_the_pattern_says():
    letters, numbers = ("".join(re.escape(chr(c)) for c in range(0x250) if unicodedata.category(chr(c))[0] == kind) for kind in "LN")
    find = re.compile(rf"'(?:[sdmt]|ll|ve|re)| ?[{letters}]+| ?[{numbers}]+| ?[^\s{letters}{numbers}]+|\s+(?!\S)|\s+").findall
    rng = random.Random(10)
    for chars in ("'''stdmlvre x1 ", "  \xa0\xa0 \n a'é", "ab 1²,\t\xa0É÷'s", "".join(c for c in map(chr, range(0x20, 0x250)) if not "\x7f" <= c < "\xa0")):
        texts = ["".join(rng.choice(chars) for _ in range(rng.randint(0, 30))) for _ in range(1500)] + ["", "'", "'l", "it's", "", "'ll", " "]
        raw = np.frombuffer("".join(texts).encode(), np.uint8)
        offsets = np.cumsum([0, *(len(x.encode()) for x in texts)])
        kinds = token_files._kinds(raw)
        assert not (kinds == token_files._OTHER).any()
        starts = token_files._words(raw, kinds, offsets).tolist()
        words = [raw[a:b].tobytes().decode() for a, b in zip(starts, [*starts[1:], len(raw)])]
        assert words == [w for x in texts for w in find(x)]


def test_repeated_words_of_a_slice_are_looked_up_once():
    tokenizers = pytest.importorskip("public_tokenizers")
    own = token_files._Tokenizer(tokenizers.path("byte_bpe_50k.json"))
    looked_up = []

    class Counted(type(own.index)):
        def get(self, *key):
            looked_up.append(key)
            return super().get(*key)

        def __getitem__(self, key):
            looked_up.append(key)
            return super().__getitem__(key)

    own.index = Counted()
    texts = ["the cat's naïve", " the cat"] * 500
    assert [x.tolist() for x in own.ids(texts)] == [x.ids for x in own.own.encode_batch(texts, add_special_tokens=False)]
    assert len(looked_up) == 5


def test_ids_of_columns():
    """Arrow columns with nulls, of any offset, with texts that go to the tokenizer whole and without."""
    tokenizers = pytest.importorskip("public_tokenizers")
    own = token_files._Tokenizer(tokenizers.path("byte_bpe_50k.json"))
    texts = [None, "lost", "a <|endoftext|>", "|> b", None, "中", "", "plain é", "<|endof", "text|>", "x\x00", "it's"]
    for a in range(len(texts)):
        for b in (a, a + 1, len(texts)):
            plain = own.own.encode_batch([x or "" for x in texts[a:b]], add_special_tokens=False)
            assert [x.tolist() for x in own.ids(pa.array(texts, pa.string()).slice(a, b - a))] == [x.ids for x in plain]


def test_token_files(spark, tmp_path):
    tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    rng = random.Random(9)
    rows = [(rng.randrange(60) - 20, " ".join(rng.choice(["the", "cat", "naïve", "<|endoftext|>", "中", "a\n\n"]) for _ in range(rng.randrange(40)))) for _ in range(120)]
    rows += [(3, None), (3, ""), (4, "lorem ipsum " * 30_000), (5, "same"), (5, "same"), (None, "lost")]
    frame = spark.createDataFrame([(d, t, 1, "s", 2) for d, t in rows], "doc_id long, text string, place int, shard string, row_key int")
    token_files.write_tokens(frame, path, str(tmp_path / "a"), segment_tokens=400)
    found = token_files.read_tokens(spark, str(tmp_path / "a")).collect()
    assert spark.read.parquet(str(tmp_path / "a")).count() > 4
    ids = lambda t: np.array(plain.encode(t or "", add_special_tokens=False).ids + [0], "<u4").tobytes()
    assert sorted((r["doc_id"], bytes(r["ids"])) for r in found) == sorted((d, ids(t)) for d, t in rows if d is not None)
    at = 0
    for r in sorted(found, key=lambda r: r["start"]):
        assert r["start"] == at and 4 * r["n_tokens"] == len(r["ids"])
        at += r["n_tokens"]
    names = [r["doc_id"] for r in sorted(found, key=lambda r: r["start"])]
    assert names == sorted(names)

    token_files.write_tokens(frame.limit(0), path, str(tmp_path / "b"))
    assert token_files.read_tokens(spark, str(tmp_path / "b")).count() == 0
    token_files.write_tokens(frame.where("doc_id = 3"), path, str(tmp_path / "c"), end_id=None)
    assert all(r["n_tokens"] == len(plain.encode(t or "").ids) for r, t in zip(token_files.read_tokens(spark, str(tmp_path / "c")).where("n_tokens = 0").collect(), [None, ""]))


def test_query_digests(spark, tmp_path):
    tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizers.path("byte_bpe_50k.json"))
    rows = [(7, "two words"), (2, None), (5, "Ünïcödé 😀"), (9, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    expected, at = [], 0
    for d, t in sorted(rows):
        ids = np.array(plain.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        expected.append((d, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(map(tuple, token_files.op11_token_files(spark, str(tmp_path)).collect())) == expected
