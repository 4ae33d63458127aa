"""Operators 12 and 13 against plain restatements, and against the SQL that states the same results."""

import random
from pathlib import Path

import pytest
from brute import prefix_nodes, variants
from pyspark.sql import functions as F

from emberflux.llm import prefix_trie, registry, spelling

SF = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string, pos int, node string, block int"


@pytest.fixture(autouse=True)
def many_ranges(spark):
    """Small ranges of rows stay ranges of their own."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def talks(spark, rows, parts=6):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], TURNS).repartition(parts)


def nodes(df):
    return sorted(tuple(r[c] for c in "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()) for r in df.collect())


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0], r[1]))


@pytest.mark.parametrize("seed", [1, 2])
def test_prefix_trie(spark, seed):
    rng = random.Random(seed)
    rows = []
    for c in [*range(-12, 40), 10**15]:
        if rng.random() < 0.85:
            for t in range(rng.choice([1, 2, 3, 9, 14])):
                rows.append((c, rng.choice([t, t, t, None]), rng.choice(["u", "a", None]), rng.choice(["", "x", "yé", None, "long " * 30])))
    rows += rows[:25] + [(None, 1, "u", "lost")]
    got = nodes(prefix_trie.prefix_trie(talks(spark, rows)))
    assert got == ordered(prefix_nodes(rows)) and max(r[4] for r in got) > 2 and max(r[1] for r in got) > 9


def test_prefix_trie_of_one_long_conversation(spark):
    """A conversation over all ranges of rows, on which others hang."""
    rows = [(0, t, "u", f"t{t % 7}") for t in range(900)] + [(5 * c, t, "u", f"t{t % 7}") for c in range(1, 9) for t in range(100 * c)] + [(11, None, "u", "z")] * 300
    got = nodes(prefix_trie.prefix_trie(talks(spark, rows)))
    assert got == ordered(prefix_nodes(rows))


def test_prefix_trie_of_equal_conversations(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 7)
    rows = [(5 * c, t, "u", "same") for c in range(200) for t in range(2)] + [(7, 0, None, None)]
    got = nodes(prefix_trie.prefix_trie(talks(spark, rows)))
    assert got == ordered(prefix_nodes(rows)) and got[0][3] == 201
    assert prefix_trie.prefix_trie(talks(spark, [])).collect() == []


def test_running_sums_cross_ranges(spark):
    rng = random.Random(3)
    rows = [(rng.choice([1, 1, 1, 2, 3]), i, rng.randrange(9)) for i in range(500)]
    df = spark.createDataFrame(rows, "conv_id long, at long, x long").repartition(5)
    at, total, expected = {}, {}, []
    for c, i, x in sorted(rows):
        at[c], total[c] = at.get(c, -1) + 1, total.get(c, 0) + x
        expected.append((c, i, at[c], total[c]))
    got = prefix_trie.running(df, ["at"], ["x"], "test")
    assert got.select("block").distinct().count() > 2
    assert sorted(map(tuple, got.select("conv_id", "at", "pos", "s_x").collect())) == expected


def found(df):
    return sorted((tuple(r[c] for c in "word form root n n_near form_n".split()) for r in df.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(d, t, 1, "w", 3) for d, t in rows], "doc_id long, text string, n int, word string, id int")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_spelling_variants(spark, seed):
    rng = random.Random(seed)
    letters = ["aab", "aé", "abcdefÿ"][seed - 1]
    stems = ["".join(rng.choice(letters) for _ in range(rng.randint(6, 9))) for _ in range(40)]
    vocabulary = []
    for w in stems:
        for _ in range(6):
            k = rng.randrange(len(w))
            vocabulary.append(w[:k] + rng.choice(["", *letters, w[k] + rng.choice(letters)]) + w[k + rng.randint(0, 1) :])
    rows = [(d, " ".join(rng.choice(stems if rng.random() < 0.8 else vocabulary).title() for _ in range(rng.randrange(200)))) for d in range(60)]
    got = found(spelling.spelling_variants(frame(spark, rows)))
    assert got == sorted(variants(rows), key=str)
    assert any(r[1] for r in got) and max(r[4] for r in got) > 3


def test_spelling_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n "), (4, "lorem ipsum dolorem " * 20_000), (5, "a" * 40_000), (6, "÷×÷×÷× ÀÉÎÕÜß àéîõüß ABCDEF abcdef abcdefg 漢abcdef字"), (7, "\x00abcdef\x00")] + [(7, "abcdefgh abcdefhg xabcdef")] * 40 + [(8, "a" * 40_001)] * 6 + [(9, "a" * 40_000)] * 31
    got = found(spelling.spelling_variants(frame(spark, [*rows, (None, "abcdef " * 99)])))
    assert [r[:2] + r[3:] for r in got if len(r[0]) < 99] == [r[:2] + r[3:] for r in sorted(variants([(d, t) for d, t in rows if len(t or "") != 40_000 and len(t or "") != 40_001]), key=str)]
    long = {len(r[0]): r for r in got if len(r[0]) > 99}
    assert long[40_000][3] == 32 and long[40_001][3] == 6 and long[40_001][1] == "a" * 40_000 == long[40_001][2]
    assert found(spelling.spelling_variants(frame(spark, []))) == []
    with pytest.raises(ValueError):
        spelling.spelling_variants(frame(spark, []), times=2)


def test_forms_are_followed_to_the_last(spark):
    words = ["abcdef", "abcdeg", "abcdhg", "abcihg", "abjihg", "akjihg", "lkjihg"]
    rows = [(0, " ".join(" ".join([w] * 5 ** (k + 1)) for k, w in enumerate(words)))]
    got = {r["word"]: (r["form"], r["root"]) for r in spelling.spelling_variants(frame(spark, rows), drop=None).collect()}
    assert got == {w: (words[k + 1] if k < 6 else None, words[6]) for k, w in enumerate(words)}


@pytest.mark.skipif(not Path(SF).is_dir(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_matches_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = registry.queries()[name](spark, SF)
    found = con.execute(registry.oracle_sql()[name])
    kinds = {c[0]: str(c[1]) for c in found.description}
    assert sorted(df.columns) == sorted(kinds)
    assert all({"bigint": "BIGINT", "string": "VARCHAR"}[t] == kinds[c] for c, t in df.dtypes)
    assert sorted(map(tuple, df.select(*kinds).collect()), key=str) == sorted(found.fetchall(), key=str)
    assert df.where(F.lit(True)).count() > 0
