"""The pipeline against a plain restatement of its stages."""

import random
import sys
from pathlib import Path

import pytest
from brute import components, counts, sanitize, sha

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))


def test_pipeline(spark, tmp_path):
    tokenizers = pytest.importorskip("public_tokenizers")
    import corpus_pipeline
    import tiktoken

    from emberflux.llm import bpe
    from emberflux.llm.decontaminate import normalize

    rng = random.Random(1)
    prose = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n))
    rows = [(i, prose(rng.randint(12, 90))) for i in range(40)]
    items = [(i, prose(40)) for i in range(3)]
    rows += [(100, rows[3][1]), (101, rows[4][1] + " extra"), (102, "too short"), (103, "x y z w v " * 20), (104, f"{prose(20)} {items[1][1]} {prose(20)}"), (105, f"{prose(30)} mail me@here.org or 10.0.0.1 {prose(5)}"), (106, None)]
    full = [(d, t, "en", "s", len(t or ""), "kept") for d, t in rows]
    spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, base string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    kept = [(d, t) for d, t in rows if not counts(t)[-1]]
    kept = [(d, t) for (d, t), (_, _, c) in zip(kept, components(kept)) if c == d]
    kept = [(d, sanitize(t)) for d, t in kept if not any(normalize(x) in normalize(t) for _, x in items)]
    path = tokenizers.path("byte_bpe_50k.tiktoken")
    plain = tiktoken.Encoding("t", pat_str=tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    expected = sorted((d, len(i := plain.encode_ordinary(t)), sha(" ".join(map(str, i)).encode()), sha(t.encode())) for d, t in kept)
    assert sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect())) == expected
    assert {100, 102, 103, 104}.isdisjoint(d for d, _ in kept) and any("<EMAIL>" in t for _, t in kept)

    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns


def test_quality_stage_judges_small_groups(spark):
    pytest.importorskip("public_tokenizers")
    import corpus_pipeline

    rng = random.Random(2)
    prose = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n))
    rows = [(i, prose(rng.randint(30, 90)), "en", f"s{i % 12}") for i in range(60)]
    junk = [(100 + i, " ".join(f"{w}###%%%" for w in prose(50).split()), "en", f"s{i}") for i in range(4)]
    docs = spark.createDataFrame(rows + junk, "doc_id long, text string, lang string, source string")
    assert {r["doc_id"] for r in corpus_pipeline.quality(spark, docs, "").collect()} == {d for d, *_ in rows}


def test_stages_tell_rows_of_one_doc_id_apart(spark):
    pytest.importorskip("public_tokenizers")
    import corpus_pipeline

    rng = random.Random(3)
    prose = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n))
    one, two, three = (prose(60) for _ in range(3))
    rows = [(1, one), (1, "short"), (2, two), (2, three), (2, three), (3, one), (3, two + " more"), (4, None), (4, "")] + [(10 + i, prose(60)) for i in range(20)]
    docs = spark.createDataFrame([(d, t, "en", "s") for d, t in rows], "doc_id long, text string, lang string, source string")
    of = lambda df: sorted((r["doc_id"], r["text"]) for r in df.collect() if r["doc_id"] < 10)
    assert of(corpus_pipeline.quality(spark, docs, "")) == sorted([(1, one), (2, two), (2, three), (2, three), (3, one), (3, two + " more")])
    kept = {(r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect() if r["doc_id"] < 10}
    assert kept == {(1, one), (1, "short"), (2, two), (2, three), (4, None), (4, "")}


def test_stages_leave_other_columns_alone(spark, tmp_path):
    """Columns named like those that stages add on their way, an empty table, and a very long text."""
    pytest.importorskip("public_tokenizers")
    import corpus_pipeline

    rng = random.Random(4)
    prose = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n))
    names = ["row", "__row", "ROW_", "kept", "leaks", "__leaks", "only", "spans", "base", "row_key", "distance"]
    rows = [(i, prose(60 if i else 30_000), "en", "s", *range(i, i + len(names))) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, " + ", ".join(f"`{c}` int" for c in names))
    spark.createDataFrame([(1, prose(40))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        # The very long text is far from all others of its language and source.
        expected = rows[1:] if name == "quality rules" else rows
        assert out.columns == docs.columns and sorted(map(tuple, out.collect())) == expected
        assert stage(spark, docs.limit(0), str(tmp_path)).collect() == []
