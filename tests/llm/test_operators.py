"""Each operator against a plain restatement, on random texts and on the defined edge cases."""

import json
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import zstandard
from brute import KINDS, components, counts, private, repeated_bytes, repeated_words, sha, shingles, words
from pyspark.sql import functions as F

from emberflux.llm import bpe, chat_format, decontaminate, jaccard_join, language_id, pii, quality_model, quality_rules, substring_dedup, suffix_dedup

SCHEMA = "doc_id long, text string, lang string, source string, ranges string, packed int, base string, n int, size string"
LONG = "lorem ipsum dolor " * 20_000


def texts(seed, n, vocabulary, lengths, edits=3):
    rng, out = random.Random(seed), []
    for _ in range(n):
        if out and rng.random() < 0.7:
            w = rng.choice(out).split(" ")
            for _ in range(rng.randint(0, edits)):
                k = rng.randrange(len(w))
                w[k : k + rng.randint(0, 1)] = [rng.choice(vocabulary)] * rng.randint(0, 2)
                w = w or [""]
            out.append(" ".join(w))
        else:
            out.append(" ".join(rng.choice(vocabulary) for _ in range(rng.choice(lengths))))
    return out


def frame(spark, rows):
    """Documents with further columns whose names the operators use themselves."""
    full = [(d, t, "en", None if d and d % 3 == 0 else "s", "x", 1, "y", 2, "z") for d, t in rows]
    return spark.createDataFrame(full, SCHEMA)


EDGES = [(1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, LONG), (6, "Ünïcödé 😀 " * 60), (7, "Ünïcödé 😀 " * 60), (8, "a b c"), (9, "A b C"), (10, "\x00\x00 x"), (11, "one " * 60)]


def found(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


@pytest.mark.parametrize("limit", [2000, 1])
def test_substring_dedup(spark, limit):
    rows = list(enumerate(texts(1, 150, [f"w{i}" for i in range(40)], [0, 5, 30, 80])))
    got = found(substring_dedup.substring_dedup(frame(spark, rows), k=12, m=3, bucket_limit=limit), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == sorted(repeated_words(rows, 12)) and any(r[2] for r in got)


def repeated_ids(seed, texts_):
    """Rows whose doc_ids repeat, on different texts and on equal ones."""
    rng = random.Random(seed)
    rows = [(rng.randrange(len(texts_) // 3), t) for t in texts_]
    return rows + rows[:7] + rows[:3]


@pytest.mark.parametrize("limit", [2000, 1])
def test_substring_dedup_of_repeated_ids(spark, limit):
    rows = repeated_ids(21, texts(21, 120, [f"w{i}" for i in range(40)], [0, 5, 30, 80]))
    got = found(substring_dedup.substring_dedup(frame(spark, rows), k=12, m=3, bucket_limit=limit), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == sorted(repeated_words(rows, 12)) and any(r[2] for r in got)


@pytest.mark.parametrize("limit", [4000, 1])
def test_suffix_dedup_of_repeated_ids(spark, limit):
    rows = repeated_ids(22, texts(22, 120, ["ab", "é", "xyz", "abab"], [0, 3, 20, 60]))
    got = found(suffix_dedup.suffix_dedup(frame(spark, rows), k=40, m=8, bucket_limit=limit), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == sorted(repeated_bytes(rows, 40)) and any(r[2] for r in got)


def test_minimisers_do_not_depend_on_company():
    from emberflux.llm import common, superkmers

    rng = random.Random(23)
    w = superkmers.Windows("byte", 40, 8)
    text = "".join(rng.choice("abcd") for _ in range(3000))

    def cut(*all_):
        first, u = np.cumsum([0, *map(len, all_)]), np.frombuffer("".join(all_).encode(), np.uint8)
        doc, start, n, anchor, *_ = w.cut(first, common.byte_values(u, 0), common.byte_values(u, 1))
        return [(int(a), int(b), int(c)) for d, a, b, c in zip(doc, start, n, anchor) if d == 0]

    assert cut(text) == cut(text, "".join(rng.choice("abcd") for _ in range(200_000)))


def test_byte_super_kmers_memory():
    import tracemalloc

    import pyarrow as pa

    from emberflux.llm import common, superkmers

    class Rows:
        def mapInArrow(self, run, schema):
            return run

    run = superkmers.occurrences(Rows(), superkmers.Windows("byte", 400, 32))
    letters = np.random.default_rng(24).integers(97, 123, (1000, 4000), dtype=np.uint8)
    batch = pa.RecordBatch.from_pydict({"doc_id": range(1000), "row_key": range(1000), "text": [x.tobytes().decode() for x in letters]})
    common._powers.cache_clear()
    tracemalloc.start()
    cut = {(d, s, n) for part in run(iter([batch])) for d, s, n in zip(*(part.column(c).to_pylist() for c in ("doc_id", "start", "n")))}
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(n for *_, n in cut) == 1000 * 3601 and most < 90e6


def test_substring_dedup_edges(spark):
    got = found(substring_dedup.substring_dedup(frame(spark, [*EDGES, (None, "lost"), (11, "one " * 60)])), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == sorted([*repeated_words(EDGES), next(r for r in repeated_words(EDGES) if r[0] == 11)])


@pytest.mark.parametrize("limit", [4000, 1])
def test_suffix_dedup(spark, limit):
    rows = list(enumerate(texts(2, 150, ["ab", "é", "xyz", "abab"], [0, 3, 20, 60])))
    got = found(suffix_dedup.suffix_dedup(frame(spark, rows), k=40, m=8, bucket_limit=limit), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == sorted(repeated_bytes(rows, 40)) and any(r[2] for r in got)


def test_suffix_dedup_edges(spark):
    edges = [(d, t if t != LONG else LONG[:3000]) for d, t in EDGES]
    got = found(suffix_dedup.suffix_dedup(frame(spark, [*edges, (None, "lost")])), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == sorted(repeated_bytes(edges))
    got = found(suffix_dedup.suffix_dedup(frame(spark, [(1, None), (4, LONG)])), "doc_id", "n_removed", "n_spans")
    assert got == [(1, 0, 0), (4, len(LONG), 1)]


@pytest.mark.parametrize("seed", [3, 4])
def test_jaccard_join(spark, seed):
    rows = list(enumerate(texts(seed, 400, [f"w{i}" for i in range(30)], [0, 1, 4, 5, 9, 14, 25, 40, 70, 130], edits=4)))
    got = found(jaccard_join.jaccard_join(frame(spark, rows)), "doc_id", "n_shingles", "component_id")
    assert got == sorted(components(rows)) and any(r[0] != r[2] for r in got)


def test_jaccard_join_edges(spark):
    got = found(jaccard_join.jaccard_join(frame(spark, [*EDGES, (None, "lost"), (8, "a b c")])), "doc_id", "n_shingles", "component_id")
    assert got == sorted([*components(EDGES), (8, 1, 8)])


def by_row(rows):
    """components() where each row is linked by its own text, whatever its doc_id."""
    inner = components([(i, t) for i, (_, t) in enumerate(rows)])
    least = {}
    for (d, _), (_, _, c) in zip(rows, inner):
        least[c] = min(least.get(c, d), d)
    return [(d, n, least[c]) for (d, _), (_, n, c) in zip(rows, inner)]


def test_jaccard_join_of_repeated_ids(spark):
    rows = repeated_ids(24, texts(24, 200, [f"w{i}" for i in range(30)], [0, 4, 9, 25, 70], edits=4))
    got = found(jaccard_join.jaccard_join(frame(spark, rows)), "doc_id", "n_shingles", "component_id")
    assert got == sorted(by_row(rows)) and any(r[0] != r[2] for r in got)


def test_jaccard_join_of_many_copies(spark, monkeypatch):
    """50,000 copies of a text send one entry for each task that meets it to its buckets, and stay one set there."""
    rng = random.Random(25)
    rows = list(enumerate(texts(25, 150, [f"w{i}" for i in range(30)], [4, 9, 14, 25], edits=2)))
    one = " ".join(rng.choice("abcdefgh") + str(k) for k in range(12))
    both = [*rows, *((1000 + i, one) for i in range(50_000)), (999, one + " more")]
    df = frame(spark, both).repartition(3)
    packs = jaccard_join._emit(df.select("doc_id", "text"), 5, 75, 4)
    alone = jaccard_join._emit(frame(spark, [(1, one)]).select("doc_id", "text"), 5, 75, 4)

    def entries(packs):
        return sum(int(np.frombuffer(zstandard.decompress(r["packed"]), np.int64, 1)[0]) for r in packs.where("bucket >= 0").collect())

    assert entries(packs) - entries(jaccard_join._emit(frame(spark, [*rows, (999, one + " more")]).select("doc_id", "text"), 5, 75, 4)) <= 12 * entries(alone)
    monkeypatch.setattr(jaccard_join, "HELD", 50)
    monkeypatch.setattr(jaccard_join, "SENT", 3)
    got = found(jaccard_join.jaccard_join(df), "doc_id", "n_shingles", "component_id")
    want = dict((d, (n, c)) for d, n, c in components([*rows, (1000, one), (999, one + " more")]))
    assert got == sorted([(d, *want[min(d, 1000)]) for d, _ in both])


def test_jaccard_join_reads_no_plan_several_times(spark, monkeypatch):
    """The driver holds and plans anew each written table's whole plan, so none may contain the others' again and again."""
    from emberflux.llm import common

    exchanges, write = [], common.materialize

    def counted(df, tag):
        exchanges.append((df._jdf.queryExecution().executedPlan().toString().count("Exchange "), tag))
        return write(df, tag)

    monkeypatch.setattr(common, "materialize", counted)
    # Of few different words, so that some sets can't pay and the look-up by rarest shingles has work, too.
    rows = list(enumerate(texts(5, 60, "abcdef", [6, 9, 30, 200])))
    got = found(jaccard_join.jaccard_join(frame(spark, rows)), "doc_id", "n_shingles", "component_id")
    assert got == sorted(components(rows))
    assert max(exchanges)[0] <= 12, sorted(exchanges)[-3:]


def test_jaccard_join_of_chains(spark):
    """Texts that slide over one long text: neighbours share 0.3 to 0.8 of their shingles."""
    rng = random.Random(25)
    long, at, rows = [f"v{rng.randrange(5000)}" for _ in range(6000)], 0, []
    while at + 90 < len(long):
        rows.append((len(rows), " ".join(long[at : at + rng.choice((60, 66, 80))])))
        at += rng.choice((4, 7, 12, 25, 30))
    got = found(jaccard_join.jaccard_join(frame(spark, rows)), "doc_id", "n_shingles", "component_id")
    assert got == sorted(components(rows)) and len({c for *_, c in got}) > 20


def test_jaccard_fallback_for_sets_that_cannot_pay(spark):
    """The path for poor sets alone finds the links of all sets."""
    rows = list(enumerate(texts(9, 80, [f"w{i}" for i in range(20)], [6, 12], edits=2)))
    docs = frame(spark, rows).select("doc_id", "text")
    sets = [(d, len(shingles(t)), hash(frozenset(shingles(t))), 0, 0, 9) for d, t in rows]
    sizes = spark.createDataFrame(sets, "doc_id long, size int, k1 long, k2 long, units int, h int")
    links = {tuple(sorted(r)) for r in jaccard_join._fallback(docs, sizes, 5, 75).collect()}
    parent = {d: d for d, _ in rows}
    links |= {(sets[i][0], e[0]) for i in range(len(sets)) for e in sets[:i] if e[2] == sets[i][2] and e[1]}
    for _ in rows:
        for a, b in links:
            parent[a] = parent[b] = min(parent[a], parent[b])
    assert sorted(parent.items()) == sorted((d, c) for d, _, c in components(rows))


def test_quality_rules(spark):
    rows = [*EDGES, *enumerate(texts(5, 60, ["a", "b#", "c|", "d\nd", "e", "f f f"], [0, 9, 40]), 100)]
    df = quality_rules.quality_rules(frame(spark, [*rows, (None, "lost")]))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert found(df, "doc_id", *names) == sorted((d, *counts(t)) for d, t in rows)
    assert not any(r["kept"] for r in df.collect() if r["base_failed"])


def test_quality_rules_reject_outliers_only(spark):
    rng = random.Random(6)
    rows = [(i, " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(40, 160)))) for i in range(200)]
    junk = [(1000 + i, " ".join(f"{w}###%%%" for w in t.split())) for i, t in rows[:12]]
    kept = {r["doc_id"] for r in quality_rules.quality_rules(spark.createDataFrame([(d, t, "en", "s") for d, t in rows + junk], "doc_id long, text string, lang string, source string")).where("kept").collect()}
    assert not kept & {d for d, _ in junk} and len(kept) >= 198


def test_quality_rules_judge_small_groups(spark):
    rng = random.Random(9)
    prose = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(40, 160)))
    rows = [(i, prose(), f"l{i % 3}", f"s{i % 40}") for i in range(240)]
    rows += [(500, prose(), "rare", "s0"), (501, prose(), None, None)]
    junk = [(1000, "l0", "s0"), (1001, "l1", "alone"), (1002, "rare", "s0"), (1003, None, None), (1004, "l2", "pair"), (1005, "l2", "pair")]
    spoiled = [(d, " ".join(f"{w}###%%%" for w in prose().split()), lang, source) for d, lang, source in junk]
    out = quality_rules.quality_rules(spark.createDataFrame(rows + spoiled, "doc_id long, text string, lang string, source string")).collect()
    assert all(r["distance"] is not None for r in out)
    assert {r["doc_id"] for r in out if not r["kept"]} == {d for d, *_ in junk}


def restated_distances(rows, core=0.75, steps=10, prior=50.0):
    """Distances of (doc, key, vector) rows by numpy; a key is (lang, source)."""
    keys = [[()] * len(rows), [k[:1] for _, k, _ in rows], [k for _, k, _ in rows]]
    x = np.array([v for *_, v in rows])
    scale, floors = quality_rules._consistency(core), np.array(quality_rules.FLOORS)
    middle = lambda bins: sorted(bins)[(len(bins) + 1) // 2 - 1]
    fits = {}
    for level in range(3):
        for key in set(keys[level]):
            own = x[[k == key for k in keys[level]]]
            weight = len(own) / (len(own) + prior) if level else 1.0

            def drawn(m, c):
                if level:
                    m, c = weight * m + (1 - weight) * fits[key[:-1]][0], weight * c + (1 - weight) * fits[key[:-1]][1]
                c = c.copy()
                np.fill_diagonal(c, np.maximum(np.diag(c), floors**2))
                return m, c

            bins = np.floor(own / 0.02 + 0.5)
            a = np.array([middle(b) for b in bins.T])
            d = np.maximum([1.4826 * 0.02 * middle(abs(b - m)) for m, b in zip(a, bins.T)], floors)
            a = a * 0.02
            y = np.tanh((own - a) / d)
            s = np.cov(y.T, bias=True).reshape(4, 4)
            r = s / np.sqrt(np.maximum(np.diag(s), 1e-9))[:, None] / np.sqrt(np.maximum(np.diag(s), 1e-9))
            np.fill_diagonal(r, 1)
            best = (np.inf, None)
            for m, c in ((a, np.diag(d**2)), (own.mean(0), np.cov(own.T, bias=True).reshape(4, 4)), (a, r * d[:, None] * d)):
                now, least = drawn(m, c), np.inf
                for _ in range(steps):
                    far = np.einsum("ni,ni->n", own - now[0], np.linalg.solve(now[1], (own - now[0]).T).T)
                    bin_ = np.round(np.log(far + 1e-6) * 64)
                    near = own[bin_ <= sorted(bin_)[max(1, math.floor(core * len(own))) - 1]]
                    new = drawn(near.mean(0), scale * np.cov(near.T, bias=True).reshape(4, 4))
                    if not (value := np.linalg.slogdet(new[1])[1]) < least - 1e-3:
                        break
                    now, least = new, value
                if least < best[0]:
                    best = (least, now)
            fits[key] = best[1]
    return {d: (v - fits[key][0]) @ np.linalg.solve(fits[key][1], v - fits[key][0]) for d, key, v in rows}


def test_least_determinant_is_that_of_many_random_starts(spark):
    """The estimate of all rows against plain concentration from 300 random starts, with a third of the rows off."""
    rng = np.random.default_rng(12)
    good = rng.multivariate_normal([1, 2, 3, 4], np.diag([1.0, 2, 1, 3]) + 0.7, 600)
    bad = rng.multivariate_normal([9, -5, 8, 9], np.eye(4) * 0.6, 150)
    x = np.concatenate((good, bad))
    df = spark.createDataFrame([(0, "l", "s", *map(float, v)) for v in x], "g_all int, g_lang string, g_source string, f0 double, f1 double, f2 double, f3 double")
    found_ = quality_rules.minimum_covariance(df, 0.75, 20, 1e-9).first()
    n, least = int(0.75 * len(x)), np.inf
    for _ in range(300):
        own = x[rng.choice(len(x), 5, replace=False)]
        for _ in range(30):
            m, c = own.mean(0), np.cov(own.T, bias=True) + 1e-9 * np.eye(4)
            own = x[np.argsort(np.einsum("ni,ni->n", x - m, np.linalg.solve(c, (x - m).T).T))[:n]]
        least = min(least, np.linalg.slogdet(quality_rules._consistency(0.75) * np.cov(own.T, bias=True))[1])
    assert found_["determinant"] <= least + 0.05
    far = [(v - [found_[f"m{i}"] for i in range(4)]) @ np.linalg.solve([[found_[f"c{max(i, j)}{min(i, j)}"] for j in range(4)] for i in range(4)], v - [found_[f"m{i}"] for i in range(4)]) for v in bad]
    assert min(far) > quality_rules.quantile(1 - 1e-6)


@pytest.mark.parametrize("broadcast_rows", [quality_rules.BROADCAST_ROWS, 0])
def test_quality_rules_restated(spark, monkeypatch, broadcast_rows):
    monkeypatch.setattr(quality_rules, "BROADCAST_ROWS", broadcast_rows)
    rng = random.Random(10)
    texts_of = lambda: "\n".join(" ".join(rng.choice(["ab", "cdefg", "h#", "ijklm|", "nopqrstu"]) for _ in range(rng.randint(3, 30))) for _ in range(rng.randint(4, 9)))
    rows = [(i, texts_of(), rng.choice("xxxyz"), rng.choice("aab")) for i in range(160)] + [(900, texts_of(), "w", "a")]
    out = quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    vectors = []
    for d, t, lang, source in rows:
        n, chars, symbols, lines, _, failed = counts(t)
        if not failed:
            vectors.append((d, (lang, source), [math.log1p(n), math.log(chars / n), math.log1p(100 * symbols / n), math.log1p(100 * lines / n)]))
    expected = restated_distances(vectors)
    assert len(expected) > 100
    assert {r["doc_id"]: r["distance"] for r in out if not r["base_failed"]} == pytest.approx(expected, rel=1e-6)


def test_pii_spans(spark):
    rng = random.Random(7)
    parts = ["a", "b@", ".", "1", "22", "255", "256", "+", "-", " ", "_x@y.z", "😀", "é", "(", ")", "4111 1111 1111 1111", "+1 (663) 555-6869", "\n", "@", "%"]
    rows = [(100 + i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))) for i in range(800)]
    rows += [*EDGES, (20, "a@b" + ".c" * 5000), (21, "1 " * 5000), (22, "9" * 500)]
    out = pii.find_private(frame(spark, rows)).select("doc_id", F.transform("base", lambda x: F.struct(x.start, x.kind, x.end)).alias("b"))
    got = {r["doc_id"]: [tuple(x) for x in r["b"]] for r in out.collect()}
    assert got == {d: private(t) for d, t in rows}


def test_pii_of_many_spans_in_one_text(spark):
    """Far more spans than a block holds, of mixed kinds, valid and not, in one text."""
    rng = random.Random(71)
    parts = ["a{}@b{}.org", "10.0.{}.{}", "4111 1111 1111 1111", "+1 (663) 555-68{:02}", "999.1.{}.{}", "wörd", "12"]
    one = " ".join(rng.choice(parts).format(rng.randrange(100), rng.randrange(100)) for _ in range(3000))
    rows = [(1, one), (1, "other text with c@d.org"), (2, one + "\n" + one)]
    out = pii.find_private(frame(spark, rows)).withColumn("clean", pii.sanitized()).collect()
    assert sorted((r["doc_id"], len(r["text"]), [(x["start"], x["kind"], x["end"]) for x in r["base"]]) for r in out) == sorted((d, len(t), private(t)) for d, t in rows)
    for r in out:
        at, clean = 0, ""
        for x in r["spans"]:
            if x["start"] >= at:
                clean += r["text"][at : x["start"]] + ("<EMAIL>", "<IP>", "<CARD>", "<PHONE>", "", "<TERM>", "<NAME>")[x["kind"]]
            at = max(at, x["end"])
        assert r["clean"] == clean + r["text"][at:]
        base = [(x["start"], x["end"]) for x in r["base"]]
        assert not any(a < x["end"] and x["start"] < b for x in r["spans"] if x["kind"] > 3 for a, b in base)


def planted(n):
    """Documents with a name, a place and a common word near one address n times, and unrelated ones."""
    rng = random.Random(72)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(4, 7)))
    rows = [(i, f"{word()} Quagmire common {word()} q@x.org or street {word()}\nend common {word()}") for i in range(n)]
    rows += [(100 + i, f"{word()} {word()} street common") for i in range(4)]
    return rows + [(200 + i, f"{word()} common {word()} {word()}@{word()}.org {word()}") for i in range(50)]


def bits_left(n_te, n_lines, n_t, z=1.96):
    p, n = n_te / n_t, min(n_te, n_lines) * n_t / n_te
    return -math.log2((p + z * z / 2 / n - z * math.sqrt(p * (1 - p) / n + z * z / 4 / n**2)) / (1 + z * z / n))


@pytest.mark.parametrize("n", [3, 6, 20])
def test_pii_terms_follow_evidence_only(spark, n):
    """Whatever the number of unrelated documents, a term seen 20 times is removed, 6 times generalised, and no rare word is touched."""
    rows = planted(n)
    found = []
    for more in (0, 60, 3000):
        df = spark.createDataFrame(rows + [(1000 + i, f"x y unrelated common{i}") for i in range(more)], "doc_id long, text string")
        out = pii.find_private(df).withColumn("clean", pii.sanitized()).where("doc_id < 1000")
        found.append(sorted((r["doc_id"], r["clean"], [(x["start"], x["kind"], x["value"]) for x in r["spans"] if x["kind"] > 3]) for r in out.collect()))
    assert found[0] == found[1] == found[2]
    kinds = {"Quagmire": {3: None, 6: 6, 20: 4}[n], "street": {3: None, 6: None, 20: 5}[n]}
    assert bits_left(6, 6, 6) <= 1 and bits_left(20, 20, 20) <= 0.3 and bits_left(6, 6, 10) > 1 >= bits_left(20, 20, 24) > 0.3
    for d, clean, spans in found[0]:
        assert [(k, v) for _, k, v in spans] == [(k, v) for v, k in kinds.items() if k and d < n]
        assert ("Quagmire" in clean) == (d < n and n == 3) and "common" in clean
        if d < n:
            assert "<EMAIL>" in clean and ("<NAME>" in clean) == (n == 6) and ("or <TERM>" in clean) == (n == 20)


def test_pii_bits_of_terms(spark):
    rows = planted(20) + [(2000 + i, "copycat word c@d.org") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    told = pii.mentions(pii.base_spans(df.withColumn("row_key", F.xxhash64("text")), 200))
    bits = {(r["entity"], r["term"]): r["bits"] for r in pii.judged_terms(told, df, 1.96, 9.0).collect()}
    assert bits["q@x.org", "quagmire"] == pytest.approx(bits_left(20, 20, 20)) and bits["q@x.org", "street"] == pytest.approx(bits_left(20, 20, 24))
    assert bits["q@x.org", "common"] == pytest.approx(bits_left(20, 20, 74)) and bits["c@d.org", "copycat"] == pytest.approx(bits_left(30, 1, 30))
    few = {(r["entity"], r["term"]) for r in pii.judged_terms(told, df, 1.96, 1.0).collect()}
    assert few == {k for k, x in bits.items() if x <= 1} == {("q@x.org", "quagmire"), ("q@x.org", "street")}


def test_language_id(spark):
    rng = random.Random(8)
    kinds = {"xx": ["ba", "do", "ki"], "yy": ["schr", "ung", "pf"], "zz": ["eau", "oux", "ille"]}
    rows = [(i, " ".join("".join(rng.choice(s) for _ in range(rng.randint(1, 4))) for _ in range(30)), lang) for i, (lang, s) in enumerate(list(kinds.items()) * 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    models = language_id.train(df.where("doc_id % 2 = 0"))
    assert {(r["doc_id"], r["lang_pred"]) for r in language_id.predict(df, models).collect()} == {(d, lang) for d, _, lang in rows}
    edges = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.predict(frame(spark, EDGES), models).collect()}
    assert edges[1] == edges[2] == edges[3] == ("und", 0.0) and edges[8][0] in kinds and 0 <= edges[8][1] <= 1
    assert language_id.predict(df, language_id.train(df.limit(0))).where("lang_pred <> 'und'").isEmpty()


def test_language_id_learns_from_whole_texts(spark):
    rows = [(i, "ba " * 10_000 + "quux", f"l{i:02}") for i in range(36)]
    models = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    flat = models.coded(" quux ")
    assert len(models.automata) == 36 and all(m.phrases(flat, np.array([0]), np.array([6])).tolist() == [1] for m in models.automata.values())


def longest_match_phrases(text, query):
    i = n = 0
    while i < len(query):
        j = i + 1
        while j < len(query) and query[i : j + 1] in text:
            j += 1
        i, n = j, n + 1
    return n


def test_automaton_parses_by_longest_match():
    rng = random.Random(9)
    for _ in range(60):
        text = "".join(rng.choice("abc") for _ in range(rng.randint(0, 30)))
        queries = sorted(("".join(rng.choice("abcd") for _ in range(rng.randint(0, 30))) for _ in range(8)), key=lambda q: -len(q))
        flat, sizes = np.array([ord(c) - 96 for q in queries for c in q], np.int32), np.array([len(q) for q in queries])
        got = language_id.SuffixAutomaton([ord(c) - 96 for c in text]).phrases(flat, np.cumsum(sizes) - sizes, sizes)
        assert got.tolist() == [longest_match_phrases(text, q) for q in queries]


def test_language_predictions_against_plain_parsing(spark, monkeypatch):
    """Entropies, ties, scores and stretches restated, on texts of shared letters, with rare letters and over word borders."""
    monkeypatch.setattr(language_id, "OWN", 6)
    rng = random.Random(10)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randint(1, 5)))
    letters = {"p": "abcdé", "q": "abcdé漢", "r": "bcdefß"}
    rows = [(i, " ".join(word(letters["pqr"[i % 3]]) for _ in range(rng.choice([1, 8, 40, 600]))) + rng.choice(["", "!", " 12 "]), "pqr"[i % 3]) for i in range(60)] + [(60, "123 !", "p"), (61, None, "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    models = language_id.train(df.where("doc_id < 30"))
    clean = lambda t: f" {' '.join(re.findall(r'[^\W\d_]+', (t or '').lower()))} ".replace("  ", "")
    learned = {lang: "".join(clean(r["text"]) for r in sorted(language_id.labelled(df.where("doc_id < 30"), 300, 60_000).where(F.col("lang") == lang).collect(), key=lambda r: (r["h"], r["doc_id"], r["text"]))).replace("  ", " ") for lang in "pqr"}
    known = [c for c, _ in sorted(Counter("".join(learned.values()).replace(" ", "")).items(), key=lambda x: (-x[1], x[0]))[:6]]
    one = lambda t: "".join(c if c in known or c == " " else chr(0xE000 + ord(c) % 57) for c in t)
    for r in language_id.predict(df, models).collect():
        text = clean(rows[r["doc_id"]][1])
        if not text.strip():
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        entropy = sorted((sum(longest_match_phrases(one(learned[x]), one(text[a : a + 2048])) for a in range(0, len(text), 2048)) * math.log2(len(learned[x]) + 1) / len(text), x) for x in "pqr")
        assert r["lang_pred"] == entropy[0][1] and r["score"] == pytest.approx(entropy[1][0] / (entropy[0][0] + entropy[1][0]))


def distance(p, t):
    row = [0] * (len(t) + 1)
    for i, c in enumerate(p, 1):
        new = [i]
        for j, d in enumerate(t, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_decontamination(spark):
    rng = random.Random(10)
    items = [(i, " ".join("".join(rng.choice("abcdef") for _ in range(rng.randint(2, 7))) for _ in range(30))) for i in range(6)] + [(90, None), (91, " "), (92, "short")]
    rows = []
    for i in range(60):
        passage = list(rng.choice(items[:6])[1])
        for _ in range(rng.randint(0, 16)):
            passage[rng.randrange(len(passage))] = rng.choice(["", "x", "yy"])
        rows.append((100 + i, "Before it. " + "".join(passage).upper().replace(" ", "\n ") + " after"))
    rows += EDGES
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = []
    for d, t in rows:
        for i, x in items:
            p, q = decontaminate.normalize(x), decontaminate.normalize(t)
            if p and len(q) < 10_000 and (e := distance(p, q)) <= decontaminate.budget(len(p), 0.05, 12):
                expected.append((d, i, e))
    for block in (1 << 24, 100):
        assert found(decontaminate.leaks(frame(spark, rows), bench, block_chars=block), "doc_id", "item_id", "distance") == sorted(expected)
    clean = decontaminate.decontaminate(frame(spark, rows), bench, block_chars=100)
    assert clean.columns == SCHEMA.replace(",", "").split()[::2]
    assert {r["doc_id"] for r in clean.collect()} == {d for d, _ in rows} - {x[0] for x in expected}


def test_bpe_round_trip(spark):
    tokenizers = pytest.importorskip("public_tokenizers")
    import tiktoken

    path = tokenizers.path("byte_bpe_50k.tiktoken")
    plain = tiktoken.Encoding("t", pat_str=tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    rows = [*EDGES, (30, "it's  two   spaces \n\n end "), (31, "<|endoftext|>"), (30, "again")]
    expected = sorted((d, len(i := plain.encode_ordinary(t or "")), sha(" ".join(map(str, i)).encode()), sha((t or "").encode())) for d, t in rows)
    assert found(bpe.digests(frame(spark, [*rows, (None, "lost")]), path, tokenizers.PATTERN), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == expected
    assert found(bpe.decode(bpe.encode(frame(spark, rows), path, tokenizers.PATTERN, chunk_bytes=50), path).select("doc_id", F.sha2("decoded", 256).alias("s")), "doc_id", "s") == sorted((d, sha((t or "").encode())) for d, t in rows)


def test_quality_model(spark):
    rng = random.Random(11)
    good = [(100 + i, " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(30, 120))) + ".") for i in range(150)]
    bad = [(1000 + i, " ".join(f"{w}###%%%" if i % 2 else w.upper() + "!!" for w in t.split())) for i, (_, t) in enumerate(good[:40])]
    got = {r["doc_id"]: r["kept"] for r in quality_model.quality_model(frame(spark, good + bad + EDGES)).collect()}
    assert len(got) == len(good + bad + EDGES)
    assert sum(got[d] for d, _ in good) >= 147 and sum(got[d] for d, _ in bad) <= 2
    assert not any(got[d] for d in (1, 2, 3))


def test_expectation_maximisation_restated():
    """Over patterns and counts as over single documents, in plain loops."""
    rng = np.random.default_rng(3)
    docs = rng.choice([-1, 0, 1], (400, 3), p=[0.3, 0.3, 0.4])
    patterns, n = np.unique(docs, axis=0, return_counts=True)
    post, shares = quality_model.expectation_maximisation(patterns, n.astype(float), rounds=25)
    p = [((d == 1).sum() + 0.5) / ((d >= 0).sum() + 1.0) for d in docs]
    for _ in range(25):
        weight = [p, [1 - x for x in p]]
        prior = [(sum(w) + 1) / (len(docs) + 2) for w in weight]
        share = [[[sum(w for w, d in zip(weight[c], docs) if d[j] == v) + 0.05 * len(docs) * quality_model.EXPECTED[c][k] for j in range(3)] for k, v in enumerate((1, 0, -1))] for c in (0, 1)]
        for c in (0, 1):
            for j in range(3):
                total = sum(share[c][k][j] for k in range(3))
                for k in range(3):
                    share[c][k][j] /= total
        like = [[prior[c] * math.prod(share[c][(1, 0, -1).index(d[j])][j] for j in range(3)) for d in docs] for c in (0, 1)]
        p = [a / (a + b) for a, b in zip(*like)]
    of = {tuple(x): y for x, y in zip(patterns, post)}
    assert [of[tuple(d)] for d in docs] == pytest.approx(p, abs=1e-6) and shares == pytest.approx(np.array(share), abs=1e-6)


def test_expectation_maximisation_finds_the_better_labeller():
    import numpy as np

    rng = np.random.default_rng(1)
    truth = rng.random(20_000) < 0.7
    votes = np.stack([np.where(rng.random(20_000) < p, truth, ~truth).astype(int) for p in (0.95, 0.75, 0.8)], 1)
    patterns, n = np.unique(votes, axis=0, return_counts=True)
    post, shares = quality_model.expectation_maximisation(patterns, n.astype(float))
    right = {tuple(p): x > 0.5 for p, x in zip(patterns, post)}
    assert np.mean([right[tuple(v)] for v in votes] == truth) > 0.93 and shares[0][0].argmax() == 0


def test_chat_format(spark):
    call = '{"content":"x","tool_calls":[{"id":"b","name":"f","arguments":{"y":2,"x":"s"},"after":["a"]},{"id":"a","name":"g","arguments":{"q":1}},{"id":"c","name":"f","arguments":{"x":1},"after":["d"]},{"id":"d","name":"f","arguments":{},"after":["c"]}]}'
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", call), (1, 2, "tool", '{"tool_call_id":"a","content":"r"}'), (1, 3, "tool", '{"tool_call_id":"zz","content":"r"}'), (2, 0, None, None), (2, 0, "user", ""), (2, 1, "assistant", "{broken"), (None, 1, "user", "lost")]
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], "conv_id long, turn long, role string, text string, calls int, level string")
    parameters = spark.createDataFrame([("f", "x", "string", True), ("f", "y", "integer", False)], chat_format.PARAMETERS)
    got = {(r[0], r[1], r[2]): tuple(r)[3:] for r in chat_format.format_chat(df, parameters).collect()}
    assert len(got) == 7 and (1, 0, '{"content":"hi","role":"user"}') in got and (2, 0, '{"content":null,"role":null}') in got and (2, 1, '{"content":"{broken","role":"assistant"}') in got
    asked = next(k for k in got if k[:2] == (1, 1))
    order = [asked[2].index(f'"id":"{x}"') for x in "abcd"]
    assert order == sorted(order) and got[asked] == (4, 1, 3) and '"level":null' in asked[2] and "missing x" in asked[2] and "wrong type of x" in asked[2]
    assert '"linked":true' in next(k for k in got if k[:2] == (1, 2))[2] and '"linked":false' in next(k for k in got if k[:2] == (1, 3))[2]


def test_calls_that_repeat_an_id_keep_their_own(spark):
    one, two = '{"content":"","tool_calls":[{"id":"x","name":"f","arguments":{"x":"s"}},{"id":"x","name":"g","arguments":{"b":3}}]}', '{"content":"","tool_calls":[{"id":"x","name":"f","arguments":{"b": 2},"after":["x"]}]}'
    rows = [(1, 0, "assistant", one), (1, 2, "assistant", two), (1, 3, "tool", '{"tool_call_id":"x","content":"r"}'), (2, 0, "assistant", two)]
    parameters = spark.createDataFrame([("f", "x", "string", True)], chat_format.PARAMETERS)
    got = [(tuple(r)[:2], [tuple(c[k] for k in ("name", "arguments", "level", "problems", "repeated", "result_turn")) for c in json.loads(r["json"]).get("tool_calls", [])], tuple(r)[3:]) for r in chat_format.format_chat(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), parameters).collect()]
    wrong = ["missing x", "unknown parameter b"]
    assert sorted(got) == [
        ((1, 0), [("f", '{"x":"s"}', 0, [], False, 3), ("g", '{"b":3}', None, ["unknown parameter b", "unknown tool"], True, None)], (2, 1, 1)),
        ((1, 2), [("f", '{"b":2}', None, wrong, True, None)], (1, 0, 1)),
        ((1, 3), [], (0, 0, 0)),
        ((2, 0), [("f", '{"b":2}', 0, wrong, False, None)], (1, 0, 1)),
    ]


def test_messages_that_share_conversation_and_turn(spark):
    one, two = ('{"content":"x","tool_calls":[{"id":"%s","name":"f","arguments":{}}]}' % x for x in "ab")
    rows = [(1, 1, "assistant", one), (1, 1, "assistant", two), (1, 1, "assistant", two), (1, 2, "tool", '{"tool_call_id":"b","content":"r"}')]
    got = sorted(tuple(r) for r in chat_format.format_chat(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect())
    assert [r[3:] for r in got] == [(1, 0, 1), (1, 1, 1), (1, 1, 1), (0, 0, 0)] and got[1] == got[2] and '"id":"a"' in got[0][2] and '"id":"b"' in got[1][2]


def test_long_chain_of_calls(spark):
    calls = ",".join(f'{{"id":"c{i}","name":"f","arguments":{{}},"after":["c{i - 1}"]}}' for i in range(4, -1, -1))
    df = spark.createDataFrame([(1, 0, "assistant", f'{{"tool_calls":[{calls}]}}')], "conv_id long, turn long, role string, text string")
    text = chat_format.format_chat(df).first()["json"]
    assert [text.index(f'"id":"c{i}"') for i in range(5)] == sorted(text.index(f'"id":"c{i}"') for i in range(5))


def plain_features(text):
    """Measures, and features by name: words, shapes of words, and levels of the measures."""
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or ""), text or ""
    low, own, raw = words(text[0]), words(text[1]), text[1].encode()
    kind = lambda b: 1 if 97 <= b <= 122 or b > 127 else 2 if 65 <= b <= 90 else 4 if 48 <= b <= 57 else 8 if chr(b) in ".,;:?!'\"()-" else 16 if chr(b) in "#*$%&|<>@^~_=+{}[]\\/`" else 0
    kinds, n = Counter(map(kind, raw)), len(low)
    grams = [tuple(low[i : i + 5]) for i in range(n - 4)]
    lines = [x for x in text[1].split("\n") if x.strip(" \t\r\v\f")]
    size = lambda w: len(w.encode())
    m = [n, kinds[16] / n, kinds[2] / max(1, kinds[1] + kinds[2]), 1 - len(set(grams)) / max(1, len(grams)), 1 - len(set(lines)) / max(1, len(lines)), sum(map(size, low)) / n, raw.count(b"!") / n, kinds[4] / max(1, len(raw))] if n else [0.0] * 8
    found = Counter(("word", w) for w in low)
    for w in own:
        shape = 0
        for b in w.encode():
            shape |= kind(b)
        found["shape", shape, min(size(w), 20)] += 1
    levels = [*(int(min(20, 40 * v)) for v in m[1:5]), int(min(20, m[5])), int(min(20, 60 * m[6])), int(min(20, 40 * m[7]))]
    return m, {k: v / (n + 30) for k, v in found.items()} | {("level", k, v): 1.0 for k, v in enumerate(levels)}


def test_quality_scorer_against_named_weights(spark):
    """Measures, training and scores with weights by name instead of hash; enough bits that no two names meet."""
    rng = random.Random(31)
    prose = lambda: " ".join(rng.choice(["lorem", "Ipsum", "dolor!", "a1", "##x", "çedille", "amet,"]) for _ in range(rng.randint(0, 40))) + rng.choice(["", "\nx y\nx y"])
    rows = [(i, prose()) for i in range(60)] + [(60, None), (61, "")]
    df = frame(spark, rows)
    found = {r["doc_id"]: [r[c] for c in quality_model.MEASURES] for r in quality_model.measured(df).collect()}
    plain = {d: plain_features(t) for d, t in rows}
    for d, (m, _) in plain.items():
        assert found[d] == pytest.approx(m)
    labels = [(d, t, rng.random()) for d, t in rows[:40]]
    weights, bias = quality_model.train(spark.createDataFrame(labels, "doc_id long, text string, posterior double").coalesce(1), 22, rounds=5)
    w, sums, b, own, order = Counter(), {}, 0.0, 1e-6, np.random.default_rng(7)
    for _ in range(5):
        for i in order.permutation(len(labels)):
            d, _, target = labels[i]
            f = {k: float(np.float32(v)) for k, v in plain[d][1].items()}
            slope = 1 / (1 + math.exp(-(b + sum(w[k] * v for k, v in f.items())))) - target
            for k, v in f.items():
                sums[k] = sums.get(k, 1e-6) + (slope * v) ** 2
                w[k] -= 0.5 * slope * v / math.sqrt(sums[k])
            own += slope * slope
            b -= 0.5 * slope / math.sqrt(own)
    assert bias == pytest.approx(b, rel=1e-4)
    for r in quality_model.score(df, weights, bias, 22).collect():
        f = plain[r["doc_id"]][1]
        expected = 1 / (1 + math.exp(-(b + sum(w[k] * v for k, v in f.items())))) if len(f) > 7 else 0.0
        assert r["score"] == pytest.approx(expected, abs=1e-4)


def test_empty_tables(spark):
    none = frame(spark, [])
    bench = spark.createDataFrame([], "item_id long, text string")
    chat = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    outs = [substring_dedup.substring_dedup(none), suffix_dedup.suffix_dedup(none), jaccard_join.jaccard_join(none), quality_rules.quality_rules(none), pii.find_private(none), language_id.predict(none, language_id.train(none)), decontaminate.leaks(none, bench), quality_model.quality_model(none), chat_format.format_chat(chat)]
    tokenizers = pytest.importorskip("public_tokenizers")
    outs.append(bpe.digests(none, tokenizers.path("byte_bpe_50k.tiktoken"), tokenizers.PATTERN))
    assert all(df.count() == 0 for df in outs)


def test_brute_words():
    assert words("a\x0bb\xa0c\x1cd") == ["a", "b\xa0c\x1cd"] and KINDS[0] == "email"
