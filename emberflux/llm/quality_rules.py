"""Operator 9: quality rules with robust multivariate outliers, in DataFrame functions only.

Base rules come from counts over the whole text. Beyond them, all rows, each language and each
(lang, source) group get a minimum-covariance-determinant estimate of location and scatter of a
transformed statistic vector. Three starts (medians and median deviations; mean and covariance; medians
with the correlation of tanh scores) are each improved by concentration steps: the rows nearest in
Mahalanobis distance (a share `core` of the group) give the next mean and covariance, until the
determinant stops falling; of all starts the least determinant counts. Levels go from all rows down, and
every estimate is drawn at each step towards that of the level above: n rows count against `prior` rows
of it, so every row is judged however small its group. All group statistics are counts, sums and
fixed-width histograms, which combine on the map side, and rows meet the few numbers of their group by
broadcast or, beyond a checked size, by group and salt, so a hot group is never gathered anywhere. Rows
beyond a chi-square quantile of the squared distance are rejected.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from . import common as C

WORD = r"[^\x20\x09-\x0D]+"
P = 4
#: Least standard deviation of each feature, so that a group in which a feature never varies rejects no small departure.
FLOORS = (0.5, 0.08, 0.5, 0.5)
#: What names a group: its level (1 all rows, 2 a language, 3 a language and source) and what tells it from others of the level.
GROUP = ["g_level", "g_lang", "g_source"]
START = [*GROUP, "start", "size"]
PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]
M, COV, FACTOR = [f"m{i}" for i in range(P)], [f"c{i}{j}" for i, j in PAIRS], [f"l{i}{j}" for i, j in PAIRS]
UP = [f"up_{v}" for v in (*M, *COV)]
#: Tables of groups with up to this many rows (some 5 MB) are broadcast; beyond it rows meet their groups by group and salt.
BROADCAST_ROWS = 20_000
SALTS = 64


def statistics(docs: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words to rows with `text`."""
    text, n = F.coalesce("text", F.lit("")), F.col("n_words")
    windows = F.when(n >= 5, F.transform(F.slice("wh", F.lit(1), n - 4), lambda x, i: F.xxhash64(x, *(F.get("wh", i + F.lit(k)) for k in range(1, 5))))).otherwise(F.array().cast("array<bigint>"))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return (
        docs.withColumn("words", F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
        .withColumn("lines", lines)
        .withColumn("n_words", F.size("words").cast("long"))
        .withColumn("word_chars", F.length(F.array_join("words", "")).cast("long"))
        .withColumn("n_symbols", (F.length(text) - F.length(F.regexp_replace(text, "[#*$%&|<>]+", ""))).cast("long"))
        .withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
        .withColumn("wh", F.transform("words", lambda w: F.xxhash64(w)))
        .drop("words", "lines")
        .withColumn("windows", windows.cast("array<bigint>"))
        .drop("wh")
        .withColumn("sorted", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
        .drop("windows")
        .withColumn("again", F.filter(F.transform("sorted", lambda x, j: F.when((x.h == F.get("sorted", j - 1).h) | (x.h == F.get("sorted", j + 1).h), x.i)), lambda i: i.isNotNull()))
        .drop("sorted")
        .withColumn("again", F.sort_array("again"))
        .withColumn("n_repeat_words", F.coalesce(F.aggregate(F.transform("again", lambda i, j: F.least(F.lit(5), F.coalesce(F.get("again", j + 1) - i, F.lit(5)))), F.lit(0), lambda a, b: a + b), F.lit(0)).cast("long"))
        .drop("again")
    )


def base_failed(min_words: int = 10, repeat_percent: int = 20) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))


def _features() -> list[Column]:
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return [F.log1p("n_words"), F.log(F.greatest(F.col("word_chars"), F.lit(1)) / words), F.log1p(100.0 * F.col("n_symbols") / words), F.log1p(100.0 * F.col("n_dup_lines") / words)]


def _below(d: float) -> float:
    """Distribution function of chi-square with 4 degrees of freedom."""
    return 1 - math.exp(-d / 2) * (1 + d / 2)


def quantile(p: float) -> float:
    a, b = 0.0, 1000.0
    for _ in range(200):
        a, b = ((a + b) / 2, b) if _below((a + b) / 2) < p else (a, (a + b) / 2)
    return a


def _consistency(core: float) -> float:
    """By how much the covariance of the inner share `core` falls short for normal data."""
    x = quantile(core) / 2
    return core / (1 - math.exp(-x) * (1 + x + x * x / 2))


def _at(level: int, rows: DataFrame, *columns: str) -> DataFrame:
    """The rows as members of their groups of one level."""
    return rows.select(F.lit(level).alias("g_level"), *((F.col(c) if level > k else F.lit("")).alias(c) for k, c in enumerate(GROUP) if k), *columns)


def _every_level(part: Callable[[int], DataFrame]) -> DataFrame:
    """One DataFrame of all levels. Each has joins of its own, so that the one group of all rows never is a hot join key."""
    return part(1).unionByName(part(2)).unionByName(part(3))


def _few(groups: DataFrame) -> bool:
    return groups.count() <= BROADCAST_ROWS


def _meet(rows: DataFrame, groups: DataFrame, few: bool, how: str = "inner") -> DataFrame:
    """The rows with the columns of their groups; a hot group's rows stay where they are, or are dealt over SALTS."""
    if few:
        return rows.join(F.broadcast(groups), GROUP, how)
    dealt = rows.withColumn("salt", (F.monotonically_increasing_id() % SALTS).cast("int"))
    return dealt.join(groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), [*GROUP, "salt"], how).drop("salt")


def _cut(counts: DataFrame, share: float, *by: str) -> DataFrame:
    """The least bin at which a histogram (by.., bin, n) holds `share` of its rows."""
    order = Window.partitionBy(*by).orderBy("bin")
    run = counts.select(*by, "bin", F.sum("n").over(order).alias("up_to"), F.sum("n").over(Window.partitionBy(*by)).alias("all"))
    return run.where(F.col("up_to") >= share * F.col("all")).groupBy(*by).agg(F.min("bin").alias("bin"))


def _medians(vectors: DataFrame, width: float = 0.02) -> DataFrame:
    """Rows `size`, median and scaled median deviation of each feature in each group, from histograms of fixed width."""
    long = vectors.select(*GROUP[1:], F.posexplode(F.array(*(f"f{i}" for i in range(P)))).alias("feature", "x"))
    finest = C.materialize(long.groupBy("g_lang", "g_source", "feature", F.round(F.col("x") / width).cast("int").alias("bin")).agg(F.count("*").alias("n")), "mcd")
    counts = C.materialize(_every_level(lambda k: _at(k, finest, "feature", "bin", "n").groupBy(*GROUP, "feature", "bin").agg(F.sum("n").alias("n"))), "mcd")
    middle = _cut(counts, 0.5, *GROUP, "feature").withColumnRenamed("bin", "middle")
    off = counts.join(middle, [*GROUP, "feature"]).groupBy(*GROUP, "feature", F.abs(F.col("bin") - F.col("middle")).alias("bin")).agg(F.sum("n").alias("n"))
    sizes = counts.groupBy(*GROUP, "feature").agg(F.sum("n").alias("n"))
    both = middle.join(_cut(off, 0.5, *GROUP, "feature"), [*GROUP, "feature"]).join(sizes, [*GROUP, "feature"])
    of = lambda i, value: F.max(F.when(F.col("feature") == i, value))
    rows = both.groupBy(*GROUP).agg(F.max("n").alias("size"), *(of(i, F.col("middle") * width).alias(f"a{i}") for i in range(P)), *(of(i, 1.4826 * width * F.col("bin")).alias(f"d{i}") for i in range(P)))
    return C.materialize(rows.select(*GROUP, "size", *(f"a{i}" for i in range(P)), *(F.greatest(F.col(f"d{i}"), F.lit(FLOORS[i])).alias(f"d{i}") for i in range(P))), "mcd")


def _moments(n: Column, sums: list[Column], squares: dict) -> dict:
    return {(i, j): squares[i, j] / n - sums[i] * sums[j] / n / n for i, j in PAIRS}


def _starts(vectors: DataFrame) -> DataFrame:
    """The key START and the raw mean m0.. and covariance c00.. of the three starts of each group of every level."""
    middle = _medians(vectors)
    few = _few(middle)
    x = [F.col(f"f{i}") for i in range(P)]
    y = [F.tanh((F.col(f"f{i}") - F.col(f"a{i}")) / F.col(f"d{i}")) for i in range(P)]
    totals = [F.count("*").alias("n"), *(F.sum(v[i]).alias(f"{k}{i}") for k, v in (("x", x), ("y", y)) for i in range(P)), *(F.sum(v[i] * v[j]).alias(f"{k}{i}{j}") for k, v in (("xx", x), ("yy", y)) for i, j in PAIRS)]
    sums = _every_level(lambda k: _meet(_at(k, vectors, *(f"f{i}" for i in range(P))), middle.where(F.col("g_level") == k).drop("size"), few).groupBy(*GROUP).agg(*totals))
    n = F.col("n")
    plain = _moments(n, [F.col(f"x{i}") for i in range(P)], {(i, j): F.col(f"xx{i}{j}") for i, j in PAIRS})
    score = _moments(n, [F.col(f"y{i}") for i in range(P)], {(i, j): F.col(f"yy{i}{j}") for i, j in PAIRS})
    spread = [F.sqrt(F.greatest(score[i, i], F.lit(1e-9))) for i in range(P)]
    deviation = [F.col(f"d{i}") for i in range(P)]
    starts = [
        ([F.col(f"a{i}") for i in range(P)], [deviation[i] * deviation[i] if i == j else F.lit(0.0) for i, j in PAIRS]),
        ([F.col(f"x{i}") / n for i in range(P)], [plain[p] for p in PAIRS]),
        ([F.col(f"a{i}") for i in range(P)], [deviation[i] * deviation[i] if i == j else score[i, j] / spread[i] / spread[j] * deviation[i] * deviation[j] for i, j in PAIRS]),
    ]
    both = sums.join(middle, GROUP)
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("start"), *(c.alias(f"m{i}") for i, c in enumerate(m)), *(c.alias(name) for c, name in zip(cov, COV))) for k, (m, cov) in enumerate(starts)))).alias("s")
    return both.select(*GROUP, "size", each).select(*GROUP, "size", "s.*")


def _factored(raw: DataFrame, prior: float) -> DataFrame:
    """The estimate drawn towards that of the level above (UP), with floors on its variances, its Cholesky factor l00.. and log-determinant."""
    weight = F.when(F.col("g_level") == 1, 1.0).otherwise(F.col("size") / (F.col("size") + F.lit(prior)))
    raw = raw.withColumns({v: weight * F.col(v) + (1 - weight) * F.col(f"up_{v}") for v in (*M, *COV)})
    raw = raw.withColumns({f"c{i}{i}": F.greatest(F.col(f"c{i}{i}"), F.lit(FLOORS[i] ** 2)) for i in range(P)})
    for i, j in PAIRS:
        rest = F.col(f"c{i}{j}")
        for k in range(j):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        raw = raw.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(1e-9))) if i == j else rest / F.col(f"l{j}{j}"))
    return raw.withColumn("determinant", 2 * sum((F.log(f"l{i}{i}") for i in range(1, P)), F.log("l00")))


def _distances(vectors: DataFrame, groups: DataFrame, few: bool, how: str = "inner") -> DataFrame:
    """The rows and their squared distance from their group; a row for each start, if groups have starts."""
    more = [c for c in ("start", "size") if c in groups.columns]
    rows = _meet(vectors, groups.select(*GROUP, *more, *M, *FACTOR), few, how)
    for i in range(P):
        rest = F.col(f"f{i}") - F.col(f"m{i}")
        for k in range(i):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"y{k}")
        rows = rows.withColumn(f"y{i}", rest / F.col(f"l{i}{i}"))
    total = sum((F.col(f"y{i}") * F.col(f"y{i}") for i in range(1, P)), F.col("y0") * F.col("y0"))
    return rows.select(*vectors.columns, *more, total.alias("distance"))


def _concentrated(vectors: DataFrame, groups: DataFrame, few: bool, core: float) -> DataFrame:
    """Raw mean and covariance of the rows nearest to each estimate: the bins of distance up to the share `core`."""
    far = _distances(vectors, groups, few)
    bins = far.groupBy(*START, F.round(F.log(F.col("distance") + 1e-6) * 64).cast("int").alias("bin")).agg(F.count("*").alias("n"), *(F.sum(f"f{i}").alias(f"s{i}") for i in range(P)), *(F.sum(F.col(f"f{i}") * F.col(f"f{j}")).alias(f"q{i}{j}") for i, j in PAIRS))
    before = F.sum("n").over(Window.partitionBy(*START).orderBy("bin")) - F.col("n")
    near = bins.withColumn("before", before).where(F.col("before") < F.greatest(F.lit(1), F.floor(core * F.col("size"))))
    near = near.groupBy(*START).agg(F.sum("n").alias("n"), *(F.sum(f"s{i}").alias(f"s{i}") for i in range(P)), *(F.sum(f"q{i}{j}").alias(f"q{i}{j}") for i, j in PAIRS))
    n, scale = F.col("n"), _consistency(core)
    cov = _moments(n, [F.col(f"s{i}") for i in range(P)], {(i, j): F.col(f"q{i}{j}") for i, j in PAIRS})
    return near.select(*START, *((F.col(f"s{i}") / n).alias(f"m{i}") for i in range(P)), *((scale * cov[i, j]).alias(f"c{i}{j}") for i, j in PAIRS))


def minimum_covariance(vectors: DataFrame, core: float, steps: int, prior: float, tolerance: float = 1e-3) -> DataFrame:
    """Mean, covariance, factor and log-determinant of each (lang, source) group: the least determinant of all starts.

    The starts of all levels are worked out together. An estimate's table carries that of the level above
    it, so a step joins the rows with the estimates, and the new estimates with the old ones. A start
    ends when a step lowers its log-determinant by no more than `tolerance`, after `steps` steps at the latest.
    """
    features, values = [f"f{i}" for i in range(P)], [*M, *COV, *FACTOR, "determinant"]
    starts, above = C.materialize(_starts(vectors), "mcd"), None
    few = _few(starts)
    for level in (1, 2, 3):
        members, now = _at(level, vectors, *features), starts.where(F.col("g_level") == level)
        if above is None:
            now = now.select("*", *(F.lit(0.0).alias(v) for v in UP))
        else:
            parents = above.select(F.col("g_lang").alias("p_lang"), *(F.col(v).alias(f"up_{v}") for v in (*M, *COV)))
            now = now.withColumn("p_lang", F.col("g_lang") if level == 3 else F.lit("")).join(parents, "p_lang").drop("p_lang")
        now = C.materialize(_factored(now, prior).withColumn("determinant", F.lit(float("inf"))).select(*START, *UP, F.lit(True).alias("falls"), *values), "mcd")
        for _ in range(steps):
            old = now.select(*START, *UP, F.struct(*values).alias("old"))
            new = _factored(old.join(_concentrated(members, now.where("falls"), few, core), START, "left"), prior)
            less = F.col("m0").isNotNull() & (F.col("determinant") < F.col("old.determinant") - tolerance)
            still = Observation()
            now = new.select(*START, *UP, less.alias("falls"), *(F.when(less, F.col(v)).otherwise(F.col(f"old.{v}")).alias(v) for v in values))
            now = C.materialize(now.observe(still, F.count_if("falls").alias("falls")), "mcd")
            if not still.get["falls"]:
                break
        least = now.groupBy(*GROUP).agg(F.min(F.struct("determinant", "start", *(v for v in values if v != "determinant"))).alias("best"))
        above = C.materialize(least.select(*GROUP, "best.*").drop("start"), "mcd")
    return above


def quality_rules(documents: DataFrame, core: float = 0.75, steps: int = 10, alpha: float = 1e-6, prior: float = 50.0) -> DataFrame:
    """doc_id, the five counts, base_failed, kept, the squared robust `distance` and row_key, which tells rows of one doc_id apart.

    `distance` is null in a group without a row that passes the base rules. Defined cases: a null or empty
    text has zero counts and fails the base rules; a very long text is one row's work; null lang or source
    is a group of its own; rows that repeat a doc_id each give a row, judged by its own text, lang and
    source (row_key is `row_key()` of them); rows without doc_id are left out; other columns are ignored;
    an empty table gives an empty result.
    """
    docs = C.documents(documents, F.lit(3).alias("g_level"), F.coalesce(F.col("lang").cast("string"), F.lit("\0")).alias("g_lang"), F.coalesce(F.col("source").cast("string"), F.lit("\0")).alias("g_source"), row_key().alias("row_key"))
    rated = statistics(docs).drop("text").withColumn("base_failed", base_failed())
    rated = C.materialize(rated.select("*", *(f.alias(f"f{i}") for i, f in enumerate(_features()))), "statistics")
    estimate = minimum_covariance(rated.where("not base_failed"), core, steps, prior)
    judged = _distances(rated, estimate, _few(estimate), "left")
    far = F.coalesce(F.col("distance") > quantile(1 - alpha), F.lit(False))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & ~far).alias("kept"), "distance", "row_key")


def row_key() -> Column:
    """64 bits of what the rules look at."""
    return F.xxhash64(F.col("text").cast("string"), F.col("lang").cast("string"), F.col("source").cast("string"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("row_key")
