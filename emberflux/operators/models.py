"""Marginal and average emissions: ramp pairs, regressions, calibration, correlations and comparison models."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .blocks import above, quantiles, running_sum


def ramp_pairs(df: DataFrame, step_seconds: int, y: str = "tons_co2", q: str = "total_generation", time: str = "timestamp", by: tuple[str, ...] = ()) -> DataFrame:
    """q, y and their changes dq and dy since the row exactly one step before, for rows that have one.

    A row finds its predecessor by an equi-join on time, so no pass over the whole series is needed.
    """
    rows = df.select(*by, time, F.col(q).alias("q"), F.col(y).alias("y"))
    before = rows.select(*by, (F.col(time) + F.expr(f"interval {step_seconds} seconds")).cast("timestamp_ntz").alias(time), F.col("q").alias("__q"), F.col("y").alias("__y"))
    pairs = rows.join(before, [*by, time])
    return pairs.select(*by, time, "q", "y", (F.col("q") - F.col("__q")).alias("dq"), (F.col("y") - F.col("__y")).alias("dy"))


def adjacent_mean(column: str, time: str = "timestamp", by: tuple[str, ...] = ()) -> Column:
    return F.avg(column).over(Window.partitionBy(*by).orderBy(time).rowsBetween(-1, 0))


def quantile_bins(df: DataFrame, column: str, n: int, out: str) -> DataFrame:
    """Adds the quantile bin 0..n-1; cut points are exact and belong to the upper bin."""
    cuts = quantiles(df, column, [i / n for i in range(1, n)])
    bin_ = F.lit(0) if None in cuts else above(F.col(column).cast("double"), cuts)
    return df.withColumn(out, F.when(F.col(column).isNotNull(), bin_))


def group_ols(df: DataFrame, y: str, x: str, by: tuple[str, ...]) -> DataFrame:
    """Slope, intercept and R2 of each group; null where x does not vary."""
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(*by).agg(F.count("*").alias("n"), F.avg(x).alias("mx"), F.avg(y).alias("my"), F.covar_pop(x, y).alias("sxy"), F.var_pop(x).alias("sxx"), F.var_pop(y).alias("syy"))
    some = lambda c: F.when(F.col("sxx") > 1e-12, c)
    slope = F.col("sxy") / F.nullif(F.col("sxx"), F.lit(0.0))
    return both.select(*by, "n", some(slope).alias("slope"), some(F.col("my") - slope * F.col("mx")).alias("intercept"), some(F.when(F.col("syy") > 1e-12, F.col("sxy") * F.col("sxy") / (F.nullif(F.col("sxx"), F.lit(0.0)) * F.nullif(F.col("syy"), F.lit(0.0))))).alias("r2"))


def group_quadratic(df: DataFrame, y: str, x: str, by: tuple[str, ...]) -> DataFrame:
    """y = a + b z + c z^2 with z = x - mean(x) of each group, from the group's power sums; null if singular."""
    means = df.groupBy(*by).agg(F.avg(x).alias("mx"))
    z, t = F.col(x) - F.col("mx"), F.col(y)
    s = df.join(means, list(by)).groupBy(*by, "mx").agg(F.count("*").alias("n"), *(F.sum(F.pow(z, F.lit(float(p)))).alias(f"s{p}") for p in (1, 2, 3, 4)), *(F.sum(t * F.pow(z, F.lit(float(p)))).alias(f"t{p}") for p in (0, 1, 2)))
    c = F.col
    det = c("n") * (c("s2") * c("s4") - c("s3") * c("s3")) - c("s1") * (c("s1") * c("s4") - c("s3") * c("s2")) + c("s2") * (c("s1") * c("s3") - c("s2") * c("s2"))
    lin = c("n") * (c("t1") * c("s4") - c("t2") * c("s3")) - c("t0") * (c("s1") * c("s4") - c("s3") * c("s2")) + c("s2") * (c("s1") * c("t2") - c("t1") * c("s2"))
    quad = c("n") * (c("s2") * c("t2") - c("s3") * c("t1")) - c("s1") * (c("s1") * c("t2") - c("t1") * c("s2")) + c("t0") * (c("s1") * c("s3") - c("s2") * c("s2"))
    ok = F.abs(det) > 1e-6
    return s.select(*by, "n", F.when(ok, lin / F.nullif(det, F.lit(0.0))).alias("linear"), F.when(ok, quad / F.nullif(det, F.lit(0.0))).alias("quadratic"))


def weighted_line(df: DataFrame, y: str, x: str, weight: Column, by: tuple[str, ...] = ()) -> DataFrame:
    """Weighted least squares y = a + b x in closed form from weighted sums."""
    rows = df.select(*by, F.col(x).alias("x"), F.col(y).alias("y"), weight.alias("w")).where("x is not null and y is not null and w is not null")
    s = rows.groupBy(*by).agg(F.count("*").alias("n"), F.sum("w").alias("w"), F.sum(F.expr("w*x")).alias("wx"), F.sum(F.expr("w*y")).alias("wy"), F.sum(F.expr("w*x*x")).alias("wxx"), F.sum(F.expr("w*x*y")).alias("wxy"))
    b = F.expr("(w*wxy - wx*wy) / nullif(w*wxx - wx*wx, 0.0D)")
    return s.select(*by, "n", b.alias("b"), (F.expr("wy / nullif(w, 0.0D)") - b * F.expr("wx / nullif(w, 0.0D)")).alias("a"))


def correlation(x: str, y: str) -> Column:
    """Pearson correlation, null where either side does not vary."""
    a, b = F.stddev_pop(x), F.stddev_pop(y)
    return F.when((a > 1e-9) & (b > 1e-9), F.covar_pop(x, y) / (F.nullif(a, F.lit(0.0)) * F.nullif(b, F.lit(0.0))))


def correlation_by_threshold(df: DataFrame, x: str, y: str, size: str, thresholds: list[float]) -> DataFrame:
    """n and r of x and y over rows with |size| >= tau, for each tau that a row reaches.

    Each row is in one bin, that of the last threshold it reaches; moments are summed over bins from the last
    one down. x and y are taken from their means, so that sums of squares keep their digits.
    """
    taus = sorted(set(map(float, thresholds)))
    means = df.agg(F.avg(x).alias("x"), F.avg(y).alias("y")).first()
    rows = df.where(F.col(size).isNotNull()).select(above(F.abs(F.col(size)), taus).alias("bin"), (F.col(x) - (means["x"] or 0.0)).alias("x"), (F.col(y) - (means["y"] or 0.0)).alias("y"))
    both = F.col("x").isNotNull() & F.col("y").isNotNull()
    one = lambda c: F.sum(F.when(both, c).otherwise(0.0))
    parts = rows.where("bin > 0").groupBy("bin").agg(F.count("*").alias("n"), one(F.lit(1.0)).alias("m"), one(F.col("x")).alias("sx"), one(F.col("y")).alias("sy"), one(F.expr("x*x")).alias("sxx"), one(F.expr("y*y")).alias("syy"), one(F.expr("x*y")).alias("sxy"))
    every = df.sparkSession.createDataFrame([(k + 1, t) for k, t in enumerate(taus)], "bin int, tau double").join(parts, "bin", "left").coalesce(1)
    down = Window.orderBy(F.desc("bin"))
    sums = every.select("tau", *(F.sum(F.coalesce(c, F.lit(0))).over(down).alias(c) for c in ("n", "m", "sx", "sy", "sxx", "syy", "sxy"))).where("n > 0")
    a, b, c = (F.expr(f"{s} / m - {u} / m * {v} / m") for s, u, v in (("sxx", "sx", "sx"), ("syy", "sy", "sy"), ("sxy", "sx", "sy")))
    wide = F.expr("m > 0")
    return sums.select("tau", "n", F.when(wide, F.when((F.sqrt(F.greatest(a, F.lit(0.0))) > 1e-9) & (F.sqrt(F.greatest(b, F.lit(0.0))) > 1e-9), c / (F.sqrt(a) * F.sqrt(b)))).alias("r"))


def average_ranks(df: DataFrame, column: str, out: str) -> DataFrame:
    """Adds ranks of values with ties at their mean rank, by counts of distinct values."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("__n"))
    ranked = running_sum(counts, column, "__n", "__u")
    return df.join(ranked.select(column, (F.col("__u") - (F.col("__n") - 1) / 2).alias(out)), column)


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """Rank correlation of the rows that have both values."""
    rows = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(x, y)
    ranked = average_ranks(average_ranks(rows, x, "__rx"), y, "__ry")
    return ranked.agg(F.count("*").alias("n"), correlation("__rx", "__ry").alias("rho"))


def average_factor(carbon: str = "tons_co2", energy: str = "total_generation") -> Column:
    return F.sum(carbon) / F.nullif(F.sum(energy), F.lit(0.0))


def metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """R2 against the mean, Pearson r, root mean square and mean absolute error."""
    mean = df.agg(F.avg(actual)).first()[0]
    off = F.col(actual) - F.col(predicted)
    total = F.sum(F.pow(F.col(actual) - F.lit(mean), F.lit(2.0)))
    return df.agg(F.count("*").alias("n"), (1 - F.sum(off * off) / F.nullif(total, F.lit(0.0))).alias("r2"), correlation(actual, predicted).alias("r"), F.sqrt(F.avg(off * off)).alias("rmse"), F.avg(F.abs(off)).alias("mae"))


def poisson_weights(df: DataFrame, replicates: int, key: str, seed: int = 1) -> DataFrame:
    """Rows for bootstrap replicates with their Poisson(1) weights, fixed by md5 of `<key>:<replicate>:<seed>`; weight 0 is left out."""
    digest = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.col("replicate").cast("string"), F.lit(str(seed))))
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") + 0.5) / float(1 << 32)
    weight = F.lit(0)
    for c in poisson_steps():
        weight = weight + F.when(u > c, 1).otherwise(0)
    return df.withColumn("replicate", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1)))).withColumn("weight", weight).where("weight > 0")


def poisson_steps() -> list[float]:
    """The distribution function of Poisson(1) at 0 to 7."""
    total, term, out = 0.0, math.exp(-1), []
    for k in range(1, 9):
        total += term
        out.append(total)
        term /= k
    return out


# Comparison models: a quadratic in z, x standardised in its group, from weighted power sums.


def _standardised(df: DataFrame, y: str, x: str, by: tuple[str, ...]) -> DataFrame:
    rows = df.select(*by, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).where("x is not null and y is not null")
    scale = rows.groupBy(*by).agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("spread"))
    return rows.join(scale, list(by)).withColumn("z", (F.col("x") - F.col("mean")) / F.nullif("spread", F.lit(0.0))).withColumn("w", F.lit(1.0))


def _weighted_quadratic(rows: DataFrame, by: tuple[str, ...], penalty: float = 0.0) -> DataFrame:
    """n, intercept, linear and quadratic of y = a + b z + c z^2 by weights w, b and c shrunk by `penalty`; null if singular."""
    s = rows.groupBy(*by).agg(F.count("*").alias("n"), *(F.sum(F.expr(e)).alias(k) for k, e in {"w": "w", "s1": "w*z", "s2": "w*z*z", "s3": "w*z*z*z", "s4": "w*z*z*z*z", "t0": "w*y", "t1": "w*z*y", "t2": "w*z*z*y"}.items()))
    s = s.select(*by, "n", "w", "s1", "s2", "t0", F.expr(f"s2 - s1*s1/w + {penalty}D").alias("c11"), F.expr("s3 - s1*s2/w").alias("c12"), F.expr(f"s4 - s2*s2/w + {penalty}D").alias("c22"), F.expr("t1 - s1*t0/w").alias("d1"), F.expr("t2 - s2*t0/w").alias("d2"))
    s = s.withColumn("det", F.expr("c11*c22 - c12*c12"))
    s = s.withColumn("linear", F.expr("case when abs(det) > 1e-9 then (c22*d1 - c12*d2)/det end")).withColumn("quadratic", F.expr("case when abs(det) > 1e-9 then (c11*d2 - c12*d1)/det end"))
    return s.select(*by, "n", F.expr("(t0 - linear*s1 - quadratic*s2)/w").alias("intercept"), "linear", "quadratic")


def ridge_quadratic(df: DataFrame, y: str, x: str, by: tuple[str, ...], penalty: float = 1.0) -> DataFrame:
    """All coefficients of a ridge regression on z and z^2 in each group; the constant is not shrunk."""
    return _weighted_quadratic(_standardised(df, y, x, by), by, penalty)


def huber_quadratic(df: DataFrame, y: str, x: str, by: tuple[str, ...], k: float = 1.345, rounds: int = 10) -> DataFrame:
    """All coefficients of a Huber regression on z and z^2 in each group, by `rounds` of iteratively reweighted least squares.

    Residuals beyond k times the root mean square residual of the unweighted fit count in proportion to their size. Each
    round is one aggregation; groups meet their coefficients by a join on the group. Every third round writes the
    coefficients out, so that plans stay short.
    """
    rows = _standardised(df, y, x, by)
    off = F.col("y") - F.col("intercept") - F.col("linear") * F.col("z") - F.col("quadratic") * F.col("z") * F.col("z")
    first = _weighted_quadratic(rows, by)
    limit = rows.join(first.drop("n"), list(by)).groupBy(*by).agg((k * F.sqrt(F.avg(off * off))).alias("limit"))
    rows, found = rows.join(limit, list(by)), first
    for i in range(rounds):
        if i % 3 == 2:
            found = written(found, "huber")
        apart = rows.join(found.drop("n"), list(by)).withColumn("w", F.when(F.abs(off) > F.col("limit"), F.col("limit") / F.abs(off)).otherwise(F.lit(1.0)))
        found = _weighted_quadratic(apart, by)
    return found
