"""Ordered passes over long series without one task for all rows.

A series is cut into blocks of time; windows run within blocks, and what crosses their borders is one
row for each block, whose number follows the time span and not the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _block(time: str, seconds: int) -> Column:
    return F.floor(F.unix_micros(F.col(time).cast("timestamp")) / (seconds * 1_000_000)).cast("long")


def carry(df: DataFrame, value: str, out: str, time: str, by: tuple[str, ...] = (), backward: bool = False, seconds: int = 86_400, ties: tuple[str, ...] = ()) -> DataFrame:
    """Adds the last known `value` up to each row, or the next known from it if backward."""
    rows = df.withColumn("__b", _block(time, seconds))
    keys = [*by, "__b"]
    order = Window.partitionBy(*keys).orderBy(time, *ties)
    known = F.when(F.col(value).isNotNull(), F.struct(time, *ties))
    if backward:
        inside = F.first(value, True).over(order.rowsBetween(0, Window.unboundedFollowing))
        ends = rows.groupBy(*keys).agg(F.min_by(value, known).alias("__v"))
        across = F.first("__v", True).over(Window.partitionBy(*by).orderBy("__b").rowsBetween(1, Window.unboundedFollowing))
    else:
        inside = F.last(value, True).over(order.rowsBetween(Window.unboundedPreceding, 0))
        ends = rows.groupBy(*keys).agg(F.max_by(value, known).alias("__v"))
        across = F.last("__v", True).over(Window.partitionBy(*by).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1))
    borders = ends.select(*keys, across.alias("__c"))
    return rows.withColumn("__i", inside).join(borders, keys).withColumn(out, F.coalesce("__i", "__c")).drop("__b", "__i", "__c")


def previous(df: DataFrame, value: str, out: str, time: str, by: tuple[str, ...] = (), seconds: int = 86_400) -> DataFrame:
    """Adds the `value` of the row before each in time, null for the first; times are distinct within a group."""
    rows = df.withColumn("__b", _block(time, seconds))
    keys = [*by, "__b"]
    inside = F.lag(F.struct(value)).over(Window.partitionBy(*keys).orderBy(time))
    ends = rows.groupBy(*keys).agg(F.max_by(F.struct(value), time).alias("__v"))
    borders = ends.select(*keys, F.lag("__v").over(Window.partitionBy(*by).orderBy("__b")).alias("__c"))
    return rows.withColumn("__i", inside).join(borders, keys).withColumn(out, F.coalesce("__i", "__c")[value]).drop("__b", "__i", "__c")


def above(value: Column, cuts: list[float]) -> Column:
    """How many of the ascending cuts the value reaches, by halving them."""
    if not cuts:
        return F.lit(0)

    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value >= F.lit(float(cuts[middle])), between(middle + 1, high)).otherwise(between(low, middle))

    return between(0, len(cuts))


#: Values that the driver may get at the end of a selection, and cells of a histogram on the way there.
FETCHED, CELLS = 50_000, 16_384


def _finite(column: str) -> Column:
    return F.abs(F.col(column).cast("double")) < float("inf")


def select_ranks(df: DataFrame, column: str, ranks: list[int]) -> dict[int, float]:
    """The values at the given ranks (from 0, of finite values, all below their number), by histograms.

    Each round splits the ranges that still hold a rank into even cells and counts them in one aggregation, with no
    shuffle of values; a rank is found where its cell holds one value only. What is left is
    fetched once it is small. Ties, gaps and skew only change the number of rounds: a range's ends are values, so
    it splits.
    """
    rows = df.select(F.col(column).cast("double").alias("x")).where(_finite("x"))
    ends = rows.agg(F.min("x").alias("low"), F.max("x").alias("high"), F.count("*").alias("n")).first()
    found: dict[int, float] = {}
    # (low, high, rows below, rows inside) -> ranks
    open_ = {(ends["low"], ends["high"], 0, ends["n"]): sorted(set(ranks))}
    while open_:
        for key in [k for k in open_ if k[0] == k[1]]:
            found |= dict.fromkeys(open_.pop(key), key[0])
        if not open_:
            break
        inside = [F.col("x").between(low, high) for low, high, *_ in open_]
        if sum(k[3] for k in open_) <= FETCHED:
            any_ = inside[0]
            for i in inside[1:]:
                any_ = any_ | i
            values = sorted(r["x"] for r in rows.where(any_).collect())
            for (low, high, before, n), own in open_.items():
                mine = [v for v in values if low <= v <= high]
                found |= {k: mine[k - before] for k in own}
            break
        cells = max(64, CELLS // len(open_))
        which, cell = F.lit(None).cast("int"), F.lit(None).cast("int")
        for i, (low, high, *_) in enumerate(open_):
            which = F.when(inside[i], F.lit(i)).otherwise(which)
            cell = F.when(inside[i], F.least(F.lit(cells - 1), F.floor((F.col("x") / 2 - low / 2) / (high / 2 - low / 2) * cells)).cast("int")).otherwise(cell)
        counted = rows.select("x", which.alias("i"), cell.alias("cell")).where("i is not null").groupBy("i", "cell").agg(F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).collect()
        after: dict[tuple, list[int]] = {}
        for i, ((_, _, before, _), own) in enumerate(open_.items()):
            for c in sorted((c for c in counted if c["i"] == i), key=lambda c: c["cell"]):
                if mine := [k for k in own if before <= k < before + c["n"]]:
                    after[c["low"], c["high"], before, c["n"]] = mine
                before += c["n"]
        open_ = after
    return found


def quantiles(df: DataFrame, column: str, shares: list[float]) -> list[float | None]:
    """Exact interpolated quantiles of the finite values, from the values at two ranks each."""
    total = df.where(_finite(column)).count()
    if not total:
        return [None] * len(shares)
    at = [p * (total - 1) for p in shares]
    x = select_ranks(df, column, [k for p in at for k in (int(p), min(total - 1, int(p) + 1))])
    return [x[int(p)] + (p - int(p)) * (x[min(total - 1, int(p) + 1)] - x[int(p)]) for p in at]


def running_sum(df: DataFrame, order: str, value: str, out: str, block_rows: int = 1_000_000, most: int = 4096) -> DataFrame:
    """Adds the sum of `value` over all rows up to each in `order`, whose values are distinct.

    There is a block of the order for each `block_rows` rows, up to `most`; approximate quantiles cut them, and the result
    does not depend on where they lie.
    """
    parts = min(most, df.count() // block_rows + 1)
    cuts = sorted(set(df.approxQuantile(order, [i / parts for i in range(1, parts)], 0.1 / parts))) if parts > 1 else []
    rows = df.withColumn("__b", above(F.col(order).cast("double"), cuts))
    before = rows.groupBy("__b").agg(F.sum(value).alias("__s"))
    before = before.select("__b", (F.sum("__s").over(Window.orderBy("__b")) - F.col("__s")).alias("__o"))
    inside = F.sum(value).over(Window.partitionBy("__b").orderBy(order))
    return rows.withColumn("__i", inside).join(before, "__b").withColumn(out, F.col("__i") + F.col("__o")).drop("__b", "__i", "__o")
