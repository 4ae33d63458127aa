"""Time-series operators: resampling, gaps, accumulation and grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .blocks import carry, previous

MEANS = ("thermal_generation", "gas_generation", "hydro_generation", "nuclear_generation", "renewable_generation", "total_generation", "demand_met", "net_demand")
WEIGHTED = ("g_co2_per_kwh", "tons_co2_per_mwh")


def resample_grid(df: DataFrame, step: str = "30 minutes") -> DataFrame:
    """Power is averaged, carbon summed, intensities averaged with generation as weight."""
    weighted = [(F.sum(F.col(c) * F.col("total_generation")) / F.nullif(F.sum(F.when(F.col(c).isNotNull(), F.col("total_generation"))), F.lit(0.0))).alias(c) for c in WEIGHTED]
    return df.groupBy(F.window("timestamp", step).start.alias("timestamp")).agg(*(F.avg(c).alias(c) for c in MEANS), F.sum("tons_co2").alias("tons_co2"), *weighted)


def spine(df: DataFrame, step: str, time: str = "timestamp") -> DataFrame:
    """Every instant from the first to the last of df in even steps, from two aggregated values."""
    ends = df.agg(F.min(time).alias("a"), F.max(time).alias("b"))
    return ends.where("a is not null").select(F.explode(F.sequence("a", "b", F.expr(f"interval {step}"))).alias(time))


def fill_spine(df: DataFrame, step: str, time: str = "timestamp") -> DataFrame:
    return spine(df, step, time).join(df, time, "left")


def gap_report(df: DataFrame, step: str, time: str = "timestamp") -> DataFrame:
    """Instants without a row."""
    return spine(df, step, time).join(df.select(time), time, "left_anti")


def detect_gaps(df: DataFrame, seconds: int, time: str = "timestamp", by: tuple[str, ...] = ()) -> DataFrame:
    """Neighbouring rows more than `seconds` apart, in each group."""
    before = previous(df.select(*by, F.col(time).alias("gap_end")).distinct(), "gap_end", "gap_start", "gap_end", by)
    size = (F.unix_micros(F.col("gap_end").cast("timestamp")) - F.unix_micros(F.col("gap_start").cast("timestamp"))) / 1e6
    return before.select(*by, "gap_end", "gap_start", size.cast("long").alias("gap_seconds")).where(F.col("gap_seconds") > seconds)


def completeness(df: DataFrame, step_seconds: int, time: str = "timestamp") -> DataFrame:
    """Of each month the rows it has, those it should have, and their ratio."""
    months = df.groupBy(F.date_trunc("month", time).cast("date").alias("month")).agg(F.count_distinct(time).alias("n_rows"))
    expected = (F.day(F.last_day("month")) * 86400 / step_seconds).cast("long")
    return months.select("month", "n_rows", expected.alias("n_expected"), (F.col("n_rows") / expected).alias("ratio"))


def fill_forward(df: DataFrame, column: str, time: str = "timestamp", by: tuple[str, ...] = ()) -> DataFrame:
    return carry(df, column, "__f", time, by).withColumn(column, F.col("__f")).drop("__f")


def fill_linear(df: DataFrame, column: str, time: str = "timestamp", by: tuple[str, ...] = ()) -> DataFrame:
    """Straight lines between known neighbours; ends stay null."""
    at = F.unix_micros(F.col(time).cast("timestamp")) / 1e6
    known = df.withColumn("__k", F.when(F.col(column).isNotNull(), F.struct(at.alias("t"), F.col(column).alias("v"))))
    rows = carry(carry(known, "__k", "__p", time, by), "__k", "__n", time, by, backward=True)
    line = F.col("__p.v") + (F.col("__n.v") - F.col("__p.v")) * (at - F.col("__p.t")) / F.nullif(F.col("__n.t") - F.col("__p.t"), F.lit(0.0))
    return rows.withColumn(column, F.coalesce(column, line)).drop("__k", "__p", "__n")


def deaccumulate(df: DataFrame, column: str, out: str, by: tuple[str, ...], reset: Column, time: str = "valid_time") -> DataFrame:
    """Steps of a running total that starts anew with each value of reset."""
    rows = df.withColumn("__r", reset)
    order = Window.partitionBy(*by, "__r").orderBy(time)
    return rows.withColumn(out, F.col(column) - F.coalesce(F.lag(column).over(order), F.lit(0.0))).drop("__r")


def halve_hours(df: DataFrame, rates: tuple[str, ...], quantities: tuple[str, ...], time: str = "valid_time") -> DataFrame:
    """Two half-hour rows for each hour: rates repeat, quantities are split."""
    half = F.explode(F.array(F.expr("interval 0 minutes"), F.expr("interval 30 minutes")))
    rows = df.withColumn("__h", half)
    return rows.withColumns({time: (F.col(time) + F.col("__h")).cast("timestamp_ntz"), **{c: F.col(c) / 2 for c in quantities}}).drop("__h")


def regional_mean(df: DataFrame, columns: tuple[str, ...], time: str = "valid_time", by_area: bool = False) -> DataFrame:
    """Mean over cells; by_area weighs cells by the cosine of latitude."""
    if not by_area:
        return df.groupBy(time).agg(*(F.avg(c).alias(c) for c in columns))
    weight = F.cos(F.radians("latitude"))
    return df.groupBy(time).agg(*((F.sum(F.col(c) * weight) / F.sum(F.when(F.col(c).isNotNull(), weight))).alias(c) for c in columns))


def regrid(df: DataFrame, columns: tuple[str, ...], resolution: float, time: str = "valid_time") -> DataFrame:
    """Means over coarser cells, named by their south-west corner's index."""
    cell = lambda c: F.floor(F.round(F.col(c) / resolution, 6)).cast("long")
    return df.groupBy(time, cell("latitude").alias("row"), cell("longitude").alias("col")).agg(*(F.avg(c).alias(c) for c in columns))
