"""Joins of grid and weather series on time and place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import carry


def cell_keys(df: DataFrame, resolution: float) -> DataFrame:
    """Adds row and col, the nearest cell of a grid of that resolution, as exact integers to join on."""
    near = lambda c: F.floor(F.round(F.col(c) / resolution, 6) + 0.5).cast("long")
    return df.withColumns({"row": near("latitude"), "col": near("longitude")})


def asof(left: DataFrame, right: DataFrame, columns: tuple[str, ...], on: str = "timestamp", by: tuple[str, ...] = ()) -> DataFrame:
    """Of each left row the latest right row not after it: one union and one sorted pass over blocks of time.

    Where several right rows share an instant, which one counts is undetermined.
    """
    names = [c for c in left.columns if c != on and c not in by]
    value = F.struct(*(F.col(c) for c in columns), F.col(on).alias("__at"))
    a = left.select(*by, on, *names, F.lit(None).alias("__v"), F.lit(1).alias("__side"))
    b = right.select(*by, on, *(F.lit(None).alias(c) for c in names), value.alias("__v"), F.lit(0).alias("__side"))
    both = carry(a.unionByName(b), "__v", "__m", on, by, ties=("__side",)).where("__side = 1")
    return both.select(*by, on, *names, *(F.col(f"__m.{c}").alias(c) for c in columns), F.col("__m.__at").alias("matched_at"))


def fallback(first: DataFrame, second: DataFrame, keys: list[str], columns: tuple[str, ...]) -> DataFrame:
    """First's rows, its null values taken from second."""
    other = second.select(*keys, *(F.col(c).alias(f"__{c}") for c in columns))
    return first.join(other, keys, "left").withColumns({c: F.coalesce(c, f"__{c}") for c in columns}).drop(*(f"__{c}" for c in columns))


def weighted_mean(df: DataFrame, weights: DataFrame, columns: tuple[str, ...], key: list[str], time: str = "valid_time") -> DataFrame:
    """Means over places with the weights that a table gives them; places without a weight don't count."""
    rows = df.join(weights, key)
    return rows.groupBy(time).agg(*((F.sum(F.col(c) * F.col("weight")) / F.nullif(F.sum(F.when(F.col(c).isNotNull(), F.col("weight"))), F.lit(0.0))).alias(c) for c in columns))
