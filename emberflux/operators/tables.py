"""Table operators: union, deduplication, compaction, filters and profiles."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blocks import quantiles

NUMERIC = (T.NumericType,)


def union_relaxed(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of frames with the same columns in the same order; numbers widen, other differences are refused."""
    first = frames[0]
    for other in frames[1:]:
        if other.columns != first.columns:
            raise ValueError(f"columns differ: {first.columns} and {other.columns}")
        for a, b in zip(first.schema, other.schema):
            if a.dataType != b.dataType and not (isinstance(a.dataType, NUMERIC) and isinstance(b.dataType, NUMERIC)) and T.NullType() not in (a.dataType, b.dataType):
                raise TypeError(f"{a.name}: {a.dataType.simpleString()} and {b.dataType.simpleString()} have no common type")
    return reduce(DataFrame.unionByName, frames)


def dedupe(df: DataFrame, key: str, *order: Column | str) -> DataFrame:
    """One row for each key, the first in the given order, which must be total for a determined result."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("__k", rank).where("__k = 1").drop("__k")


def compact_sorted(frames: Sequence[DataFrame], time: str = "timestamp") -> DataFrame:
    """The union in time order."""
    return union_relaxed(frames).orderBy(time)


def write_by_month(df: DataFrame, path: str, time: str = "timestamp") -> None:
    """Replace the months that df has, leave others: partitions year and month. A large month is several tasks' work."""
    dated = df.withColumns({"year": F.year(time), "month": F.month(time)})
    dated.repartitionByRange("year", "month", time).sortWithinPartitions("year", "month", time).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "month").parquet(path)


def discover(spark: SparkSession, path: str, glob: str = "*.parquet", months: Sequence[str] | None = None) -> DataFrame:
    """path, size, modified, year and month of each file below `path` that fits `glob`, by path.

    Year and month are those of folders year=Y/month=M, else of a name's YYYY-MM or YYYY_MM, else null; `months`
    ("2024-01", ...) keeps the files of these. Only file status is read. Nothing found is an error.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    part = lambda k: F.coalesce(*(F.try_to_number(F.nullif(F.regexp_extract("path", p, k), F.lit("")), F.lit("9999")).cast("int") for p in (r"year=(\d{4})/month=(\d{1,2})/", r"(?:^|\D)(\d{4})[-_](\d{2})\.[A-Za-z0-9]+$")))
    found = listed.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"), part(1).alias("year"), part(2).alias("month"))
    if months is not None:
        found = found.where(F.format_string("%04d-%02d", "year", "month").isin(list(months)))
    if found.isEmpty():
        raise FileNotFoundError(f"no file {glob} below {path}" + (f" of the months {', '.join(months)}" if months is not None else ""))
    return found.orderBy("path")


def row_bytes(df: DataFrame) -> float:
    """Mean width of a row before compression; texts and binaries are measured, other fields count eight bytes."""
    wide = [F.coalesce(F.octet_length(f.name), F.lit(0)) + 4 for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    fixed = 8.0 * (len(df.columns) - len(wide))
    return fixed + (float(df.agg(F.avg(sum(wide[1:], wide[0]))).first()[0] or 0) if wide else 0.0)


def export_by_year(df: DataFrame, path: str, time: str = "timestamp", max_bytes: int = 100_000_000) -> None:
    """A folder a year, in time order, in files of at most about `max_bytes`: rows are counted at their uncompressed width."""
    rows = max(1, int(max_bytes / max(1.0, row_bytes(df))))
    df.withColumn("year", F.year(time)).repartitionByRange("year", time).sortWithinPartitions("year", time).write.mode("overwrite").option("maxRecordsPerFile", rows).partitionBy("year").parquet(path)


def in_box(n: float, w: float, s: float, e: float, latitude: str = "latitude", longitude: str = "longitude") -> Column:
    """Within a box; one whose east lies west of its west crosses longitude 180."""
    lon = F.col(longitude)
    inside = (lon >= w) & (lon <= e) if w <= e else (lon >= w) | (lon <= e)
    return F.col(latitude).between(s, n) & inside


def in_polygon(corners: Sequence[tuple[float, float]], latitude: str = "latitude", longitude: str = "longitude") -> Column:
    """Even-odd test against (latitude, longitude) corners, as one expression."""
    y, x, inside = F.col(latitude), F.col(longitude), F.lit(False)
    for (y1, x1), (y2, x2) in zip(corners, [*corners[1:], corners[0]]):
        if y1 != y2:
            crosses = (F.lit(y1) > y) != (F.lit(y2) > y)
            inside = F.when(crosses & (x < (x2 - x1) * (y - y1) / (y2 - y1) + x1), ~inside).otherwise(inside)
    return inside


def tail(df: DataFrame, n: int, order: str) -> DataFrame:
    return df.orderBy(F.desc(order)).limit(n).orderBy(order)


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row for each column: counts, mean, deviation and exact quartiles as numbers."""
    spark, out = df.sparkSession, None
    for c in columns:
        x = F.col(c).cast("double")
        q25, median, q75 = quantiles(df, c, [0.25, 0.5, 0.75])
        row = df.agg(F.count(x).alias("n"), F.count_if(F.isnull(x)).alias("n_null"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"))
        row = row.select(F.lit(c).alias("variable"), "n", "n_null", "mean", "std", "min", *(F.lit(v).cast("double").alias(name) for name, v in (("q25", q25), ("median", median), ("q75", q75))), "max")
        out = row if out is None else out.unionByName(row)
    return out if out is not None else spark.createDataFrame([], "variable string, n long, n_null long, mean double, std double, min double, q25 double, median double, q75 double, max double")


def profile_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    parts = F.array(*(F.struct(F.lit(c).alias("variable"), F.isnull(c).alias("gone")) for c in columns))
    return df.select(F.explode(parts).alias("v")).select("v.*").groupBy("variable").agg(F.count("*").alias("n_rows"), F.count_if("gone").alias("n_null"))
