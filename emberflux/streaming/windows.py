"""Windows and incremental ingestion, the same for batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def tumbling(df: DataFrame, size: str, time: str, *by: str) -> DataFrame:
    return df.groupBy(F.window(time, size).alias("w"), *by).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), *by, "n", "total")


def sliding(df: DataFrame, size: str, slide: str, time: str, *by: str) -> DataFrame:
    return df.groupBy(F.window(time, size, slide).alias("w"), *by).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), *by, "n", "total")


def sessions(df: DataFrame, gap: str, time: str, *by: str) -> DataFrame:
    return df.groupBy(F.session_window(time, gap).alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "n")


def watermarked(df: DataFrame, delay: str, time: str) -> DataFrame:
    """Watermarks need an instant: the time column becomes TIMESTAMP, read as UTC."""
    return df.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)


def landed(spark: SparkSession, path: str, schema: T.StructType, glob: str = "*.parquet") -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", glob).parquet(path)


def ingest_months(stream: DataFrame, path: str, checkpoint: str, time: str = "timestamp"):
    """Append what has landed since the last call to a table by month; returns the finished query."""
    dated = stream.withColumns({"year": F.year(time), "month": F.month(time)})
    query = dated.writeStream.format("parquet").partitionBy("year", "month").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
