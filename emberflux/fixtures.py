"""Proxy views over the events table: grid and weather series with known answers, for tests and queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

KINDS = {"thermal_generation": "click", "gas_generation": "view", "hydro_generation": "purchase", "nuclear_generation": "signup", "renewable_generation": "error"}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def grid(spark: SparkSession, sf_dir: str, step: str = "30 minutes") -> DataFrame:
    """One row for each occupied interval, with the canonical grid columns."""
    kinds = [F.sum(F.when(F.col("event_type") == kind, F.col("value")).otherwise(0.0)).alias(name) for name, kind in KINDS.items()]
    sums = events(spark, sf_dir).groupBy(F.window("ts", step).start.alias("timestamp")).agg(*kinds, F.sum("value").alias("total_generation"))
    carbon = 0.95 * F.col("thermal_generation") + 0.45 * F.col("gas_generation")
    per_mwh = carbon / F.nullif(F.col("total_generation"), F.lit(0.0))
    return sums.select("*", F.col("total_generation").alias("demand_met"), (F.col("total_generation") - F.col("renewable_generation")).alias("net_demand"), carbon.alias("tons_co2"), per_mwh.alias("tons_co2_per_mwh"), (1000 * per_mwh).alias("g_co2_per_kwh"))


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each cell and hour; tp accumulates over the day."""
    cell = F.col("user_id") % 12
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    rows = events(spark, sf_dir).groupBy(cell.alias("cell"), hour.alias("valid_time")).agg(F.avg("value").alias("m"), F.avg((F.col("user_id") % 50).cast("double")).alias("w"), F.sum("value").alias("s"))
    day = Window.partitionBy("cell", F.to_date("valid_time")).orderBy("valid_time")
    return rows.select(
        "cell",
        "valid_time",
        (6.5 + 0.1 * (F.col("cell") % 4)).alias("latitude"),
        (68 + 0.1 * F.floor(F.col("cell") / 4)).alias("longitude"),
        (273.15 + F.col("m") / 10).alias("t2m"),
        (F.col("m") - 50).alias("u10"),
        (25 - F.col("w")).alias("v10"),
        (F.col("s") / 1000).alias("tp_step"),
        F.sum(F.col("s") / 1000).over(day).alias("tp"),
        (F.col("s") * 1000).alias("ssrd"),
    )


def _grid_sql(step: str) -> str:
    kinds = ", ".join(f"SUM(CASE WHEN event_type = '{kind}' THEN value ELSE 0.0 END) AS {name}" for name, kind in KINDS.items())
    return f"""SELECT *, total_generation AS demand_met, total_generation - renewable_generation AS net_demand,
      0.95 * thermal_generation + 0.45 * gas_generation AS tons_co2,
      (0.95 * thermal_generation + 0.45 * gas_generation) / NULLIF(total_generation, 0) AS tons_co2_per_mwh,
      1000 * (0.95 * thermal_generation + 0.45 * gas_generation) / NULLIF(total_generation, 0) AS g_co2_per_kwh
      FROM (SELECT time_bucket(INTERVAL '{step}', ts) AS timestamp, {kinds}, SUM(value) AS total_generation FROM events GROUP BY 1)"""


_WEATHER_SQL = """SELECT cell, valid_time, 6.5::DOUBLE + 0.1::DOUBLE * (cell % 4) AS latitude, 68::DOUBLE + 0.1::DOUBLE * (cell // 4) AS longitude,
  273.15::DOUBLE + m / 10 AS t2m, m - 50 AS u10, 25 - w AS v10, s / 1000 AS tp_step,
  SUM(s / 1000) OVER (PARTITION BY cell, CAST(valid_time AS DATE) ORDER BY valid_time) AS tp, s * 1000 AS ssrd
  FROM (SELECT user_id % 12 AS cell, date_trunc('hour', ts) AS valid_time, AVG(value) AS m, AVG(user_id % 50) AS w, SUM(value) AS s FROM events GROUP BY 1, 2)"""

#: Common table expressions with the same content for the SQL side.
SQL = f"WITH grid AS ({_grid_sql('30 minutes')}), grid5 AS ({_grid_sql('5 minutes')}), weather AS ({_WEATHER_SQL}) "
