"""Decoding of grid payloads: parallel arrays in JSON, wrapped in a JSON string."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as K

_ARRAYS = "timestamps array<string>, " + ", ".join(f"{v} array<double>" for v in K.GRID_VARIABLES)
BODY = f"struct<timeseries_values:struct<{_ARRAYS.replace(' array', ':array')}>>"


def payload_rows(payloads: DataFrame, column: str = "body", key: str = "month") -> DataFrame:
    """(key, timestamp, the grid variables) of each payload; one without the arrays, with a variable missing,
    with arrays of unequal length or with a malformed timestamp gives no rows."""
    inner = F.from_json(F.concat(F.lit('{"s":'), F.col(column), F.lit("}")), "s string").s
    values = payloads.select(key, F.from_json(inner, BODY).timeseries_values.alias("v")).where("v is not null")
    names = ["timestamps", *K.GRID_VARIABLES]
    sound = F.lit(True)
    for name in names:
        sound = sound & F.coalesce(F.size(F.col("v")[name]) == F.size("v.timestamps"), F.lit(False))
    sound = sound & F.forall("v.timestamps", lambda x: F.try_to_timestamp(x, F.lit("yyyy-MM-dd HH:mm:ss")).isNotNull())
    zipped = F.arrays_zip(*(F.col(f"v.{n}").alias(n) for n in names))
    rows = values.where(sound).select(key, F.inline(zipped))
    return rows.select(key, F.to_timestamp_ntz("timestamps", F.lit("yyyy-MM-dd HH:mm:ss")).alias("timestamp"), *K.GRID_VARIABLES)
