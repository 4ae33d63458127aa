"""Model features as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as K


def time_features(ts: Column) -> dict[str, Column]:
    hour, day = 2 * math.pi * F.hour(ts) / 24, 2 * math.pi * F.dayofyear(ts) / K.DAYS_PER_YEAR
    return {"hour_sin": F.sin(hour), "hour_cos": F.cos(hour), "doy_sin": F.sin(day), "doy_cos": F.cos(day), "is_weekend": F.dayofweek(ts).isin(1, 7)}


def wind_features(u: Column, v: Column) -> dict[str, Column]:
    """Speed, and the direction's sine and cosine, null in a calm."""
    speed = F.hypot(u, v)
    return {"wind_speed": speed, "wind_dir_sin": u / F.nullif(speed, F.lit(0.0)), "wind_dir_cos": v / F.nullif(speed, F.lit(0.0))}


def is_sunny(ssrd: Column, threshold: float = K.SUNNY_SSRD) -> Column:
    return ssrd > threshold


def hydro_share(hydro: Column, total: Column) -> Column:
    return hydro / F.nullif(total, F.lit(0.0))


def log1p_solar(ssrd: Column) -> Column:
    return F.log1p(F.greatest(ssrd, F.lit(0.0)))


def net_load(demand: Column, renewable: Column) -> Column:
    return demand - renewable
