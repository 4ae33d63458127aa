"""A request's settings, read and checked on the driver."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field
from datetime import date, timedelta
from pathlib import Path

from pyspark.sql import DataFrame

from .. import config as K

POLICIES = ("overwrite_all", "skip_all", "case_by_case")


class RequestError(ValueError):
    """A setting is missing or out of range."""


def _day(text: str, end: bool = False) -> date:
    parts = [int(x) for x in text.split("-")]
    if len(parts) == 3:
        return date(*parts)
    if len(parts) != 2:
        raise RequestError(f"{text!r} is neither YYYY-MM-DD nor YYYY-MM")
    first = date(parts[0], parts[1], 1)
    return first if not end else (first.replace(day=28) + timedelta(days=4)).replace(day=1) - timedelta(days=1)


@dataclass(frozen=True)
class WeatherRequest:
    """One weather extract: dataset, period, box [north, west, south, east], variables and policies."""

    dataset: str
    start: date
    end: date
    bounds: tuple[float, float, float, float]
    variables: tuple[str, ...]
    policy: str = "skip_all"
    retries: int = 3
    delay: int = 15
    parallel: int = 1
    dropped: tuple[str, ...] = field(default=())

    @classmethod
    def from_dict(cls, raw: dict, as_of: date | None = None, on_invalid: str = "raise") -> WeatherRequest:
        """as_of clamps the end date to the provider's lag; on_invalid='drop' leaves denied variables out."""
        spelled = str(raw.get("dataset_short_name", "")).strip().lower()
        dataset = K.DATASETS.get(spelled, spelled)
        if dataset not in K.RESOLUTION:
            raise RequestError(f"unknown dataset {spelled!r}")
        start, end = _day(str(raw["start_date"])), _day(str(raw["end_date"]), end=True)
        if as_of:
            end = min(end, as_of - timedelta(days=K.LAG_DAYS))
        if end <= start:
            raise RequestError("the end date must lie after the start date")
        bounds = cls._bounds(raw)
        n, w, s, e = bounds
        if not (-90 <= s < n <= 90 and -180 <= w <= 180 and -180 <= e <= 180):
            raise RequestError(f"invalid bounds {bounds}")
        names = raw.get("variables") or []
        names = names.split(",") if isinstance(names, str) else names
        names = [x for x in (str(v).strip().lower().strip('"').strip("'") for v in names) if x]
        denied = [v for v in names if dataset == "era5-world" and v in K.DENIED_WORLD]
        if denied and on_invalid == "raise":
            raise RequestError(f"{dataset} does not deliver {denied}")
        names = [v for v in names if v not in denied]
        if not names:
            raise RequestError("no variables")
        policy = raw.get("existing_file_action", "skip_all")
        if policy not in POLICIES:
            raise RequestError(f"unknown policy {policy!r}")
        retry, parallel = raw.get("retry_settings") or {}, raw.get("parallel_settings") or {}
        return cls(
            dataset,
            start,
            end,
            bounds,
            tuple(names),
            policy,
            max(1, min(K.MOST_RETRIES, int(retry.get("max_retries", 3)))),
            max(0, min(K.MOST_DELAY, int(retry.get("retry_delay_sec", 15)))),
            max(1, min(K.MOST_PARALLEL, int(parallel.get("max_concurrent", 1)))) if parallel.get("enabled") else 1,
            tuple(denied),
        )

    def options(self, folder: str, plan: DataFrame | None = None) -> dict[str, str]:
        """What `monthly_weather` reads for this request; a plan (see plans.months) leaves its months to `fetch` and `overwrite`."""
        out = {"dataset": self.dataset, "start": str(self.start), "end": str(self.end), "bounds": ",".join(map(str, self.bounds)), "variables": ",".join(self.variables)}
        out |= {"retries": str(self.retries), "delay": str(self.delay), "streams": str(self.parallel), "existing": self.policy, "folder": folder}
        if plan is not None:
            if "status" in plan.columns:
                plan = plan.where("status <> 'skip'")
            out["months"] = ",".join(f"{r['year']}-{r['month']:02d}" for r in plan.select("year", "month").distinct().orderBy("year", "month").collect())  # a row for each month of the period
        return out

    @staticmethod
    def _bounds(raw: dict) -> tuple[float, float, float, float]:
        for found in (raw.get("region_bounds"), raw.get("bounds"), raw.get("area"), raw):
            if isinstance(found, (list, tuple)) and len(found) == 4:
                return tuple(map(float, found))
            if isinstance(found, dict):
                keys = {str(k).lower(): v for k, v in found.items()}
                for names in (("north", "west", "south", "east"), tuple("nwse")):
                    if all(keys.get(x) is not None for x in names):
                        return tuple(float(keys[x]) for x in names)
        raise RequestError("no bounds")


def load(path: str | Path, **options) -> WeatherRequest:
    return WeatherRequest.from_dict(json.loads(Path(path).read_text()), **options)


def root(kind: str = "data") -> Path:
    """The folder for data, config, cache or logs: its environment variable, else under EMBERFLUX_ROOT or home."""
    own = os.environ.get(f"EMBERFLUX_{kind.upper()}_DIR")
    return Path(own) if own else Path(os.environ.get("EMBERFLUX_ROOT", Path.home() / ".emberflux")) / kind
