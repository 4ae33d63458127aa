"""Run logs: what each step of a run read, wrote and rejected, counted while its rows pass."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .session import written

LOG = "run string, step string, status string, rows_in long, rows_out long, rows_rejected long, first timestamp_ntz, last timestamp_ntz, started timestamp, seconds double, error string, parameters map<string,string>"


class RunLog:
    """Rows of a run table, one for each step; `save` appends them.

    Counts come from observed metrics of the job that writes a step's rows, to a staging table in the shared folder, from
    which the sink takes them: a sink that samples its rows or runs again would count them again. A stage that
    Spark repeats for a lost executor may do so still; the rows themselves aren't touched by that.
    """

    def __init__(self, spark: SparkSession, path: str, **parameters: object):
        self.spark, self.path, self.run, self.rows = spark, path, uuid.uuid4().hex, []
        self.parameters = {k: str(v) for k, v in parameters.items()}

    def step(self, name: str, rows: DataFrame, sink: Callable[[DataFrame], object], work: Callable[[DataFrame], DataFrame] | None = None, valid: Column | None = None, time: str | None = None, staged: bool = True) -> object:
        """Pass `rows` through `valid` (others are rejected), `work` and `sink`; a failing step is logged and raises.

        first and last are the ends of `time` among the valid rows. `staged=False` saves the staging table for a sink
        that reads its rows in one job, once.
        """
        seen, out, started = Observation(), Observation(), datetime.now(timezone.utc)
        ok = F.lit(True) if valid is None else F.coalesce(valid, F.lit(False))
        span = [f(F.when(ok, F.col(time).cast("timestamp_ntz"))).alias(k) for k, f in (("first", F.min), ("last", F.max))] if time else []
        taken = rows.observe(seen, F.count(F.lit(1)).alias("rows_in"), F.count_if(~ok).alias("rows_rejected"), *span)
        kept = taken if valid is None else taken.where(ok)
        result = (work(kept) if work else kept).observe(out, F.count(F.lit(1)).alias("rows_out"))
        try:
            answer = sink(written(result, "step") if staged else result)
        except Exception as error:
            self._add(name, "failed", {}, started, f"{type(error).__name__}: {error}"[:2000])
            raise
        self._add(name, "success", seen.get | out.get, started, None)
        return answer

    def skipped(self, name: str) -> None:
        """Log a step that had nothing to do."""
        self._add(name, "skipped", {}, datetime.now(timezone.utc), None)

    def _add(self, name: str, status: str, found: dict, started: datetime, error: str | None) -> None:
        seconds = (datetime.now(timezone.utc) - started).total_seconds()
        self.rows.append((self.run, name, status, *(found.get(k) for k in ("rows_in", "rows_out", "rows_rejected", "first", "last")), started, seconds, error, self.parameters))

    def save(self) -> None:
        """Append the steps so far to the run table."""
        self.spark.createDataFrame(self.rows, LOG).coalesce(1).write.mode("append").parquet(self.path)
        self.rows = []


def history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG).parquet(path)
