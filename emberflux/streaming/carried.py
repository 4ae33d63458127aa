"""Series that continue from one micro-batch to the next: steps of running totals and last known values."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

STATE = "at timestamp_ntz, reset date, total double, known double"


def carry_over(stream: DataFrame, key: str, time: str, total: str, value: str) -> DataFrame:
    """A stream of key, time, `<total>_step`, `<value>_known` and late, for streams and, in one batch, for tables read as such.

    The step of a running total that starts anew each day is what it rose by since the key's row before; the known value
    is the last that isn't null. Both go on over the borders of micro-batches: a key's state is one row. In a
    micro-batch a key's rows are taken in order of time (ties: of the total). Rows not after the key's last
    row of an earlier micro-batch are late: they come out with late set and no step, and change no state. Rows without
    key or time are left out. A null total has no step and leaves the total as it was.
    """
    kind = stream.schema[key].dataType
    out = T.StructType([T.StructField(key, kind), T.StructField(time, T.TimestampNTZType()), T.StructField(f"{total}_step", T.DoubleType()), T.StructField(f"{value}_known", T.DoubleType()), T.StructField("late", T.BooleanType())])

    def follow(name: tuple, parts: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, day, before, known = state.get if state.exists else (None, None, None, None)
        border, found = last, []
        for at, sum_, now in pd.concat(list(parts)).sort_values([time, total])[[time, total, value]].itertuples(index=False):
            if border is not None and at <= border:
                found.append((name[0], at, None, None, True))
                continue
            if at.date() != day:
                before = None
            step = None if pd.isna(sum_) else sum_ - (before or 0.0)
            before = before if pd.isna(sum_) else sum_
            known = known if pd.isna(now) else float(now)
            last, day = at.to_pydatetime(), at.date()
            found.append((name[0], at, step, known, False))
        if last is not None:
            state.update((last, day, before, known))
        yield pd.DataFrame(found, columns=out.names)

    rows = stream.select(key, F.col(time).cast("timestamp_ntz").alias(time), F.col(total).cast("double").alias(total), F.col(value).cast("double").alias(value)).where(F.col(key).isNotNull() & F.col(time).isNotNull())
    return rows.groupBy(key).applyInPandasWithState(follow, out, STATE, "append", GroupStateTimeout.NoTimeout)


def ingest(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append what has landed since the last call, with the state of that call."""
    stream.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
