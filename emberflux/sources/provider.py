"""A Python data source for monthly grid extracts from an HTTP service.

    spark.dataSource.register(MonthlyGrid)
    spark.read.format("monthly_grid").options(url=..., start="2024-01-01 00:00:00", end="2024-03-01 00:00:00").load()

Rows have the columns month and body; sources.payload decodes the bodies. The service is spared: months
are dealt to `streams` partitions (option, 1 by default), and each reads its months in order with `pause`
seconds (5 by default) in between. The option `fetch` names a function "module:name" to use in place of
the HTTP request, for recorded data; `login` one that gives request headers for a url: it is called before
the first request of a partition and again when the service answers 401 or 403.
"""

from __future__ import annotations

import importlib
import time
import urllib.parse
import urllib.request
from collections.abc import Iterator
from datetime import datetime

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def months(start: datetime, end: datetime) -> list[tuple[datetime, datetime]]:
    """(first instant, the sooner of next month and end) of each month; months of no length are left out."""
    out, now = [], start.replace(day=1, hour=0, minute=0, second=0, microsecond=0)
    while now < end:
        following = now.replace(year=now.year + now.month // 12, month=now.month % 12 + 1)
        out.append((now, min(following, end)))
        now = following
    return out


def http_fetch(url: str, start: datetime, end: datetime, headers: dict | None = None) -> str:
    query = urllib.parse.urlencode({"start_time": str(start), "end_time": str(end), "corrected_values": "true"}, quote_via=urllib.parse.quote, safe=":")
    request = urllib.request.Request(f"{url}?{query}", headers=headers or {})  # noqa: S310
    with urllib.request.urlopen(request, timeout=30) as answer:  # noqa: S310
        return answer.read().decode()


def _named(name: str):
    """The function that "module:name" names."""
    module, function = name.split(":")
    return getattr(importlib.import_module(module), function)


class MonthlyGrid(DataSource):
    @classmethod
    def name(cls) -> str:
        return "monthly_grid"

    def schema(self) -> str:
        return "month string, body string"

    def reader(self, schema) -> DataSourceReader:
        return MonthlyGridReader(self.options)


class MonthlyGridReader(DataSourceReader):
    def __init__(self, options: dict):
        self.url, self.fetch = options.get("url", ""), options.get("fetch")
        self.start, self.end = (datetime.fromisoformat(options[k]) for k in ("start", "end"))
        self.attempts, self.delay = max(1, int(options.get("retries", 3))), float(options.get("delay", 5))
        self.streams, self.pause, self.login = max(1, int(options.get("streams", 1))), float(options.get("pause", 5)), options.get("login")

    def partitions(self) -> list[InputPartition]:
        every = months(self.start, self.end)
        return [InputPartition(every[k :: self.streams]) for k in range(min(self.streams, len(every)))]

    def _session(self) -> dict:
        return {"headers": _named(self.login)(self.url)} if self.login else {}

    def read(self, partition: InputPartition) -> Iterator[tuple[str, str]]:
        fetch, session = _named(self.fetch) if self.fetch else http_fetch, self._session()
        for k, (a, b) in enumerate(partition.value):
            if k:
                time.sleep(self.pause)
            for attempt in range(self.attempts):
                try:
                    body = fetch(self.url, a, b, **session)
                    break
                except OSError as error:
                    if attempt + 1 == self.attempts:
                        raise
                    if getattr(error, "code", None) in (401, 403):
                        session = self._session()
                    else:
                        time.sleep(self.delay)
            yield f"{a:%Y-%m}", body
