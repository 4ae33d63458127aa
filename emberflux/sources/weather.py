"""A Python data source for monthly weather extracts from a climate data store.

    spark.dataSource.register(MonthlyWeather)
    spark.read.format("monthly_weather").options(dataset="era5-land", start="2024-01-01", end="2024-03-31", bounds="37,68,6,98", variables="t2m,ssrd", folder="/shared/raw").load()

A month's body goes in pieces to `folder`, which all machines share, and the file in it (taken out of its archive if the
store sends one) to its own name there by a last move; no body is ever held in memory. Rows have the columns year,
month, status, member, path, size and sha256. Status is success, failed (on all attempts; the other months stay),
or skipped: the file was there before, and the option `existing` isn't "overwrite_all". Months are dealt to `streams` partitions (option, 1 by default, at most as many as the
provider allows), and each asks for its months in order. `months` names the months to ask for instead of all of the
period ("2024-01,2024-03"), for what a plan leaves over. `fetch` names a function "module:name" to use in place
of the store's client, for recorded data; `login` one that gives its further arguments: it is called before the
first request of a partition and again after a failure.
"""

from __future__ import annotations

import calendar
import hashlib
import io
import time
import urllib.request
import uuid
import zipfile
from collections.abc import Iterator
from datetime import datetime
from typing import BinaryIO

import pyarrow.fs as fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .. import config as K
from .provider import _named, months


#: Bytes that are copied at a time.
PIECE = 1 << 20


def store_fetch(product: str, request: dict, **credentials) -> BinaryIO:
    """One request through the store's own client, where that is installed; the body as a stream."""
    import cdsapi

    answer = cdsapi.Client(**credentials).retrieve(product, request)
    return urllib.request.urlopen(answer.location, timeout=600)  # noqa: S310


def request_of(year: int, month: int, variables: list[str], bounds: list[float]) -> dict:
    """What is asked for: every hour of every day of one month, within [north, west, south, east]."""
    days = calendar.monthrange(year, month)[1]
    return {
        "product_type": ["reanalysis"],
        "variable": variables,
        "year": str(year),
        "month": [f"{month:02d}"],
        "day": [f"{d:02d}" for d in range(1, days + 1)],
        "time": [f"{h:02d}:00" for h in range(24)],
        "area": bounds,
        "format": "grib",
    }


def copied(source: BinaryIO, target: BinaryIO) -> tuple[int, str]:
    """Copy in pieces; size and sha256 of what was copied."""
    size, digest = 0, hashlib.sha256()
    while piece := source.read(PIECE):
        target.write(piece)
        digest.update(piece)
        size += len(piece)
    return size, digest.hexdigest()


def chosen(body: BinaryIO, name: str) -> tuple[str, BinaryIO]:
    """Name and stream of the file in a seekable body: of an archive its only GRIB-like member, else the largest of them, else the largest file."""
    magic = body.read(4)
    body.seek(0)
    if magic == b"GRIB":
        return name, body
    if magic != b"PK\x03\x04":
        raise ValueError("the body is neither an archive nor GRIB")
    found = zipfile.ZipFile(body)
    members = [x for x in found.infolist() if not x.is_dir()]
    if not members:
        raise ValueError("the archive is empty")
    like = [x for x in members if x.filename.lower().endswith((".grib", ".grb", ".grib2", ".grb2"))]
    best = min(like or members, key=lambda x: (-x.file_size, x.filename))
    return best.filename, found.open(best)


class Folder:
    """Files of a folder that come into view whole."""

    def __init__(self, path: str):
        remote = "://" in path or path.startswith("file:")
        self.store, self.root = fs.FileSystem.from_uri(path) if remote else (fs.LocalFileSystem(), path)
        self.path = path.rstrip("/")

    def size(self, name: str) -> int | None:
        found = self.store.get_file_info(f"{self.root}/{name}")
        return found.size if found.type == fs.FileType.File else None

    def take(self, body: bytes | BinaryIO, name: str) -> tuple[str, int, str]:
        """Member, size and sha256 of the file in a body, once it lies in the folder as `name`; nothing stays behind if that fails."""
        self.store.create_dir(self.root, recursive=True)
        raw, part = (f"{self.root}/.{name}.{kind}-{uuid.uuid4().hex}" for kind in ("body", "part"))
        try:
            with self.store.open_output_stream(raw) as out:
                copied(io.BytesIO(body) if isinstance(body, bytes) else body, out)
            with self.store.open_input_file(raw) as stored:
                member, content = chosen(stored, name)
                with self.store.open_output_stream(part) as out:
                    size, digest = copied(content, out)
            self.store.move(part, f"{self.root}/{name}")
            return member, size, digest
        finally:
            for left in (raw, part):
                if self.store.get_file_info(left).type == fs.FileType.File:
                    self.store.delete_file(left)


class MonthlyWeather(DataSource):
    @classmethod
    def name(cls) -> str:
        return "monthly_weather"

    def schema(self) -> str:
        return "year int, month int, status string, member string, path string, size long, sha256 string"

    def reader(self, schema) -> DataSourceReader:
        return MonthlyWeatherReader(self.options)


class MonthlyWeatherReader(DataSourceReader):
    def __init__(self, options: dict):
        self.dataset = K.DATASETS[options["dataset"]]
        self.variables = [v.strip() for v in options["variables"].split(",")]
        self.bounds = [float(x) for x in options["bounds"].split(",")]
        first, last = (datetime.fromisoformat(options[k]) for k in ("start", "end"))
        every = [(a.year, a.month) for a, _ in months(first, last.replace(hour=23, minute=59))]
        only = options.get("months")
        self.months = [m for m in every if only is None or f"{m[0]}-{m[1]:02d}" in only.split(",")]
        self.attempts, self.delay = min(K.MOST_RETRIES, max(1, int(options.get("retries", 6)))), float(options.get("delay", 15))
        self.streams = min(K.MOST_PARALLEL, max(1, int(options.get("streams", 1))))
        self.fetch, self.login = options.get("fetch"), options.get("login")
        self.folder, self.overwrite = options["folder"], options.get("existing", "skip_all") == "overwrite_all"

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(self.months[k :: self.streams]) for k in range(max(1, min(self.streams, len(self.months))))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        fetch, folder = _named(self.fetch) if self.fetch else store_fetch, Folder(self.folder)
        session = _named(self.login)() if self.login else {}
        for year, month in partition.value:
            name, found = f"{self.dataset}_{year}-{month:02d}.grib", None
            path = f"{folder.path}/{name}"
            if not self.overwrite and (size := folder.size(name)) is not None:
                yield year, month, "skipped", None, path, size, None
                continue
            for attempt in range(self.attempts):
                try:
                    body = fetch(K.PRODUCTS[self.dataset], request_of(year, month, self.variables, self.bounds), **session)
                    found = folder.take(body, name)
                    break
                except (OSError, RuntimeError, ValueError, zipfile.BadZipFile):
                    if attempt + 1 < self.attempts:
                        time.sleep(self.delay)
                        session = _named(self.login)() if self.login else {}
            yield (year, month, "success", found[0], path, found[1], found[2]) if found else (year, month, "failed", None, None, None, None)
