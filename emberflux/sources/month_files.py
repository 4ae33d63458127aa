"""A Python data sink for months of Parquet files that are replaced as a whole or not at all.

    spark.dataSource.register(MonthFiles)
    df.write.format("month_files").mode("overwrite").option("path", ...).option("time", "timestamp").save()

Tasks write to a folder of their own beside the table and tell the driver what they wrote. Only when all have
succeeded does the driver put the new months in place of the old ones; if a task fails, the staged files go and every
old month stays as it is (a task that is still at work then may leave a folder `_staging-...`, which readers pass over). Months that the rows don't have stay, too. Folders are year=Y/month=M, as
Spark reads partitions. Path and table lie on a file system that Python reaches, at the same place on all machines.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as fs
import pyarrow.parquet as pq
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType


@dataclass
class Staged(WriterCommitMessage):
    """The months that a task wrote, and the file name in each."""

    name: str
    months: list[tuple[int, int]]


class MonthFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "month_files"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return MonthFilesWriter(self.options, overwrite)


class MonthFilesWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.time, self.overwrite = options["path"].rstrip("/"), options.get("time", "timestamp"), overwrite
        self.staging, self.retired = (f"{self.path}/_{kind}-{uuid.uuid4().hex}" for kind in ("staging", "retired"))

    def _store(self, path: str) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        store, folder = self._store(self.staging)
        name, open_ = f"part-{uuid.uuid4().hex}.parquet", {}
        try:
            for batch in iterator:
                table = pa.Table.from_batches([batch])
                year, month = pc.year(table[self.time]), pc.month(table[self.time])
                for key in sorted(set(zip(year.to_pylist(), month.to_pylist())), key=str):
                    if None in key:
                        raise ValueError("a row without a time has no month")
                    mine = table.filter(pc.and_(pc.equal(year, key[0]), pc.equal(month, key[1])))
                    if key not in open_:
                        at = f"{folder}/year={key[0]}/month={key[1]}"
                        store.create_dir(at, recursive=True)
                        open_[key] = pq.ParquetWriter(f"{at}/{name}", table.schema, filesystem=store)
                    open_[key].write_table(mine)
        finally:
            for writer in open_.values():
                writer.close()
        return Staged(name, sorted(open_))

    def commit(self, messages: list[Staged | None]) -> None:
        """Put each month in place. Files that attempts without a message have staged are removed before."""
        months = sorted({key for m in messages if m for key in m.months})
        (store, staging), (_, retired), (_, path) = (self._store(x) for x in (self.staging, self.retired, self.path))
        won, moved = {m.name for m in messages if m}, []
        if months:
            for file in store.get_file_info(fs.FileSelector(staging, recursive=True)):
                if file.type == fs.FileType.File and file.base_name not in won:
                    store.delete_file(file.path)
        try:
            for year, month in months:
                at = f"year={year}/month={month}"
                old = store.get_file_info(f"{path}/{at}").type == fs.FileType.Directory
                if old and self.overwrite:
                    store.create_dir(f"{retired}/year={year}", recursive=True)
                    store.move(f"{path}/{at}", f"{retired}/{at}")
                    moved.append(at)
                if old and not self.overwrite:
                    for file in store.get_file_info(fs.FileSelector(f"{staging}/{at}")):
                        store.move(file.path, f"{path}/{at}/{file.base_name}")
                else:
                    store.create_dir(f"{path}/year={year}", recursive=True)
                    store.move(f"{staging}/{at}", f"{path}/{at}")
        except Exception:
            for at in moved:
                if store.get_file_info(f"{path}/{at}").type == fs.FileType.NotFound:
                    store.move(f"{retired}/{at}", f"{path}/{at}")
            raise
        self._clear()

    def abort(self, messages: list[Staged | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        for folder in (self.staging, self.retired):
            store, at = self._store(folder)
            if store.get_file_info(at).type == fs.FileType.Directory:
                store.delete_dir(at)
