"""File listings: magic bytes and the choice of a member in an archive."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def file_kind(head: Column) -> Column:
    """zip, grib or other by the first four bytes."""
    start = F.hex(F.substring(head, 1, 4))
    return F.when(start == "504B0304", "zip").when(start == "47524942", "grib").otherwise("other")


def read_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """path, length, content and kind of the files under a folder."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "length", "content", file_kind(F.col("content")).alias("kind"))


def choose_member(members: DataFrame) -> DataFrame:
    """Of each archive the only GRIB-like member, else the largest of them, else the largest file; ties by name."""
    grib = F.lower("name").rlike(r"\.(grib|grb|grib2|grb2)$")
    best = F.max_by("name", F.struct(grib.alias("g"), F.col("size").alias("s"), F.reverse("name").alias("n")))
    return members.where(~F.col("name").endswith("/")).groupBy("archive").agg(best.alias("member"))


def zip_members(archives: DataFrame) -> DataFrame:
    """(archive, name, size) of each member of zip files with `path` and `content`."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as found:
                    yield pd.DataFrame([(path, x.filename, x.file_size) for x in found.infolist()], columns=["archive", "name", "size"])

    return archives.where("kind = 'zip'").select("path", "content").mapInPandas(run, "archive string, name string, size long")


def extract(archives: DataFrame) -> DataFrame:
    """(path, member, content): the chosen member of each zip file, other files as they are."""
    chosen = choose_member(zip_members(archives)).withColumnRenamed("archive", "path")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = [(p, m, zipfile.ZipFile(io.BytesIO(c)).read(m)) for p, m, c in zip(frame["path"], frame["member"], frame["content"])]
            yield pd.DataFrame(out, columns=["path", "member", "content"])

    unpacked = archives.join(chosen, "path").select("path", "member", "content").mapInPandas(run, "path string, member string, content binary")
    return unpacked.unionByName(archives.where("kind <> 'zip'").select("path", F.element_at(F.split("path", "/"), -1).alias("member"), "content"))
