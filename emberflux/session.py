"""Session helpers."""

from __future__ import annotations

import re
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    } | conf
    spark = SparkSession.builder.master(f"local[{cores}]").config(map=settings).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ship(spark)


def ship(spark: SparkSession) -> SparkSession:
    """Let Python workers find this package where it lies beside the caller and isn't installed."""
    env, home = spark.sparkContext.environment, str(Path(__file__).resolve().parents[1])
    if home not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(x for x in (home, env.get("PYTHONPATH", "")) if x)
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share; a temporary one only on a local master where none is named."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("name a folder that driver and executors share in spark.checkpoint.dir")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="emberflux-"))
        found = sc.getCheckpointDir()
    return f"{found.rstrip('/')}/emberflux/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: the rows as a Parquet table in the shared folder."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
