"""Intermediate tables in the shared folder the session names."""

from __future__ import annotations

import atexit
import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from crystalflow.operators import files

SETTING = "spark.checkpoint.dir"

_written: list[tuple[SparkSession, str]] = []


def folder(spark: SparkSession) -> str:
    """The session's checkpoint folder.

    Where none is set, a temporary one in local mode; on a cluster, whose
    machines share no temporary folder, an error.
    """
    named = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING, None)
    if named:
        return named
    if spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local":
        made = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set(SETTING, made)
        return made
    raise RuntimeError(f"set {SETTING} to a folder that the driver and all executors share")


def new_path(spark: SparkSession, kind: str = "crystalflow") -> str:
    """A fresh path in the shared folder, deleted when the driver's Python ends."""
    path = f"{folder(spark).rstrip('/')}/{kind}/{uuid4().hex}"
    if not _written:
        atexit.register(sweep)
    _written.append((spark, path))
    return path


def sweep() -> None:
    """Delete every intermediate table written so far whose session still runs."""
    while _written:
        spark, path = _written.pop()
        if spark.sparkContext._jsc is not None:
            files.remove(spark, path)


def materialise(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet and read back, for plans that use it twice.

    Cuts lineage, survives lost executors and, unlike a checkpoint, keeps
    column pruning.
    """
    path = new_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
