"""The few file-system questions that jobs ask, on whatever Hadoop file system."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def is_complete(spark: SparkSession, path: str) -> bool:
    """True when a Spark job finished writing ``path``."""
    return exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def mark_complete(spark: SparkSession, path: str) -> None:
    """Say that everything due at ``path`` is written."""
    fs, p = _fs(spark, f"{path.rstrip('/')}/_SUCCESS")
    fs.create(p, True).close()


def has_data(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds any data file, whoever wrote it and whether or not it left a marker."""
    fs, root = _fs(spark, path)
    if not fs.exists(root):
        return False
    found = fs.listFiles(root, True)
    while found.hasNext():
        parts = found.next().getPath().toString()[len(fs.makeQualified(root).toString()) :].strip("/").split("/")
        if not any(p.startswith(("_", ".")) for p in parts):
            return True
    return False


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)
