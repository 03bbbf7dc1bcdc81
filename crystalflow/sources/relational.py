"""Relational snapshots: the four dump tables, from Parquet or over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from crystalflow import schema as S


def read_snapshot(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The dump tables from Parquet folders ``<path>/<table>``."""
    return {
        name: spark.read.schema(dtype).parquet(f"{path.rstrip('/')}/{name}")
        for name, dtype in S.dump_tables().items()
    }


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    key: str = "id",
    partitions: int = 64,
    properties: dict[str, str] | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """A table read in ``partitions`` parallel key ranges.

    Key ranges replace unordered LIMIT/OFFSET paging, which can repeat or skip
    rows. The bounds only set the strides; rows outside them are still read.
    """
    reader = spark.read.format("jdbc").option("url", url).options(**(properties or {}))
    bounds = reader.option("query", f"SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {table}").load().first()
    source = (
        spark.read.format("jdbc")
        .option("url", url)
        .options(**(properties or {}))
        .option("dbtable", table)
        .option("fetchsize", fetch_size)
    )
    if bounds["lo"] is None or bounds["lo"] == bounds["hi"]:
        return source.load()
    return (
        source.option("partitionColumn", key)
        .option("lowerBound", bounds["lo"])
        .option("upperBound", bounds["hi"])
        .option("numPartitions", partitions)
        .load()
    )
