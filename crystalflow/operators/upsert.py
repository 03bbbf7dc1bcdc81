"""Keyed upsert of batches into tables.

:func:`write_upsert` merges into plain Parquet and rewrites only the partitions
a batch touches; hash buckets of the key keep those few for small batches.
:func:`merge_upsert` leaves the merge to a catalog that has row-level
operations.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession, functions as F, types as T

from crystalflow.operators import files, scratch
from crystalflow.operators.selection import best_per_group

_MOST_LITERALS = 1000
BUCKET = "key_bucket"


def latest_per_key(batch: DataFrame, key: str, newest_first: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``newest_first`` order."""
    return best_per_group(batch, [key], newest_first)


def upsert(
    target: DataFrame, batch: DataFrame, key: str = "id", newest_first: Sequence[Column] | None = None
) -> DataFrame:
    """Target with the batch's rows inserted, or replacing rows of the same key.

    The target is read once and never sorted; when the batch is small Spark
    broadcasts its keys and the target is not shuffled either. Without
    ``newest_first`` batch keys must be unique.
    """
    new = batch if newest_first is None else latest_per_key(batch, key, newest_first)
    untouched = target.join(new.select(key), key, "left_anti").select(*target.columns)
    return untouched.unionByName(new.select(*target.columns))


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    partition_by: Sequence[str] = (),
    location: str | None = None,
) -> None:
    """Create the Parquet table unless it exists.

    Partitioning and sorting within files take the place of an index.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    partitions = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{partitions}{at}")


def write_upsert(
    batch: DataFrame,
    path: str,
    key: str = "id",
    newest_first: Sequence[Column] | None = None,
    partition_by: Sequence[str] = (),
    buckets: int | None = None,
) -> None:
    """Upsert ``batch`` into the Parquet table at ``path``.

    Only partitions the batch touches are rewritten (a key must not change
    partition). With ``buckets`` the table is partitioned by a hash of the key
    as well, as column ``key_bucket``; their number must stay the same. The
    batch is computed once. The merged rows are written next to the table first
    and moved in by a second job, so the table is never overwritten while being
    read. A run that died between the two is finished by the next call.

    Files are sorted by the key and carry a Bloom filter of it, so that lookups
    of few keys skip row groups (:func:`selection.lookup_few`).
    """
    spark = batch.sparkSession
    if buckets is not None:
        batch = batch.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
        partition_by = [*partition_by, BUCKET]
    staging = f"{path.rstrip('/')}__staging"
    if files.is_complete(spark, staging):
        _move_in(spark, staging, path, key, partition_by)
    new = batch if newest_first is None else latest_per_key(batch, key, newest_first)
    if not files.has_data(spark, path):
        _keyed(new, key, partition_by).mode("overwrite").parquet(path)
        return
    new = scratch.materialise(new)
    target = spark.read.schema(batch.schema).parquet(path)
    if partition_by:
        target = _touched(target, new, partition_by)
    upsert(target, new, key).write.mode("overwrite").partitionBy(*partition_by).parquet(staging)
    _move_in(spark, staging, path, key, partition_by)


def merge_upsert(
    batch: DataFrame, table: str, key: str = "id", newest_first: Sequence[Column] | None = None
) -> None:
    """Upsert ``batch`` into a catalog table that supports row-level operations.

    The catalog rewrites only the files that hold changed keys. A batch key must
    be unique, or ``newest_first`` say which row to take.
    """
    new = batch if newest_first is None else latest_per_key(batch, key, newest_first)
    same = F.col(f"{table}.{key}") == F.col(f"new.{key}")
    new.alias("new").mergeInto(table, same).whenMatched().updateAll().whenNotMatched().insertAll().merge()


def _touched(target: DataFrame, new: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """The partitions of ``target`` that ``new`` has rows for.

    Partition values are few, so they become literals and prune the scan; more
    of them are joined. Either way only these partitions are rewritten.
    """
    named = new.select(*partition_by).distinct()
    values = named.limit(_MOST_LITERALS + 1).collect()
    if len(values) > _MOST_LITERALS:
        held = named.select(*[F.col(c).alias(f"_new_{c}") for c in partition_by])
        same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_new_{c}")) for c in partition_by])
        return target.join(held, same, "left_semi")
    conditions = [
        reduce(and_, [F.col(c).eqNullSafe(F.lit(row[c])) for c in partition_by]) for row in values
    ]
    return target.where(reduce(or_, conditions, F.lit(False)))


def _keyed(rows: DataFrame, key: str, partition_by: Sequence[str]) -> DataFrameWriter:
    """A writer of files sorted by the key, with a Bloom filter of it."""
    writer = rows.sortWithinPartitions(*partition_by, key).write.partitionBy(*partition_by)
    return writer.option(f"parquet.bloom.filter.enabled#{key}", "true")


def _move_in(spark: SparkSession, staging: str, path: str, key: str, partition_by: Sequence[str]) -> None:
    writer = _keyed(spark.read.parquet(staging), key, partition_by).mode("overwrite")
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    files.remove(spark, staging)
