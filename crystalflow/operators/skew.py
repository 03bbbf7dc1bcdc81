"""Joining rows to a one-row-per-key table when some keys are very frequent.

Spark's own skew handling splits a hot key only where both join sides come
straight from a shuffle. A per-key summary comes from an aggregate, so a key
with a third of all rows would end up in one task. Here frequent keys are
found by a sketch and salted: their rows spread over many partitions, and their
summary row is copied to each. All other keys join as usual.

What the sketch misses costs balance, never rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from crystalflow.operators.segments import default_segments

SALT = "_salt"
_TRACKED_PER_PARTITION = 16

_ATOMIC = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k).cast("string") for k in keys])


def frequent_keys(df: DataFrame, keys: Sequence[str]) -> list[int]:
    """Hashes of the keys that hold half a shuffle partition's share of the rows or more.

    One pass over the key columns counts the rows and keeps a sketch of
    frequent items, whose size follows the number of partitions; so does the
    number of hashes the driver gets.
    """
    partitions = default_segments(df)
    tracked = min(1_000_000, _TRACKED_PER_PARTITION * partitions)
    top = F.expr(f"approx_top_k(h, {min(2 * partitions, tracked)}, {tracked})")
    row = df.select(_hash(keys).alias("h")).agg(F.count(F.lit(1)).alias("n"), top.alias("top")).first()
    least = max(2, row["n"] / (2 * partitions))
    return [item["item"] for item in row["top"] or [] if item["count"] >= least]


def spread(rows: DataFrame, keys: Sequence[str], per_task: int) -> DataFrame:
    """``rows`` dealt by ``keys`` over tasks of about ``per_task`` rows, however few or small the files are.

    For rows that later steps make large: Spark sizes its tasks by compressed
    bytes, which say little about those. Counts the rows, and the partitions
    are kept as they are by later joins and windows on ``keys``.
    """
    return rows.repartition(max(default_segments(rows), -(-rows.count() // per_task)), *keys)


def join_per_key(
    rows: DataFrame,
    per_key: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    frequent: Sequence[int] | None = None,
) -> DataFrame:
    """``rows`` joined to ``per_key``, which has at most one row per key.

    ``how`` is inner, left, left_semi or left_anti.
    """
    keys = list(keys)
    hot_hashes = frequent_keys(rows, keys) if frequent is None else frequent
    if not hot_hashes:
        return rows.join(per_key, keys, how)
    # equal keys must hash alike on both sides, whatever their integer width
    types = {f.name: f.dataType for f in rows.schema.fields}
    per_key = per_key.withColumns({k: F.col(k).cast(types[k]) for k in keys})
    salts = default_segments(rows)
    hot = _hash(keys).isin(list(hot_hashes))
    spread = [f.name for f in rows.schema.fields if isinstance(f.dataType, _ATOMIC)]
    salted = rows.withColumn(
        SALT, F.when(hot, F.pmod(F.xxhash64(*spread), F.lit(salts))).otherwise(F.lit(0)).cast("int")
    )
    copies = per_key.withColumn(
        SALT,
        F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))),
    )
    return salted.join(copies, [*keys, SALT], how).drop(SALT)
