"""Choosing calculations: task references, best per group, group rejection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from crystalflow import schema as S
from crystalflow.functions import text
from crystalflow.operators import segments as seg
from crystalflow.operators.skew import join_per_key

_FEW_IDS = 500  # literals in a plan


def explode_task_references(materials: DataFrame, material_id: str = "material_id") -> DataFrame:
    """One row per non-deprecated task a material names, in document order.

    Reads ``task_types``, ``calc_types`` and ``deprecated_tasks``; gives
    ``material_id, task_pos, task_id, task_type, calc_type``.
    """
    named = materials.select(
        material_id,
        "calc_types",
        "deprecated_tasks",
        F.posexplode(F.map_entries("task_types")).alias("task_pos", "_task"),
    )
    return named.select(
        material_id,
        "task_pos",
        F.col("_task.key").alias("task_id"),
        F.col("_task.value").alias("task_type"),
        F.try_element_at("calc_types", F.col("_task.key")).alias("calc_type"),
        F.coalesce(F.array_contains("deprecated_tasks", F.col("_task.key")), F.lit(False)).alias("_old"),
    ).where(~F.col("_old")).drop("_old")


def allowed_tasks(references: DataFrame, with_static: bool = True) -> DataFrame:
    """Keep structure optimizations and, by default, static calculations."""
    kinds = [S.STRUCTURE_OPTIMIZATION] + ([S.STATIC] if with_static else [])
    return references.where(F.col("task_type").isin(kinds))


def allowed_or_static(
    references: DataFrame, with_static: bool = False, material_id: str = "material_id"
) -> DataFrame:
    """Allowed tasks; a material without any falls back to its static ones."""
    chosen = allowed_tasks(references, with_static)
    if with_static:
        return chosen
    # one row per material crosses the join, however many tasks it has
    served = chosen.select(material_id).distinct()
    static = references.where(F.col("task_type") == S.STATIC)
    fallback = join_per_key(static, served, [material_id], "left_anti")
    return chosen.unionByName(fallback)


def missing_tasks(references: DataFrame, tasks: DataFrame, task_id: str = "task_id") -> DataFrame:
    """References whose task is not in the task table."""
    return references.join(tasks.select(task_id), task_id, "left_anti")


def task_order(
    task_type: str = "task_type",
    lasph: str = "lasph",
    ispin: str = "ispin",
    energy: str = "energy",
    nsites: str = "nsites",
    label: str | None = None,
) -> list[Column]:
    """Sort key of the preferred task, best first, as ascending columns.

    Static first, then the sum of the LASPH flag and the ISPIN number (null
    parameters count 0), then energy per site, unknown last. With ``label``, GGA+U goes
    before GGA whatever the rest says.
    """
    score = F.coalesce(F.col(lasph).cast("int"), F.lit(0)) + F.coalesce(F.col(ispin).cast("int"), F.lit(0))
    per_site = F.col(energy) / F.col(nsites)
    order = [
        (F.col(task_type) != S.STATIC).cast("int"),
        -score,
        per_site.isNull().cast("int"),
        per_site,
    ]
    if label is not None:
        order.insert(0, (text.label_prefix(F.col(label)) != "GGA+U").cast("int"))
    return order


def best_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First row of each group.

    A row-number-equals-one filter: Spark keeps one row per group and map task
    before the shuffle, so a hot group does not travel.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").drop("_rank")


def rank_in_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    name: str = "trajectory_number",
    segments: int | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Keep every row and add its 0-based rank within the group; of the columns, those in ``keep`` (default all)."""
    helper = [f"_order_{i}" for i in range(len(order))]
    columns = df.columns if keep is None else list(keep)
    computed = [(F.col(o) if isinstance(o, str) else o).alias(h) for o, h in zip(order, helper)]
    return seg.position(df.select(*columns, *computed), keys, helper, name, segments, columns)


def label_rank(label: str, labels: Sequence[str]) -> Column:
    """1-based preference of a label, 0 when it is not listed."""
    return F.array_position(F.array(*[F.lit(x) for x in labels]), F.col(label))


def drop_groups(df: DataFrame, keys: Sequence[str], bad: Column) -> DataFrame:
    """Drop the whole group of every row where ``bad`` holds.

    Only the keys of bad groups are shuffled, one per map task and group.
    """
    doomed = df.where(bad).select(*keys).distinct()
    return join_per_key(df, doomed, keys, "left_anti")


def drop_groups_where(df: DataFrame, keys: Sequence[str], bad: Column) -> DataFrame:
    """Drop groups whose aggregate condition ``bad`` holds."""
    doomed = df.groupBy(*keys).agg(F.coalesce(bad, F.lit(False)).alias("_bad")).where("_bad").drop("_bad")
    return join_per_key(df, doomed, keys, "left_anti")


def drop_duplicate_labels(df: DataFrame, keys: Sequence[str], label: str = "label") -> DataFrame:
    """Drop groups in which a label occurs twice.

    Counts per (group, label) first, so no distinct set is built per group.
    """
    repeated = (
        df.where(F.col(label).isNotNull())
        .groupBy(*keys, label)
        .count()
        .where("count > 1")
        .select(*keys)
        .distinct()
    )
    return join_per_key(df, repeated, keys, "left_anti")


def drop_null_references(
    df: DataFrame, keys: Sequence[str], first: str = "input_id", second: str = "output_id"
) -> DataFrame:
    """Drop groups in which an input or output reference is null."""
    return drop_groups(df, keys, F.col(first).isNull() | F.col(second).isNull())


def drop_unconverged(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], converged: str = "converged"
) -> DataFrame:
    """Drop groups of several calculations whose last one has not converged."""
    last = F.max_by(F.coalesce(F.col(converged), F.lit(False)), F.struct(*order))
    return drop_groups_where(df, keys, (F.count(F.lit(1)) > 1) & ~last)


def join_roles(
    calculations: DataFrame,
    structures: DataFrame,
    key: str = "id",
    first: str = "input_id",
    second: str = "output_id",
) -> DataFrame:
    """Calculations with the structures they start from and end at.

    Structure columns come back prefixed ``input_`` and ``output_``.
    """

    def role(prefix: str, on: str) -> DataFrame:
        others = [F.col(c).alias(f"{prefix}_{c}") for c in structures.columns if c != key]
        return structures.select(F.col(key).alias(on), *others)

    return calculations.join(role("input", first), first).join(role("output", second), second)


def used_all_steps(electronic_steps: Column, nelm: Column) -> Column:
    """True when the electronic loop stopped at its limit; a null limit never does."""
    return F.coalesce(electronic_steps == nelm, F.lit(False))


def lookup(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in ``ids``. Spark broadcasts ``ids`` only when it is small."""
    return df.join(ids.select(key), key, "left_semi")


def lookup_few(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """As :func:`lookup`; up to ``_FEW_IDS`` ids become literals.

    These reach the scan, where statistics of sorted files and Bloom filters of
    tables written by :func:`upsert.write_upsert` skip row groups without any of
    them. More ids are joined.
    """
    few = ids.select(key).where(F.col(key).isNotNull()).distinct().limit(_FEW_IDS + 1).collect()
    if len(few) > _FEW_IDS:
        return lookup(df, ids, key)
    return df.where(F.col(key).isin([r[0] for r in few]))


def slice_by_key(
    df: DataFrame,
    order: Sequence[str | Column],
    offset: int = 0,
    limit: int | None = None,
    max_offset: int | None = None,
    segments: int | None = None,
) -> DataFrame:
    """Rows at positions ``[offset, offset + limit)`` of the ordered table.

    ``max_offset`` is an exclusive bound on the position. Any offset and limit
    stay distributed: rows are counted per segment, and only those of border
    segments are sorted.
    """
    end = None if limit is None else offset + limit
    if max_offset is not None:
        end = max_offset if end is None else min(end, max_offset)
    return seg.between(df, order, offset, end, segments)


def count_by_kind(df: DataFrame, kind: str) -> DataFrame:
    """(kind, n_rows): how many rows there are of each kind."""
    return df.groupBy(F.col(kind).alias("kind")).agg(F.count(F.lit(1)).alias("n_rows"))
