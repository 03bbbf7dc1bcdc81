"""Typed, split, chunked exports of curated tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from crystalflow import schema as S
from crystalflow.operators import files, segments as seg
from crystalflow.operators.scratch import materialise, new_path

# --- fixed values: export columns and types -------------------------------
STRUCTURE_EXPORT = {
    "elements": "array<string>",
    "nsites": "int",
    "chemical_formula_anonymous": "string",
    "chemical_formula_reduced": "string",
    "chemical_formula_descriptive": "string",
    "nelements": "tinyint",
    "dimension_types": "array<tinyint>",
    "nperiodic_dimensions": "tinyint",
    "lattice_vectors": "array<array<double>>",
    "immutable_id": "string",
    "cartesian_site_positions": "array<array<double>>",
    "species": "string",
    "species_at_sites": "array<string>",
    "last_modified": "string",
    "elements_ratios": "array<double>",
    "stress_tensor": "array<array<double>>",
    "energy": "double",
    "energy_corrected": "double",
    "magnetic_moments": "array<double>",
    "forces": "array<array<double>>",
    "total_magnetization": "double",
    "charges": "array<double>",
    "dos_ef": "double",
    "functional": "string",
    "cross_compatibility": "boolean",
    "bawl_fingerprint": "string",
    "space_group_it_number": "int",
}
NOT_IN_FRAMES = ["magnetic_moments", "dos_ef", "charges", "total_magnetization", "bawl_fingerprint"]
FRAME_EXPORT = {
    **{k: v for k, v in STRUCTURE_EXPORT.items() if k not in NOT_IN_FRAMES},
    "id": "string",
    "relaxation_step": "int",
    "relaxation_number": "int",
}

NON_COMPATIBLE = "non_compatible"
CHUNKS = "_chunks"  # table of finished chunks beside an export


def split_name(functional: Column, cross_compatibility: Column) -> Column:
    """``compatible_<functional>`` or ``non_compatible``; null for neither."""
    known = cross_compatibility & functional.isin(S.FUNCTIONALS)
    return F.when(known, F.concat(F.lit("compatible_"), functional)).when(
        ~cross_compatibility, F.lit(NON_COMPATIBLE)
    )


def with_split(df: DataFrame) -> DataFrame:
    """Add ``split``; rows that belong to none are left out."""
    split = split_name(F.col("functional"), F.col("cross_compatibility"))
    return df.withColumn("split", split).where(F.col("split").isNotNull())


def split_counts(df: DataFrame) -> DataFrame:
    """Rows per non-empty split."""
    return with_split(df).groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))


def is_empty(df: DataFrame) -> bool:
    """Emptiness check that stops at the first row."""
    return df.isEmpty()


def json_with_nulls(value: Column) -> Column:
    return F.to_json(value, {"ignoreNullFields": "false"})


def export_columns(df: DataFrame, columns: dict[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Project and cast to the export types; nested ``species`` becomes JSON text.

    Casts follow the session's ANSI mode, so a value that does not fit its
    narrow type is an error, not a wrapped number.
    """
    fields = {f.name: f.dataType.simpleString() for f in df.schema.fields}

    def cast(name: str, dtype: str) -> Column:
        value = F.col(name)
        if dtype == "string" and fields[name].startswith(("array", "struct", "map")):
            value = json_with_nulls(value)
        return value.cast(dtype).alias(name)

    return df.select(*keep, *[cast(n, t) for n, t in columns.items() if n not in keep])


def export_ready(df: DataFrame, data_type: str = "structures") -> DataFrame:
    """Rows with their split, in export shape.

    ``data_type`` is ``structures``, ``trajectories`` or ``any`` (no projection).
    The id stays as a routing column; the writer drops it where it is not exported.
    """
    tagged = with_split(df)
    if data_type == "any":
        return tagged
    columns = STRUCTURE_EXPORT if data_type == "structures" else FRAME_EXPORT
    return export_columns(tagged, columns, keep=["split", "id"])


def union_tables(tables: Sequence[DataFrame]) -> DataFrame:
    """All tables as one; a column a table lacks is null there."""
    out = tables[0]
    for other in tables[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out


def cap_rows(
    df: DataFrame, max_rows: int, key: str = "id", seed: int | None = None, segments: int | None = None
) -> DataFrame:
    """First ``max_rows`` rows by key, or by seeded hash; -1 keeps all.

    Rows are counted per segment, so a large cap does not pass through one task.
    """
    if max_rows < 0:
        return df
    if seed is None:
        return seg.between(df, [key], 0, max_rows, segments)
    shuffled = df.withColumn("_shuffle", F.md5(F.concat(F.lit(f"{seed}-"), F.col(key).cast("string"))))
    return seg.between(shuffled, ["_shuffle", key], 0, max_rows, segments).drop("_shuffle")


def chunked(
    df: DataFrame,
    chunk_size: int,
    key: str = "id",
    group: Sequence[str] = ("split",),
    segments: int | None = None,
) -> DataFrame:
    """Add ``chunk``: which run of ``chunk_size`` rows, in key order, a row is in."""
    placed = seg.position(df, list(group), [key], "_position", segments)
    return placed.withColumn("chunk", F.floor(F.col("_position") / chunk_size)).drop("_position")


def chunk_table(placed: DataFrame, key: str = "id", group: Sequence[str] = ("split",)) -> DataFrame:
    """What each chunk of :func:`chunked` holds: rows, first and last key, and a digest of its rows in any order."""
    columns = [f.name for f in placed.schema.fields if "map<" not in f.dataType.simpleString()]
    row = F.xxhash64(*columns)
    return placed.groupBy(*group, "chunk").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(key).cast("string").alias("first_id"),
        F.max(key).cast("string").alias("last_id"),
        F.bit_xor(row).alias("digest"),
    )


def due_chunks(plan: DataFrame, finished: DataFrame) -> DataFrame:
    """Chunks of ``plan`` that ``finished`` does not list with the same content."""
    return plan.join(finished.select(*plan.columns).distinct(), plan.columns, "left_anti")


def _finished(spark: SparkSession, path: str, plan: DataFrame) -> DataFrame:
    """The table of finished chunks beside an export; empty if there is none."""
    table = f"{path}/{CHUNKS}"
    if not files.has_data(spark, table):
        return plan.limit(0)
    return spark.read.schema(plan.schema).parquet(table)


def _drop_stale(spark: SparkSession, path: str, plan: DataFrame, finished: DataFrame) -> None:
    """Remove folders of chunks that an earlier run finished and this one does not have."""
    names = ["split", "chunk"]
    for row in finished.select(*names).distinct().join(plan, names, "left_anti").toLocalIterator():
        files.remove(spark, f"{path}/split={row['split']}/chunk={row['chunk']}")


def write_export(
    df: DataFrame,
    path: str,
    data_type: str = "structures",
    chunk_size: int = 1000,
    max_rows: int = -1,
    force_refresh: bool = False,
    fmt: str = "json",
    waves: int = 8,
) -> None:
    """Write splits as chunks of ``chunk_size`` rows in key order, a sorted file in a folder each.

    Chunks are dealt to ``waves`` jobs. After each, its chunks are added to the
    table ``_chunks`` beside them (rows, first and last key, digest). A run that
    finds such a table writes only chunks that are not in it with the same
    content, and removes those that no longer exist, so an export that was
    killed goes on where it stopped, and one whose input changed in places
    rewrites these. A finished export is left alone. ``force_refresh`` starts
    from nothing.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    if force_refresh:
        files.remove(spark, path)
    elif files.is_complete(spark, path):
        return
    ready = cap_rows_per_split(export_ready(df, data_type), max_rows)
    placed = chunked(ready, chunk_size).withColumn("chunk", F.lpad(F.col("chunk").cast("string"), 8, "0"))
    scratch = new_path(spark, "export")
    wave = F.pmod(F.xxhash64("split", "chunk"), F.lit(waves)).cast("int")
    placed.withColumn("_wave", wave).write.partitionBy("_wave").parquet(scratch)
    held = spark.read.schema(T.StructType([*placed.schema, T.StructField("_wave", T.IntegerType())])).parquet(scratch)
    plan = materialise(chunk_table(held.drop("_wave")).withColumn("format", F.lit(f"{data_type} {fmt}")))
    finished = materialise(_finished(spark, path, plan))
    _drop_stale(spark, path, plan, finished)
    due = materialise(due_chunks(plan, finished).withColumn("_wave", wave))
    for number in sorted(r["_wave"] for r in due.select("_wave").distinct().collect()):  # at most ``waves``
        mine = due.where(F.col("_wave") == number)
        rows = held.where(F.col("_wave") == number).join(mine.select("split", "chunk"), ["split", "chunk"], "left_semi")
        _write_chunks(rows.drop("_wave"), path, data_type, fmt)
        mine.drop("_wave").coalesce(1).write.mode("append").parquet(f"{path}/{CHUNKS}")
    files.mark_complete(spark, path)


def _write_chunks(rows: DataFrame, path: str, data_type: str, fmt: str) -> None:
    """Replace the folders of the chunks in ``rows``."""
    together = rows.repartition("split", "chunk").sortWithinPartitions("split", "chunk", "id")
    if data_type == "structures":
        together = together.drop("id")
    writer = together.write.mode("overwrite").partitionBy("split", "chunk").option("partitionOverwriteMode", "dynamic")
    writer = writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    if fmt == "json":
        writer = writer.option("ignoreNullFields", "false")
    writer.format(fmt).save(path)


def cap_rows_per_split(df: DataFrame, max_rows: int, key: str = "id") -> DataFrame:
    """At most ``max_rows`` rows of every split, in key order; -1 keeps all."""
    if max_rows < 0:
        return df
    placed = seg.position(df, ["split"], [key], "_position")
    return placed.where(F.col("_position") < max_rows).drop("_position")
