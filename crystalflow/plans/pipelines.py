"""The public surface: ingest, curate, export, and how to add a source."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from crystalflow import schema as S
from crystalflow.functions import text
from crystalflow.operators import export as ex, files, ledger, quality, scratch, selection, upsert
from crystalflow.plans import dump, materials, vendor
from crystalflow.sources import documents, links, listing

StructureJob = Callable[..., DataFrame]
TrajectoryJob = Callable[..., tuple[DataFrame, DataFrame]]

_STRUCTURE_JOBS: dict[str, StructureJob] = {
    "mp": materials.curate_structures,
    "alexandria": vendor.curate_structures,
    "oqmd": dump.curate_structures,
}
_TRAJECTORY_JOBS: dict[str, TrajectoryJob] = {
    "mp": partial(materials.curate_trajectories, write_once=True),
    "alexandria": partial(vendor.curate_trajectories, write_once=True),
    "oqmd": partial(dump.curate_trajectories, write_once=True),
}


def register_source(
    name: str, structures: StructureJob | None = None, trajectories: TrajectoryJob | None = None
) -> None:
    """Add a source.

    ``structures(*inputs, **options)`` gives rows classified with ``reasons``;
    ``trajectories`` gives ``(frames, rejects)``.
    """
    if structures is not None:
        _STRUCTURE_JOBS[name] = structures
    if trajectories is not None:
        _TRAJECTORY_JOBS[name] = trajectories


def curate_structures(source: str, *inputs, most_rejected: float | None = None, **options) -> tuple[DataFrame, DataFrame]:
    """Good structures of a source, and the rejected rows with their reasons.

    The classified rows are written to scratch once, so that storing both
    parts does not run the job twice. Where more than the share
    ``most_rejected`` of them is rejected, the run stops with
    :class:`quality.TooManyRejects` and nothing is stored.
    """
    classified = _STRUCTURE_JOBS[source](*inputs, **options)
    classified = quality.written_within(classified, F.size(quality.REASONS) > 0, most_rejected)
    return quality.accepted(classified), quality.rejected(classified)


def curate_trajectories(source: str, *inputs, **options) -> tuple[DataFrame, DataFrame]:
    """Good frames of a source, and the rejected ones with their reasons.

    The known sources write the classified frames to scratch once, so that
    storing both parts does not run the job twice.
    """
    return _TRAJECTORY_JOBS[source](*inputs, **options)


def ingest(
    spark: SparkSession,
    path: str,
    table_path: str,
    ledger_path: str,
    dataset: str,
    offset: int = 0,
    partition_by: Sequence[str] = (),
    buckets: int | None = 64,
) -> str:
    """Fetch new JSON-lines files into the raw table; returns the new version.

    For dated collections ``path`` is what :func:`listing.latest_collection_path` gives.
    Files older than the ledger's version are skipped. The new version is the
    latest modification day seen, today when nothing was found. Lines without
    a usable document go to the table ``<table_path>_rejects``.
    """
    objects = listing.data_files(listing.list_objects(spark, path))
    version = ledger.read_version(spark, ledger_path, dataset)
    due = listing.oldest_first(listing.modified_since(objects, version), offset)
    # file names only, which Spark's own file index keeps on the driver as well
    paths = [r["path"] for r in due.select("path", "file_no").orderBy("file_no").toLocalIterator()]
    if paths:
        routed = documents.route(documents.read_lines(spark, paths))
        newest = documents.latest_documents(routed.where("parsed"))
        upsert.write_upsert(newest, table_path, partition_by=partition_by, buckets=buckets)
        upsert.write_upsert(documents.unusable_lines(routed), documents.rejects_path(table_path))
    fresh = ledger.new_version(objects).first()["version"]
    ledger.write_version(spark, ledger_path, dataset, fresh)
    return fresh


def ingest_keyed(
    spark: SparkSession,
    path: str,
    table_path: str,
    ledger_path: str,
    dataset: str,
    offset: int = 0,
    buckets: int | None = 64,
) -> str:
    """Fetch new keyed files into a raw trajectory table; returns the new version.

    Files of any size are read by as many tasks as they have splits. A row's
    key is its id and file: a file that comes again replaces the rows of the ids
    it holds, and files of other functionals keep theirs. Ids that it no longer
    holds stay.
    """
    objects = listing.list_objects(spark, path).where(F.col("path").rlike(r"\.json(\.[a-z0-9]+)?$"))
    version = ledger.read_version(spark, ledger_path, dataset)
    due = listing.oldest_first(listing.modified_since(objects, version), offset)
    paths = [r["path"] for r in due.select("path", "file_no").orderBy("file_no").toLocalIterator()]
    if paths:
        rows = documents.read_keyed_json_pieces(spark, paths).withColumn("key", text.composite_id("id", "path"))
        upsert.write_upsert(rows, table_path, "key", [F.col("last_modified").desc()], buckets=buckets)
    fresh = ledger.new_version(objects).first()["version"]
    ledger.write_version(spark, ledger_path, dataset, fresh)
    return fresh


def ingest_pages(
    spark: SparkSession,
    source: str,
    table_path: str,
    ledger_path: str,
    dataset: str,
    options: Mapping[str, str] | None = None,
    buckets: int | None = 64,
) -> str:
    """Fetch all documents of a paged service into the raw table; returns the new version.

    ``source`` is the name a :func:`documents.paged_source` is registered under.
    Documents not newer than the ledger's version are left out.
    """
    served = documents.with_modified(spark.read.format(source).options(**(options or {})).load())
    pages = scratch.materialise(served)  # each page is asked for once
    version = ledger.read_version(spark, ledger_path, dataset)
    due = listing.modified_since(pages, version)
    upsert.write_upsert(due, table_path, "id", [F.col("last_modified").desc_nulls_last()], buckets=buckets)
    fresh = ledger.new_version(pages).first()["version"]
    ledger.write_version(spark, ledger_path, dataset, fresh)
    return fresh


def due_downloads(
    pages: DataFrame, ledger_path: str, dataset: str, pattern: str | None = None
) -> DataFrame:
    """Links of index pages (columns ``url, html``) to files of the ledger's version day or later."""
    version = ledger.read_version(pages.sparkSession, ledger_path, dataset)
    found = links.extract_links(pages, pattern)
    return listing.modified_since(found, version, "last_modified")


def due_dumps(dumps: DataFrame, ledger_path: str, dataset: str) -> DataFrame:
    """Dumps (columns ``url, last_modified``) whose url or date is not the one loaded last."""
    spark = dumps.sparkSession
    if not files.has_data(spark, ledger_path):
        return dumps
    return ledger.unseen_sources(dumps, spark.read.schema(S.LEDGER).parquet(ledger_path), dataset)


def store(
    df: DataFrame, table_path: str, ledger_path: str, dataset: str, partition_by=("source", "functional")
) -> str:
    """Upsert curated rows and record the transform's version."""
    newest = [F.col("last_modified").desc_nulls_last(), F.xxhash64(*df.columns).desc()]
    upsert.write_upsert(df, table_path, "id", newest, partition_by)
    stored = df.sparkSession.read.parquet(table_path)
    fresh = ledger.new_version(stored).first()["version"]
    ledger.write_version(df.sparkSession, ledger_path, ledger.transform_key(dataset), fresh)
    return fresh


def slice_input(raw: DataFrame, offset: int = 0, limit: int | None = None, max_offset: int | None = None) -> DataFrame:
    """The part of a raw table a run is asked to transform, by key position."""
    if offset == 0 and limit is None and max_offset is None:
        return raw
    return selection.slice_by_key(raw, ["id"], offset, limit, max_offset)


def export(
    tables: Sequence[DataFrame],
    path: str,
    data_type: str = "structures",
    chunk_size: int = 1000,
    max_rows: int = -1,
    force_refresh: bool = False,
    fmt: str = "json",
) -> None:
    """Write the union of curated tables as export splits."""
    ex.write_export(ex.union_tables(tables), path, data_type, chunk_size, max_rows, force_refresh, fmt)


def enrich(df: DataFrame, fn: Callable, schema: T.StructType | str | None = None) -> DataFrame:
    """Apply ``fn(pandas.DataFrame) -> pandas.DataFrame`` to Arrow batches.

    For per-structure libraries a user brings, such as space-group detection or
    structure hashing. The schema defaults to the input's.
    """

    def batches(parts: Iterator) -> Iterator:
        for part in parts:
            yield fn(part)

    return df.mapInPandas(batches, df.schema if schema is None else schema)


SCHEMAS = {"raw": S.RAW, "structures": S.STRUCTURE, "trajectories": S.FRAME, "ledger": S.LEDGER}
