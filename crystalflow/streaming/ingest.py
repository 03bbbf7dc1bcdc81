"""Structured Streaming ingestion: new files or new pages only, upserted by key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from crystalflow.operators import quality
from crystalflow.operators.scratch import materialise
from crystalflow.operators.upsert import write_upsert
from crystalflow.sources import documents


def ingest_new_files(
    spark: SparkSession,
    path: str,
    table_path: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    files_per_batch: int | None = None,
    buckets: int | None = 64,
    most_unusable: float | None = None,
) -> StreamingQuery:
    """Upsert the documents of files not seen before, then stop.

    The checkpoint remembers files; a batch that is retried after a failure
    writes the same rows again, which an upsert by key makes harmless. Lines
    without a usable document go to the table ``<table_path>_rejects``. A batch
    in which they are more than the share ``most_unusable`` fails the query
    before a table is touched, and comes again when it is started anew.
    """
    reader = spark.readStream.format("text")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    lines = reader.load(path).select(
        "value",
        F.col("_metadata.file_modification_time").alias("file_modified"),
        F.col("_metadata.file_path").alias("file_path"),
    )

    def store(batch: DataFrame, batch_id: int) -> None:
        # the batch's rows are used twice, and their line numbers must agree
        routed = documents.route(batch.withColumn("line_no", F.monotonically_increasing_id()))
        routed = quality.written_within(routed, ~F.col("parsed"), most_unusable)
        latest = documents.latest_documents(routed.where("parsed"))
        write_upsert(latest, table_path, partition_by=partition_by, buckets=buckets)
        write_upsert(documents.unusable_lines(routed), documents.rejects_path(table_path))

    return (
        lines.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_new_pages(
    spark: SparkSession,
    source: str,
    table_path: str,
    checkpoint: str,
    options: Mapping[str, str] | None = None,
    buckets: int | None = 64,
) -> StreamingQuery:
    """Upsert what a paged service has added since the last run, then stop.

    ``source`` is the name a :func:`documents.paged_source` is registered under.
    The checkpoint remembers how many rows were taken, so pages taken before
    are not asked for again, but for a last one that was not full. A run in which a page fails
    stores nothing of its batch; the next one asks for the batch's pages again.
    """
    served = documents.with_modified(spark.readStream.format(source).options(**(options or {})).load())

    def store(batch: DataFrame, batch_id: int) -> None:
        held = materialise(batch)  # each page is asked for once
        write_upsert(held, table_path, "id", [F.col("last_modified").desc_nulls_last()], buckets=buckets)

    return served.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
