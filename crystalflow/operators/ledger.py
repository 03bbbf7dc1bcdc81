"""Dataset versions: what was synced last, and what a run brings."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from crystalflow import schema as S
from crystalflow.operators import files
from crystalflow.operators.upsert import write_upsert

log = logging.getLogger(__name__)
COMPLETED = "completed"


def transform_key(dataset: str) -> str:
    """Ledger key of the transform that fills table ``dataset``."""
    return f"{dataset}_transform"


def read_version(spark: SparkSession, path: str, dataset: str) -> str | None:
    """Last synced version; None when unknown or the ledger cannot be read."""
    try:
        if not files.has_data(spark, path):
            return None
        row = (
            spark.read.schema(S.LEDGER)
            .parquet(path)
            .where(F.col("dataset_name") == dataset)
            .select("last_synced_version")
            .first()
        )
    except Exception as error:  # an unreadable ledger must not stop a sync
        log.warning("ledger %s cannot be read: %s", path, error)
        return None
    return row["last_synced_version"] if row else None


def write_version(spark: SparkSession, path: str, dataset: str, version: str) -> bool:
    """Store a version. Returns False, and writes nothing, when it has not changed."""
    if read_version(spark, path, dataset) == version:
        return False
    entry = spark.range(1).select(
        F.lit(dataset).alias("dataset_name"),
        F.lit(version).alias("last_synced_version"),
        F.current_timestamp().alias("last_sync_date"),
        F.lit(COMPLETED).alias("sync_status"),
    )
    write_upsert(entry, path, key="dataset_name")
    return True


def new_version(df: DataFrame, modified: str = "last_modified") -> DataFrame:
    """One row ``version``: the latest modification day, or today without any."""
    day = F.max(F.to_date(modified))
    return df.agg(F.date_format(F.coalesce(day, F.current_date()), "yyyy-MM-dd").alias("version"))


def source_version(url: str | Column, updated: str | Column) -> Column:
    """Version text of a dump: its url and date."""
    u = F.lit(url) if isinstance(url, str) else url
    d = F.lit(updated) if isinstance(updated, str) else updated
    return F.concat_ws("|", u, d.cast("string"))


def unseen_sources(listing: DataFrame, ledger: DataFrame, dataset: str) -> DataFrame:
    """Dumps whose url and date are not the stored version, so need a load."""
    stored = ledger.where(F.col("dataset_name") == dataset).select(
        F.col("last_synced_version").alias("_version")
    )
    tagged = listing.withColumn("_version", source_version(F.col("url"), F.col("last_modified")))
    return tagged.join(stored, "_version", "left_anti").drop("_version")
