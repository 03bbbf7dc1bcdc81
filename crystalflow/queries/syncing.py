"""Incremental sync: listings, versions, upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from crystalflow.operators import ledger, selection, upsert
from crystalflow.queries import Tables, query, roles
from crystalflow.sources import listing

_DATA = "path LIKE '%.jsonl.gz' AND path NOT LIKE '%manifest.jsonl.gz%'"


@query(
    f"""WITH {roles.LISTING}
    SELECT doc_id, path FROM v_listing
    WHERE {_DATA} AND (last_modified IS NULL OR last_modified::DATE >= DATE '2023-03-01')"""
)
def modified_since(t: Tables) -> DataFrame:
    due = listing.modified_since(listing.data_files(roles.listing(t)), "2023-03-01")
    return due.select("doc_id", "path")


@query(f"WITH {roles.LISTING} SELECT doc_id, path FROM v_listing WHERE {_DATA}")
def modified_since_bad_version(t: Tables) -> DataFrame:
    """A stored version that is no date selects every file."""
    due = listing.modified_since(listing.data_files(roles.listing(t)), "release-7")
    return due.select("doc_id", "path")


@query(
    f"""WITH {roles.LISTING}
    SELECT path, row_number() OVER (ORDER BY last_modified NULLS FIRST, path) - 1 AS file_no FROM v_listing"""
)
def file_order(t: Tables) -> DataFrame:
    return listing.oldest_first(roles.listing(t)).select("path", "file_no")


@query(
    """SELECT CASE o_orderstatus WHEN 'F' THEN 'finished' ELSE 'open' END AS kind,
           strftime(max(date_trunc('day', o_orderdate)), '%Y-%m-%d') AS version, count(*) AS n_rows
    FROM orders GROUP BY 1"""
)
def max_modified(t: Tables) -> DataFrame:
    kinds = t.orders.withColumn("kind", F.when(F.col("o_orderstatus") == "F", "finished").otherwise("open"))
    latest = listing.latest_modified(kinds, "o_orderdate", by=["kind"])
    counted = selection.count_by_kind(kinds, "kind")
    return latest.join(counted, "kind").select("kind", F.date_format("latest", "yyyy-MM-dd").alias("version"), "n_rows")


@query("SELECT strftime(max(o_orderdate), '%Y-%m-%d') AS version FROM orders")
def new_version(t: Tables) -> DataFrame:
    return ledger.new_version(t.orders, "o_orderdate")


@query(
    f"""WITH {roles.LISTING}
    SELECT path FROM v_listing WHERE last_modified IS NULL
      OR path || '|' || strftime(last_modified, '%Y-%m-%d') NOT IN (
        SELECT path || '|' || strftime(last_modified, '%Y-%m-%d') FROM v_listing
        WHERE last_modified IS NOT NULL AND length > 1000)"""
)
def source_fingerprint(t: Tables) -> DataFrame:
    """Sources to load again: the ledger knows the long ones under url and date."""
    files = roles.listing(t).select(
        F.col("path").alias("url"), F.to_date("last_modified").alias("last_modified"), "length"
    )
    known = files.where((F.col("length") > 1000) & F.col("last_modified").isNotNull()).select(
        F.lit("dump").alias("dataset_name"),
        ledger.source_version(F.col("url"), F.col("last_modified")).alias("last_synced_version"),
    )
    return ledger.unseen_sources(files, known, "dump").select(F.col("url").alias("path"))


@query(
    """WITH newest AS (
      SELECT * FROM (SELECT o_custkey AS id, o_totalprice AS value,
                            row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r
                     FROM orders) WHERE r = 1)
    SELECT id, value FROM newest
    UNION ALL
    SELECT c_custkey, c_acctbal FROM customer WHERE c_custkey NOT IN (SELECT id FROM newest)"""
)
def upsert_latest(t: Tables) -> DataFrame:
    """Customers replaced by, or extended with, the latest order of their key."""
    target = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("value"))
    batch = t.orders.select(
        F.col("o_custkey").alias("id"), F.col("o_totalprice").alias("value"), "o_orderdate", "o_orderkey"
    )
    return upsert.upsert(
        target, batch, "id", [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]
    )
