"""Export splits, casts, unions, chunks and caps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from crystalflow.functions import text
from crystalflow.operators import export
from crystalflow.queries import Tables, query, roles


def _curated(t: Tables) -> DataFrame:
    """Tasks as curated rows; those with a high discount are not compatible."""
    return roles.tasks(t).select(
        F.col("task_id").alias("id"),
        text.functional_from_label(F.col("calc_type")).alias("functional"),
        (F.col("ispin") == 2).alias("cross_compatibility"),
        "energy",
        "nsites",
        F.col("l_shipdate").alias("last_modified"),
    )


_CURATED = f"""{roles.TASKS},
v_curated AS (
  SELECT task_id AS id, functional, ispin = 2 AS cross_compatibility, energy, nsites, l_shipdate AS last_modified,
         CASE WHEN ispin = 2 THEN 'compatible_' || functional ELSE 'non_compatible' END AS split
  FROM v_ranked_tasks)"""


@query(f"WITH {_CURATED} SELECT id, split FROM v_curated")
def export_splits(t: Tables) -> DataFrame:
    return export.with_split(_curated(t)).select("id", "split")


@query(f"WITH {_CURATED} SELECT split, count(*) AS n_rows FROM v_curated GROUP BY split")
def split_counts(t: Tables) -> DataFrame:
    return export.split_counts(_curated(t))


@query(
    f"""WITH {_CURATED}
    SELECT id, CAST(nsites AS TINYINT) AS nelements, nsites, energy, functional, cross_compatibility,
           '[{{"name":"' || functional || '","mass":null}}]' AS species,
           strftime(last_modified, '%Y-%m-%d') AS last_modified
    FROM v_curated"""
)
def export_cast(t: Tables) -> DataFrame:
    record = F.struct(F.col("functional").alias("name"), F.lit(None).cast("double").alias("mass"))
    rows = _curated(t).withColumns(
        {
            "nelements": F.col("nsites"),
            "species": F.array(record),
            "last_modified": F.to_date("last_modified"),
        }
    )
    names = ["nelements", "nsites", "energy", "functional", "cross_compatibility", "species", "last_modified"]
    return export.export_columns(rows, {n: export.STRUCTURE_EXPORT[n] for n in names}, keep=["id"])


@query(
    """SELECT 'c-' || c_custkey AS id, c_acctbal AS energy, c_mktsegment AS segment FROM customer
    UNION ALL SELECT 's-' || s_suppkey, s_acctbal, NULL FROM supplier"""
)
def export_union(t: Tables) -> DataFrame:
    customers = t.customer.select(
        F.concat(F.lit("c-"), F.col("c_custkey").cast("string")).alias("id"),
        F.col("c_acctbal").alias("energy"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = t.supplier.select(
        F.concat(F.lit("s-"), F.col("s_suppkey").cast("string")).alias("id"),
        F.col("s_acctbal").alias("energy"),
    )
    return export.union_tables([customers, suppliers])


@query(
    f"""WITH {_CURATED},
    placed AS (SELECT *, (row_number() OVER (PARTITION BY split ORDER BY id) - 1) // 1000 AS chunk FROM v_curated)
    SELECT split, chunk, count(*) AS n_rows, min(id) AS first_id, max(id) AS last_id
    FROM placed GROUP BY split, chunk"""
)
def export_chunks(t: Tables) -> DataFrame:
    placed = export.chunked(export.with_split(_curated(t)), chunk_size=1000)
    return placed.groupBy("split", "chunk").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("id").alias("first_id"), F.max("id").alias("last_id")
    )


@query(
    f"""WITH {_CURATED},
    placed AS (SELECT *, (row_number() OVER (PARTITION BY split ORDER BY id) - 1) // 1000 AS chunk FROM v_curated),
    earlier AS (SELECT *, (row_number() OVER (PARTITION BY split ORDER BY id) - 1) // 1000 AS chunk
                FROM v_curated WHERE id < '5'),
    plan AS (SELECT split, chunk, count(*) AS n_rows, min(id) AS first_id, max(id) AS last_id FROM placed GROUP BY split, chunk)
    SELECT * FROM plan
    EXCEPT SELECT split, chunk, count(*), min(id), max(id) FROM earlier GROUP BY split, chunk"""
)
def export_chunks_due(t: Tables) -> DataFrame:
    """What an export still has to write after a run on a table that lacked the ids from ``5`` on."""
    now = export.with_split(_curated(t))
    then = now.where(F.col("id") < "5")
    plan, finished = (export.chunk_table(export.chunked(rows, chunk_size=1000)) for rows in (now, then))
    return export.due_chunks(plan, finished).drop("digest")


@query("SELECT o_orderkey AS id FROM orders ORDER BY md5('7-' || o_orderkey), o_orderkey LIMIT 500")
def sample_cap(t: Tables) -> DataFrame:
    """A run's cap on the number of exported rows, taken in seeded order."""
    return export.cap_rows(t.orders.select(F.col("o_orderkey").alias("id")), 500, seed=7)


@query("SELECT o_orderkey AS id FROM orders ORDER BY o_orderkey LIMIT 500")
def row_cap(t: Tables) -> DataFrame:
    """The same cap in key order."""
    return export.cap_rows(t.orders.select(F.col("o_orderkey").alias("id")), 500)
