"""Layouts that save work: bucketed joins without a shuffle, Bloom filters that skip row groups; Euclid on large amounts."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from crystalflow.functions import chem
from crystalflow.operators import bucketed, selection, upsert


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_bucketed_tables_join_and_group_without_a_shuffle(spark, no_broadcast):
    tasks = spark.range(400).select(F.concat(F.lit("t"), F.col("id")).alias("task_id"), (F.col("id") * 2).alias("energy"))
    names = spark.range(900).select((F.col("id") % 300).alias("material_id"), F.concat(F.lit("t"), F.col("id") % 500).alias("task_id"))
    plain = names.join(tasks, "task_id")
    assert "Exchange" in plan_of(plain)
    held = bucketed.write_bucketed(tasks, "layout_tasks", ["task_id"], 8)
    named = bucketed.write_bucketed(names, "layout_names", ["task_id"], 8)
    try:
        joined = named.join(held, "task_id")
        assert "SortMergeJoin" in plan_of(joined) and "Exchange" not in plan_of(joined)
        assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, plain.collect()))
        missing = selection.missing_tasks(named, held)
        assert "Exchange" not in plan_of(missing)
        assert missing.count() == selection.missing_tasks(names, tasks).count() > 0
        grouped = held.groupBy("task_id").agg(F.max("energy"))
        assert "Exchange" not in plan_of(grouped) and grouped.count() == 400
        one_side = names.join(held, "task_id")
        assert plan_of(one_side).count("Exchange") == 1
    finally:
        spark.sql("DROP TABLE layout_tasks")
        spark.sql("DROP TABLE layout_names")


def scanned(df):
    """Rows that the scan gave out, after the query has run."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.apply(0).metrics().apply("numOutputRows").value()


def test_lookup_skips_row_groups_by_bloom_filter(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        keys = F.sha2((F.col("id") * 2).cast("string"), 256)
        for start in (0, 20_000):
            batch = spark.range(start, start + 20_000).select(keys.alias("id"), F.lit("x").alias("kind"), F.col("id").alias("v"))
            upsert.write_upsert(batch, path, buckets=4)
        table = spark.read.parquet(path)
        ids = spark.range(3).select(F.sha2((F.col("id") * 2).cast("string"), 256).alias("id"))
        found = selection.lookup_few(table, ids, "id")
        assert sorted(r["v"] for r in found.collect()) == [0, 1, 2]
        absent = spark.range(3).select(F.sha2((F.col("id") * 2 + 1).cast("string"), 256).alias("id"))
        none = selection.lookup_few(table, absent, "id")
        assert scanned(none) == 0  # within the range of every file, so statistics alone would read them
        assert scanned(table.where(F.col("v") >= 0)) == 40_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_lookup_of_many_ids_is_a_join(spark, monkeypatch):
    monkeypatch.setattr(selection, "_FEW_IDS", 5)
    rows = spark.range(100).withColumnRenamed("id", "key")
    ids = spark.range(90, 120).withColumnRenamed("id", "key").unionByName(spark.createDataFrame([(None,)], "key long"))
    assert selection.lookup_few(rows, ids, "key").count() == 10
    assert selection.lookup_few(rows, ids.limit(0), "key").count() == 0


@pytest.mark.parametrize("amounts", [[2, 4, 6], [1], [7, 11], [10**9, 5 * 10**8], [701408733, 433494437], [12, 18, 30, 42], [2**40, 2**33 * 3]])
def test_common_divisor(spark, amounts):
    entries = [(f"E{k}", n) for k, n in enumerate(amounts)]
    df = spark.createDataFrame([(entries,)], "c array<struct<element:string,n:bigint>>")
    assert df.select(chem.common_divisor(F.col("c"))).first()[0] == math.gcd(*amounts)
