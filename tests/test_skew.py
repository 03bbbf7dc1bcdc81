"""Salted joins against plain ones, with a key that holds a third of the rows."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from crystalflow.functions import text
from crystalflow.operators import frames, selection, skew
from crystalflow.plans import dump


@pytest.fixture(scope="module")
def rows(spark):
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 31 == 1, F.lit(None)).otherwise(100 + F.col("id") % 900)
    return spark.range(9000).select(key.alias("key"), "id", (F.col("id") % 13).cast("int").alias("v"))


@pytest.fixture(scope="module")
def per_key(rows):
    return rows.groupBy("key").agg(F.sum("v").alias("total")).where("total % 2 = 0 AND key IS NOT NULL")


def bag(df):
    return Counter(tuple(r) for r in df.select("key", "id", *[c for c in df.columns if c == "total"]).collect())


def test_frequent_keys_are_found(spark, rows):
    found = skew.frequent_keys(rows, ["key"])
    hot = rows.where("key = 7").select(skew._hash(["key"])).first()[0]
    assert found == [hot]
    assert skew.frequent_keys(spark.range(50).withColumnRenamed("id", "key"), ["key"]) == []
    assert skew.frequent_keys(rows.limit(0), ["key"]) == []


def test_rarer_keys_count_with_more_partitions(spark):
    """With 100 partitions a key of one per cent fills two of them."""
    df = spark.range(20_000).select(F.when(F.col("id") % 100 == 0, -1).otherwise(F.col("id")).alias("key"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "100")
    try:
        assert skew.frequent_keys(df, ["key"]) == [df.where("key = -1").select(skew._hash(["key"])).first()[0]]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(rows, per_key, how):
    salted = skew.join_per_key(rows, per_key, ["key"], how)
    assert skew.SALT not in salted.columns
    assert bag(salted) == bag(rows.join(per_key, "key", how))
    narrow = per_key.withColumn("key", F.col("key").cast("int"))
    assert bag(skew.join_per_key(rows, narrow, ["key"], how)) == bag(rows.join(per_key, "key", how))


def test_hot_key_is_spread(spark, rows, per_key):
    every = rows.groupBy("key").agg(F.count("*").alias("total"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = skew.join_per_key(rows, every, ["key"]).where("key = 7")
        places = joined.groupBy(F.spark_partition_id()).count().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert places > 1


def test_group_operators_on_a_hot_key(rows):
    df = rows.where("key IS NOT NULL")
    plain = df.groupBy("key").agg(F.max_by("v", "id").alias("last"), F.max("id").alias("end"))
    expected = {(r["key"], r["id"], r["last"]) for r in df.join(plain, "key").collect()}
    got = frames.last_value(df, ["key"], ["id"], "v", "last")
    assert {(r["key"], r["id"], r["last"]) for r in got.collect()} == expected
    kept = selection.drop_groups(df, ["key"], F.col("id").isin(3, 4))
    assert kept.where("key IN (7, 104)").count() == 0 and kept.count() == df.where("key NOT IN (7, 104)").count()


def test_hot_structure_keeps_its_arrays(spark):
    """Arrays come in atom order for every structure, also one with a third of all atoms."""
    atoms = spark.range(6000).select(
        "id",
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.floor(F.col("id") / 6) + 10).cast("bigint").alias("structure_id"),
        F.lit("Al").alias("element_id"),
        F.col("id").cast("double").alias("x"),
        *[F.lit(0.0).alias(c) for c in ("y", "z", "fx", "fy", "fz", "charge")],
    )
    sites = {r["structure_id"]: [p[0] for p in r["fractional"]] for r in dump.site_arrays(atoms).collect()}
    assert sites[1] == [float(i) for i in range(0, 6000, 3)]
    assert sites[11] == [7.0, 8.0, 10.0, 11.0] and len(sites) == 1001
    some = dump.site_arrays(atoms, spark.createDataFrame([(1,), (12,)], "id long"))
    assert {r["structure_id"] for r in some.select("structure_id").collect()} == {1, 12}


def test_best_and_labels(spark):
    df = spark.createDataFrame(
        [("m", "GGA+U x", 3.0), ("m", "GGA x", 1.0), ("m", "HSE", 0.0)], "key string, label string, e double"
    ).withColumn("functional", text.functional_from_label(F.col("label")))
    best = selection.best_per_group(df.where("functional IS NOT NULL"), ["key", "functional"], ["e"])
    assert [r["label"] for r in best.collect()] == ["GGA x"]
