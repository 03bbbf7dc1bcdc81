"""The number of tasks follows the rows, not the files or their compressed size."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from crystalflow.operators import frames
from crystalflow.operators.skew import spread
from crystalflow.plans import common
from crystalflow.queries import Tables, curating

SMALL = "/root/testdata/sf0.001"


def test_spread_keeps_keys_together(spark):
    rows = spark.range(1000, numPartitions=1).select((F.col("id") % 50).alias("k"))
    dealt = spread(rows, ["k"], 20)
    assert dealt.rdd.getNumPartitions() == 50
    placed = dealt.withColumn("at", F.spark_partition_id())
    at = placed.groupBy("k").agg(F.countDistinct("at").alias("n"), F.count(F.lit(1)).alias("rows"))
    assert {(r["n"], r["rows"]) for r in at.collect()} == {(1, 20)}


@pytest.mark.parametrize("query", ["curate_vendor_trajectories", "curate_material_trajectories"])
def test_documents_are_dealt_before_they_become_frames(spark, monkeypatch, query):
    """one small file of documents made its frames in one task, or in as few as its bytes suggest."""
    seen = []
    filtered = frames.convergence_filter

    def watched(df, *args, **kwargs):
        seen.append(df.rdd.getNumPartitions())
        return filtered(df, *args, **kwargs)

    monkeypatch.setattr(common, "DOCUMENTS_PER_TASK", 10)
    monkeypatch.setattr(frames, "convergence_filter", watched)
    getattr(curating, query)(Tables(spark, SMALL))
    assert seen and min(seen) >= 20
