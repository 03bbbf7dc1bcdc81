"""Bounded, reproducible samples of labelled rows, to fit models on."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from crystalflow.operators.scratch import materialise

FEW_LABELS = 100_000


def lowest_hashes(rows: DataFrame, id_col: str, label: Column, per_label: int) -> DataFrame:
    """(id, label) of the ``per_label`` rows of each non-null label whose ids hash lowest.

    The same rows at every partitioning. Rows are counted first, and only those
    whose hash lies in about the lowest ``per_label`` are ranked, so a label
    with most of the rows gives its task no more than any other. The counts are
    sent to all tasks, so that other rows go before the shuffle by label; more
    than ``FEW_LABELS`` labels are joined instead.
    """
    named = rows.select(F.col(id_col).alias("id"), label.alias("label")).where("id IS NOT NULL AND label IS NOT NULL")
    hashed = named.withColumn("turn", F.shiftrightunsigned(F.xxhash64("id"), 11) / F.lit(float(1 << 53)))
    counted = materialise(hashed.groupBy("label").agg(F.count(F.lit(1)).alias("n")))
    counted = F.broadcast(counted) if counted.count() <= FEW_LABELS else counted
    enough = per_label + 10 * math.sqrt(per_label)  # misses the last few with a chance far below one in a billion
    low = hashed.join(counted, "label").where(F.col("turn") * F.col("n") <= enough)
    order = Window.partitionBy("label").orderBy("turn", "id")
    return low.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= per_label).select("id", "label")


def texts_of(docs: DataFrame, sample: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, label, text) of a bounded sample; the sample is small by construction and is sent to all tasks."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return texts.join(F.broadcast(sample.dropDuplicates(["id"])), "id")
