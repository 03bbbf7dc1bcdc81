"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from crystalflow.operators.scratch import materialise


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _contracted(edges: DataFrame, larger: bool) -> DataFrame:
    """One star step: neighbours (the larger ones, or all others) are linked to the smallest one."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if larger else edges
    # written, so that both join sides come straight from a shuffle and Spark can split a much linked node
    least = materialise(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least")))
    stars = both.join(least, "a")
    if larger:
        moved = stars.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        moved = stars.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            least.select("a", F.col("least").alias("b"))
        )
    return moved.where(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a and b) but the smallest of each component, which is the root.

    Each round writes its edges, which never grow in number; rounds grow with
    the logarithm of the longest chain. Links of a node with itself are left
    out.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where(F.col("a") != F.col("b"))
    edges = materialise(edges.distinct())
    state = _state(edges)
    while True:
        edges = materialise(_contracted(materialise(_contracted(edges, larger=True)), larger=False))
        now = _state(edges)
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now
