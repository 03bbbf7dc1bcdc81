"""Exact top-k search by inner product, with vectors in buckets of similar length.

Candidates are sorted by length and cut into buckets. The longest bucket gives
every query a first k-th best score. In any other bucket that score, over the
query's length and the bucket's greatest length, is a cosine the candidate must
reach: above 1 the whole bucket is passed over; a high one is used on the
query's largest coordinates, whose feasible ranges are looked up in sorted
lists; a low one on the candidates' lengths. What is left is multiplied out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from crystalflow.operators.scratch import materialise

BUCKET_ROWS = 4096
QUERY_ROWS = 1024
COSINE = 0.35  # from this local threshold on, coordinates prune better than lengths
COORDINATES = 4
_SLACK = 1e-9

RESULT = "query_id long, vec_id long, score long"


def quantised(vectors: DataFrame, is_query: Column, id_col: str, vector_col: str, factor: int) -> DataFrame:
    """(id, vec, asked, length) with components floor(factor * x); only rows with an id and finite components."""
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & finite)
    rows = rows.select(F.col(id_col).cast("long").alias("id"), F.transform(x, lambda v: F.floor(v * factor)).alias("vec"), F.coalesce(is_query, F.lit(False)).alias("asked"))
    square = F.aggregate("vec", F.lit(0.0), lambda total, v: total + v.cast("double") * v.cast("double"))
    return rows.withColumn("length", F.sqrt(square))


def _stacked(vectors: pd.Series, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    out = np.zeros((len(vectors), width), np.int64)
    for row, v in zip(out, vectors, strict=True):
        row[: len(v)] = v
    return out


def coordinate_candidates(unit: np.ndarray, order: np.ndarray, ranked: np.ndarray, query: np.ndarray, cosine: float) -> np.ndarray:
    """Rows of ``unit`` whose largest-weight coordinates allow a cosine of ``cosine`` with the unit vector ``query``.

    If the cosine is t or more, a coordinate q of the query confines the
    candidate's to q t +- sqrt((1 - q^2)(1 - t^2)); where q alone reaches t the
    range goes on to 1, and where -q does it goes on to -1. ``order`` and
    ``ranked`` hold the sorted list of each coordinate.
    """
    focus = np.argsort(-np.abs(query), kind="stable")[:COORDINATES]
    own = query[focus]
    reach = np.sqrt(np.maximum(0.0, (1 - own**2) * (1 - cosine**2))) + _SLACK
    lowest = np.where(-own >= cosine - _SLACK, -2.0, own * cosine - reach)
    highest = np.where(own >= cosine - _SLACK, 2.0, own * cosine + reach)
    hits = np.zeros(len(unit), np.int8)
    for f, bounds in zip(focus, zip(lowest, highest, strict=True), strict=True):
        low, high = np.searchsorted(ranked[f], bounds)
        hits[order[f, low:high]] += 1
    return np.flatnonzero(hits == len(focus))


def search_bucket(bucket: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """Up to ``k`` best candidates of a bucket for each query, none below the query's ``least`` score."""
    bucket = bucket.sort_values("length", ascending=False)
    width = max(map(len, [*bucket["vec"], *queries["vec"]]), default=0)
    vectors, wanted = _stacked(bucket["vec"], width), _stacked(queries["vec"], width)
    ids, lengths = bucket["id"].to_numpy(), bucket["length"].to_numpy()
    biggest = np.abs(vectors).max(initial=0) * float(np.abs(wanted).max(initial=0)) * width
    exact = np.float64 if biggest < 2**52 else np.int64  # products in floating point are exact up to there
    vectors, wanted = vectors.astype(exact), wanted.astype(exact)
    lists: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None
    found = []
    for query, own, length, least in zip(wanted, queries["id"], queries["length"], queries["least"], strict=True):
        at = slice(None)
        if least > 0:
            if length == 0:
                continue
            cosine = least / (length * lengths[0]) * (1 - _SLACK) if lengths[0] else 2.0
            if cosine > 1:
                continue
            if cosine >= COSINE:
                if lists is None:
                    unit = (vectors / np.maximum(lengths, _SLACK)[:, None]).astype(np.float64)
                    order = np.argsort(unit, axis=0, kind="stable").T
                    lists = unit, order, np.sort(unit, axis=0).T
                at = coordinate_candidates(*lists, query / length, cosine)
            else:
                at = slice(0, int(np.searchsorted(-lengths, -(least / length) * (1 - _SLACK), side="right")))
        scores, names = (vectors[at] @ query).astype(np.int64), ids[at]
        keep = (names != own) & (scores >= least)
        scores, names = scores[keep], names[keep]
        if len(scores) > k:
            border = np.partition(scores, len(scores) - k)[len(scores) - k]
            scores, names = scores[scores >= border], names[scores >= border]
        best = np.lexsort((names, -scores))[:k]
        found.append(pd.DataFrame({"query_id": own, "vec_id": names[best], "score": scores[best]}))
    return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")


def _search(buckets: DataFrame, queries: DataFrame, k: int, blocks: int) -> DataFrame:
    """The best of every (bucket, block of queries) that ``queries`` names, block by block."""
    spread = buckets.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return (
        spread.groupBy("bucket", "block")
        .cogroup(queries.groupBy("bucket", "block"))
        .applyInPandas(lambda b, q: search_bucket(b, q, k) if len(b) and len(q) else search_bucket(b[:0], q[:0], k), RESULT)
    )


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 10, factor: int = 1024,
    id_col: str = "vec_id", vector_col: str = "embedding",
    bucket_rows: int = BUCKET_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """For each query row, the ``k`` highest integer inner products among all other rows.

    Returns query_id, rank (from 1), vec_id and score; ties go to the smaller
    id, and fewer than ``k`` candidates are all returned. Rows with a null id,
    a null vector or a component that is null or not finite take no part.
    Vectors of different widths are compared as if they ended in zeros. Rows
    that repeat an id are all candidates, but not for a query of that id, which
    is asked once, with the smallest such vector. Components and products must
    fit in 64 bits. Memory in a task is bounded by a bucket and a block of
    queries.
    """
    kept = materialise(quantised(vectors, is_query, id_col, vector_col, factor))
    parts = max(1, math.ceil(kept.count() / bucket_rows))
    ordered = kept.repartitionByRange(parts, F.col("length").desc(), F.col("id"))
    buckets = materialise(ordered.withColumn("bucket", F.spark_partition_id()))
    asked = buckets.where("asked").groupBy("id").agg(F.min(F.struct("vec", "length")).alias("q"))
    asked = materialise(asked.select("id", "q.*"))
    blocks = max(1, math.ceil(asked.count() / query_rows))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    # a number per bucket
    sizes = sorted(map(tuple, buckets.groupBy("bucket").agg(F.max("length")).collect()))
    first = sizes[0][0] if sizes else 0
    others, longest = np.array([b for b, _ in sizes[1:]], np.int32), np.array([n for _, n in sizes[1:]], float)
    unknown = F.lit(-(2**63)).cast("long").alias("least")
    start = materialise(
        _search(buckets.where(F.col("bucket") == F.lit(first)), asked.select("*", F.lit(first).cast("int").alias("bucket"), unknown), k, blocks)
    )
    reached = start.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).where(F.col("n") == k)
    bounded = asked.join(reached.select(F.col("query_id").alias("id"), "least"), "id", "left").withColumn(
        "least", F.coalesce("least", unknown)
    )

    def reachable(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Each query with every bucket that can still hold a better candidate."""
        for part in parts:
            for row in part.itertuples(index=False):
                able = others if row.least <= 0 else others[longest * row.length * (1 + _SLACK) >= row.least]
                for block in np.array_split(able, 1 + len(able) // 1000):
                    if len(block) == 0:
                        continue
                    yield pd.DataFrame({"id": row.id, "vec": [row.vec] * len(block), "length": row.length, "block": row.block, "bucket": block, "least": row.least})

    rest = bounded.mapInPandas(reachable, "id long, vec array<bigint>, length double, block int, bucket int, least long")
    found = start.unionByName(_search(buckets.where(F.col("bucket") != F.lit(first)), rest, k, blocks))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
