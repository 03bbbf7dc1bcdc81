"""Sharding by minimax contiguous partition.

Equal texts form a group that no shard may split. Groups stand in the order of
their hash; the hash space is cut into 2^16 slices, and a slice with all its
groups is an atom. The driver gets the atoms' sizes (2^16 numbers at most,
however many rows) and searches the smallest capacity with which a greedy walk
needs no more than the given shards. An atom that alone sets this capacity gets
its own shard, and the runs beside it are searched again with the shards that
remain; other runs are cut near equal shares within the capacity.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from crystalflow.llm.helpers import running_totals
from crystalflow.operators.scratch import materialise

SLICE_BITS = 16


def greedy_cuts(ends: np.ndarray, capacity: int) -> list[int]:
    """Where each shard ends (exclusive atom index) when filled up to ``capacity``."""
    cuts, at, filled = [], 0, 0
    while at < len(ends):
        at = int(np.searchsorted(ends, filled + capacity, side="right"))
        filled = int(ends[at - 1])
        cuts.append(at)
    return cuts


def least_capacity(sizes: np.ndarray, shards: int) -> int:
    """The smallest capacity with which ``shards`` contiguous shards hold ``sizes``."""
    ends = np.cumsum(sizes)
    low, high = max(int(max(sizes)), -(-int(ends[-1]) // shards)), int(ends[-1])
    while low < high:
        middle = (low + high) // 2
        if len(greedy_cuts(ends, middle)) <= shards:
            high = middle
        else:
            low = middle + 1
    return low


def even_cuts(sizes: np.ndarray, shards: int, capacity: int) -> list[int]:
    """Ends of ``shards`` shards within a feasible ``capacity``, none empty, each near its share of what is left."""
    ends, count = np.cumsum(sizes), len(sizes)
    starts = [count]  # starts[k]: the first atom from which k shards hold the rest
    for _ in range(shards - 1):
        after = int(ends[starts[-1] - 1]) if starts[-1] else 0
        starts.append(int(np.searchsorted(ends, after - capacity, side="left")) + 1 if after > capacity else 0)
    cuts, at, filled = [], 0, 0
    for left in range(shards - 1, 0, -1):
        share = filled + (int(ends[-1]) - filled) / (left + 1)
        near = int(np.searchsorted(ends, share, side="left"))
        if near > at and share - int(ends[near - 1]) < int(ends[near]) - share:
            near -= 1
        most = min(int(np.searchsorted(ends, filled + capacity, side="right")), count - left)
        at = min(max(near + 1, at + 1, starts[left]), most)
        filled = int(ends[at - 1])
        cuts.append(at)
    return [*cuts, count]


def minimax_cuts(sizes: np.ndarray, shards: int) -> tuple[int, list[int]]:
    """The smallest capacity of contiguous shards over ``sizes``, and the shards' ends; none is empty while atoms suffice.

    >>> minimax_cuts(np.array([7, 2, 5, 10, 8]), 2)
    (18, [3, 5])
    """
    sizes = np.asarray(sizes, np.int64)
    if len(sizes) == 0:
        return 0, []
    shards = min(shards, len(sizes))
    capacity, widest = least_capacity(sizes, shards), int(np.argmax(sizes))
    if shards == 1 or int(sizes[widest]) < capacity or capacity * shards == int(sizes.sum()):
        return capacity, even_cuts(sizes, shards, capacity)
    before, after = sizes[:widest], sizes[widest + 1 :]

    def largest(k: int) -> list[int]:
        sides = ((before, k), (after, shards - 1 - k))
        return sorted((least_capacity(part, n) for part, n in sides if n), reverse=True)

    fewest = max(int(len(before) > 0), shards - 1 - len(after))
    most = min(len(before), shards - 1 - int(len(after) > 0))
    best = min(range(fewest, most + 1), key=largest)
    _, left = minimax_cuts(before, best)
    _, right = minimax_cuts(after, shards - 1 - best)
    return capacity, [*left, widest + 1, *[widest + 1 + end for end in right]]


def shard(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text", slice_bits: int = SLICE_BITS) -> DataFrame:
    """Per row: the id column, size, text_crc32, shard (0 to shards - 1) and slot.

    ``size`` is the text's UTF-8 bytes plus 1. Null counts as the empty text and
    shares its group. Slots count from 0 without gaps in each shard, by id;
    rows that repeat get slots of their own. A group larger than a fair share
    fills a shard with the rest of its slice, as it may not be split, and the
    other shards share what is left about equally. With fewer atoms than shards
    the last shards stay empty; no rows give no rows. Other columns are not
    read.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = materialise(
        docs.select(
            F.col(id_col),
            (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.shiftrightunsigned(F.xxhash64(text), 64 - slice_bits).cast("int").alias("_slice"),
        )
    )
    atoms = sorted((r["_slice"], r["size"]) for r in rows.groupBy("_slice").agg(F.sum("size").alias("size")).collect())
    _, cuts = minimax_cuts(np.array([s for _, s in atoms], np.int64), shards)
    number = F.lit(0)
    for cut in cuts[:-1]:
        number = number + (F.col("_slice") >= F.lit(atoms[cut][0])).cast("int")
    placed = rows.withColumn("shard", number).drop("_slice")
    ordered = running_totals(placed, [F.col("shard"), F.col(id_col)], {"slot": F.lit(1).cast("long")})
    held = dict(placed.groupBy("shard").count().collect())  # one row per shard
    first = F.lit(0).cast("long")
    for k in range(1, shards):
        first = F.when(F.col("shard") == k, F.lit(sum(held.get(i, 0) for i in range(k))).cast("long")).otherwise(first)
    return ordered.withColumn("slot", F.col("slot") - first)
