"""What several operators share: slicing batches, hashing words, running totals."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from crystalflow.operators.scratch import materialise

CHUNK_BYTES = 1 << 20
ROWS_PER_BLOCK = 50_000
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def chunks(batches: Iterable[pa.RecordBatch], text: str = "text", size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a piece holds about ``size`` bytes of text, or one longer document.

    Bounds a task's memory by the chunk, or by the longest text.
    """
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths.astype(np.int64) + 64)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + size, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns as ``id`` and ``text``; keeps Spark's batches for Python small unless the session says otherwise."""
    conf = docs.sparkSession.conf
    if conf.get(BATCH_ROWS) == "10000":  # Spark's default
        conf.set(BATCH_ROWS, "500")
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))


def word_hashes(words: Sequence[bytes]) -> np.ndarray:
    """A stable 64-bit hash of each word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """64-bit values with their bits spread, for use as hash slots."""
    values = (values ^ (values >> np.uint64(32))) * _MIX[0]
    values = (values ^ (values >> np.uint64(29))) * _MIX[1]
    return values ^ (values >> np.uint64(32))


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every run of ``width`` consecutive word hashes."""
    if len(words) < width:
        return words[:0]
    count = len(words) - width + 1
    out = words[:count].copy()
    for step in range(1, width):
        out = out * _MIX[1] + words[step : step + count]
    return mixed(out)


def running_totals(
    df: DataFrame,
    order: Sequence[Column],
    totals: Mapping[str, Column],
    rows_per_block: int = ROWS_PER_BLOCK,
    aside: Sequence[str] = (),
) -> DataFrame:
    """``df`` with, for each of ``totals``, its sum over all rows that come before in ``order``.

    Rows are cut by range into blocks of about ``rows_per_block``; windows run
    inside blocks, and a window over one row per block carries the bases. For
    narrow rows: they are written twice. Wide columns named in ``aside`` are
    written once, and wait there for the totals of their row. Rows that tie in
    ``order`` come in any order, and share a block however many they are.
    """
    if aside:
        # numbers that are written with the rows, so both readers see the same
        kept = materialise(df.withColumn("_row", F.monotonically_increasing_id()))
        counted = running_totals(kept.drop(*aside), order, totals, rows_per_block)
        return kept.select("_row", *aside).join(counted, "_row").select(*df.columns, *totals)
    kept = materialise(df)
    blocks = max(1, math.ceil(kept.count() / rows_per_block))
    ranged = materialise(kept.repartitionByRange(blocks, *order).withColumn("_block", F.spark_partition_id()))
    names = list(totals)
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    bases = ranged.groupBy("_block").agg(*[F.sum(totals[n]).alias(f"_base_{n}") for n in names])
    bases = bases.select("_block", *[F.coalesce(F.sum(f"_base_{n}").over(before), F.lit(0)).alias(f"_base_{n}") for n in names])
    inside = Window.partitionBy("_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumns({n: F.coalesce(F.sum(totals[n]).over(inside), F.lit(0)) for n in names})
    joined = local.join(bases, "_block")
    return joined.withColumns({n: F.col(n) + F.col(f"_base_{n}") for n in names}).select(*df.columns, *names)
