"""Tables bucketed and sorted by a join key, whose joins and groupings on it need no shuffle.

Folders named after a hash (``key_bucket`` of raw tables) prune scans but mean
nothing to joins. These are catalog tables: Spark knows that equal keys lie in
equal buckets. Two tables join without a shuffle if they have the same number
of buckets; otherwise the smaller one alone is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Write ``df`` as table ``name`` (replacing it) and give it back.

    Rows are dealt by the keys first, so that every bucket is one sorted file.
    A key with most of the rows makes one large bucket; leave such tables to
    skew-aware joins.
    """
    dealt = df.repartition(buckets, *keys)
    writer = dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)
