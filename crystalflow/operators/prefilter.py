"""Dropping rows that find no partner before they are shuffled to a join.

A bitmap of fixed size marks the hashes of the keys asked for. It is built by
an aggregate, sent to all tasks (2 MB at most by default, whatever the input)
and checked where the rows are read. What passes by chance goes in the join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

BITS = 24
_PIECE, _BIT, _MARKS = "_piece", "_bit", "_marks"


def _slot(keys: Sequence[str], bits: int) -> Column:
    # as text, so that integers of different widths hash alike
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(1 << bits)).cast("long")


def likely(rows: DataFrame, keys: Sequence[str], wanted: DataFrame, bits: int = BITS) -> DataFrame:
    """The rows whose keys may be among those of ``wanted``: all that are, and few others.

    With k different keys asked for, about k / 2^bits of the other rows pass;
    with very many keys all do, and nothing is gained or lost. Rows with a null
    key go, as an inner or semi join on the keys would drop them. ``wanted`` is
    evaluated here and again by the join: materialise it if it is dear.
    """
    slot = _slot(keys, bits)
    piece, bit = F.bitmap_bucket_number(slot).alias(_PIECE), F.bitmap_bit_position(slot)
    known = wanted.dropna(subset=list(keys))
    # rows of 4 kB, one for every 2^15 slots
    marks = known.groupBy(piece).agg(F.bitmap_construct_agg(bit).alias(_MARKS))
    placed = rows.dropna(subset=list(keys)).withColumns({_PIECE: F.bitmap_bucket_number(slot), _BIT: bit})
    byte = F.conv(F.hex(F.substring(_MARKS, (F.col(_BIT) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = F.getbit(byte, (F.col(_BIT) % 8).cast("int")) == 1
    return placed.join(F.broadcast(marks), _PIECE).where(marked).select(*rows.columns)
