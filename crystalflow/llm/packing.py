"""Packing by power-of-two decomposition.

A document of n ids becomes n div M pieces of M ids and one piece for each bit
set in n mod M, longest first. Pieces of one length form a bucket, and each
piece is a sequence of its own: none crosses documents and none is padded.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, StringType

from crystalflow.llm.helpers import chunks, id_and_text, running_totals
from crystalflow.llm.tokens import BYTE_LEVEL, Splitter, worker_encoder

SEQUENCE = 1024
PIECE = "start long, length long, doc_tokens long, ids binary"


def piece_lengths(n: int, longest: int = SEQUENCE) -> list[int]:
    """Binary lengths that add up to ``n``, longest first.

    >>> piece_lengths(11, 4)
    [4, 4, 2, 1]
    """
    lengths = [longest] * (n // longest)
    rest = n % longest
    return lengths + [1 << bit for bit in range(rest.bit_length() - 1, -1, -1) if rest >> bit & 1]


def split_pieces(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
    longest: int = SEQUENCE, end_id: int = 0, splitter: Splitter = BYTE_LEVEL,
) -> DataFrame:
    """One row per piece: the id column, start, length, doc_tokens and the ids.

    ``ids`` holds little-endian unsigned 32-bit values. A null or empty text is
    a document of the end id alone. Rows that repeat are documents of their
    own; other columns are not read.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest piece must be a power of two")
    end = np.array([end_id], "<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer, splitter)
        for batch in chunks(batches):
            source, start, length, total, ids = [], [], [], [], []
            for row, encoded in enumerate(encoder.encode(batch.column("text").to_pylist())):
                data = encoded + end  # bytes: Arrow does not give memory views back
                at, n = 0, len(data) // 4
                for size in piece_lengths(n, longest):
                    source.append(row)
                    start.append(at)
                    length.append(size)
                    total.append(n)
                    ids.append(data[4 * at : 4 * (at + size)])
                    at += size
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(source, pa.int64())), *map(lambda v: pa.array(v, pa.int64()), (start, length, total)), pa.array(ids, pa.binary())],
                names=[id_col, "start", "length", "doc_tokens", "ids"],
            )

    rows = id_and_text(docs, id_col, text_col)
    return rows.mapInArrow(pieces, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, {PIECE}")


def pack(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
    longest: int = SEQUENCE, end_id: int = 0, keep: Mapping[str, Column] | None = None, splitter: Splitter = BYTE_LEVEL,
) -> DataFrame:
    """The pieces with their sequences: sequence_id, offset and bucket (log2 of the length).

    Sequences are numbered from 0 without gaps, longest bucket first and by
    document within a bucket, whatever the partitioning. ``keep`` names what to
    keep of each piece's ``ids``: the ids themselves unless given. Binary values,
    strings and arrays do not travel with the numbering. No rows give no rows.
    """
    pieces = split_pieces(docs, tokenizer, id_col, text_col, longest, end_id, splitter)
    keep = {"ids": F.col("ids")} if keep is None else keep
    pieces = pieces.select(id_col, "start", "length", *[c.alias(n) for n, c in keep.items()], "doc_tokens")
    order = [F.col("length").desc(), F.col(id_col), F.col("start")]
    wide = [f.name for f in pieces.schema.fields if f.name in keep and isinstance(f.dataType, (BinaryType, StringType, ArrayType))]
    numbered = running_totals(pieces, order, {"sequence_id": F.lit(1).cast("long")}, aside=wide)
    return numbered.withColumns(
        {"offset": F.lit(0).cast("long"), "bucket": F.log2(F.col("length")).cast("int")}
    )
