"""Line deduplication over overlapping windows of three lines, on DataFrame functions only.

A window is three consecutive lines of a document. Of every window that occurs
more than once in the corpus, the first occurrence (lowest document id, then
lowest line) stays and the lines of all later ones go; what overlapping windows
cover is merged line by line.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from crystalflow.operators.scratch import materialise

WINDOW = 3


def _windows(text: Column, width: int) -> Column:
    """(position, hash, chars) of every window of ``width`` lines."""
    lines = F.split(text, "\n", -1)
    known = F.transform(lines, lambda line: F.struct(F.xxhash64(line).alias("h"), F.length(line).alias("n")))
    parts = [F.slice(known, k + 1, F.size(known) - (width - 1)) for k in range(width)]
    return F.transform(
        F.arrays_zip(*[p.alias(f"w{k}") for k, p in enumerate(parts)]),
        lambda w, i: F.struct(
            i.alias("position"),
            F.xxhash64(*[w[f"w{k}"]["h"] for k in range(width)]).alias("hash"),
            sum((w[f"w{k}"]["n"] for k in range(1, width)), w["w0"]["n"]).alias("chars"),
        ),
    )


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WINDOW) -> DataFrame:
    """Per document with lines to remove: the id column, and ``removed``, their positions from 0, sorted.

    Two windows are equal when a 64-bit hash of their lines and their numbers of
    characters are. Documents with fewer lines than a window, and null ids or
    texts, have none. Rows that repeat an id count as the same document, so
    they keep and lose the same lines.
    """
    lines = F.length(F.col(text_col)) - F.length(F.replace(F.col(text_col), F.lit("\n"))) + 1
    long_enough = docs.where(F.col(id_col).isNotNull() & (lines >= width))
    seen = materialise(
        long_enough.select(F.col(id_col).alias("id"), F.inline(_windows(F.col(text_col), width)))
    )
    # one partial row per window and task, so a window in a third of the documents costs no more than others
    first = seen.groupBy("hash", "chars").agg(F.min(F.struct("id", "position")).alias("first"), F.count(F.lit(1)).alias("n"))
    first = materialise(first.where("n > 1").drop("n"))
    later = seen.join(first, ["hash", "chars"]).where(F.struct("id", "position") > F.col("first"))
    covered = later.select("id", F.explode(F.sequence(F.col("position"), F.col("position") + (width - 1))).alias("line"))
    return covered.groupBy("id").agg(F.sort_array(F.collect_set("line")).alias("removed")).withColumnRenamed("id", id_col)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WINDOW) -> DataFrame:
    """All rows and columns of ``docs`` with repeated lines cut from the text, and ``n_removed`` (which replaces a column of that name).

    No row goes, and a text may become empty. A row without removed lines keeps
    its text, null included.
    """
    key, lost = (_fresh(name, docs.columns) for name in ("dedup_id", "dedup_removed"))
    removed = repeated_lines(docs, id_col, text_col, width).select(F.col(id_col).alias(key), F.col("removed").alias(lost))
    joined = docs.join(removed, F.col(id_col) == F.col(key), "left")
    lines = F.split(F.col(text_col), "\n", -1)
    left = F.array_join(F.filter(lines, lambda line, i: ~F.array_contains(F.col(lost), i)), "\n")
    return joined.withColumns(
        {
            text_col: F.when(F.col(lost).isNull(), F.col(text_col)).otherwise(left),
            "n_removed": F.coalesce(F.size(lost), F.lit(0)).cast("long"),
        }
    ).drop(key, lost)


def _fresh(name: str, taken: Sequence[str]) -> str:
    """A column name that is not taken."""
    while name.lower() in {t.lower() for t in taken}:
        name = f"_{name}"
    return name
