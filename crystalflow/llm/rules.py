"""Quality rules: base counts, and a log-likelihood ratio between a trusted target and the raw corpus.

Runs of letters and runs of marks, and pairs of neighbouring runs, are hashed
into slots. Two smoothed
multinomials over the slots, one of trusted documents and one of all
documents, give each slot a log ratio. A document's score is the mean ratio of
its n-grams, and a document is kept if the score reaches a fixed threshold.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from crystalflow.llm.helpers import chunks, id_and_text, mixed, window_hashes, word_hashes

SLOTS = 1 << 14  # at least
SLOTS_PER_ROOT_BYTE = 3
SMOOTHING = 1.0
THRESHOLD = -0.3
FEWEST_WORDS = 10
MOST_REPEATED_PERCENT = 20
REPEAT_WINDOW = 5

SPACE = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"

RUNS = re.compile(r"\w+|[^\w\s]+").findall

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(hashes: np.ndarray, width: int = REPEAT_WINDOW) -> int:
    """How many words stand in a window of ``width`` words that occurs at least twice."""
    windows = window_hashes(hashes, width)
    if len(windows) < 2:
        return 0
    in_order = np.sort(windows)
    twice = in_order[1:][in_order[1:] == in_order[:-1]]
    if len(twice) == 0:
        return 0
    starts = np.flatnonzero(np.isin(windows, twice))
    edges = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + width, -1)
    return int(np.count_nonzero(np.cumsum(edges)))


def repeated_line_count(text: bytes) -> int:
    """Lines with a word that equal an earlier line of the text."""
    lines = [line for line in text.split(b"\n") if line.strip(SPACE)]
    return len(lines) - len(set(lines))


def base_counts(text: bytes, hashes: np.ndarray) -> tuple[int, int, int, int, int]:
    """The values of ``COUNTS`` for UTF-8 text whose words have these hashes."""
    seen = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    continued = int(seen[0x80:0xC0].sum())
    return (
        len(hashes),
        len(text) - continued - int(seen[list(SPACE)].sum()),
        int(seen[list(SYMBOLS)].sum()),
        repeated_line_count(text),
        repeated_words(hashes),
    )


def ngram_slots(text: str, slots: int = SLOTS) -> np.ndarray:
    """Slots of all runs of letters or marks and of all pairs of neighbouring runs."""
    hashes = word_hashes(RUNS(text))
    grams = np.concatenate([mixed(hashes), window_hashes(hashes, 2)])
    return (grams % np.uint64(slots)).astype(np.int64)


def slot_counts(texts: DataFrame, slots: int = SLOTS) -> np.ndarray:
    """How often each slot occurs over all rows of ``text``: one row per slot and task is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(slots, np.int64)
        for batch in chunks(batches):
            for text in batch.column("text").to_pylist():
                if text:
                    np.add.at(total, ngram_slots(text, slots), 1)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["slot", "n"])

    summed = texts.select("text").mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    found = summed.toArrow()  # at most ``slots`` rows
    out = np.zeros(slots, np.int64)
    out[found.column("slot").to_numpy()] = found.column("n").to_numpy()
    return out


def slots_for(text_bytes: int) -> int:
    """A power of two of slots that grows with the square root of the text, as distinct n-grams about do."""
    return max(SLOTS, 1 << (math.ceil(SLOTS_PER_ROOT_BYTE * math.sqrt(text_bytes)) - 1).bit_length())


def log_ratios(target: np.ndarray, raw: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    """Log of target over raw probability for each slot; 0 everywhere if either has no n-gram."""
    if not target.sum() or not raw.sum():
        return np.zeros(len(raw))
    shares = [(n + smoothing) / (n.sum() + smoothing * len(n)) for n in (target, raw)]
    return np.log(shares[0]) - np.log(shares[1])


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    slots: int | None = None,
) -> np.ndarray:
    """The log ratio of every slot.

    The target is every document with a label of quality 1 and toxic not 1, the
    raw side all documents. Without ``slots`` their number follows the bytes of
    text. Without any trusted document all ratios are 0.
    """
    good = labels.where((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0))
    texts = id_and_text(docs, id_col, text_col)
    if slots is None:
        slots = slots_for(texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    # the ids grow with the input: merged at every size, never sent to all tasks
    ids = good.select(F.col(id_col).alias("id")).distinct().hint("merge")
    trusted = texts.join(ids, "id", "left_semi")
    return log_ratios(slot_counts(trusted, slots), slot_counts(texts, slots))


def judge(
    docs: DataFrame, ratios: np.ndarray, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """Per row: the id column, the base counts, base_failed, ratio and kept.

    ``base_failed`` if there are fewer than 10 words or over 20 % of them stand
    in repeated windows; ``ratio`` is the mean log ratio of the n-grams (0 for
    none). A null text counts as empty and fails. Rows that repeat are judged
    each; other columns are not read; no rows give no rows.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            counts, means = [], []
            for text in batch.column("text").to_pylist():
                data = (text or "").encode()
                hashes = word_hashes(data.split())
                counts.append(base_counts(data, hashes))
                grams = ngram_slots(text or "", len(ratios))
                means.append(float(ratios[grams].mean()) if len(grams) else 0.0)
            columns = np.array(counts, np.int64).reshape(-1, len(COUNTS)).T
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *map(pa.array, columns), pa.array(means, pa.float64())],
                names=[id_col, *COUNTS, "ratio"],
            )

    rows = id_and_text(docs, id_col, text_col)
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, " + ", ".join(f"{c} long" for c in COUNTS) + ", ratio double"
    failed = (F.col("n_words") < FEWEST_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED_PERCENT
    )
    return rows.mapInArrow(score, schema).withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("ratio") >= threshold)
    )
