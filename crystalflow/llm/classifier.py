"""Quality classifier: logistic regression on hashed word n-grams, trained by FTRL-proximal updates.

Words and pairs of neighbouring words are hashed into slots; a document is the
sparse vector of their counts, scaled to length 1. Several shards of a bounded sample are trained side by side, one pass
of per-coordinate updates after another, and their weights are averaged. A
score is the logistic of a sparse dot product.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from crystalflow.llm.helpers import chunks, id_and_text, mixed, window_hashes, word_hashes
from crystalflow.llm.rules import RUNS
from crystalflow.llm.sampling import lowest_hashes, texts_of

SLOTS = 1 << 18
PER_LABEL = 8_000
SHARDS = 4
PASSES = 4
INTERCEPT = 0.2


@dataclass
class Ftrl:
    """Follow the regularised leader with one learning rate per coordinate."""

    slots: int
    alpha: float = 10.0
    beta: float = 1.0
    l1: float = 0.01
    l2: float = 0.01

    def __post_init__(self):
        self.z, self.n = np.zeros(self.slots), np.zeros(self.slots)

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        rate = (self.beta + np.sqrt(n)) / self.alpha + self.l2
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / rate)

    def update(self, at: np.ndarray, values: np.ndarray, label: float, weight: float = 1.0) -> None:
        """One row: distinct slots, their values, the label (0 or 1) and the row's weight."""
        w = self.weights(at)
        g = weight * (logistic(float(w @ values)) - label) * values
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def logistic(x: float | np.ndarray):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def features(text: str, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct slots of a text and their counts, scaled to length 1.

    Slot 0 is the intercept; slot 1 is shared by all pairs of a word with itself.
    """
    words = word_hashes(RUNS(text))
    pairs = window_hashes(words, 2)
    same = np.flatnonzero(words[1:] == words[:-1])
    grams = (np.concatenate([mixed(words), pairs]) % np.uint64(slots - 2)).astype(np.int64) + 2
    used, counts = np.unique(np.concatenate([grams, np.ones(len(same), np.int64)]), return_counts=True)
    scale = max(1.0, float(np.sqrt((counts * counts).sum())))
    return np.concatenate([[0], used]), np.concatenate([[INTERCEPT], counts / scale])


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    per_label: int = PER_LABEL, slots: int = SLOTS, shards: int = SHARDS, passes: int = PASSES,
) -> np.ndarray:
    """The weight of every slot, the intercept first.

    Trains on at most ``per_label`` rows of each label, split by hash into
    ``shards`` tasks; their order follows the hash of the id too. Rows of
    either side without a partner, null labels and null ids are not used; a
    null text counts as empty. Without labels all weights are 0.
    """
    sample = lowest_hashes(labels, id_col, F.col(label_col).cast("double"), per_label)
    rows = texts_of(docs, sample, id_col, text_col).select(
        F.pmod(F.xxhash64("id"), F.lit(shards)).alias("shard"), F.xxhash64("id", F.lit(1)).alias("turn"), "label", "text"
    )

    def train(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["turn", "label"])
        vectors = [features(t or "", slots) for t in part["text"]]
        # both labels weigh the same
        weights_of = {label: len(part) / (2 * n) for label, n in part["label"].value_counts().items()}
        model = Ftrl(slots)
        for _ in range(passes):
            for (at, values), label in zip(vectors, part["label"], strict=True):
                model.update(at, values, label, weights_of[label])
        weights = model.weights()
        used = np.flatnonzero(weights)
        return pd.DataFrame({"slot": used, "weight": weights[used]})

    learned = rows.groupBy("shard").applyInPandas(train, "slot long, weight double")
    trained = max(1, min(shards, rows.select("shard").distinct().count()))
    out = np.zeros(slots)
    for slot, weight in learned.groupBy("slot").agg(F.sum("weight").alias("w")).orderBy("slot").collect():  # at most ``slots`` rows
        out[slot] = weight / trained
    return out


def score(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """Per row: the id column, score (0 to 1) and predicted (1 from ``threshold`` on).

    A null or empty text gets the intercept's score. Rows that repeat are scored
    each; other columns are not read; no rows give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            sums = []
            for text in batch.column("text").to_pylist():
                at, values = features(text or "", len(weights))
                sums.append(float(weights[at] @ values))
            scores = logistic(np.array(sums, np.float64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
                names=[id_col, "score", "predicted"],
            )

    rows = id_and_text(docs, id_col, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, score double, predicted int")
