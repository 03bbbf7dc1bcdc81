"""Main text of web pages: a linear-chain conditional random field over leaf blocks.

A block is either main text or not. Its score is a sparse sum over features of
the elements around it and of its text; each border between neighbours adds a
weight that depends on both labels and on the kind of border. Weights maximise
the likelihood of labelled pages (forward-backward, per-coordinate adaptive
gradient steps, several shards side by side, averaged); Viterbi picks the
labels of a page.
"""

from __future__ import annotations

import difflib
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from crystalflow.llm.helpers import chunks
from crystalflow.llm.html_blocks import SLOTS, Block, blocks, said, slot, step

SHARDS = 4
PASSES = 8
RATE = 0.5
DECAY = 1e-5
STEPS = 3  # kinds of border
EDGES = SLOTS  # then, per kind: 4 weights, by label before and label


@dataclass(frozen=True)
class Field:
    """Weights of the block features' slots, then of the borders."""

    weights: np.ndarray

    def edge(self, kind: int) -> list[float]:
        return self.weights[EDGES + 4 * kind : EDGES + 4 * kind + 4].tolist()


def size() -> int:
    return EDGES + 4 * STEPS


def features(block: Block) -> np.ndarray:
    """Distinct slots of a block."""
    return np.unique(np.fromiter(map(slot, (*said(block), *block.around)), np.int64))


def labels(found: Sequence[Block], text: str) -> list[int]:
    """1 for the blocks that, in page order, make up the main text (blocks between blank lines)."""
    gold = [" ".join(part.split()) for part in text.split("\n\n")]
    out = [0] * len(found)
    for match in difflib.SequenceMatcher(None, [b.text for b in found], gold, autojunk=False).get_matching_blocks():
        out[match.a : match.a + match.size] = [1] * match.size
    return out


def _log_sum(a: float, b: float) -> float:
    high, low = (a, b) if a > b else (b, a)
    return high + math.log1p(math.exp(low - high))


def marginals(scores: Sequence[float], edges: Sequence[Sequence[float]]) -> tuple[list[float], list[list[float]], float]:
    """Chance of label 1 per block, of each label pair per border, and the log of the sum over all labellings.

    ``scores``: of label 1 against 0; ``edges``: of (0,0), (0,1), (1,0), (1,1) at each border.
    """
    n = len(scores)
    ahead = [(0.0, scores[0])]
    for k in range(1, n):
        a, b = ahead[-1]
        e = edges[k - 1]
        ahead.append((_log_sum(a + e[0], b + e[2]), _log_sum(a + e[1], b + e[3]) + scores[k]))
    back = [(0.0, 0.0)]
    for k in range(n - 1, 0, -1):
        a, b = back[-1]
        e = edges[k - 1]
        one = b + scores[k]
        back.append((_log_sum(e[0] + a, e[1] + one), _log_sum(e[2] + a, e[3] + one)))
    back.reverse()
    total = _log_sum(*ahead[-1])
    ones = [math.exp(f[1] + g[1] - total) for f, g in zip(ahead, back, strict=True)]
    pairs = []
    for k in range(1, n):
        f, g, e = ahead[k - 1], back[k], edges[k - 1]
        one = g[1] + scores[k]
        pairs.append([math.exp(x - total) for x in (f[0] + e[0] + g[0], f[0] + e[1] + one, f[1] + e[2] + g[0], f[1] + e[3] + one)])
    return ones, pairs, total


def best_labels(scores: Sequence[float], edges: Sequence[Sequence[float]]) -> list[int]:
    """The likeliest labelling (Viterbi); ties go to label 0."""
    if not scores:
        return []
    zero, one, came = 0.0, scores[0], []
    for score, e in zip(scores[1:], edges, strict=True):
        from_zero = one + e[2] > zero + e[0], one + e[3] > zero + e[1]
        came.append(from_zero)
        zero, one = max(zero + e[0], one + e[2]), max(zero + e[1], one + e[3]) + score
    out = [int(one > zero)]
    for back in reversed(came):
        out.append(int(back[out[-1]]))
    return out[::-1]


def train(pages: Sequence[tuple[Sequence[Block], Sequence[int]]], passes: int = PASSES) -> np.ndarray:
    """Weights from labelled pages, taken in order, ``passes`` times."""
    weights, power = np.zeros(size()), np.zeros(size())
    known = [([features(b) for b in found], [step(a, b) for a, b in zip(found, found[1:])], list(given)) for found, given in pages if found]
    for _ in range(passes):
        for slots, kinds, given in known:
            scores = [float(weights[s].sum()) for s in slots]
            field = Field(weights)
            edges = [field.edge(k) for k in kinds]
            ones, pairs, _ = marginals(scores, edges)
            at = np.concatenate([*slots, *[np.arange(EDGES + 4 * k, EDGES + 4 * k + 4) for k in kinds]])
            apart = [np.full(len(s), y - p) for s, y, p in zip(slots, given, ones, strict=True)]
            for y, z, pair in zip(given, given[1:], pairs):
                edge = -np.array(pair)
                edge[2 * y + z] += 1
                apart.append(edge)
            used, places = np.unique(at, return_inverse=True)
            gradient = np.bincount(places, np.concatenate(apart)) - DECAY * weights[used]
            power[used] += gradient * gradient
            weights[used] += RATE * gradient / (1e-3 + np.sqrt(power[used]))
    return weights


def fit(labelled: DataFrame, html_col: str = "html", text_col: str = "text", shards: int = SHARDS, passes: int = PASSES) -> Field:
    """Learn from pages with their main text, whose blocks stand between blank lines.

    All pages are used, so bound them before (``page_layouts.labelled_pages``
    does). They are dealt to ``shards`` tasks by hash and taken in hash order;
    the shards' weights are averaged. Null texts are empty; without pages all
    weights are 0, and then nothing is main text.
    """

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["turn", "html"])
        pages = []
        for page, text in zip(part["html"], part["text"], strict=True):
            found = blocks(page)
            pages.append((found, labels(found, text or "")))
        weights = train(pages, passes)
        used = np.flatnonzero(weights)
        return pd.DataFrame({"at": used, "weight": weights[used]})

    rows = labelled.select(F.col(html_col).alias("html"), F.col(text_col).alias("text")).where("html IS NOT NULL")
    dealt = rows.withColumns({"shard": F.pmod(F.xxhash64("html"), F.lit(shards)), "turn": F.xxhash64("html", F.lit(1))})
    learned = dealt.groupBy("shard").applyInPandas(run, "at long, weight double")
    total, parts = np.zeros(size()), 0
    for at, weight, seen in learned.groupBy("at").agg(F.sum("weight"), F.count(F.lit(1))).collect():  # at most ``size()`` rows
        total[at] = weight
        parts = max(parts, seen)
    return Field(total / max(1, parts))


class Labeller:
    """Labels the blocks of one page after another; sums of open elements' weights are remembered."""

    def __init__(self, field: Field):
        self.weights = field.weights
        self.edges = [field.edge(k) for k in range(STEPS)]
        self.around: dict[frozenset[str], tuple[float, set[int]]] = {}

    def score(self, block: Block) -> float:
        known = self.around.get(block.around)
        if known is None:
            if len(self.around) > 20_000:
                self.around.clear()
            slots = set(map(slot, block.around))
            known = self.around[block.around] = float(self.weights[list(slots)].sum()), slots
        total, slots = known
        own = {s for s in map(slot, said(block)) if s not in slots}
        return total + float(self.weights[list(own)].sum())

    def main_text(self, page: str | None) -> str:
        found = blocks(page)
        picked = best_labels([self.score(b) for b in found], [self.edges[step(a, b)] for a, b in zip(found, found[1:])])
        return "\n\n".join(b.text for b, y in zip(found, picked, strict=True) if y)


def extract(pages: DataFrame, field: Field, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Per row: the id column and ``text``, the main text of the whole page.

    Blocks are trimmed, white space inside them is one space, and a blank line
    is between them. A null or empty page, and one without main text, gives the
    empty text. Rows that repeat are extracted each; a long page takes memory
    by its own size; other columns are not read; no rows give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(field)
        for batch in chunks(batches):
            texts = [labeller.main_text(page) for page in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], names=[id_col, "text"])

    kind = pages.schema[id_col].dataType.simpleString()
    rows = pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("text"))
    return rows.mapInArrow(run, f"`{id_col}` {kind}, text string")
