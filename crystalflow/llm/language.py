"""Language identification for texts that may mix languages.

Each language is a smoothed multinomial over hashed letter trigrams. A document
is a mixture of languages: its words are the units, a word's likelihood in a
language is that of its trigrams, and expectation-maximisation estimates the
proportions. Sets of languages are compared by penalised likelihood (half the
log of the number of words for every language), and the best set stays.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from crystalflow.llm.helpers import chunks, id_and_text
from crystalflow.llm.sampling import lowest_hashes, texts_of

SLOTS = 1 << 16
PER_LANGUAGE = 3_000
SMOOTHING = 0.5
ROUNDS = 12
UNKNOWN = "und"
CHUNK = 1 << 18

_alpha: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For every code point, whether it is a letter."""
    if not _alpha:
        _alpha.append(np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1))
    return _alpha[0]


def trigrams(texts: Sequence[str | None], slots: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots of all letters' trigrams, the words' starts among them, and each word's text number.

    A trigram is a letter with its neighbours, anything but a letter counting as
    a space; words are runs of letters, in lower case.
    """
    lowered = [t.lower() if t else "" for t in texts]
    codes = np.frombuffer(("\n" + "\n".join(lowered) + "\n").encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letters()[codes]
    codes = np.where(letter, codes, 32).astype(np.uint64)
    at = np.flatnonzero(letter)
    if len(at) == 0:
        return at, at, at
    hashed = codes[at - 1] * np.uint64(0x9E3779B97F4A7C15) + codes[at] * np.uint64(0xC2B2AE3D27D4EB4F) + codes[at + 1] * np.uint64(0x165667B19E3779F9)
    found = ((hashed ^ (hashed >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(slots)
    starts = np.flatnonzero(~letter[at - 1])
    ends = np.cumsum([len(t) + 1 for t in lowered])
    owner = np.searchsorted(ends, at[starts] - 1, side="right")
    return found.astype(np.int64), starts, owner


@dataclass
class Model:
    """Languages and, for every slot, their log probabilities (slots x languages)."""

    languages: list[str]
    log_probability: np.ndarray


def fit(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    per_language: int = PER_LANGUAGE, slots: int = SLOTS,
) -> Model:
    """Learn from a sample of at most ``per_language`` rows of every non-null language.

    Rows with null ids are not used. Without any row nothing is learned, and
    every text is ``und``.
    """
    sample = lowest_hashes(docs, id_col, F.col(lang_col), per_language)
    texts = texts_of(docs, sample, id_col, text_col)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in chunks(batches, size=CHUNK):
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                found, _, _ = trigrams([text], slots)
                total[label] = total.get(label, 0) + np.bincount(found, minlength=slots)
        for label, counts in total.items():
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([label] * len(used), pa.string()), pa.array(used), pa.array(counts[used])], names=["lang", "slot", "n"]
            )

    counted = texts.select("label", "text").mapInArrow(count, "lang string, slot long, n long")
    summed = counted.groupBy("lang", "slot").agg(F.sum("n").alias("n")).collect()  # at most slots x languages rows
    languages = sorted({r["lang"] for r in summed})
    counts = np.zeros((slots, len(languages)))
    number = {lang: k for k, lang in enumerate(languages)}
    for lang, slot, n in summed:
        counts[slot, number[lang]] = n
    counts += SMOOTHING
    return Model(languages, np.log(counts / counts.sum(axis=0)).astype(np.float32) if languages else counts)


def _mixture(likelihood: np.ndarray, first: np.ndarray, owner: np.ndarray, start: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log likelihood of each text, by EM from ``start``; words of a text lie together."""
    share = start
    words = np.diff(np.append(first, len(owner)))[:, None]
    for _ in range(rounds):
        joint = share[owner] * likelihood
        joint /= joint.sum(axis=1, keepdims=True)
        share = np.add.reduceat(joint, first, axis=0) / words
    total = (share[owner] * likelihood).sum(axis=1)
    return share, np.add.reduceat(np.log(np.maximum(total, 1e-300)), first)


def infer(texts: Sequence[str | None], model: Model, rounds: int = ROUNDS) -> np.ndarray:
    """Proportions of the languages (texts x languages); all 0 for a text without letters."""
    return infer_with_evidence(texts, model, rounds)[0]


def infer_with_evidence(texts: Sequence[str | None], model: Model, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Proportions as ``infer`` gives them, and how much better the chosen set explains a text than chance.

    That is the mean over its trigrams of the log of their likelihood in the
    chosen mixture over that of a background in which all slots are equally
    likely; 0 for a text without letters. Letters in no learned language, or
    typed at random, meet slots that no language fills and fall below 0; a text
    in any mixture of the learned languages lies above.

    Sets of every size are tried up to the number of languages that a first EM
    gives half a word or more; the penalised likelihood alone chooses.
    """
    shares, evidence = np.zeros((len(texts), len(model.languages))), np.zeros(len(texts))
    found, starts, owner = trigrams(texts, len(model.log_probability))
    if len(found) == 0 or not model.languages:
        return shares, evidence
    logs = np.add.reduceat(model.log_probability[found], starts, axis=0).astype(np.float64)
    likelihood = np.exp(np.maximum(logs - logs.max(axis=1, keepdims=True), -60.0))
    first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    local = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(owner))))
    n_words = np.bincount(local)
    languages = len(model.languages)
    share, _ = _mixture(likelihood, first, local, np.full((len(first), languages), 1.0 / languages), rounds)
    rank = np.argsort(np.argsort(-share, axis=1, kind="stable"), axis=1, kind="stable")
    best, best_share = np.full(len(first), -np.inf), share
    most = np.maximum((share * n_words[:, None] >= 0.5).sum(axis=1), 1)
    for size in range(1, int(most.max()) + 1):
        start = np.where(rank < size, np.maximum(share, 1e-6), 0.0)
        part, fit_ = _mixture(likelihood, first, local, start / start.sum(axis=1, keepdims=True), 1 if size == 1 else rounds // 2)
        value = fit_ - 0.5 * size * np.log(n_words)
        better = (value > best) & (size <= most)
        best = np.where(better, value, best)
        best_share = np.where(better[:, None], part, best_share)
    shares[owner[first]] = best_share
    explained = np.log(np.maximum((best_share[local] * likelihood).sum(axis=1), 1e-300)) + logs.max(axis=1)
    n_trigrams = np.add.reduceat(np.diff(np.append(starts, len(found))), first)
    evidence[owner[first]] = np.add.reduceat(explained, first) / n_trigrams + np.log(len(model.log_probability))
    return shares, evidence


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id column, lang_pred, score, langs (the chosen set with its proportions) and evidence.

    ``lang_pred`` is the language with the largest proportion (the first by name
    in a tie) and ``score`` that proportion; ``und`` and 0 for a null text, one
    without letters, or if nothing was learned. ``evidence`` is the mean log
    ratio per trigram to a uniform background: not above 0 for a text that the
    learned languages do not explain. A long text is read whole; memory holds
    one at a time. Rows that repeat are judged
    each; other columns are not read; no rows give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.languages, UNKNOWN])
        for batch in chunks(batches, size=CHUNK):
            shares, evidence = infer_with_evidence(batch.column("text").to_pylist(), model)
            padded = np.column_stack([shares, np.zeros(len(shares))])
            known = padded.sum(axis=1) > 0
            top = np.where(known, padded.argmax(axis=1), len(names) - 1)
            sets = [{model.languages[k]: float(row[k]) for k in np.flatnonzero(row)} for row in shares]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(names[top].tolist(), pa.string()),
                    pa.array(np.clip(padded.max(axis=1), 0.0, 1.0)),
                    pa.array([list(s.items()) for s in sets], pa.map_(pa.string(), pa.float64())),
                    pa.array(evidence),
                ],
                names=[id_col, "lang_pred", "score", "langs", "evidence"],
            )

    rows = id_and_text(docs, id_col, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double, langs map<string,double>, evidence double")
