"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Rows are centred; X is the table of distinct centred vectors. Each step is one
distributed pass that alternates the two products: u = Xv - beta u', then
X'u, with the inner products of u with all earlier u measured on the same rows,
so that both sides are fully reorthogonalised. Row values of earlier u are not
stored: u = Xw for a known w of the vectors' own length, so a lost executor
costs its tasks only. The singular vectors of the small bidiagonal matrix turn
the v into components; its singular values are their deviations.

What the driver holds is bounded by the vectors' length: sums per dimension,
the v and w of at most as many steps as there are dimensions.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from crystalflow.operators.scratch import materialise

SCALE = 256.0
BLOCK_VALUES = 1 << 19  # values per packed block
EXACT = 1e-13  # residual of a converged component, of the largest singular value
NOTHING = 1e-10  # a singular value below this share of the data's norm is none
SAFE = 1 << 62


@dataclass
class Whitening:
    """Fitted components: ``directions`` (length x components), eigenvalues, and exact sums of the fit list."""

    count: int
    sums: list[int]
    directions: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float
    passes: int

    @property
    def mean(self) -> np.ndarray:
        return _mean(self.sums, self.count)


def usable(vector: Column) -> Column:
    """True where a vector is not null and all its entries are finite."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    return vector.isNotNull() & finite


def integers(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = SCALE) -> DataFrame:
    """(id column, x): usable vectors with each entry c as floor(scale * c), a long.

    Values beyond a long end at its limits. Null ids and repeated rows stay.
    Vectors of another length than most are left out (of lengths equally
    common, the longest counts).
    """
    kept = vectors.where(usable(F.col(vector_col)))
    x = F.transform(F.col(vector_col), lambda c: F.floor(F.lit(scale) * c.cast("double")))
    rows = kept.select(F.col(id_col), x.alias("x"))
    lengths = rows.groupBy(F.size("x").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("length")).first()
    return rows.where(F.size("x") == (most["length"] if most else 0))


def _matrix(batch: pa.RecordBatch, length: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


def _packed(distinct: DataFrame, length: int) -> DataFrame:
    """Rows as blocks (kind, data) of the narrowest integers that hold them."""
    step = max(1, BLOCK_VALUES // length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                block = _matrix(batch.slice(start, step), length)
                kind = next(k for k in ("<i2", "<i4", "<i8") if block.min() >= np.iinfo(k).min and block.max() <= np.iinfo(k).max)
                yield pa.RecordBatch.from_arrays([pa.array([kind]), pa.array([block.astype(kind).tobytes()], pa.binary())], names=["kind", "data"])

    return distinct.mapInArrow(run, "kind string, data binary")


def _blocks(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for kind, data in zip(batch.column("kind").to_pylist(), batch.column("data"), strict=True):
            yield np.frombuffer(data.as_buffer(), kind).reshape(-1, length)


def _totals(blocks: DataFrame, length: int, width: int, add: Callable[[np.ndarray, np.ndarray], None]) -> np.ndarray:
    """``width`` numbers that ``add`` accumulates from every block, summed over all tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for block in _blocks(batches, length):
            add(block, total)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(total)], names=["at", "value"])

    out = np.zeros(width)
    for at, value in blocks.mapInArrow(run, "at long, value double").groupBy("at").agg(F.sum("value")).collect():
        out[at] = value
    return out


def _exact_sums(blocks: DataFrame, length: int) -> tuple[int, list[int], int]:
    """Rows, sums per dimension and the sum of all squares, as integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, squares, sums = 0, 0, [0] * length
        for block in _blocks(batches, length):
            largest = max(abs(int(block.min())), abs(int(block.max())), 1)
            wide = block.astype(np.int64 if largest * largest * block.size < SAFE else object)
            count += len(block)
            sums = [a + int(b) for a, b in zip(sums, wide.sum(axis=0), strict=True)]
            squares += int((wide * wide).sum())
        values = [str(v) for v in (count, squares, *sums)]
        yield pa.RecordBatch.from_arrays([pa.array(range(length + 2), pa.int32()), pa.array(values)], names=["at", "value"])

    parts = blocks.mapInArrow(run, "at int, value string").groupBy("at").agg(F.sum(F.col("value").cast("decimal(38,0)")))
    found = {at: int(v) for at, v in parts.collect()}  # one row per dimension
    return found.get(0, 0), [found.get(k + 2, 0) for k in range(length)], found.get(1, 0)


def _mean(sums: list[int], count: int) -> np.ndarray:
    return np.array([s / count for s in sums]) if count else np.zeros(len(sums))


def _apart(vector: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """What is left of ``vector`` across ``basis``; twice, so that rounding goes too."""
    for _ in range(2):
        vector = vector - basis @ (basis.T @ vector)
    return vector


class Bidiagonal:
    """The passes over one table of centred rows."""

    def __init__(self, blocks: DataFrame, mean: np.ndarray, norm: float):
        self.blocks, self.mean, self.norm = blocks, mean, norm
        self.length, self.passes = len(mean), 0

    def products(self, v: np.ndarray, beta: float, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """For u = Xv - beta u', the last of U = Xw: X'u, U'u and u'u."""
        mean, length, earlier = self.mean, self.length, w.shape[1]

        def add(block: np.ndarray, total: np.ndarray) -> None:
            rows = block - mean
            u = rows @ v
            if earlier:
                us = rows @ w
                u = u - beta * us[:, -1]
                total[length : length + earlier] += us.T @ u
            total[:length] += rows.T @ u
            total[-1] += u @ u

        self.passes += 1
        out = _totals(self.blocks, length, length + earlier + 1, add)
        return out[:length], out[length:-1], float(out[-1])

    def sweep(self, start: np.ndarray, locked: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        """Singular values and components across ``locked`` until ``wanted`` have converged.

        The third value spans all that was reached where nothing is left to
        reach from it, and is none if the sweep ended early.
        """
        vs, ws, qs = start[:, None], np.zeros((self.length, 0)), np.zeros((self.length, 0))
        alphas, betas = [], []
        while True:
            beta = betas[-1] if betas else 0.0
            w = vs[:, -1] - (beta * ws[:, -1] if betas else 0.0)
            q, c, size = self.products(vs[:, -1], beta, ws)
            left = size - c @ c
            w, q = w - ws @ c, q - qs @ c
            if 0 < left < 0.5 * size:  # much was taken off: once more
                q, c, size = self.products(w, 0.0, ws)
                left = size - c @ c
                w, q = w - ws @ c, q - qs @ c
            alpha = math.sqrt(max(left, 0.0))
            if alpha <= NOTHING * self.norm:
                alphas.append(0.0)
                return *self._components(alphas, betas, vs, 0.0)[:2], vs
            ws, qs = np.column_stack([ws, w / alpha]), np.column_stack([qs, q / alpha])
            alphas.append(alpha)
            rest = _apart(qs[:, -1] - alpha * vs[:, -1], np.column_stack([locked, vs]))
            beta = float(np.linalg.norm(rest))
            steps, all_steps = len(alphas), self.length - locked.shape[1]
            if steps == all_steps or beta <= NOTHING * self.norm * 1e-2:
                return *self._components(alphas, betas, vs, 0.0)[:2], vs
            sigma, components, residual = self._components(alphas, betas, vs, beta)
            done = steps >= wanted and bool((residual[:wanted] <= EXACT * sigma[0]).all())
            if done and all_steps - steps > steps // 2:  # else the rest of the space costs less than a second look
                return sigma[:wanted], components[:, :wanted], None
            vs = np.column_stack([vs, _apart(rest / beta, np.column_stack([locked, vs]))])
            vs[:, -1] /= np.linalg.norm(vs[:, -1])
            betas.append(beta)

    @staticmethod
    def _components(alphas: list[float], betas: list[float], vs: np.ndarray, beta: float) -> tuple[np.ndarray, ...]:
        small = np.diag(alphas) + np.diag(betas, 1)
        left, sigma, right = np.linalg.svd(small)
        return sigma, vs @ right.T, beta * np.abs(left[-1])

    def largest(self, wanted: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
        """The ``wanted`` largest singular values and their components, equal ones counted.

        One start vector reaches one direction of each singular value. So sweeps
        across all directions found go on until one finds nothing larger than
        the least that is wanted.
        """
        random = np.random.default_rng(seed)
        sigmas, found, locked = np.zeros(0), np.zeros((self.length, 0)), np.zeros((self.length, 0))
        while locked.shape[1] < self.length:
            start = _apart(random.standard_normal(self.length), locked)
            more, components, reached = self.sweep(start / np.linalg.norm(start), locked, 1 if len(sigmas) >= wanted else wanted)
            least = np.sort(sigmas)[::-1][wanted - 1] if len(sigmas) >= wanted else 0.0
            news = more[0] > max(least * (1 + 1e-12), NOTHING * self.norm)
            sigmas, found = np.concatenate([sigmas, more]), np.column_stack([found, components])
            locked = np.column_stack([locked, components if reached is None else reached])
            if not news:
                break
        best = np.argsort(-sigmas, kind="stable")[:wanted]
        best = best[sigmas[best] > NOTHING * self.norm]
        return sigmas[best], found[:, best]


def fit(rows: DataFrame, components: int = 4) -> Whitening:
    """Whitening learned from the distinct ``x`` of ``rows`` (arrays of longs, one length).

    Components whose deviation is nothing beside the data's (fewer distinct
    vectors than components, constant dimensions) are left out; no rows give
    no components.
    """
    first = rows.select(F.size("x").alias("n")).first()
    length = first["n"] if first else 0
    if length == 0:
        return Whitening(0, [], np.zeros((0, 0)), np.zeros(0), 0.0, 0.0, 0)
    blocks = materialise(_packed(rows.select("x").distinct(), length))
    count, sums, squares = _exact_sums(blocks, length)
    spread = count * squares - sum(s * s for s in sums)  # n^2 times the trace, exact
    trace, mean = spread / count**2, _mean(sums, count)
    work = Bidiagonal(blocks, mean, math.sqrt(spread / count))
    sigmas, directions = work.largest(components) if spread else (np.zeros(0), np.zeros((length, 0)))
    eigenvalues = sigmas**2 / count
    error = _identity_error(blocks, mean, directions, eigenvalues, count) if len(sigmas) else 0.0
    return Whitening(count, sums, directions, eigenvalues, trace, error, work.passes)


def _identity_error(blocks: DataFrame, mean: np.ndarray, directions: np.ndarray, eigenvalues: np.ndarray, count: int) -> float:
    """Largest entry by which the whitened fit list's covariance differs from the identity."""
    k = len(eigenvalues)
    onto = directions / np.sqrt(eigenvalues)

    def add(block: np.ndarray, total: np.ndarray) -> None:
        z = (block - mean) @ onto
        total[:k] += z.sum(axis=0)
        total[k:] += (z.T @ z).ravel()

    out = _totals(blocks, len(mean), k + k * k, add)
    centre = out[:k] / count
    return float(np.abs(out[k:].reshape(k, k) / count - np.outer(centre, centre) - np.eye(k)).max())


def whiten(rows: DataFrame, model: Whitening, id_col: str = "vec_id") -> DataFrame:
    """(id, whitened array, deviation) of every row.

    ``deviation`` is the exact sum of (n x - S)^2 over the dimensions; null if it
    exceeds a long.
    """
    count, sums, mean, length = model.count, model.sums, model.mean, len(model.sums)
    onto = model.directions / np.sqrt(model.eigenvalues)
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch, length)
            largest = count * max(abs(int(x.min())), abs(int(x.max()))) + max(map(abs, sums))
            wide = x.astype(np.int64 if largest * largest * length < SAFE else object)
            apart = count * wide - np.array(sums, dtype=wide.dtype)
            deviations = [d if d < 1 << 63 else None for d in map(int, (apart * apart).sum(axis=1))]
            z = (x - mean) @ onto
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), pa.array(list(z), pa.list_(pa.float64())), pa.array(deviations, pa.int64())],
                names=[id_col, "whitened", "deviation"],
            )

    return rows.select(id_col, "x").mapInArrow(run, f"`{id_col}` {kind}, whitened array<double>, deviation long")
