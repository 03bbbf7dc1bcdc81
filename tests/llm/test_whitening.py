"""Whitening against a dense eigendecomposition, equal eigenvalues, low rank and edge cases."""

from __future__ import annotations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from crystalflow.llm import queries, whitening

NAN, INF = float("nan"), float("inf")


def table(spark, matrix):
    rows = [(k, [float(c) for c in row]) for k, row in enumerate(matrix)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def dense(x):
    distinct = np.unique(x, axis=0)
    centred = distinct - distinct.mean(axis=0)
    values, vectors = np.linalg.eigh(centred.T @ centred / len(distinct))
    return distinct, values[::-1], vectors[:, ::-1]


def test_query_against_dense(spark):
    small = driver.SMALL
    given = duckdb.sql(f"SELECT vec_id, embedding FROM '{small}/embeddings.parquet'").fetchall()
    x = np.floor(256 * np.array([e for _, e in given], float)).astype(int)
    distinct, values, vectors = dense(x)
    n, sums = len(distinct), distinct.sum(axis=0)
    expected = {}
    for (key, _), row in zip(given, x, strict=True):
        for k in range(4):
            expected[key, k + 1] = (row - sums / n) @ vectors[:, k] / np.sqrt(values[k])
    deviation = {key: sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums, strict=True)) for (key, _), row in zip(given, x, strict=True)}
    rows = queries.QUERIES["op11_whitening"](spark, small).collect()
    assert sorted((r["vec_id"], r["component"]) for r in rows) == sorted(expected)
    sign = {k: np.sign(next(r["whitened"] for r in rows if r["component"] == k and r["vec_id"] == 0) * expected[0, k]) for k in range(1, 5)}
    for r in rows:
        assert r["n"] == n and r["deviation"] == deviation[r["vec_id"]]
        assert r["whitened"] * sign[r["component"]] == pytest.approx(expected[r["vec_id"], r["component"]], abs=1e-9)
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / values.sum(), rel=1e-12)
        assert r["identity_error"] < 1e-12


def subspaces_agree(model, x, k):
    _, values, _ = dense(x)
    assert np.allclose(model.eigenvalues, values[:k], rtol=1e-10)
    d = model.directions
    assert np.allclose(d.T @ d, np.eye(k), atol=1e-12)
    _, _, vectors = dense(x)
    near = [j for j in range(len(values)) if values[j] >= values[k - 1] * (1 - 1e-9)]
    inside = vectors[:, near]
    assert np.allclose(inside @ (inside.T @ d), d, atol=1e-8)


def test_equal_eigenvalues(spark):
    x = np.vstack([np.eye(6), -np.eye(6)])  # one value six times
    model = whitening.fit(whitening.integers(table(spark, x)), 4)
    subspaces_agree(model, np.floor(256 * x), 4)
    assert model.identity_error < 1e-12


def test_twice_the_largest_among_many(spark):
    random = np.random.default_rng(3)
    x = random.standard_normal((400, 40)) * 0.02
    x = np.vstack([x, -x])
    for k in range(2):  # two directions of exactly equal weight
        for sign in (4.0, -4.0, 3.0, -3.0):
            x = np.vstack([x, np.zeros(40)])
            x[-1, k] = sign
    work = whitening.fit(whitening.integers(table(spark, x)), 2)
    subspaces_agree(work, np.floor(256 * x), 2)


def test_converges_early_on_steep_spectra(spark):
    random = np.random.default_rng(5)
    x = random.standard_normal((300, 60)) * (0.5 ** np.arange(60) + 1e-2)
    model = whitening.fit(whitening.integers(table(spark, x), scale=4096.0), 3)
    subspaces_agree(model, np.floor(4096 * x), 3)
    assert model.passes < 50


def test_low_rank_and_few_rows(spark):
    line = whitening.fit(whitening.integers(table(spark, [[k, 2 * k, 0.5] for k in range(9)])), 4)
    assert len(line.eigenvalues) == 1 and abs(line.directions[:, 0] @ [1, 2, 0]) == pytest.approx(5**0.5)
    two = whitening.fit(whitening.integers(table(spark, [[1, 0], [0, 1], [0, 1]])), 4)
    assert two.count == 2 and len(two.eigenvalues) == 1
    same = whitening.fit(whitening.integers(table(spark, [[1.5, 2]] * 3)), 4)
    assert same.count == 1 and len(same.eigenvalues) == 0 and same.trace == 0


def test_edges(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [NAN, 1.0]), (3, [INF, 1.0]), (4, [None, 1.0]), (5, [1.0]), (6, []), (None, [0.0, -0.001]), (7, [3.0, 1.0])]
    vectors = spark.createDataFrame([*rows, rows[0]], "vec_id long, embedding array<float>")
    vectors = vectors.withColumn("x", F.lit("clash")).withColumn("whitened", F.lit(1)).withColumn("deviation", F.lit(1))
    ints = whitening.integers(vectors)
    assert {(r["vec_id"], tuple(r["x"])) for r in ints.collect()} == {(0, (256, 512)), (None, (0, -1)), (7, (768, 256))}
    model = whitening.fit(ints, 4)
    out = whitening.whiten(ints, model).collect()
    assert model.count == 3 and sorted(str(r["vec_id"]) for r in out) == ["0", "0", "7", "None"]
    empty = whitening.integers(vectors.limit(0))
    assert whitening.whiten(empty, whitening.fit(empty)).count() == 0


def test_deviation_beyond_long_is_null(spark):
    ints = whitening.integers(table(spark, [[1e15, 0.0], [-1e15, 1.0], [1e300, 2.0]]))
    assert {tuple(r["x"])[0] for r in ints.collect()} == {256 * 10**15, -256 * 10**15, (1 << 63) - 1}
    model = whitening.fit(ints, 1)
    assert model.sums[0] == (1 << 63) - 1
    assert {r["deviation"] for r in whitening.whiten(ints, model).collect()} == {None}
