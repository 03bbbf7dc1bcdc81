"""Nested-array expressions for per-site data and small matrices."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row.

    An expression named twice is evaluated twice, and inside a lambda once per
    element. Passing it through a one-element array binds it.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def null_if_any_null(values: Column) -> Column:
    """The array, or null when one of its elements is null."""
    return F.when(F.forall(values, lambda v: v.isNotNull()), values)


def matrix_null_if_any_null(rows: Column) -> Column:
    """The matrix, or null when one of its components is null."""
    return F.when(~F.exists(rows, lambda row: F.exists(row, lambda v: v.isNull())), rows)


def nan_to_null(value: Column) -> Column:
    """A double with NaN replaced by null."""
    return F.nullif(value, F.lit(float("nan")))


def vector_nan_to_null(values: Column) -> Column:
    return F.transform(values, nan_to_null)


def matrix_nan_to_null(rows: Column) -> Column:
    return F.transform(rows, vector_nan_to_null)


def frac_to_cart(points: Column, lattice: Column) -> Column:
    """Fractional coordinates times the lattice (rows are lattice vectors)."""

    def cartesian(p: Column, rows: Column) -> Column:
        return F.array(
            *[
                F.get(p, F.lit(0)) * F.get(F.get(rows, F.lit(0)), F.lit(axis))
                + F.get(p, F.lit(1)) * F.get(F.get(rows, F.lit(1)), F.lit(axis))
                + F.get(p, F.lit(2)) * F.get(F.get(rows, F.lit(2)), F.lit(axis))
                for axis in range(3)
            ]
        )

    return let(lattice, lambda rows: F.transform(points, lambda p: cartesian(p, rows)))


def voigt_to_matrix(xx: Column, yy: Column, zz: Column, yz: Column, xz: Column, xy: Column) -> Column:
    """Symmetric 3x3 tensor from its six Voigt components."""
    return F.array(F.array(xx, xy, xz), F.array(xy, yy, yz), F.array(xz, yz, zz))


def norm(vector: Column) -> Column:
    """Euclidean length of a vector; null when a component is null."""
    squares = F.aggregate(vector, F.lit(0.0), lambda acc, v: acc + v * v)
    return F.sqrt(squares)


def max_norm(vectors: Column) -> Column:
    """Length of the longest vector."""
    return F.array_max(F.transform(vectors, norm))


def array_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)
