"""Composition-based energy correction with caller-supplied coefficients."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from crystalflow import schema as S
from crystalflow.functions.arrays import let


def coefficients_from(table: DataFrame, value: str = "coefficient") -> dict[str, float]:
    """Read an ``element, coefficient`` table; it has one row per element."""
    limit = len(S.ELEMENT_SYMBOLS)
    rows = table.select("element", value).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"a coefficient table has at most one row per element ({limit})")
    return {r["element"]: float(r[value]) for r in rows}


def _any_of(elements: Column, symbols: list[str]) -> Column:
    return F.arrays_overlap(elements, F.array(*[F.lit(s) for s in symbols]))


def _lookup(coefficients: Mapping[str, float], element: Column) -> Column:
    if not coefficients:
        return F.lit(0.0)
    table = F.create_map(*[F.lit(x) for k, v in coefficients.items() for x in (k, float(v))])
    return F.coalesce(F.try_element_at(table, element), F.lit(0.0))


def corrected_energy(
    energy: Column,
    functional: Column,
    source: Column,
    composition: Column,
    coefficients: Mapping[str, float],
    hubbard_coefficients: Mapping[str, float] | None = None,
) -> Column:
    """``energy`` plus the per-atom coefficients of its composition.

    A row-local expression: the coefficients are literals, nothing is joined.

    * unknown energy or a functional other than pbe: energy unchanged
    * Po or At present: null
    * V present and source mp or oqmd: null
    * O or F present: the transition metals treated with a Hubbard U use
      ``hubbard_coefficients``
    """
    return let(
        composition,
        lambda c: _corrected(energy, functional, source, c, coefficients, hubbard_coefficients or {}),
    )


def _corrected(
    energy: Column,
    functional: Column,
    source: Column,
    composition: Column,
    coefficients: Mapping[str, float],
    hubbard_coefficients: Mapping[str, float],
) -> Column:
    elements = F.transform(composition, lambda e: e["element"])
    base = F.aggregate(
        composition,
        F.lit(0.0),
        lambda acc, e: acc + e["n"] * _lookup(coefficients, e["element"]),
    )
    with_u = F.aggregate(
        composition,
        F.lit(0.0),
        lambda acc, e: acc
        + e["n"]
        * F.when(
            e["element"].isin(S.HUBBARD_ELEMENTS), _lookup(hubbard_coefficients, e["element"])
        ).otherwise(_lookup(coefficients, e["element"])),
    )
    return (
        F.when(energy.isNull() | (functional != "pbe"), energy)
        .when(_any_of(elements, S.UNCORRECTABLE_ELEMENTS), F.lit(None).cast("double"))
        .when(
            source.isin(S.NO_VANADIUM_SOURCES) & _any_of(elements, ["V"]), F.lit(None).cast("double")
        )
        .when(_any_of(elements, S.HUBBARD_ANIONS), energy + with_u)
        .otherwise(energy + base)
    )
