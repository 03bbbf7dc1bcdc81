"""Compositions and formulas.

A composition is ``array<struct<element: string, n: bigint>>`` in alphabetical
element order, so two rows with the same atoms always compare equal.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from crystalflow import schema as S
from crystalflow.functions.arrays import let

_TOKEN = r"([A-Z][a-z]?)([0-9]*)"


def _entry(element: Column, n: Column) -> Column:
    return F.struct(element.alias("element"), n.cast("bigint").alias("n"))


def _amounts(composition: Column) -> Column:
    return F.transform(composition, lambda e: e["n"])


def composition_of_sites(species_at_sites: Column) -> Column:
    """Count the atoms of each element of a site list."""
    return _counted(species_at_sites, lambda sites: F.array_sort(F.array_distinct(sites)))


def _counted(species_at_sites: Column, elements_of) -> Column:
    return let(
        species_at_sites,
        lambda sites: F.transform(
            elements_of(sites), lambda el: _entry(el, F.size(F.filter(sites, lambda s: s == el)))
        ),
    )


def composition_of_map(amounts: Column) -> Column:
    """Composition from an element -> amount map."""
    entries = F.transform(F.map_entries(amounts), lambda e: _entry(e["key"], e["value"]))
    return F.array_sort(entries)


def composition_of_formula(formula: Column) -> Column:
    """Parse a formula such as ``Al2 O3``; an element named twice is summed."""
    symbols = F.regexp_extract_all(formula, F.lit(_TOKEN), F.lit(1))
    numbers = F.regexp_extract_all(formula, F.lit(_TOKEN), F.lit(2))
    terms = F.zip_with(
        symbols, numbers, lambda s, n: _entry(s, F.when(n == "", F.lit("1")).otherwise(n))
    )

    def total(pairs: Column, el: Column) -> Column:
        own = F.filter(pairs, lambda p: p["element"] == el)
        return F.aggregate(own, F.lit(0).cast("bigint"), lambda acc, p: acc + p["n"])

    return let(
        terms,
        lambda pairs: F.transform(
            F.array_sort(F.array_distinct(element_names(pairs))),
            lambda el: _entry(el, total(pairs, el)),
        ),
    )


def common_divisor(composition: Column) -> Column:
    """Greatest common divisor of the amounts, by Euclid.

    Two numbers take at most five steps per decimal digit of the smaller one,
    and one more to put it first; the fold starts from the smallest amount.
    """

    def pair(x: Column, y: Column) -> Column:
        return F.struct(x.alias("x"), y.alias("y"))

    def divisor(a: Column, b: Column, steps: Column) -> Column:
        shrink = lambda s, _: F.when(s["y"] == 0, s).otherwise(pair(s["y"], s["x"] % s["y"]))
        return F.aggregate(steps, pair(a, b), shrink)["x"]

    def fold(amounts: Column) -> Column:
        least = F.array_min(amounts)
        steps = F.sequence(F.lit(0), 5 * F.length(least.cast("string")))
        return F.aggregate(amounts, least, lambda g, n: divisor(g, n, steps))

    return let(_amounts(composition), fold)


def reduced(composition: Column, keep_doubled: bool = True) -> Column:
    """Divide by the common divisor.

    With ``keep_doubled`` the conventional exceptions (H2, N2, ..., Li2O2) keep
    a factor of two.
    """

    def divide(whole: Column) -> Column:
        return let(
            common_divisor(whole),
            lambda divisor: F.transform(whole, lambda e: _entry(e["element"], e["n"] / divisor)),
        )

    def redouble(smallest: Column) -> Column:
        unit = F.forall(smallest, lambda e: e["n"] == 1)
        doubled = F.transform(smallest, lambda e: _entry(e["element"], e["n"] * 2))
        return F.when(unit & F.array_join(element_names(smallest), "").isin(keys), doubled).otherwise(
            smallest
        )

    keys = sorted("".join(sorted(_split_symbols(f))) for f in S.DOUBLED_FORMULAS)
    smallest = let(composition, divide)
    return let(smallest, redouble) if keep_doubled else smallest


def _split_symbols(formula: str) -> list[str]:
    symbols: list[str] = []
    for ch in formula:
        if ch.isupper():
            symbols.append(ch)
        else:
            symbols[-1] += ch
    return symbols


def ratios(composition: Column) -> Column:
    """Fraction of each element, in composition order."""
    return _shares(_amounts(composition))


def ratios_of_map(amounts: Column) -> Column:
    """Fraction of each element of an element -> amount map, alphabetically."""
    return _shares(F.transform(F.array_sort(F.map_entries(amounts)), lambda e: e["value"]))


def _shares(amounts: Column) -> Column:
    def divide(values: Column) -> Column:
        total = F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)
        return let(total, lambda t: F.transform(values, lambda v: v / t))

    return let(amounts, divide)


def element_names(composition: Column) -> Column:
    return F.transform(composition, lambda e: e["element"])


def _term(element: Column, n: Column) -> Column:
    return F.when(n == 1, element).otherwise(F.concat(element, n.cast("string")))


def reduced_formula(composition: Column) -> Column:
    """Element symbols and amounts, ones left out: ``Al2O3``."""
    return F.array_join(F.transform(composition, lambda e: _term(e["element"], e["n"])), "")


def _lettered(amounts: Column) -> Column:
    ordered = F.sort_array(amounts, asc=False)
    return F.array_join(
        F.transform(ordered, lambda n, i: _term(F.char(F.lit(65) + i), n)),
        "",
    )


def anonymous_formula(composition: Column) -> Column:
    """Formula with elements replaced by letters, largest amount first."""
    return _lettered(_amounts(reduced(composition, keep_doubled=False)))


ANONYMOUS_PATTERN = r"^([A-Z][0-9]*)+$"


def normalise_anonymous(formula: Column) -> Column:
    """Re-letter an anonymous formula by descending amount; null if malformed."""
    numbers = F.regexp_extract_all(formula, F.lit(r"[A-Z]([0-9]*)"), F.lit(1))
    amounts = F.transform(
        numbers, lambda n: F.when(n == "", F.lit("1")).otherwise(n).cast("bigint")
    )
    # an explicit amount of one, or zero, is written without a number
    shown = F.transform(F.sort_array(amounts, asc=False), lambda n: F.when(n > 1, n.cast("string")).otherwise(""))
    text = F.array_join(F.transform(shown, lambda n, i: F.concat(F.char(F.lit(65) + i), n)), "")
    return F.when(formula.rlike(ANONYMOUS_PATTERN), text)


def normalise_descriptive(formula: Column) -> Column:
    """Drop unit amounts: ``H2 O1`` becomes ``H2 O``."""
    return F.regexp_replace(formula, r"([A-Z][a-z]?)1\b", "$1")


def descriptive_formula(composition: Column, by_electronegativity: bool = True) -> Column:
    """``Al2 O3`` style text, ones left out.

    Elements follow electronegativity (then name), or the order of
    ``composition`` itself.
    """
    ordered = composition
    if by_electronegativity:
        scale = F.create_map(*[F.lit(x) for pair in S.ELECTRONEGATIVITY.items() for x in pair])
        keyed = F.transform(
            composition,
            lambda e: F.struct(
                F.coalesce(F.try_element_at(scale, e["element"]), F.lit(99.0)).alias("x"),
                e["element"].alias("element"),
                e["n"].alias("n"),
            ),
        )
        ordered = F.array_sort(keyed)
    return F.array_join(F.transform(ordered, lambda e: _term(e["element"], e["n"])), " ")


def site_order_composition(species_at_sites: Column) -> Column:
    """Composition in first-appearance order instead of alphabetical."""
    return _counted(species_at_sites, F.array_distinct)


def reduced_formula_of_text(formula: Column) -> Column:
    """Reduced formula re-derived from a descriptive one."""
    return reduced_formula(reduced(composition_of_formula(formula)))


def species(elements: Column) -> Column:
    """One fully occupied species record per element."""
    return F.transform(
        elements,
        lambda el: F.struct(
            F.lit(None).cast("double").alias("mass"),
            el.alias("name"),
            F.lit(None).cast("string").alias("attached"),
            F.lit(None).cast("int").alias("nattached"),
            F.array(F.lit(1.0)).alias("concentration"),
            F.lit(None).cast("string").alias("original_name"),
            F.array(el).alias("chemical_symbols"),
        ),
    )


def cross_compatible(elements: Column, source: str) -> Column:
    """False when an element of the source's blocklist is present."""
    blocked = F.array(*[F.lit(e) for e in S.INCOMPATIBLE_ELEMENTS[source]])
    return ~F.arrays_overlap(elements, blocked)


def extensive(per_atom: str | Column, nsites: str | Column) -> Column:
    """A quantity per atom as the whole cell's."""
    value, sites = (F.col(c) if isinstance(c, str) else c for c in (per_atom, nsites))
    return value * sites
