"""Column functions on hand-computed values."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from crystalflow.functions import arrays, chem, text
from crystalflow.operators import correction


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def sites(*symbols):
    return F.array(*[F.lit(s) for s in symbols])


def pairs(composition):
    return [(r["element"], r["n"]) for r in composition]


@pytest.mark.parametrize(
    "atoms, reduced, formula, anonymous, descriptive",
    [
        (["O", "Al", "O", "Al", "O"], [("Al", 2), ("O", 3)], "Al2O3", "A3B2", "Al2 O3"),
        (["O"] * 4 + ["Si"] * 2, [("O", 2), ("Si", 1)], "O2Si", "A2B", "Si2 O4"),
        (["H"] * 4, [("H", 2)], "H2", "A", "H4"),
        (["Fe"] * 4, [("Fe", 1)], "Fe", "A", "Fe4"),
        (["Li", "O"] * 3, [("Li", 2), ("O", 2)], "Li2O2", "AB", "Li3 O3"),
        (["Na", "Cl"], [("Cl", 1), ("Na", 1)], "ClNa", "AB", "Na Cl"),
    ],
)
def test_composition(spark, atoms, reduced, formula, anonymous, descriptive):
    counted = chem.composition_of_sites(sites(*atoms))
    less = chem.reduced(counted)
    assert pairs(value(spark, less)) == reduced
    assert value(spark, chem.reduced_formula(less)) == formula
    assert value(spark, chem.anonymous_formula(counted)) == anonymous
    assert value(spark, chem.descriptive_formula(counted)) == descriptive
    total = sum(n for _, n in reduced)
    assert value(spark, chem.ratios(less)) == pytest.approx([n / total for _, n in reduced])


def test_formula_text(spark):
    assert value(spark, chem.reduced_formula_of_text(F.lit("Si2 O4"))) == "O2Si"
    assert value(spark, chem.reduced_formula_of_text(F.lit("C H3 C H2 O H"))) == "C2H6O"
    assert value(spark, chem.normalise_descriptive(F.lit("H2 O1 Ce1 C12"))) == "H2 O Ce C12"
    cases = {"A2B5C3": "A5B3C2", "A2B2C5D12": "A12B5C2D2", "AB": "AB", "A10B1": "A10B", "a2": None, "": None}
    for stated, expected in cases.items():
        assert value(spark, chem.normalise_anonymous(F.lit(stated))) == expected


def test_map_composition_and_site_order(spark):
    amounts = F.create_map(F.lit("O"), F.lit(3.0), F.lit("Al"), F.lit(2.0))
    assert value(spark, chem.ratios_of_map(amounts)) == pytest.approx([0.4, 0.6])
    assert value(spark, chem.reduced_formula(chem.composition_of_map(amounts))) == "Al2O3"
    ordered = chem.site_order_composition(sites("O", "Al", "O"))
    assert value(spark, chem.descriptive_formula(ordered, by_electronegativity=False)) == "O2 Al"


def test_species_records(spark):
    record = value(spark, chem.species(sites("Al")))[0].asDict()
    assert record == {
        "mass": None,
        "name": "Al",
        "attached": None,
        "nattached": None,
        "concentration": [1.0],
        "original_name": None,
        "chemical_symbols": ["Al"],
    }


def test_cross_compatibility(spark):
    assert [value(spark, chem.cross_compatible(sites("V", "O"), s)) for s in ("mp", "alexandria", "oqmd")] == [False, True, False]
    assert [value(spark, chem.cross_compatible(sites("Yb"), s)) for s in ("mp", "alexandria", "oqmd")] == [True, False, False]


def test_arrays(spark):
    vector = F.from_json(F.lit("[1.0, null]"), "array<double>")
    assert value(spark, arrays.null_if_any_null(vector)) is None
    assert value(spark, arrays.null_if_any_null(F.array(F.lit(1.0)))) == [1.0]
    matrix = F.from_json(F.lit("[[1.0, 2.0], [NaN, 0.5]]"), "array<array<double>>")
    assert value(spark, arrays.matrix_nan_to_null(matrix)) == [[1.0, 2.0], [None, 0.5]]
    assert value(spark, arrays.matrix_null_if_any_null(arrays.matrix_nan_to_null(matrix))) is None
    lattice = F.from_json(F.lit("[[4,0,0],[1,3,0],[0,0.5,5]]"), "array<array<double>>")
    points = F.from_json(F.lit("[[0.5,0.5,0],[0,0,1]]"), "array<array<double>>")
    assert value(spark, arrays.frac_to_cart(points, lattice)) == [[2.5, 1.5, 0.0], [0.0, 0.5, 5.0]]
    six = [F.lit(x) for x in ("xx", "yy", "zz", "yz", "xz", "xy")]
    assert value(spark, arrays.voigt_to_matrix(*six)) == [["xx", "xy", "xz"], ["xy", "yy", "yz"], ["xz", "yz", "zz"]]
    assert value(spark, arrays.max_norm(F.from_json(F.lit("[[3,4,0],[1,0,0]]"), "array<array<double>>"))) == 5.0


@pytest.mark.parametrize(
    "settings, expected",
    [
        ("{'ispin': 2}", True),
        ("{'ispin': '2', 'x': 1}", True),
        ('{"ispin": "2"}', True),
        ("{'ispin': 1, 'nelm': 2}", False),
        ("{'ispin': 20}", False),
        ("{}", False),
        (None, False),
    ],
)
def test_spin(spark, settings, expected):
    assert value(spark, text.spin_polarised(F.lit(settings).cast("string"))) is expected


def test_functionals(spark):
    by_text = {"PBEsol": "pbesol", "xc PBE": "pbe", "r2SCAN": "scan", "LDA": None}
    for stated, expected in by_text.items():
        assert value(spark, text.functional_from_text(F.lit(stated))) == expected
    assert value(spark, text.functional_from_text(F.lit("http://h/PBE"), case_sensitive=True)) is None
    by_label = {"GGA Static": "pbe", "GGA+U": "pbe", "PBEsol x": "pbesol", "r2SCAN x": "r2scan", "SCAN x": "scan", "HSE": None}
    for label, expected in by_label.items():
        assert value(spark, text.functional_from_label(F.lit(label))) == expected
    assert value(spark, text.functional_from_label(F.lit("HSE Static"), keep_unknown=True)) == "HSE Static"


BASE, HUBBARD = {"O": -0.5, "Fe": -1.0}, {"Fe": -2.0}


@pytest.mark.parametrize(
    "atoms, energy, functional, source, expected",
    [
        (["Fe", "Fe"], -10.0, "pbe", "mp", -12.0),
        (["Fe", "O"], -10.0, "pbe", "mp", -12.5),
        (["Fe", "F"], -10.0, "pbe", "mp", -12.0),
        (["Fe", "O"], -10.0, "scan", "mp", -10.0),
        (["Fe", "O"], None, "pbe", "mp", None),
        (["Po"], -1.0, "pbe", "mp", None),
        (["V"], -1.0, "pbe", "oqmd", None),
        (["V"], -1.0, "pbe", "alexandria", -1.0),
        (["Po"], -1.0, "pbesol", "mp", -1.0),
    ],
)
def test_correction(spark, atoms, energy, functional, source, expected):
    got = correction.corrected_energy(
        F.lit(energy).cast("double"),
        F.lit(functional),
        F.lit(source),
        chem.composition_of_sites(sites(*atoms)),
        BASE,
        HUBBARD,
    )
    assert value(spark, got) == expected


def test_coefficient_table_is_checked(spark):
    table = spark.createDataFrame([("O", -0.5)], "element string, coefficient double")
    assert correction.coefficients_from(table) == {"O": -0.5}
    with pytest.raises(ValueError):
        correction.coefficients_from(spark.range(500).selectExpr("cast(id as string) element", "1.0 coefficient"))
