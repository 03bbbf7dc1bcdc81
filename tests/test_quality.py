"""Each quality rule with a passing and a failing record."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from crystalflow import schema as S
from crystalflow.operators import quality

CUBE = [[4.25, 0.0, 0.0], [0.0, 4.25, 0.0], [0.0, 0.0, 4.25]]
SITES = ["Mg", "Mg", "O", "O", "O", "O", "Si"]
N = len(SITES)
# forsterite, one formula unit in a made-up cube
VALID = {
    "id": "fo-1-pbesol",
    "source": "mp",
    "elements": ["Mg", "O", "Si"],
    "nelements": 3,
    "elements_ratios": [2 / N, 4 / N, 1 / N],
    "nsites": N,
    "cartesian_site_positions": [[0.5 * i, 0.25 * i, 1.5] for i in range(N)],
    "lattice_vectors": CUBE,
    "species_at_sites": SITES,
    "species": [{"name": e} for e in ("Mg", "O", "Si")],
    "chemical_formula_anonymous": "A4B2C",
    "chemical_formula_reduced": "Mg2O4Si",
    "chemical_formula_descriptive": "Mg2 O4 Si",
    "dimension_types": [1] * 3,
    "nperiodic_dimensions": 3,
    "immutable_id": "fo-1",
    "last_modified": datetime.datetime(2023, 7, 9, 4, 30),
    "cross_compatibility": True,
}
STILL = [[0.0, 0.03, 0.0]] * N
OPTIONAL = {
    "functional": "pbesol",
    "stress_tensor": CUBE,
    "forces": STILL,
    "magnetic_moments": [0.0, 1.5] + [0.25] * (N - 2),
    "charges": [2.0, 2.0, -2.0, -2.0, -2.0, -2.0, 4.0],
    "energy": -47.5,
    "space_group_it_number": 62,
}


def _first(values, changed):
    return [changed, *values[1:]]


# by field: a value that breaks one rule, and the rule's code
_TEXTS = ("id", "immutable_id", "chemical_formula_anonymous", "chemical_formula_reduced", "chemical_formula_descriptive")
_ARRAYS = ("elements", "elements_ratios", "cartesian_site_positions", "species_at_sites", "species")
_PER_SITE = ("forces", "magnetic_moments", "charges")
BREAKS = {
    "nelements": {0: "nelements_positive", 4: "element_counts_agree"},
    "nsites": {0: "nsites_positive", N + 1: "site_count:species_at_sites", N - 1: "site_count:cartesian_site_positions"},
    "source": {"": "source_known", "elsewhere": "source_known"},
    "functional": {"lda": "functional_known"},
    "nperiodic_dimensions": {2: "three_periodic_dimensions", -3: "three_periodic_dimensions"},
    "space_group_it_number": {-1: "space_group_range", 500: "space_group_range"},
    "last_modified": {None: "last_modified_date"},
    "cross_compatibility": {None: "cross_compatibility_missing"},
    "chemical_formula_anonymous": {"A4b2C": "anonymous_formula_form", "4A2BC": "anonymous_formula_form"},
    "chemical_formula_descriptive": {"Mg2 o4 Si": "descriptive_formula_form", "Mg2 O4": "element_counts_agree"},
    "chemical_formula_reduced": {
        "Mg2(SiO4)": "reduced_formula_parentheses",
        "Mg2O4Si1": "reduced_formula_ones",
        "mg2O4Si": "reduced_formula_form",
    },
}
BAD = [({name: value}, code) for name, cases in BREAKS.items() for value, code in cases.items()]
BAD += [({name: ""}, f"text_empty:{name}") for name in _TEXTS] + [({"id": None}, "text_empty:id")]
BAD += [({name: []}, f"array_empty:{name}") for name in _ARRAYS]
BAD += [({name: []}, f"optional_empty:{name}") for name in _PER_SITE]
BAD += [({name: OPTIONAL[name][1:]}, f"site_count:{name}") for name in _PER_SITE]
BAD += [({name: [*OPTIONAL[name], OPTIONAL[name][0]]}, f"site_count:{name}") for name in _PER_SITE]
BAD += [
    ({"elements": ["Si", "O", "Mg"]}, "elements_sorted"),
    ({"elements_ratios": [0.25, 0.25, 0.25]}, "ratios_sum_to_one"),
    ({"elements_ratios": [0.25, 0.5, 0.25003]}, "ratios_sum_to_one"),
    ({"elements_ratios": [0.5, 0.5]}, "element_counts_agree"),
    ({"stress_tensor": CUBE[1:]}, "stress_3x3"),
    ({"lattice_vectors": [*CUBE, CUBE[0]]}, "lattice_3x3"),
    ({"lattice_vectors": [row[1:] for row in CUBE]}, "lattice_3x3"),
    ({"cartesian_site_positions": [[1.0, 2.0]] * N}, "positions_3_vectors"),
    ({"forces": _first(STILL, [0.01])}, "forces_3_vectors"),
    ({"forces": _first(STILL, [0.01, 0.02, 0.03, 0.04])}, "forces_3_vectors"),
    ({"forces": _first(STILL, [0.01, 0.02, None])}, "forces_3_vectors"),
    ({"forces": _first(STILL, [0.08, 0.0, 0.08])}, "forces_too_high"),
    ({"charges": _first(OPTIONAL["charges"], None)}, "optional_empty:charges"),
    ({"species_at_sites": _first(SITES, "Qq")}, "site_symbols_valid"),
    ({"dimension_types": [1, 0, 1]}, "dimension_types_periodic"),
    ({"dimension_types": [1, 1]}, "dimension_types_periodic"),
]
GOOD = [
    {},
    OPTIONAL,
    *[{"functional": f} for f in (None, *S.FUNCTIONALS)],
    {"forces": _first(STILL, [0.0, 0.0, -0.1])},
    {"elements_ratios": [2 / N, 4 / N, 1 / N + 8e-6]},
    {"chemical_formula_reduced": "Mg12O24Si"},
    {"chemical_formula_descriptive": "Mg2 O4 Si1"},
    {"space_group_it_number": 1},
]


def table(spark, changes, schema=S.STRUCTURE):
    names = [f.name for f in schema.fields]
    rows = []
    for i, change in enumerate(changes):
        record = {**VALID, **change}
        rows.append((i, *[record.get(n) for n in names]))
    keyed = schema.__class__([S.T.StructField("n", S.T.IntegerType()), *schema.fields])
    return spark.createDataFrame(rows, keyed)


def test_bad_records_name_their_rule(spark):
    got = quality.classify(table(spark, [c for c, _ in BAD])).select("n", "reasons").collect()
    found = {r["n"]: r["reasons"] for r in got}
    wrong = [(BAD[n], reasons) for n, reasons in found.items() if BAD[n][1] not in reasons]
    assert wrong == [] and len(found) == len(BAD)


def test_good_records_have_no_reason(spark):
    got = quality.classify(table(spark, GOOD)).select("n", "reasons").collect()
    assert [r for r in got if r["reasons"]] == []


def test_normalised_values(spark):
    rows = quality.accepted(
        quality.classify(
            table(
                spark,
                [
                    {"chemical_formula_anonymous": "A3B7C4", "chemical_formula_descriptive": "Mg1 O10 Si12"},
                    {"chemical_formula_anonymous": "A3B3C8D20"},
                    {"chemical_formula_anonymous": "AB14"},
                ],
            )
        )
    ).orderBy("n").collect()
    assert [r["chemical_formula_anonymous"] for r in rows] == ["A7B4C3", "A20B8C3D3", "A14B"]
    assert rows[0]["chemical_formula_descriptive"] == "Mg O10 Si12"
    assert rows[0]["last_modified"] == datetime.datetime(2023, 7, 9)


def test_frames_skip_the_force_limit_but_not_negative_steps(spark):
    rows = [
        {"forces": _first(STILL, [3.0, 0.0, 0.0]), "relaxation_step": 0, "relaxation_number": 0},
        {"relaxation_step": -1, "relaxation_number": 0},
        {"relaxation_step": 0, "relaxation_number": -1},
    ]
    got = quality.classify(table(spark, rows, S.FRAME), frames=True).orderBy("n").collect()
    assert [r["reasons"] for r in got] == [[], ["negative:relaxation_step"], ["negative:relaxation_number"]]


@pytest.mark.parametrize("bounded", [False, True])
def test_document_scope(spark, bounded):
    df = table(spark, [{"immutable_id": "a"}, {"immutable_id": "a", "source": "x"}, {"immutable_id": "b"}])
    got = quality.widen_to_document(quality.classify(df), ["immutable_id"], bounded).orderBy("n").collect()
    assert [r["reasons"] for r in got] == [["document_rejected"], ["source_known"], []]


def test_counts(spark):
    df = quality.classify(table(spark, [{}, {"source": "x"}, {"source": "y", "nsites": N - 4}]))
    counts = {r["reason"]: r["n_rows"] for r in quality.reject_counts(df).collect()}
    assert counts["source_known"] == 2 and counts["site_count:species_at_sites"] == 1
    watched, watch = quality.observed(df)
    watched.select(F.size("reasons")).write.format("noop").mode("overwrite").save()
    assert watch.get == {"rows": 3, "rejected": 2}
    assert quality.accepted(df).count() == 1 and quality.rejected(df).count() == 2
