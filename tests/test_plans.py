"""The three sources end to end on small hand-made inputs."""

from __future__ import annotations

import datetime
import json

import pytest
from pyspark.sql import functions as F

from crystalflow import schema as S
from crystalflow.plans import common, dump, materials, pipelines, vendor
from crystalflow.sources import documents

UNIT = [[4.0, 0.0, 0.0], [0.0, 4.0, 0.0], [0.0, 0.0, 4.0]]
FREE = common.Coefficients({"O": -0.5, "Al": 0.0}, {})
CALM = [[0.01, 0.0, 0.0], [0.0, 0.0, 0.0]]


def structure(*symbols, magmom=None):
    sites = []
    for i, symbol in enumerate(symbols):
        site = {"species": [{"element": symbol, "occu": 1.0}], "abc": [0.25 * i, 0.0, 0.0]}
        if magmom is not None:
            site["properties"] = {"magmom": magmom}
        sites.append(site)
    return {"lattice": {"matrix": UNIT}, "sites": sites}


# --- materials and tasks --------------------------------------------------
def material(name, tasks, license="BY-C", deprecated=(), elements=("Al", "O"), **changes):
    doc = {
        "material_id": name,
        "last_updated": {"$date": "2024-03-14T10:00:00Z"},
        "elements": list(elements),
        "nelements": len(elements),
        "composition_reduced": {e: 1.0 for e in reversed(elements)},
        "formula_anonymous": "AB",
        "structure": structure(*elements),
        "task_types": {t: kind for t, kind, _ in tasks},
        "calc_types": {t: label for t, _, label in tasks},
        "deprecated_tasks": list(deprecated),
        "builder_meta": {"build_date": {"$date": "2024-03-10T23:00:00Z"}, "license": license},
    }
    return {**doc, **changes}


def ionic_step(energy, electronic=3, forces=CALM, symbols=("Al", "O")):
    return {
        "e_fr_energy": energy,
        "forces": forces,
        "stress": UNIT,
        "structure": structure(*symbols),
        "electronic_steps": [{"e": 1}] * electronic,
    }


def task(name, kind="Static", energy=-10.0, steps=((-8.0, -9.0, -10.0),), nelm=60, lasph=True, ispin=2, **output):
    return {
        "task_id": name,
        "task_type": kind,
        "nsites": 2,
        "last_updated": {"$date": "2024-03-12"},
        "composition_reduced": {"O": 1.0, "Al": 1.0},
        "elements": ["Al", "O"],
        "nelements": 2,
        "formula_anonymous": "AB",
        "input": {"parameters": {"NELM": nelm, "LASPH": lasph, "ISPIN": ispin}},
        "output": {
            "energy": energy,
            "forces": CALM,
            "stress": UNIT,
            "bandgap": 0.5,
            "efermi": 1.5,
            "magnetization": {"total_magnetization": 0.25},
            "structure": structure("Al", "O", magmom=0.1),
            **output,
        },
        "calcs_reversed": [
            {"output": {"ionic_steps": [s if isinstance(s, dict) else ionic_step(s) for s in calc]}} for calc in steps
        ],
    }


def raw(spark, docs):
    lines = spark.createDataFrame([(json.dumps(d),) for d in docs], "value string")
    return documents.route(lines).where("parsed").drop("parsed")


def mp(spark, mats, tasks):
    return materials.typed_materials(raw(spark, mats)), materials.typed_tasks(raw(spark, tasks))


def by_id(df):
    return {r["id"]: r for r in df.collect()}


OPT = "Structure Optimization"


def test_material_structures(spark):
    mats = [
        material("mp-1", [("a", "Static", "GGA Static"), ("b", "Static", "GGA+U Static"), ("c", OPT, "r2SCAN x"), ("x", "NMR", "GGA x")]),
        material("mp-2", [("d", "Static", "GGA Static"), ("old", "Static", "GGA Static")], deprecated=["old"], elements=("Cs", "O")),
        material("mp-3", [("gone", "Static", "GGA Static"), ("h", "Static", "HSE Static")]),
    ]
    tasks = [
        task("a", energy=-10.0),
        task("b", energy=-12.0),
        task("c", OPT, energy=-11.0),
        task("d", structure=structure("Cs", "O")),
        task("old", energy=-99.0),
        task("h"),
    ]
    good, bad = pipelines.curate_structures("mp", *mp(spark, mats, tasks), coefficients=FREE)
    rows = by_id(good)
    assert set(rows) == {"mp-1-pbe", "mp-1-r2scan", "mp-2-pbe"} and bad.count() == 0
    row = rows["mp-1-pbe"]
    assert row["energy"] == -12.0 and row["energy_corrected"] == -12.5
    assert rows["mp-1-r2scan"]["energy_corrected"] == -11.0
    assert (row["immutable_id"], row["source"], row["functional"]) == ("mp-1", "mp", "pbe")
    assert row["last_modified"] == datetime.datetime(2024, 3, 10)
    assert row["elements"] == ["Al", "O"] and row["elements_ratios"] == [0.5, 0.5]
    assert (row["chemical_formula_reduced"], row["chemical_formula_descriptive"]) == ("AlO", "Al O")
    assert row["cartesian_site_positions"] == [[0.0, 0.0, 0.0], [1.0, 0.0, 0.0]]
    assert row["species_at_sites"] == ["Al", "O"] and row["nsites"] == 2
    assert row["magnetic_moments"] == [0.1, 0.1] and row["total_magnetization"] == 0.25
    assert (row["dos_ef"], row["band_gap_indirect"], row["charges"]) == (1.5, 0.5, None)
    assert [s["name"] for s in row["species"]] == ["Al", "O"]
    assert row["cross_compatibility"] and not rows["mp-2-pbe"]["cross_compatibility"]
    assert good.columns == S.STRUCTURE.fieldNames()


def test_hubbard_preference(spark):
    mats = [material("mp-1", [("a", "Static", "GGA Static"), ("b", OPT, "GGA+U x")])]
    tasks = [task("a", energy=-20.0), task("b", OPT, energy=-10.0)]
    energies = []
    for flag in (False, True):
        good, _ = pipelines.curate_structures("mp", *mp(spark, mats, tasks), prefer_hubbard_u=flag)
        energies.append(good.first()["energy"])
    assert energies == [-20.0, -10.0]


def test_one_bad_functional_takes_the_material_along(spark):
    two = [("a", "Static", "GGA Static"), ("c", "Static", "SCAN Static")]
    mats = [material(f"mp-{i}", [(t + str(i), k, c) for t, k, c in two]) for i in range(4)]
    no_forces = task("a2")
    del no_forces["output"]["forces"]
    no_parameters = task("a3")
    no_parameters["input"]["parameters"] = None
    tasks = [
        task("a0"),
        task("a1", steps=((-8.0, ionic_step(-9.0, electronic=60)),)),
        no_forces,
        no_parameters,
        *[task(f"c{i}") for i in range(4)],
    ]
    good, bad = pipelines.curate_structures("mp", *mp(spark, mats, tasks))
    assert set(by_id(good)) == {"mp-0-pbe", "mp-0-scan"}
    reasons = {r["id"]: r["reasons"] for r in bad.collect()}
    assert reasons == {
        "mp-1-pbe": ["electronic_steps_exhausted"],
        "mp-1-scan": ["document_rejected"],
        "mp-2-pbe": ["targets_missing"],
        "mp-2-scan": ["document_rejected"],
        "mp-3-pbe": ["electronic_steps_exhausted"],
        "mp-3-scan": ["document_rejected"],
    }
    by_row, _ = pipelines.curate_structures("mp", *mp(spark, mats, tasks), scope="row")
    assert {"mp-1-scan", "mp-2-scan", "mp-3-scan"} <= set(by_id(by_row))


def test_material_trajectories(spark):
    mats = [
        material("mp-1", [("a", OPT, "GGA x"), ("b", OPT, "GGA x"), ("far", OPT, "GGA x"), ("s", "Static", "GGA Static")]),
        material("mp-2", [("n", OPT, "GGA x")], license="BY-NC"),
    ]
    bad_step = ionic_step(-8.5, electronic=60)
    tasks = [
        # 3.0 is more than 1 eV/atom above the end; the exhausted step takes no number
        task("a", OPT, energy=-10.0, steps=((3.0, -8.0, bad_step), (-9.0, -9.9, -10.0))),
        task("b", OPT, energy=-9.9, steps=((-9.0, -9.88, -9.9),)),
        task("far", OPT, energy=-9.0, steps=((-8.0, -8.5, -9.0),)),
        task("s"),
        task("n", OPT),
    ]
    good, bad = pipelines.curate_trajectories("mp", *mp(spark, mats, tasks), coefficients=FREE)
    rows = by_id(good)
    # the last frame is the yardstick and is not emitted
    assert set(rows) == {"mp-1-0-pbe-1", "mp-1-0-pbe-2", "mp-1-0-pbe-3", "mp-1-1-pbe-0", "mp-1-1-pbe-1"}
    assert [rows[f"mp-1-0-pbe-{i}"]["energy"] for i in (1, 2, 3)] == [-8.0, -9.0, -9.9]
    assert [rows[f"mp-1-0-pbe-{i}"]["relaxation_number"] for i in (1, 2, 3)] == [0, 1, 1]
    assert [rows[f"mp-1-0-pbe-{i}"]["relaxation_step"] for i in (1, 2, 3)] == [1, 2, 3]
    assert rows["mp-1-0-pbe-2"]["energy_corrected"] == pytest.approx(-9.5)
    assert rows["mp-1-0-pbe-1"]["last_modified"] == datetime.datetime(2024, 3, 12)
    assert [r["reasons"] for r in bad.collect()] == [["electronic_steps_exhausted"]]
    assert good.columns == S.FRAME.fieldNames()
    with_last, _ = pipelines.curate_trajectories("mp", *mp(spark, mats, tasks), keep_final=True)
    # now the true ends are compared, 0.05 eV/atom apart, and the second task goes
    assert set(by_id(with_last)) == {f"mp-1-0-pbe-{i}" for i in (1, 2, 3, 4)}
    turned, _ = pipelines.curate_trajectories("mp", *mp(spark, mats, tasks), chronological=True)
    first = min((r for r in turned.collect() if "-0-pbe-" in r["id"]), key=lambda r: r["relaxation_step"])
    assert first["energy"] == -9.0 and first["relaxation_number"] == 0


# --- vendor documents -----------------------------------------------------
def vendor_doc(name, xc="PBE", scan=False, drop=(), **changes):
    base = {
        "immutable_id": name,
        "chemical_formula_reduced": "AlO",
        "chemical_formula_anonymous": "AB",
        "chemical_formula_descriptive": "Al1 O1",
        "cartesian_site_positions": [[0, 0, 0], [1, 1, 1]],
        "elements": ["Al", "O"],
        "elements_ratios": [0.5, 0.5],
        "nelements": 2,
        "nsites": 2,
        "species_at_sites": ["Al", "O"],
        "species": [{"name": "Al", "chemical_symbols": ["Al"], "concentration": [1]}, {"name": "O"}],
        "nperiodic_dimensions": 3,
        "dimension_types": [1, 1, 1],
        "last_modified": "2024-03-14T10:00:00Z",
        "lattice_vectors": UNIT,
        S.VENDOR_FUNCTIONAL_KEY: xc,
    }
    values = {k: None for k in S.VENDOR_TARGET_KEYS} | {"energy": -3.0, "forces": CALM, "charges": [0.1, -0.1]}
    base |= {S.VENDOR_PREFIX + k: v for k, v in values.items()}
    if scan:
        base |= {S.VENDOR_SCAN_PREFIX + k: v for k, v in values.items()} | {S.VENDOR_SCAN_PREFIX + "energy": -4.0}
    base |= changes
    return (name, json.dumps({k: v for k, v in base.items() if k not in drop}))


def test_vendor_structures(spark):
    docs = [
        vendor_doc("agm1", "PBEsol", scan=True),
        vendor_doc("agm2", **{S.VENDOR_PREFIX + "energy_corrected": -3.3}),
        vendor_doc("agm3", drop=[S.VENDOR_PREFIX + "charges"]),
        vendor_doc("agm4", "LDA"),
        vendor_doc("agm5", scan=True, drop=[S.VENDOR_SCAN_PREFIX + "band_gap"]),
        vendor_doc("agm6", elements=["Al", "Yb"], species_at_sites=["Al", "Yb"]),
    ]
    table = spark.createDataFrame(docs, "id string, attributes string")
    good, bad = pipelines.curate_structures("alexandria", table, coefficients=FREE)
    rows = by_id(good)
    assert set(rows) == {"agm1-pbesol", "agm1-scan", "agm2-pbe", "agm6-pbe"}
    assert (rows["agm1-scan"]["energy"], rows["agm1-pbesol"]["energy"]) == (-4.0, -3.0)
    assert rows["agm2-pbe"]["energy_corrected"] == -3.3 and rows["agm1-scan"]["energy_corrected"] == -4.0
    assert rows["agm1-scan"]["charges"] == [0.1, -0.1]
    assert rows["agm1-scan"]["last_modified"] == datetime.datetime(2024, 3, 14)
    assert rows["agm1-scan"]["chemical_formula_descriptive"] == "Al O"
    assert not rows["agm6-pbe"]["cross_compatibility"] and rows["agm2-pbe"]["cross_compatibility"]
    reasons = {(r["immutable_id"], r["functional"]): r["reasons"] for r in bad.collect()}
    assert reasons[("agm3", "pbe")] == ["key_missing"]
    assert reasons[("agm4", None)] == ["functional_unmapped"]
    assert reasons[("agm5", "scan")] == ["key_missing"] and reasons[("agm5", "pbe")] == ["document_rejected"]


def test_vendor_trajectories(spark, tmp_path):
    def step(energy, forces=CALM, **changes):
        return {"structure": structure("Al", "O"), "energy": energy, "forces": forces, "stress": UNIT, **changes}

    content = {
        "agm1": [{"steps": [step(-1.0), step(-9.0)]}, {"steps": [step(-9.5), step(None), step(-9.9), step(-10.0)]}],
        "agm2": [{"steps": [step(-1.0)]}],
        "agm3": [],
        "agm4": [{"steps": [step(-9.0, [[float("nan"), 0, 0], [0, 0, 0]]), step(-9.5), step(-9.6)]}],
        "agm5": [{"steps": [step(-9.0), step(-9.5, stress=[[1.0]]), step(-9.6)]}],
    }
    folder = tmp_path / "geo_opt_pbe"
    folder.mkdir()
    (folder / "part.json").write_text(json.dumps(content))
    keyed = documents.read_keyed_json(spark, str(folder))
    good, bad = pipelines.curate_trajectories("alexandria", keyed, coefficients=FREE)
    rows = by_id(good)
    # agm1-0 lies too high; frame 3 has no energy; frame 5 is last
    assert set(rows) == {"agm1-pbe-1", "agm1-pbe-2", "agm1-pbe-4", "agm4-pbe-1"}
    assert [rows[f"agm1-pbe-{i}"]["relaxation_number"] for i in (1, 2, 4)] == [0, 1, 1]
    assert rows["agm1-pbe-4"]["relaxation_step"] == 4
    assert rows["agm1-pbe-4"]["energy_corrected"] == pytest.approx(-10.4)
    assert rows["agm1-pbe-1"]["chemical_formula_reduced"] == "AlO" and rows["agm1-pbe-1"]["nelements"] == 2
    # one malformed frame loses the trajectory
    assert {r["immutable_id"] for r in bad.collect()} == {"agm5"}


# --- relational snapshot --------------------------------------------------
def rows_of(spark, name, rows):
    dtype = S.dump_tables()[name]
    return spark.createDataFrame([tuple(r.get(f.name) for f in dtype.fields) for r in rows], dtype)


def cell(ident, entry, nsites=2, energy=-5.0, **changes):
    lattice = {f"{a}{i + 1}": UNIT[i][j] for i in range(3) for j, a in enumerate("xyz")}
    stress = dict(zip(("sxx", "syy", "szz", "syz", "szx", "sxy"), (1.0, 2.0, 3.0, 4.0, 5.0, 6.0)))
    return {
        "id": ident,
        "entry_id": entry,
        "composition_id": "Al1 O1",
        "nsites": nsites,
        "ntypes": 2,
        "magmom": 0.5,
        "energy": energy,
        **lattice,
        **stress,
        **changes,
    }


def atoms(structure_id, symbols=("Al", "O"), **changes):
    return [
        {
            "id": structure_id * 10 + i,
            "structure_id": structure_id,
            "element_id": s,
            "x": 0.5 * i,
            "y": 0.0,
            "z": 0.0,
            "fx": 0.01,
            "fy": 0.0,
            "fz": 0.0,
            "charge": 0.1,
            **(changes if i == 0 else {}),
        }
        for i, s in enumerate(symbols)
    ]


def calc(entry, label, **changes):
    return {
        "entry_id": entry,
        "label": label,
        "energy": -6.0,
        "energy_pa": -3.0,
        "band_gap": 0.7,
        "settings": "{'ispin': 2}",
        "nsteps": 3,
        "converged": True,
        **changes,
    }


def tables(spark, cells, calcs, sites, entries=()):
    return {
        "structures": rows_of(spark, "structures", cells),
        "calculations": rows_of(spark, "calculations", calcs),
        "atoms": rows_of(spark, "atoms", sites).orderBy(F.col("id").desc()),
        "entries": rows_of(spark, "entries", [{"id": e} for e in entries]),
    }


def test_dump_structures(spark):
    cells = [cell(1, 100), cell(2, 100), cell(3, None), cell(4, 101), cell(5, 102), cell(6, 103, nsites=3), cell(7, 104), cell(8, 105)]
    calcs = [
        calc(100, "static"),
        calc(100, "relaxation"),
        calc(101, "static", energy_pa=None),
        calc(102, "relaxation"),
        calc(103, "static"),
        calc(104, "static", settings="{'ispin': 1}"),
        calc(105, "static", settings="{'ispin': '2'}"),
    ]
    sites = [*atoms(1), *atoms(2, fx=None, charge=None), *atoms(6), *atoms(7), *atoms(8, ("Ca", "O"))]
    as_of = F.lit("2024-05-06 07:08:09").cast("timestamp")
    good, bad = pipelines.curate_structures("oqmd", tables(spark, cells, calcs, sites), coefficients=FREE, as_of=as_of)
    rows = by_id(good)
    assert set(rows) == {"oqmd-1-pbe", "oqmd-2-pbe", "oqmd-7-pbe", "oqmd-8-pbe"}
    row = rows["oqmd-1-pbe"]
    assert row["energy"] == -6.0 and row["energy_corrected"] == -6.5 and row["band_gap_indirect"] == 0.7
    assert row["stress_tensor"] == [[1.0, 6.0, 5.0], [6.0, 2.0, 4.0], [5.0, 4.0, 3.0]]
    assert row["cartesian_site_positions"] == [[0.0, 0.0, 0.0], [2.0, 0.0, 0.0]]
    assert row["species_at_sites"] == ["Al", "O"] and row["forces"][0] == [0.01, 0.0, 0.0] and row["charges"] == [0.1, 0.1]
    assert row["chemical_formula_descriptive"] == "Al O" and row["total_magnetization"] == 0.5
    assert row["last_modified"] == datetime.datetime(2024, 5, 6)
    assert rows["oqmd-2-pbe"]["forces"] is None and rows["oqmd-2-pbe"]["charges"] is None
    assert [rows[f"oqmd-{i}-pbe"]["cross_compatibility"] for i in (1, 7, 8)] == [True, False, False]
    assert {r["id"] for r in bad.collect()} == {"oqmd-6-pbe"}


def test_dump_trajectories(spark):
    cells = [cell(i, 1, energy=-5.5) for i in range(1, 10)]
    sites = [a for i in range(1, 9) for a in atoms(i)]
    calcs = [
        # out of label order on purpose
        calc(100, "fine_relax", input_id=3, output_id=4, energy=-6.0, nsteps=5),
        calc(100, "relaxation", input_id=1, output_id=2, energy=-5.8, nsteps=2, settings="{}"),
        calc(100, "coarse_relax", input_id=2, output_id=3, energy=None, nsteps=0),
        calc(100, "static", input_id=4, output_id=4),
        calc(101, "relaxation", input_id=1, output_id=2),
        calc(101, "relaxation", input_id=2, output_id=3),
        calc(102, "relaxation", input_id=1, output_id=None),
        calc(103, "relaxation", input_id=1, output_id=2),
        calc(103, "fine_relax", input_id=2, output_id=3, converged=False),
        calc(104, "relaxation", input_id=5, output_id=6, converged=False),
        calc(105, "relaxation", input_id=5, output_id=99),
        calc(999, "relaxation", input_id=5, output_id=6),
    ]
    given = tables(spark, cells, calcs, sites, range(100, 106))
    good, bad = pipelines.curate_trajectories("oqmd", given, coefficients=FREE, keep_final=True)
    rows = sorted(good.collect(), key=lambda r: (r["immutable_id"], r["relaxation_number"], r["relaxation_step"]))
    got = [(r["id"], r["relaxation_number"], r["relaxation_step"], r["energy"], r["cross_compatibility"]) for r in rows]
    assert got == [
        ("oqmd-4-pbe-0", 0, 0, -5.5, False),
        ("oqmd-4-pbe-2", 0, 2, -5.8, False),
        ("oqmd-4-pbe-7", 2, 7, -6.0, True),
        ("oqmd-6-pbe-0", 0, 0, -5.5, True),
        ("oqmd-6-pbe-3", 0, 3, -6.0, True),
    ]
    assert [r["energy_corrected"] for r in rows] == pytest.approx([-6.0, -6.3, -6.5, -6.0, -6.5])
    # the missing structure 99 rejects its entry
    assert {r["immutable_id"] for r in bad.collect()} == {"oqmd-99"}
    observed, _ = pipelines.curate_trajectories("oqmd", given)
    assert set(by_id(observed)) == {"oqmd-4-pbe-0", "oqmd-4-pbe-2", "oqmd-6-pbe-0"}
    strict, _ = pipelines.curate_trajectories("oqmd", given, apply_blocklist=True)
    assert strict.count() == 3


def test_dump_frames_count_their_own_atoms(spark):
    """What a structure declares does not matter to frames."""
    cells = [cell(1, 1, nsites=7), cell(2, 1)]
    given = tables(spark, cells, [calc(100, "relaxation", input_id=1, output_id=2)], [*atoms(1), *atoms(2)], [100])
    good, bad = pipelines.curate_trajectories("oqmd", given, coefficients=FREE, keep_final=True)
    assert {r["id"]: r["nsites"] for r in good.collect()} == {"oqmd-2-pbe-0": 2, "oqmd-2-pbe-3": 2}
    assert bad.count() == 0


def test_dump_structures_are_derived_once(spark, monkeypatch):
    """the chemistry of a structure was derived for every frame that shows it."""
    composed, derive = [], common.with_compositions
    monkeypatch.setattr(common, "with_compositions", lambda df, species: composed.append(df.count()) or derive(df, species))
    calcs = [calc(i, "relaxation", input_id=1, output_id=2) for i in (100, 101, 102)]
    given = tables(spark, [cell(1, 1), cell(2, 1)], calcs, [*atoms(1), *atoms(2)], [100, 101, 102])
    good, bad = pipelines.curate_trajectories("oqmd", given, coefficients=FREE, keep_final=True)
    assert (good.count(), bad.count()) == (6, 0)
    assert composed == [2]


def test_dump_relaxations_are_small_groups(spark):
    given = tables(spark, [], [calc(1, "relaxation", input_id=1, output_id=2)] * 50, [], [1])
    assert dump.relaxations(given["entries"], given["calculations"]).count() == 0


def test_dump_relaxations_are_one_aggregate(spark):
    """two aggregates, two joins and windows over an entry each held its calculations in a task."""
    calcs = [
        calc(1, "fine_relax", input_id=3, output_id=4, nsteps=5),
        calc(1, "relaxation", input_id=1, output_id=2, nsteps=None, converged=False),
        calc(1, "coarse_relax", input_id=2, output_id=3, nsteps=2, converged=None),
        calc(2, "fine_relax", input_id=1, output_id=7, converged=False),
        calc(3, "relaxation", input_id=1, output_id=2),
        calc(3, "coarse_relax", input_id=2, output_id=3, converged=None),
        calc(4, "relaxation", input_id=None, output_id=2),
        calc(5, "relaxation", input_id=1, output_id=2),
        *[calc(6, "relaxation", input_id=1, output_id=2)] * 50,
        calc(None, "relaxation", input_id=1, output_id=2),
        calc(7, "static", input_id=1, output_id=2),
    ]
    given = tables(spark, [], calcs, [], [1, 2, 3, 4, 6, 7])
    usable = dump.relaxations(given["entries"], given["calculations"])
    assert usable.columns[1:] == [c for c in given["calculations"].columns if c != "entry_id"] + [
        "label_no", "relaxation_number", "output_step", "last_output_id",
    ]
    rows = usable.select("entry_id", "label", "label_no", "input_id", "relaxation_number", "output_step", "last_output_id")
    assert sorted(map(tuple, rows.collect())) == [
        (1, "coarse_relax", 2, 2, 1, 2, 4),
        (1, "fine_relax", 3, 3, 2, 7, 4),
        (1, "relaxation", 1, 1, 0, None, 4),
        (2, "fine_relax", 3, 1, 0, 3, 7),
    ]
    plan = usable._jdf.queryExecution().optimizedPlan().toString()
    assert (plan.count("Aggregate"), plan.count("Join"), plan.count("Window")) == (1, 1, 0)
    assert plan.count("RepartitionByExpression") == 1  # by number of rows, under the aggregate


def test_vendor_fan_out_keeps_one_row_without_scan(spark):
    table = spark.createDataFrame([vendor_doc("a"), vendor_doc("b", scan=True)], "id string, attributes string")
    assert vendor.fan_out(table).groupBy("document_id").count().orderBy("document_id").collect()[1]["count"] == 2
