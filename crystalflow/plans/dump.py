"""Relational snapshots of structures, calculations and atoms (source ``oqmd``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from crystalflow import schema as S
from crystalflow.functions import arrays, chem, text
from crystalflow.operators import frames, prefilter, quality, scratch, selection
from crystalflow.operators.skew import join_per_key, spread
from crystalflow.plans import common

SOURCE = "oqmd"
FUNCTIONAL = "pbe"
_ATOM_PARTS = 8
#: calculations of a task: they take some 200 bytes each while they are merged
CALCULATIONS_PER_TASK = 500_000
_ORDERED = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
_LATTICE = [f"{axis}{row}" for row in (1, 2, 3) for axis in "xyz"]
_PER_STRUCTURE = ["cartesian_site_positions", "stress_tensor"]  # the other columns are cheap


def label_calculations(calculations: DataFrame, labels: list[str]) -> DataFrame:
    """Calculations with one of ``labels``, numbered by preference as ``label_no``."""
    rank = selection.label_rank("label", labels)
    return calculations.where(F.col("entry_id").isNotNull() & F.col("label").isin(labels)).withColumn(
        "label_no", rank
    )


def site_arrays(atoms: DataFrame, structures: DataFrame | None = None) -> DataFrame:
    """Per-structure arrays in atom order, for every structure that has atoms.

    With ``structures`` (column ``id``) only for those. One array per structure
    is what is asked for; atoms of a structure are gathered in several parts
    first, so that no single task collects and sorts them one by one.
    """
    if structures is not None:
        wanted = scratch.materialise(structures.select(F.col("id").alias("structure_id")).distinct())
        # atoms of other structures go where they are read
        atoms = prefilter.likely(atoms, ["structure_id"], wanted)
        atoms = join_per_key(atoms, wanted, ["structure_id"], "left_semi")
    site = F.struct(
        "id",
        F.col("element_id").alias("element"),
        F.array("x", "y", "z").alias("at"),
        F.array("fx", "fy", "fz").alias("force"),
        "charge",
    )
    parts = atoms.groupBy("structure_id", F.pmod(F.xxhash64("id"), F.lit(_ATOM_PARTS)).alias("part")).agg(
        F.collect_list(site).alias("sites")
    )
    grouped = parts.groupBy("structure_id").agg(F.sort_array(F.flatten(F.collect_list("sites"))).alias("sites"))
    part = lambda name: F.transform("sites", lambda s: s[name])
    return grouped.select(
        "structure_id",
        part("element").alias("species_at_sites"),
        part("at").alias("fractional"),
        arrays.matrix_null_if_any_null(part("force")).alias("forces"),
        arrays.null_if_any_null(part("charge")).alias("charges"),
    )


def _structure_columns() -> dict[str, Column]:
    """Columns a dump row and its sites give."""
    lattice = F.array(*[F.array(*[F.col(f"{axis}{row}") for axis in "xyz"]) for row in (1, 2, 3)])
    stress = arrays.voigt_to_matrix(*[F.col(c) for c in ("sxx", "syy", "szz", "syz", "szx", "sxy")])
    return {
        **common.periodicity(),
        "lattice_vectors": lattice,
        "stress_tensor": F.when(F.forall(F.flatten(stress), lambda v: v.isNotNull()), stress),
        "cartesian_site_positions": arrays.frac_to_cart(F.col("fractional"), lattice),
        "species_at_sites": F.col("species_at_sites"),
        "forces": F.col("forces"),
        "charges": F.col("charges"),
        "total_magnetization": F.col("magmom"),
        "source": F.lit(SOURCE),
        "functional": F.lit(FUNCTIONAL),
    }


def curate_structures(
    tables: dict[str, DataFrame],
    coefficients: common.Coefficients | None = None,
    as_of: Column | None = None,
) -> DataFrame:
    """Structures with a static calculation, as classified rows.

    ``as_of`` stands for the modification time the dump lacks (default today).
    """
    static = label_calculations(tables["calculations"], S.STATIC_LABELS)
    preferred = selection.best_per_group(
        static, ["entry_id"], ["label_no", "output_id", "input_id", "energy_pa"]
    ).where(F.col("energy_pa").isNotNull())
    chosen = preferred.select("entry_id", "energy_pa", "band_gap", "settings")
    joined = join_per_key(tables["structures"], chosen, ["entry_id"]).join(
        site_arrays(tables["atoms"]), F.col("id") == F.col("structure_id"), "left"
    )
    derived = common.chemistry_of_sites()
    identity = F.concat(F.lit("oqmd-"), F.col("id").cast("string"))
    columns = {
        **derived,
        **_structure_columns(),
        "chemical_formula_descriptive": F.col("composition_id"),
        "nelements": F.col("ntypes"),
        "nsites": F.col("nsites"),
        "energy": chem.extensive("energy_pa", "nsites"),
        "band_gap_indirect": F.col("band_gap"),
        "immutable_id": identity,
        "id": text.composite_id(identity, F.lit(FUNCTIONAL)),
        "last_modified": F.current_date() if as_of is None else as_of,
        "cross_compatibility": text.spin_polarised(F.col("settings"))
        & F.coalesce(chem.cross_compatible(derived["elements"], SOURCE), F.lit(False)),
    }
    rows = common.fill(
        common.with_compositions(joined, F.col("species_at_sites")), columns, S.STRUCTURE
    )
    return common.structures_checked(common.own_correction(rows, coefficients), document=None)


def relaxations(entries: DataFrame, calculations: DataFrame) -> DataFrame:
    """Usable relaxation calculations, numbered per entry.

    An entry goes as a whole if no trajectory can be made of it: a label
    repeats, a structure reference is missing, or several calculations end with
    one that has not converged. What is left has at most one row per label, so
    one aggregate, merged before its shuffle, holds an entry's calculations side
    by side however many there were. Rows are dealt by number first, as few
    bytes of a file may hold many.
    """
    labelled = label_calculations(calculations, S.RELAXATION_LABELS)
    labelled = spread(labelled, ["entry_id", "input_id", "output_id"], CALCULATIONS_PER_TASK)
    labels = dict(enumerate(S.RELAXATION_LABELS, start=1))
    carried = [f for f in labelled.schema.fields if f.name not in ("entry_id", "label", "label_no")]

    def value(no: int, field: T.StructField) -> Column:
        # the label's only value, where it counts; maximum needs the smaller buffer
        only = F.when(F.col("label_no") == no, F.col(field.name))
        return F.max(only) if isinstance(field.dataType, _ORDERED) else F.first(only, ignorenulls=True)

    missing = F.col("input_id").isNull() | F.col("output_id").isNull()
    side_by_side = labelled.groupBy("entry_id").agg(
        F.max(missing).alias("_missing"),
        *[F.count_if(F.col("label_no") == no).alias(f"_n_{no}") for no in labels],
        *[value(no, f).alias(f"_{no}_{f.name}") for no in labels for f in carried],
    )
    there = {no: F.col(f"_n_{no}") > 0 for no in labels}
    before = {no: sum((there[k].cast("int") for k in labels if k < no), F.lit(0)) for no in labels}

    def last(name: str) -> Column:
        return F.coalesce(*[F.when(there[no], F.col(f"_{no}_{name}")) for no in reversed(labels)])

    def of_label(per_label: dict[int, Column]) -> Column:
        chosen = F
        for no, column in per_label.items():
            chosen = chosen.when(F.col("label_no") == no, column)
        return chosen

    def steps_up_to(no: int) -> Column:
        taken = [F.col(f"_{k}_nsteps").cast("bigint") for k in labels if k <= no]
        return F.when(F.coalesce(*taken).isNotNull(), sum((F.coalesce(t, F.lit(0)) for t in taken), F.lit(0)))

    several = sum((n.cast("int") for n in there.values()), F.lit(0)) > 1
    repeated = F.greatest(*[F.col(f"_n_{no}") for no in labels]) > 1
    final = F.coalesce(*[F.when(there[no], F.coalesce(f"_{no}_converged", F.lit(False))) for no in reversed(labels)])
    usable = side_by_side.where(~repeated & ~F.col("_missing") & ~(several & ~final)).join(
        entries.select(F.col("id").alias("entry_id")), "entry_id", "left_semi"
    )
    present = F.array_compact(F.array(*[F.when(there[no], F.lit(no).cast("bigint")) for no in labels]))
    rows = usable.withColumn("label_no", F.explode(present))
    columns = {
        f.name: of_label({no: F.col(f"_{no}_{f.name}") for no in labels}) for f in carried
    } | {"label": of_label({no: F.lit(label) for no, label in labels.items()})}
    return rows.select(
        "entry_id",
        *[columns[c].alias(c) for c in labelled.columns if c in columns],
        "label_no",
        of_label(before).cast("bigint").alias("relaxation_number"),
        of_label({no: steps_up_to(no) for no in labels}).alias("output_step"),
        last("output_id").alias("last_output_id"),
    )


def curate_trajectories(
    tables: dict[str, DataFrame],
    coefficients: common.Coefficients | None = None,
    as_of: Column | None = None,
    apply_blocklist: bool = False,
    keep_final: bool = False,
    write_once: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Input and output frames of every entry's relaxations, and the rejected ones."""
    calcs = relaxations(tables["entries"], tables["calculations"])
    identity = F.concat(F.lit("oqmd-"), F.col("last_output_id").cast("string"))

    def frame(structure_id: str, step: Column, suffix: Column, is_output: bool) -> Column:
        return F.struct(
            F.col(structure_id).alias("structure_id"),
            step.cast("int").alias("step"),
            suffix.cast("string").alias("suffix"),
            F.lit(is_output).alias("is_output"),
        )

    # one structure lookup serves both roles
    both = frames.input_and_output_frames(
        calcs,
        F.col("relaxation_number") == 0,
        frame("input_id", F.lit(0), F.col("relaxation_number"), is_output=False),
        frame("output_id", F.col("output_step"), F.col("output_step"), is_output=True),
    ).select(
        "entry_id",
        "relaxation_number",
        F.col("energy").alias("calc_energy"),
        "settings",
        identity.alias("identity"),
        "frame.*",
    )
    both = scratch.materialise(both)  # narrow, and read three times
    structures = tables["structures"]
    needed = both.select(F.col("structure_id").alias("id")).distinct()
    wanted = structures.join(needed, "id", "left_semi")
    described = (
        wanted.drop("entry_id")
        .withColumnRenamed("id", "structure_id")
        .join(site_arrays(tables["atoms"], wanted), "structure_id", "left")
    )
    # what is dear is derived once per structure, before its frames
    once = {**common.chemistry_of_sites(), **{c: _structure_columns()[c] for c in _PER_STRUCTURE}}
    del once["nelements"]
    composed = common.with_compositions(described, F.col("species_at_sites")).select(
        "structure_id", "energy", "magmom", *_LATTICE, "species_at_sites", "forces", "charges",
        *[c.cast(S.FRAME[name].dataType).alias(name) for name, c in once.items()],
    )
    joined = join_per_key(both, composed, ["structure_id"], "left")

    spin = text.spin_polarised(F.col("settings"))
    allowed = F.coalesce(chem.cross_compatible(F.col("elements"), SOURCE), F.lit(False))
    columns = {
        **{name: c for name, c in _structure_columns().items() if name not in once},
        **{name: F.col(name) for name in once},
        "nelements": F.size("elements"),
        "nsites": F.size("species_at_sites"),
        "energy": F.when(F.col("is_output"), F.col("calc_energy")).otherwise(F.col("energy")),
        "immutable_id": F.col("identity"),
        "id": text.composite_id("identity", F.lit(FUNCTIONAL), "suffix"),
        "last_modified": F.current_date() if as_of is None else as_of,
        "cross_compatibility": spin & allowed if apply_blocklist else spin,
        "relaxation_number": F.col("relaxation_number"),
        "relaxation_step": F.col("step"),
    }
    rows = common.fill(joined, columns, S.FRAME, keep=("entry_id", "is_output"))
    classified = quality.widen_to_document(
        quality.classify(rows, frames=True), ["entry_id"], bounded=True
    )
    classified = scratch.materialise(classified) if write_once else classified  # good and rejected frames read it
    own = common.own_correction(quality.accepted(classified), coefficients)
    order = ["relaxation_number", "is_output"]
    corrected = frames.carry_correction(
        own, ["entry_id"], order, takes_part=F.col("is_output"), segments=1
    )
    converged = frames.convergence_filter(
        corrected, ["entry_id"], order, keep_final=keep_final, bounded=True
    )
    return converged.select(*common.FRAME_COLUMNS), quality.rejected(classified)
