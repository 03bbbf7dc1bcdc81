"""Materials with separate calculation tasks (source ``mp``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from crystalflow import schema as S
from crystalflow.functions import arrays, chem, text
from crystalflow.operators import frames, quality, scratch, selection
from crystalflow.operators.skew import spread
from crystalflow.plans import common
from crystalflow.sources import documents, shredded

SOURCE = "mp"
#: keys a task's output must have, whatever their value
REQUIRED_OUTPUT = ["energy", "forces", "bandgap", "structure"]


def typed_materials(raw: DataFrame) -> DataFrame:
    """Typed columns of material documents."""
    docs = documents.typed(raw.where(F.col("type") == documents.MATERIAL), S.MATERIAL_DOC)
    return docs.select("doc.*")


def typed_tasks(raw: DataFrame) -> DataFrame:
    """Typed columns of task documents, and which output keys are present.

    Worth storing as Parquet: the jobs below read few columns to choose tasks
    and the rest only for the chosen ones.
    """
    docs = documents.typed(raw.where(F.col("type") == documents.TASK), S.TASK_DOC)
    present = F.json_object_keys(F.get_json_object("attributes", "$.output"))
    return docs.select("doc.*", present.alias("output_keys"))


def shredded_materials(spark: SparkSession, path: str) -> DataFrame:
    """``typed_materials`` of a raw table stored by ``shredded.write_shredded``."""
    return shredded.read_shredded(spark, path, documents.MATERIAL, S.MATERIAL_DOC)


def shredded_tasks(spark: SparkSession, path: str) -> DataFrame:
    """``typed_tasks`` of a raw table stored by ``shredded.write_shredded``; of the output keys only the required ones are looked for."""
    read = shredded.read_shredded(spark, path, documents.TASK, S.TASK_DOC, keys_of=(("output",), REQUIRED_OUTPUT))
    return read.withColumnRenamed("keys", "output_keys")


def candidate_tasks(materials: DataFrame, tasks: DataFrame, with_static: bool) -> DataFrame:
    """Narrow rows ``material_id, functional, task_id`` with the selection keys."""
    references = selection.allowed_tasks(
        selection.explode_task_references(materials), with_static
    ).withColumn("functional", text.functional_from_label(F.col("calc_type")))
    keys = tasks.select(
        "task_id",
        "task_type",
        F.col("input.parameters.LASPH").alias("lasph"),
        F.col("input.parameters.ISPIN").alias("ispin"),
        F.col("output.energy").alias("energy"),
        "nsites",
    )
    # the preference looks at the type the task itself states
    return references.where(F.col("functional").isNotNull()).drop("task_type").join(keys, "task_id")


def curate_structures(
    materials: DataFrame,
    tasks: DataFrame,
    coefficients: common.Coefficients | None = None,
    prefer_hubbard_u: bool = False,
    scope: str = "source_document",
) -> DataFrame:
    """Best task of each (material, functional) as a classified structure row.

    ``scope="source_document"`` rejects all rows of a material when one is bad,
    ``"row"`` only the bad row.
    """
    order = selection.task_order(label="calc_type" if prefer_hubbard_u else None)
    chosen = selection.best_per_group(
        candidate_tasks(materials, tasks, with_static=True),
        ["material_id", "functional"],
        [*order, F.col("task_pos")],
    ).select("material_id", "functional", "task_id")

    outputs = tasks.select(
        "task_id",
        "output",
        "output_keys",
        F.col("input.parameters").alias("parameters"),
        F.try_element_at(
            F.try_element_at("calcs_reversed", F.lit(-1))["output"]["ionic_steps"], F.lit(-1)
        )["electronic_steps"].alias("last_steps"),
    )
    facts = materials.select(
        "material_id",
        "elements",
        "nelements",
        "composition_reduced",
        "formula_anonymous",
        F.col("builder_meta.build_date.$date").alias("build_date"),
        # text, so that the structure itself need not travel
        _descriptive("structure").alias("descriptive"),
    )
    joined = chosen.join(outputs, "task_id").join(facts, "material_id")
    shape = common.geometry(F.col("output.structure"))
    moments = F.transform(F.col("output.structure.sites"), lambda s: s["properties"]["magmom"])
    columns = {
        **_document_chemistry(),
        **common.periodicity(),
        **shape,
        "chemical_formula_descriptive": F.col("descriptive"),
        "id": text.composite_id("material_id", "functional"),
        "source": F.lit(SOURCE),
        "immutable_id": F.col("material_id"),
        "last_modified": text.iso_day(F.col("build_date")),
        "functional": F.col("functional"),
        "cross_compatibility": chem.cross_compatible(F.map_keys("composition_reduced"), SOURCE),
        "energy": F.col("output.energy"),
        "forces": F.col("output.forces"),
        "stress_tensor": F.col("output.stress"),
        "band_gap_indirect": F.col("output.bandgap"),
        "dos_ef": F.col("output.efermi"),
        "total_magnetization": F.col("output.magnetization.total_magnetization"),
        "magnetic_moments": arrays.null_if_any_null(moments),
    }
    checks = joined.withColumns(
        {
            "_targets": F.size(F.array_except(F.array(*[F.lit(k) for k in REQUIRED_OUTPUT]), "output_keys"))
            == 0,
            "_converged": F.col("parameters").isNotNull()
            & F.col("last_steps").isNotNull()
            & ~selection.used_all_steps(F.size("last_steps"), F.col("parameters.NELM")),
        }
    )
    rows = common.fill(checks, columns, S.STRUCTURE, keep=("_targets", "_converged"))
    corrected = common.own_correction(rows, coefficients)
    extra = [
        quality.Rule("targets_missing", "source", F.col("_targets")),
        quality.Rule("electronic_steps_exhausted", "source", F.col("_converged")),
    ]
    document = ["immutable_id"] if scope == "source_document" else None
    return common.structures_checked(corrected, document, extra).drop("_targets", "_converged")


def _descriptive(structure: str) -> Column:
    composition = chem.site_order_composition(common.site_species(F.col(structure)))
    return chem.descriptive_formula(composition, by_electronegativity=False)


def _document_chemistry() -> dict[str, Column]:
    """Composition columns stated by the document itself."""
    composition = chem.composition_of_map(F.col("composition_reduced"))
    return {
        "elements": F.col("elements"),
        "nelements": F.col("nelements"),
        "elements_ratios": chem.ratios_of_map(F.col("composition_reduced")),
        "species": chem.species(F.col("elements")),
        "chemical_formula_anonymous": F.col("formula_anonymous"),
        "chemical_formula_reduced": chem.reduced_formula(composition),
    }


def license_allows(materials: DataFrame, license: str = S.TRAJECTORY_LICENSE) -> DataFrame:
    return materials.where(F.col("builder_meta.license") == license)


def curate_trajectories(
    materials: DataFrame,
    tasks: DataFrame,
    coefficients: common.Coefficients | None = None,
    chronological: bool = False,
    keep_final: bool = False,
    write_once: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Frames of every relaxation task, and the frames that were rejected.

    All frames of a trajectory come from one task document, and all tasks of a
    material from one material document, so the windows below hold bounded
    groups. Their keys start with ``task_id``, by which the join has already
    partitioned the rows: no further exchange of the wide frames is needed. The
    number of partitions follows the number of tasks, not their compressed size.
    """
    ranked = selection.rank_in_group(
        candidate_tasks(license_allows(materials), tasks, with_static=False),
        ["material_id", "functional"],
        [*selection.task_order(), F.col("task_pos")],
        segments=1,
    ).select("material_id", "functional", "trajectory_number", "task_id")
    ranked = spread(scratch.materialise(ranked), ["task_id"], common.DOCUMENTS_PER_TASK)
    documents_ = tasks.select(
        "task_id",
        "composition_reduced",
        "elements",
        "nelements",
        "formula_anonymous",
        F.col("last_updated.$date").alias("updated"),
        F.col("input.parameters.NELM").alias("nelm"),
        "calcs_reversed",
    )
    calcs = F.reverse("calcs_reversed") if chronological else F.col("calcs_reversed")
    steps = frames.explode_relaxations(
        ranked.join(documents_, "task_id"), calcs, "output.ionic_steps", payload=["calcs_reversed", "calc"]
    )
    columns = {
        **_document_chemistry(),
        **common.periodicity(),
        **common.geometry(F.col("step.structure")),
        "chemical_formula_descriptive": _descriptive("step.structure"),
        # the id is completed once the frame has its number
        "id": text.composite_id("material_id", "trajectory_number", "functional"),
        "source": F.lit(SOURCE),
        "immutable_id": F.col("material_id"),
        "last_modified": text.iso_day(F.col("updated")),
        "functional": F.col("functional"),
        "cross_compatibility": chem.cross_compatible(F.map_keys("composition_reduced"), SOURCE),
        "energy": F.col("step.e_fr_energy"),
        "forces": F.col("step.forces"),
        "stress_tensor": F.col("step.stress"),
        "relaxation_number": F.col("relaxation_number"),
        "relaxation_step": F.col("step_pos"),
    }
    counted = F.col("step.electronic_steps").isNotNull() | F.col("nelm").isNull()
    checks = steps.withColumns(
        {
            # a step that lacks one of these is no frame, and takes no number
            "_whole": F.col("step.forces").isNotNull() & F.col("step.stress").isNotNull() & counted,
            "_converged": ~selection.used_all_steps(F.size("step.electronic_steps"), F.col("nelm")),
        }
    )
    rows = common.fill(
        checks, columns, S.FRAME, keep=("task_id", "trajectory_number", "step_pos", "_whole", "_converged")
    )
    classified = quality.classify(
        rows,
        frames=True,
        extra=[
            quality.Rule("frame_keys_missing", "source", F.col("_whole")),
            quality.Rule("electronic_steps_exhausted", "source", ~F.col("_whole") | F.col("_converged")),
        ],
    ).drop("_whole", "_converged")
    classified = scratch.materialise(classified) if write_once else classified  # good and rejected frames read it

    trajectory = ["task_id", "immutable_id", "functional", "trajectory_number"]
    numbered = frames.number_frames(
        quality.accepted(classified).drop("relaxation_step"),
        trajectory,
        ["relaxation_number", "step_pos"],
        segments=1,
    ).withColumns(
        {
            "relaxation_step": F.col("relaxation_step").cast("int"),
            "id": text.composite_id("id", "relaxation_step"),
        }
    )
    corrected = frames.carry_correction(
        common.own_correction(numbered, coefficients), trajectory, ["relaxation_step"], segments=1
    )
    converged = frames.convergence_filter(
        corrected, trajectory, ["relaxation_step"], keep_final=keep_final, bounded=True
    )
    # used twice below: by the trajectory ends and by the frames they select
    converged = scratch.materialise(converged)
    kept = frames.close_to_primary(converged, ["immutable_id", "functional"], ["relaxation_step"])
    return kept.select(*common.FRAME_COLUMNS), quality.rejected(classified)
