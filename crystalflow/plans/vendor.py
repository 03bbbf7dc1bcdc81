"""Vendor-prefixed structure documents and keyed trajectory files (source ``alexandria``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from crystalflow import schema as S
from crystalflow.functions import arrays, chem, text
from crystalflow.operators import frames, quality, scratch
from crystalflow.operators.skew import spread
from crystalflow.plans import common

SOURCE = "alexandria"


def document_type() -> T.StructType:
    """Every key the mapping reads, with the type of its curated column."""
    curated = {f.name: f.dataType for f in S.STRUCTURE.fields}
    curated["last_modified"] = T.StringType()
    base = [T.StructField(k, curated[k]) for k in S.VENDOR_BASE_KEYS]
    targets = [
        T.StructField(prefix + key, curated[column])
        for prefix in (S.VENDOR_PREFIX, S.VENDOR_SCAN_PREFIX)
        for key, column in S.VENDOR_TARGET_KEYS.items()
    ]
    return T.StructType([*base, *targets, T.StructField(S.VENDOR_FUNCTIONAL_KEY, T.StringType())])


def _variant(prefix: str, functional: Column, needs_functional: bool) -> Column:
    """One output row: the mapped keys, and whether all of them are present."""
    needed = [*S.VENDOR_BASE_KEYS, *[prefix + k for k in S.VENDOR_TARGET_KEYS]]
    if needs_functional:
        needed.append(S.VENDOR_FUNCTIONAL_KEY)
    missing = F.array_except(F.array(*[F.lit(k) for k in needed]), F.col("keys"))
    return F.struct(
        *[F.col(f"doc.{k}").alias(k) for k in S.VENDOR_BASE_KEYS],
        *[F.col(f"doc.{prefix}{k}").alias(c) for k, c in S.VENDOR_TARGET_KEYS.items()],
        functional.alias("functional"),
        (F.size(missing) == 0).alias("complete"),
    )


def fan_out(raw: DataFrame) -> DataFrame:
    """A row per functional of a document: its own, and scan if any key names it."""
    docs = raw.select(
        F.col("id").alias("document_id"),
        F.from_json("attributes", document_type()).alias("doc"),
        F.json_object_keys("attributes").alias("keys"),
    )
    own = text.functional_from_text(F.col(f"doc.{S.VENDOR_FUNCTIONAL_KEY}"))
    has_scan = F.exists("keys", lambda k: k.contains("scan"))
    variants = F.array(
        _variant(S.VENDOR_PREFIX, own, needs_functional=True),
        F.when(has_scan, _variant(S.VENDOR_SCAN_PREFIX, F.lit("scan"), needs_functional=False)),
    )
    return docs.select("document_id", F.explode(F.array_compact(variants)).alias("v")).select(
        "document_id", "v.*"
    )


def _mapped() -> quality.Rule:
    """The functional's text has to stand for a functional, though one may be missing elsewhere."""
    return quality.Rule("functional_unmapped", "source", F.col("functional").isNotNull())


def curate_structures(
    raw: DataFrame,
    coefficients: common.Coefficients | None = None,
    scope: str = "source_document",
) -> DataFrame:
    """Classified structure rows of vendor documents."""
    rows = fan_out(raw)
    columns = {c: F.col(c) for c in rows.columns if c in common.STRUCTURE_COLUMNS}
    columns |= {
        "id": text.composite_id("document_id", "functional"),
        "source": F.lit(SOURCE),
        "last_modified": F.try_to_timestamp("last_modified"),
        "cross_compatibility": chem.cross_compatible(F.col("elements"), SOURCE),
    }
    filled = common.fill(rows, columns, S.STRUCTURE, keep=("document_id", "complete"))
    extra = [quality.Rule("key_missing", "source", F.col("complete")), _mapped()]
    document = ["document_id"] if scope == "source_document" else None
    checked = common.structures_checked(common.own_correction(filled, coefficients), document, extra)
    return checked.drop("document_id", "complete")


def curate_trajectories(
    keyed: DataFrame,
    coefficients: common.Coefficients | None = None,
    keep_final: bool = False,
    write_once: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Frames of keyed files, and the rejected ones.

    A trajectory is one input row: an id in one file (column ``path``, if
    there is one). Files hold one functional each, so an id may come in several
    and its trajectories are numbered, corrected and judged apart. One bad
    frame rejects its whole trajectory, whose frames are a bounded group. Rows
    are dealt over tasks before they become frames, as their files may be few.
    """
    origin = F.col("path") if "path" in keyed.columns else F.lit("")
    unit = ["immutable_id", "origin"]
    sizes = F.transform("relaxations", lambda r: F.size(r["steps"]))
    documents_ = keyed.select(
        F.col("id").alias("document_id"), "last_modified", "relaxations", sizes.alias("sizes"), origin.alias("origin")
    )
    steps = frames.explode_relaxations(
        spread(documents_, ["document_id", "origin"], common.DOCUMENTS_PER_TASK),
        F.col("relaxations"),
        "steps",
        payload=["relaxations"],
    )
    earlier = F.aggregate(
        F.slice("sizes", F.lit(1), F.col("relaxation_number")), F.lit(0), lambda acc, n: acc + n
    )
    functional = F.lower("calc.functional")
    shape = common.geometry(F.col("step.structure"))
    placed = common.with_compositions(
        steps.withColumn("frame_no", earlier + F.col("step_pos")), shape["species_at_sites"]
    )
    columns = {
        **common.chemistry_of_sites(),
        **common.periodicity(),
        **shape,
        "id": text.composite_id("document_id", functional, "frame_no"),
        "source": F.lit(SOURCE),
        "immutable_id": F.col("document_id"),
        "last_modified": F.col("last_modified"),
        "functional": functional,
        "cross_compatibility": chem.cross_compatible(shape["species_at_sites"], SOURCE),
        "energy": F.col("step.energy"),
        "forces": arrays.matrix_null_if_any_null(F.col("step.forces")),
        "stress_tensor": F.col("step.stress"),
        "relaxation_number": F.col("relaxation_number"),
        "relaxation_step": F.col("frame_no"),
    }
    rows = common.fill(placed, columns, S.FRAME, keep=("origin",))
    classified = quality.widen_to_document(
        quality.classify(rows, frames=True, extra=[_mapped()]), unit, bounded=True
    )
    classified = scratch.materialise(classified) if write_once else classified  # good and rejected frames read it
    own = common.own_correction(quality.accepted(classified), coefficients)
    corrected = frames.carry_correction(own, unit, ["relaxation_step"], segments=1)
    converged = frames.convergence_filter(
        corrected, unit, ["relaxation_step"], keep_final=keep_final, bounded=True
    )
    return converged.select(*common.FRAME_COLUMNS), quality.rejected(classified.drop("origin"))
