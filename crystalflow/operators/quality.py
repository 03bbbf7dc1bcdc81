"""Data-quality rules over curated structures and frames.

Every rule is one boolean expression with a code. All rules are evaluated in a
single pass; a row's ``reasons`` array names the rules it breaks and is empty
for a good row. Nothing is dropped silently: bad rows go to a rejects table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from crystalflow import schema as S
from crystalflow.functions import arrays, chem
from crystalflow.operators import scratch
from crystalflow.operators.skew import join_per_key

REASONS = "reasons"

# --- fixed values: formula patterns ---------------------------------------
DESCRIPTIVE_PATTERN = (
    r"^(?:[A-Z][a-z]?(?:[2-9]\d*|1\d+)?)(?:\s+[A-Z][a-z]?(?:[2-9]\d*|1\d+)?)*$"
)
REDUCED_PATTERN = r"^(?:[A-Z][a-z]?(?:\d+)?)+$"
EXPLICIT_ONE_PATTERN = r"([A-Z][a-z]?)1(?!\d)"


@dataclass(frozen=True)
class Rule:
    """A named condition good rows meet. ``family`` groups rules for reports."""

    code: str
    family: str
    holds: Column
    frames: bool = True  # applies to trajectory frames
    structures: bool = True  # applies to plain structures


def _full(values: Column) -> Column:
    return F.forall(values, lambda v: v.isNotNull())


def three_vectors(rows: Column) -> Column:
    """Every row has three non-null components."""
    return F.forall(rows, lambda row: (F.size(row) == 3) & _full(row))


def three_by_three(matrix: Column) -> Column:
    return (F.size(matrix) == 3) & three_vectors(matrix)


def ratios_sum_to_one(ratios: Column) -> Column:
    def close(total: Column) -> Column:
        larger = F.greatest(F.abs(total), F.lit(1.0))
        return F.abs(total - 1.0) <= F.greatest(S.RATIO_REL_TOL * larger, F.lit(S.RATIO_ABS_TOL))

    return arrays.let(arrays.array_sum(ratios), close)


def valid_symbols(symbols: Column) -> Column:
    return F.forall(symbols, lambda s: F.coalesce(s.isin(S.ELEMENT_SYMBOLS), F.lit(False)))


def alphabetical(elements: Column) -> Column:
    return elements == F.array_sort(elements)


def token_count(formula: Column) -> Column:
    """Number of blank-separated terms."""
    return F.size(F.filter(F.split(formula, r"\s+"), lambda t: t != ""))


def rules() -> list[Rule]:
    """The rule table, in reporting order."""
    c = F.col
    optional = lambda name, ok: c(name).isNull() | ok
    nsites = c("nsites")
    out = [
        Rule(f"text_empty:{name}", "text", F.length(c(name)) >= 1)
        for name in (
            "id",
            "source",
            "chemical_formula_anonymous",
            "chemical_formula_reduced",
            "chemical_formula_descriptive",
            "immutable_id",
        )
    ]
    out += [
        Rule(f"array_empty:{name}", "shape", F.size(c(name)) >= 1)
        for name in (
            "elements",
            "elements_ratios",
            "cartesian_site_positions",
            "species_at_sites",
            "species",
        )
    ]
    out += [
        Rule("nelements_positive", "range", c("nelements") > 0),
        Rule("nsites_positive", "range", nsites > 0),
        Rule("source_known", "text", c("source").isin(S.SOURCES)),
        Rule("functional_known", "text", optional("functional", c("functional").isin(S.FUNCTIONALS))),
        Rule("cross_compatibility_missing", "text", c("cross_compatibility").isNotNull()),
        Rule("positions_3_vectors", "shape", three_vectors(c("cartesian_site_positions"))),
        Rule("forces_3_vectors", "shape", optional("forces", three_vectors(c("forces")))),
        Rule("stress_3x3", "shape", optional("stress_tensor", three_by_three(c("stress_tensor")))),
        Rule("lattice_3x3", "shape", three_by_three(c("lattice_vectors"))),
        Rule("site_symbols_valid", "text", valid_symbols(c("species_at_sites"))),
        Rule("ratios_sum_to_one", "range", ratios_sum_to_one(c("elements_ratios"))),
        Rule("elements_sorted", "shape", alphabetical(c("elements"))),
        Rule("anonymous_formula_form", "text", c("chemical_formula_anonymous").rlike(chem.ANONYMOUS_PATTERN)),
        Rule(
            "descriptive_formula_form",
            "text",
            chem.normalise_descriptive(c("chemical_formula_descriptive")).rlike(DESCRIPTIVE_PATTERN),
        ),
        Rule("reduced_formula_parentheses", "text", ~c("chemical_formula_reduced").rlike(r"[()]")),
        Rule("reduced_formula_ones", "text", ~c("chemical_formula_reduced").rlike(EXPLICIT_ONE_PATTERN)),
        Rule("reduced_formula_form", "text", c("chemical_formula_reduced").rlike(REDUCED_PATTERN)),
        Rule("last_modified_date", "text", c("last_modified").isNotNull()),
        Rule(
            "space_group_range",
            "range",
            optional("space_group_it_number", c("space_group_it_number").between(1, 230)),
        ),
        Rule("dimension_types_periodic", "shape", c("dimension_types") == F.array(F.lit(1), F.lit(1), F.lit(1))),
        Rule("three_periodic_dimensions", "range", c("nperiodic_dimensions") == 3),
        Rule(
            "forces_too_high",
            "range",
            optional("forces", arrays.max_norm(c("forces")) <= S.MAX_FORCE),
            frames=False,
        ),
        Rule(
            "element_counts_agree",
            "cross",
            (F.size("elements") == c("nelements"))
            & (F.size("elements_ratios") == c("nelements"))
            & (F.size("species") == c("nelements"))
            & (token_count(c("chemical_formula_descriptive")) == c("nelements")),
        ),
    ]
    out += [
        Rule(f"site_count:{name}", "cross", F.size(c(name)) == nsites)
        for name in ("cartesian_site_positions", "species_at_sites")
    ]
    out += [
        Rule(f"site_count:{name}", "cross", optional(name, F.size(c(name)) == nsites))
        for name in ("forces", "magnetic_moments", "charges")
    ]
    out += [
        Rule(f"optional_empty:{name}", "shape", optional(name, (F.size(c(name)) >= 1) & ok))
        for name, ok in (
            ("magnetic_moments", _full(c("magnetic_moments"))),
            ("charges", _full(c("charges"))),
            ("forces", F.lit(True)),
        )
    ]
    out += [
        Rule(f"negative:{name}", "range", c(name) >= 0, structures=False)
        for name in ("relaxation_step", "relaxation_number")
    ]
    return out


def reasons(selected: Sequence[Rule]) -> Column:
    """Codes of the rules a row breaks. A rule that cannot be decided is broken."""
    broken = [F.when(~F.coalesce(r.holds, F.lit(False)), F.lit(r.code)) for r in selected]
    return F.array_compact(F.array(*broken))


def normalise(df: DataFrame) -> DataFrame:
    """Bring values that may legally vary into their one stored form.

    Anonymous formula by descending amount, descriptive formula without ones,
    last_modified at midnight. Malformed formulas are left for the rules.
    """
    return df.withColumns(
        {
            "chemical_formula_anonymous": F.coalesce(
                chem.normalise_anonymous(F.col("chemical_formula_anonymous")),
                F.col("chemical_formula_anonymous"),
            ),
            "chemical_formula_descriptive": chem.normalise_descriptive(
                F.col("chemical_formula_descriptive")
            ),
            "last_modified": F.date_trunc("day", "last_modified"),
        }
    )


def realign_ratios(df: DataFrame, elements: str = "elements", ratios: str = "elements_ratios") -> DataFrame:
    """Sort (element, ratio) pairs alphabetically by element."""
    pairs = F.array_sort(F.arrays_zip(F.col(elements).alias("e"), F.col(ratios).alias("r")))
    zipped = df.withColumn("_pairs", pairs)
    return zipped.withColumns(
        {elements: F.col("_pairs.e"), ratios: F.col("_pairs.r")}
    ).drop("_pairs")


def classify(
    df: DataFrame,
    frames: bool = False,
    families: Sequence[str] | None = None,
    extra: Sequence[Rule] = (),
    barrier: bool = True,
) -> DataFrame:
    """Normalise and add ``reasons``.

    ``families`` restricts the rules used, ``extra`` adds source-specific ones.
    Filters stay above the counts taken here; ``barrier=False`` leaves them out,
    so that a later filter on ``source`` or ``functional`` reaches the scan.
    """
    chosen = [
        r
        for r in rules()
        if (r.frames if frames else r.structures) and (families is None or r.family in families)
    ]
    judged = normalise(df).withColumn(REASONS, reasons([*chosen, *extra]))
    if not barrier:
        return judged
    # The counts also keep filters on ``reasons`` above this point. Pushed below,
    # such a filter would repeat the work of every column the rules look at.
    bad = F.count(F.when(F.size(REASONS) > 0, 1))
    return judged.observe(f"quality_{uuid4().hex}", F.count(F.lit(1)).alias("rows"), bad.alias("rejected"))


def widen_to_document(df: DataFrame, document: Sequence[str], bounded: bool = False) -> DataFrame:
    """Reject all outputs of a source document when one of them is bad.

    Rows that were good themselves get the reason ``document_rejected``. The
    keys of bad documents are joined back, which holds for documents of any
    size but reads ``df`` twice, so it is written to scratch first. ``bounded``
    says that a document's rows fit a task, as when one input row produced
    them; a window then does it in one pass, without an exchange where rows
    are partitioned by document.
    """
    if bounded:
        whole = Window.partitionBy(*document)
        marked = df.withColumn("_bad", F.max(F.when(F.size(REASONS) > 0, True)).over(whole))
    else:
        df = scratch.materialise(df)
        bad = df.where(F.size(REASONS) > 0).select(*document).distinct()
        marked = join_per_key(df, bad.withColumn("_bad", F.lit(True)), document, "left")
    spoilt = F.col("_bad").isNotNull() & (F.size(REASONS) == 0)
    return marked.withColumn(
        REASONS, F.when(spoilt, F.array(F.lit("document_rejected"))).otherwise(F.col(REASONS))
    ).drop("_bad")


def accepted(df: DataFrame) -> DataFrame:
    return df.where(F.size(REASONS) == 0).drop(REASONS)


def rejected(df: DataFrame) -> DataFrame:
    return df.where(F.size(REASONS) > 0)


def reject_counts(df: DataFrame) -> DataFrame:
    """How many rows break each rule."""
    return df.select(F.explode(REASONS).alias("reason")).groupBy("reason").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def observed(df: DataFrame, name: str = "quality") -> tuple[DataFrame, Observation]:
    """Count good and bad rows as a side effect of the job that writes them."""
    watch = Observation(name)
    bad = F.size(REASONS) > 0
    return (
        df.observe(
            watch,
            F.count(F.lit(1)).alias("rows"),
            F.count(F.when(bad, 1)).alias("rejected"),
        ),
        watch,
    )


class TooManyRejects(RuntimeError):
    """A run rejected a larger share of its rows than it may."""


def written_within(df: DataFrame, bad: Column, most: float | None) -> DataFrame:
    """``df`` written to scratch and read back, if at most the share ``most`` of its rows is ``bad``.

    Rows are counted as they are written, so nothing is read twice, and a run
    that stops here has not touched any table. None sets no bound.
    """
    watch = Observation(f"rejects_{uuid4().hex}")
    counts = F.count(F.lit(1)).alias("rows"), F.count(F.when(bad, 1)).alias("rejected")
    held = scratch.materialise(df.observe(watch, *counts))
    seen = watch.get
    if most is not None and seen["rejected"] > most * seen["rows"]:
        raise TooManyRejects(f"{seen['rejected']} of {seen['rows']} rows rejected, more than a share of {most}")
    return held
