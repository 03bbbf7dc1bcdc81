"""Pieces every source's job shares."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T

from crystalflow import schema as S
from crystalflow.functions import arrays, chem
from crystalflow.operators import correction, quality

#: documents of a task: their frames take some 30 kB each while they are sorted
DOCUMENTS_PER_TASK = 8_000


@dataclass(frozen=True)
class Coefficients:
    """Per-element energy-correction coefficients, in eV per atom."""

    base: Mapping[str, float] = field(default_factory=dict)
    hubbard: Mapping[str, float] = field(default_factory=dict)


def site_species(structure: Column) -> Column:
    """Element per site; null where a site is shared by several species."""
    return F.transform(
        structure["sites"],
        lambda s: F.when(F.size(s["species"]) == 1, F.get(s["species"], F.lit(0))["element"]),
    )


def geometry(structure: Column) -> dict[str, Column]:
    """Lattice, positions and species of a structure document."""
    lattice = structure["lattice"]["matrix"]
    fractional = F.transform(structure["sites"], lambda s: s["abc"])
    computed = arrays.frac_to_cart(fractional, lattice)
    stored = F.transform(structure["sites"], lambda s: s["xyz"])
    positions = F.zip_with(stored, computed, lambda xyz, cart: F.coalesce(xyz, cart))
    return {
        "lattice_vectors": lattice,
        "cartesian_site_positions": positions,
        "species_at_sites": site_species(structure),
        "nsites": F.size(structure["sites"]),
    }


def with_compositions(df: DataFrame, species_at_sites: Column) -> DataFrame:
    """Add the composition of the sites, plain and reduced, for ``chemistry_of_sites``."""
    counted = df.withColumn("_composition", chem.composition_of_sites(species_at_sites))
    return counted.withColumn("_reduced", chem.reduced(F.col("_composition")))


def chemistry_of_sites() -> dict[str, Column]:
    """Composition columns derived from what ``with_compositions`` added."""
    composition, reduced = F.col("_composition"), F.col("_reduced")
    elements = chem.element_names(composition)
    return {
        "elements": elements,
        "nelements": F.size(elements),
        "elements_ratios": chem.ratios(reduced),
        "species": chem.species(elements),
        "chemical_formula_anonymous": chem.anonymous_formula(composition),
        "chemical_formula_reduced": chem.reduced_formula(reduced),
        "chemical_formula_descriptive": chem.descriptive_formula(composition),
    }


def periodicity() -> dict[str, Column]:
    return {
        "dimension_types": F.array(F.lit(1), F.lit(1), F.lit(1)),
        "nperiodic_dimensions": F.lit(3),
    }


def fill(df: DataFrame, columns: Mapping[str, Column], target: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Project to ``target``'s columns and types; those not given are null.

    ``keep`` columns travel along, prefixed with an underscore where they would
    clash with the target.
    """
    extras = [F.col(k).alias(f"_{k}" if k in target.fieldNames() else k) for k in keep]
    return df.select(
        *extras,
        *[
            columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.fields
        ],
    )


def own_correction(df: DataFrame, coefficients: Coefficients | None) -> DataFrame:
    """Fill missing corrected energies from the composition of the sites.

    Without coefficients, pbe energies cannot be corrected and stay null.
    """
    composition = chem.composition_of_sites(F.col("species_at_sites"))
    energy, functional = F.col("energy"), F.col("functional")
    if coefficients is None:
        computed = F.when(functional != "pbe", energy)
    else:
        computed = correction.corrected_energy(
            energy,
            functional,
            F.col("source"),
            composition,
            coefficients.base,
            coefficients.hubbard,
        )
    return df.withColumn("energy_corrected", F.coalesce("energy_corrected", computed))


def structures_checked(
    df: DataFrame, document: list[str] | None, extra: list[quality.Rule] | None = None
) -> DataFrame:
    """Classified structures; ``document`` names the key whose rows fall together.

    A document yields at most one row per functional, so the group is bounded.
    """
    classified = quality.classify(df, extra=extra or [])
    return quality.widen_to_document(classified, document, bounded=True) if document else classified


FRAME_COLUMNS = [f.name for f in S.FRAME.fields]
STRUCTURE_COLUMNS = [f.name for f in S.STRUCTURE.fields]
