"""Compositions, formulas, compatibility flags and composition corrections."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from crystalflow import schema as S
from crystalflow.functions import chem, text
from crystalflow.operators import correction
from crystalflow.operators.export import json_with_nulls
from crystalflow.queries import Tables, query, roles

_COMPOSED = f"""{roles.FORMULAS},
v_reduced AS (
  SELECT c.*, g, CASE WHEN len(list_filter(ns, lambda n: n <> g)) = 0
                       AND array_to_string(els, '') IN ('H', 'O', 'CsO') THEN 2 ELSE 1 END AS f
  FROM v_composition c JOIN v_gcd USING (p_partkey)),
v_smallest AS (SELECT *, list_transform(ns, lambda n: n // g * f) AS small FROM v_reduced)"""

_REDUCED_FORMULA = """array_to_string(list_transform(range(len(els)),
  lambda i: els[i + 1] || CASE WHEN small[i + 1] = 1 THEN '' ELSE small[i + 1]::VARCHAR END), '')"""
_ANONYMOUS = """array_to_string(list_transform(range(len(ns)),
  lambda i: chr(CAST(65 + i AS INTEGER)) || CASE WHEN list_reverse_sort(ns)[i + 1] // g = 1 THEN ''
            ELSE (list_reverse_sort(ns)[i + 1] // g)::VARCHAR END), '')"""


def _sites(t: Tables) -> DataFrame:
    """Parts with their atoms listed one by one."""
    sites = F.flatten(F.zip_with("els", "ns", lambda e, n: F.array_repeat(e, n.cast("int"))))
    return roles.formulas(t).withColumn("sites", sites)


def _names(values) -> str:
    """A list of names in SQL."""
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


@query(
    f"""WITH {_COMPOSED}
    SELECT p_partkey, array_to_string(els, ',') AS elements, len(els) AS nelements,
           CAST(total AS BIGINT) AS n_atoms, {_REDUCED_FORMULA} AS formula_reduced,
           array_to_string(list_transform(ns,
             lambda n: CAST(round(n / total * 1000000) AS BIGINT)::VARCHAR), ',') AS ratios
    FROM v_smallest"""
)
def composition(t: Tables) -> DataFrame:
    parts = _sites(t).withColumn("composition", chem.composition_of_sites(F.col("sites")))
    reduced = chem.reduced(F.col("composition"))
    scaled = F.transform(
        chem.ratios(reduced), lambda r: F.round(r * 1000000).cast("bigint").cast("string")
    )
    return parts.select(
        "p_partkey",
        F.array_join(chem.element_names(F.col("composition")), ",").alias("elements"),
        F.size("composition").cast("bigint").alias("nelements"),
        F.size("sites").cast("bigint").alias("n_atoms"),
        chem.reduced_formula(reduced).alias("formula_reduced"),
        F.array_join(scaled, ",").alias("ratios"),
    )


@query(f"WITH {_COMPOSED} SELECT p_partkey, {_REDUCED_FORMULA} AS formula_reduced FROM v_smallest")
def formula_reparse(t: Tables) -> DataFrame:
    return roles.formulas(t).select(
        "p_partkey", chem.reduced_formula_of_text(F.col("formula")).alias("formula_reduced")
    )


@query(
    f"""WITH {_COMPOSED}
    SELECT p_partkey, s.from_composition,
           CASE WHEN f.p_size <> 1 THEN array_to_string(list_transform(range(len(f.ns)),
             lambda i: chr(CAST(65 + i AS INTEGER)) || CASE WHEN list_reverse_sort(f.ns)[i + 1] = 1 THEN ''
                       ELSE list_reverse_sort(f.ns)[i + 1]::VARCHAR END), '') END AS from_text
    FROM (SELECT p_partkey, {_ANONYMOUS} AS from_composition FROM v_smallest) s
    JOIN v_formulas f USING (p_partkey)"""
)
def anonymous_formula(t: Tables) -> DataFrame:
    """Anonymous formulas, computed and re-ordered; size-1 parts spell theirs wrongly."""
    parts = _sites(t)
    spelled = F.array_join(
        F.transform("ns", lambda n, i: F.concat(F.char(F.lit(65) + i), n.cast("string"))), ""
    )
    stated = F.when(F.col("p_size") == 1, F.lower(spelled)).otherwise(spelled)
    return parts.select(
        "p_partkey",
        chem.anonymous_formula(chem.composition_of_sites(F.col("sites"))).alias("from_composition"),
        chem.normalise_anonymous(stated).alias("from_text"),
    )


@query(
    f"""WITH {roles.FORMULAS},
    scale(el, x) AS (VALUES ('Al', 1.61), ('Cs', 0.79), ('Fe', 1.83), ('H', 2.20), ('O', 3.44),
                            ('Si', 1.90), ('V', 1.63), ('Yb', 1.10)),
    by_scale AS (
      SELECT p_partkey, string_agg(el || CASE WHEN n = 1 THEN '' ELSE n::VARCHAR END, ' ' ORDER BY x) AS ordered
      FROM v_elements JOIN scale USING (el) GROUP BY p_partkey)
    SELECT p_partkey, ordered,
           array_to_string(list_transform(range(len(els)),
             lambda i: els[i + 1] || CASE WHEN ns[i + 1] = 1 THEN '' ELSE ns[i + 1]::VARCHAR END), ' ') AS normalised
    FROM v_formulas JOIN by_scale USING (p_partkey)"""
)
def descriptive_formula(t: Tables) -> DataFrame:
    parts = _sites(t)
    return parts.select(
        "p_partkey",
        chem.descriptive_formula(chem.composition_of_sites(F.col("sites"))).alias("ordered"),
        chem.normalise_descriptive(F.col("formula")).alias("normalised"),
    )


@query(
    f"""WITH {roles.FORMULAS}
    SELECT p_partkey, '[' || array_to_string(list_transform(els, lambda e:
        '{{"mass":null,"name":"' || e || '","attached":null,"nattached":null,"concentration":[1.0],'
        || '"original_name":null,"chemical_symbols":["' || e || '"]}}'), ',') || ']' AS species
    FROM v_formulas"""
)
def species_json(t: Tables) -> DataFrame:
    return roles.formulas(t).select(
        "p_partkey", json_with_nulls(chem.species(F.col("els"))).alias("species")
    )


@query(
    f"""WITH {roles.FORMULAS}
    SELECT p_partkey, NOT list_has_any(els, {_names(S.INCOMPATIBLE_ELEMENTS["mp"])}) AS mp,
           NOT list_has_any(els, {_names(S.INCOMPATIBLE_ELEMENTS["alexandria"])}) AS alexandria,
           NOT list_has_any(els, {_names(S.INCOMPATIBLE_ELEMENTS["oqmd"])}) AND p_size >= 25 AS oqmd
    FROM v_formulas"""
)
def cross_compat(t: Tables) -> DataFrame:
    """Blocklists per source; oqmd also asks for spin polarisation (size 25 up)."""
    settings = F.when(F.col("p_size") >= 25, "{'ispin': 2}").otherwise("{'ispin': 1}")
    return roles.formulas(t).select(
        "p_partkey",
        chem.cross_compatible(F.col("els"), "mp").alias("mp"),
        chem.cross_compatible(F.col("els"), "alexandria").alias("alexandria"),
        (chem.cross_compatible(F.col("els"), "oqmd") & text.spin_polarised(settings)).alias("oqmd"),
    )


_BASE = {"Al": -0.11, "Fe": -0.27, "H": -0.18, "O": -0.69, "Si": 0.07}
_HUBBARD = {"Fe": -2.25, "V": -1.7}


def _values(table: dict[str, float]) -> str:
    return ", ".join(f"('{k}', {v!r}::DOUBLE)" for k, v in table.items())


@query(
    f"""WITH {roles.FORMULAS},
    base(el, c) AS (VALUES {_values(_BASE)}), hub(el, c) AS (VALUES {_values(_HUBBARD)}),
    parts AS (
      SELECT p_partkey, els, CASE WHEN p_size > 1 THEN -p_retailprice END AS energy,
             CASE WHEN p_size < 40 THEN 'pbe' ELSE 'scan' END AS functional,
             CASE WHEN p_size < 20 THEN 'alexandria' ELSE 'mp' END AS source
      FROM v_formulas),
    sums AS (
      SELECT p_partkey, sum(n * coalesce(base.c, 0)) AS plain,
             sum(n * CASE WHEN list_contains({_names(S.HUBBARD_ELEMENTS)}, el) THEN coalesce(hub.c, 0)
                          ELSE coalesce(base.c, 0) END) AS with_u
      FROM v_elements LEFT JOIN base USING (el) LEFT JOIN hub USING (el) GROUP BY p_partkey)
    SELECT p_partkey, functional, source, round(CASE
             WHEN energy IS NULL OR functional <> 'pbe' THEN energy
             WHEN list_has_any(els, {_names(S.UNCORRECTABLE_ELEMENTS)}) THEN NULL
             WHEN list_contains({_names(S.NO_VANADIUM_SOURCES)}, source) AND list_contains(els, 'V') THEN NULL
             WHEN list_has_any(els, {_names(S.HUBBARD_ANIONS)}) THEN energy + with_u
             ELSE energy + plain END, 6) AS energy_corrected
    FROM parts JOIN sums USING (p_partkey)"""
)
def composition_correction(t: Tables) -> DataFrame:
    parts = _sites(t).select(
        "p_partkey",
        "sites",
        F.when(F.col("p_size") > 1, -F.col("p_retailprice")).alias("energy"),
        F.when(F.col("p_size") < 40, "pbe").otherwise("scan").alias("functional"),
        F.when(F.col("p_size") < 20, "alexandria").otherwise("mp").alias("source"),
    )
    corrected = correction.corrected_energy(
        F.col("energy"),
        F.col("functional"),
        F.col("source"),
        chem.composition_of_sites(F.col("sites")),
        _BASE,
        _HUBBARD,
    )
    return parts.select(
        "p_partkey", "functional", "source", F.round(corrected, 6).alias("energy_corrected")
    )
