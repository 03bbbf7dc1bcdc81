"""Data-quality rules over parts written out as full curated records."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from crystalflow import schema as S
from crystalflow.functions import chem
from crystalflow.operators import quality
from crystalflow.plans import common
from crystalflow.queries import Tables, query, roles


def records(t: Tables) -> DataFrame:
    """One curated record per part; most part sizes carry one kind of defect."""
    size = F.col("p_size")
    total = F.aggregate("ns", F.lit(0).cast("bigint"), lambda acc, n: acc + n).cast("int")
    parts = roles.formulas(t).withColumn("total", total)
    sites = F.flatten(F.zip_with("els", "ns", lambda e, n: F.array_repeat(e, n.cast("int"))))
    null_if = lambda when, value: F.when(~when, value)

    def rows_of(vector, count):
        return F.array_repeat(F.array(*vector), count)

    three = [F.lit(0.1), F.lit(0.2), F.lit(0.3)]
    unit = lambda n: F.array(
        *[F.array(*[F.lit(1.0 if i == j else 0.0) for j in range(n)]) for i in range(n)]
    )
    force = [F.lit(0.05), F.col("p_retailprice") / 12000, F.lit(0.0)]
    columns = {
        "id": F.when(size == 1, "").otherwise(F.concat(F.lit("p-"), F.col("p_partkey").cast("string"))),
        "source": F.when(size == 2, "elsewhere").otherwise("mp"),
        "elements": F.col("els"),
        "nelements": F.size("els") + (size == 3).cast("int"),
        "elements_ratios": F.transform(
            "ns", lambda n: n / F.col("total") * F.when(size == 4, 0.9).otherwise(1.0)
        ),
        "nsites": F.when(size == 5, 0).otherwise(F.col("total")),
        "cartesian_site_positions": F.when(size == 6, rows_of(three[:2], F.col("total"))).otherwise(
            rows_of(three, F.col("total"))
        ),
        "lattice_vectors": F.when(size == 7, F.slice(unit(3), 1, 2)).otherwise(unit(3)),
        "species_at_sites": F.when(size == 8, F.transform(sites, lambda s: F.lit("Xx"))).otherwise(sites),
        "species": chem.species(F.col("els")),
        "chemical_formula_anonymous": F.when(size == 16, "AB?").otherwise("A2B5C3"),
        "chemical_formula_reduced": F.when(size == 17, F.concat(F.lit("("), F.col("formula"), F.lit(")")))
        .otherwise(F.replace("formula", F.lit(" "), F.lit(""))),
        "chemical_formula_descriptive": F.when(size == 18, F.lower("formula")).otherwise(F.col("formula")),
        "dimension_types": F.when(size == 9, F.array(F.lit(1), F.lit(1), F.lit(0))).otherwise(
            F.array(F.lit(1), F.lit(1), F.lit(1))
        ),
        "nperiodic_dimensions": F.when(size == 10, 2).otherwise(3),
        "immutable_id": F.concat(F.lit("p-"), F.col("p_partkey").cast("string")),
        "last_modified": null_if(size == 11, F.lit("2024-01-01 12:00:00").cast("timestamp")),
        "stress_tensor": F.when(size == 12, unit(2)).when(size > 12, unit(3)),
        "forces": rows_of(force, F.when(size == 13, F.col("total") - 1).otherwise(F.col("total"))),
        "magnetic_moments": F.when(size == 14, F.array().cast("array<double>")).when(
            size > 14, F.array_repeat(F.lit(0.5), F.col("total"))
        ),
        "functional": F.when(size == 15, "INVALID").when(size != 20, "pbe"),
        "cross_compatibility": null_if(size == 19, F.lit(True)),
        "space_group_it_number": size * 10,
    }
    return common.fill(parts, columns, S.STRUCTURE, keep=("p_partkey",))


_RECORDS = f"""{roles.FORMULAS},
v_base AS (
  SELECT *, CAST(list_sum(ns) AS INTEGER) AS total,
         flatten(list_transform(range(len(els)),
           lambda i: list_transform(range(ns[i + 1]), lambda j: els[i + 1]))) AS sites
  FROM v_formulas),
v_records AS (
  SELECT p_partkey, p_size,
         CASE WHEN p_size = 1 THEN '' ELSE 'p-' || p_partkey END AS id,
         CASE WHEN p_size = 2 THEN 'elsewhere' ELSE 'mp' END AS source,
         els AS elements, len(els) + CASE WHEN p_size = 3 THEN 1 ELSE 0 END AS nelements,
         list_transform(ns, lambda n: n / total * CASE WHEN p_size = 4 THEN 0.9::DOUBLE ELSE 1.0::DOUBLE END)
           AS elements_ratios,
         CASE WHEN p_size = 5 THEN 0 ELSE total END AS nsites,
         list_transform(range(total),
           lambda i: CASE WHEN p_size = 6 THEN [0.1, 0.2] ELSE [0.1, 0.2, 0.3] END) AS positions,
         CASE WHEN p_size = 7 THEN [[1, 0, 0], [0, 1, 0]] ELSE [[1, 0, 0], [0, 1, 0], [0, 0, 1]] END AS lattice,
         CASE WHEN p_size = 8 THEN list_transform(sites, lambda s: 'Xx') ELSE sites END AS species_at_sites,
         CASE WHEN p_size = 16 THEN 'AB?' ELSE 'A2B5C3' END AS anonymous,
         CASE WHEN p_size = 17 THEN '(' || formula || ')' ELSE replace(formula, ' ', '') END AS reduced,
         regexp_replace(CASE WHEN p_size = 18 THEN lower(formula) ELSE formula END,
                        '([A-Z][a-z]?)1\\b', '\\1', 'g') AS descriptive,
         CASE WHEN p_size = 9 THEN [1, 1, 0] ELSE [1, 1, 1] END AS dimension_types,
         CASE WHEN p_size = 10 THEN 2 ELSE 3 END AS nperiodic,
         CASE WHEN p_size <> 11 THEN TIMESTAMP '2024-01-01' END AS last_modified,
         CASE WHEN p_size = 12 THEN [[1, 0], [0, 1]]
              WHEN p_size > 12 THEN [[1, 0, 0], [0, 1, 0], [0, 0, 1]] END AS stress,
         list_transform(range(CASE WHEN p_size = 13 THEN total - 1 ELSE total END),
           lambda i: [0.05::DOUBLE, p_retailprice / 12000, 0.0::DOUBLE]) AS forces,
         CASE WHEN p_size = 14 THEN [] WHEN p_size > 14
              THEN list_transform(range(total), lambda i: 0.5) END AS moments,
         CASE WHEN p_size = 15 THEN 'INVALID' WHEN p_size <> 20 THEN 'pbe' END AS functional, p_size * 10 AS space_group
  FROM v_base)"""

_TEXT = """concat_ws(',',
  CASE WHEN length(id) < 1 THEN 'text_empty:id' END,
  CASE WHEN source NOT IN ('alexandria', 'mp', 'oqmd') THEN 'source_known' END,
  CASE WHEN functional NOT IN ('pbe', 'pbesol', 'scan', 'r2scan') THEN 'functional_known' END,
  CASE WHEN p_size = 19 THEN 'cross_compatibility_missing' END,
  CASE WHEN list_contains(species_at_sites, 'Xx') THEN 'site_symbols_valid' END,
  CASE WHEN NOT regexp_matches(anonymous, '^([A-Z][0-9]*)+$') THEN 'anonymous_formula_form' END,
  CASE WHEN NOT regexp_matches(descriptive,
    '^([A-Z][a-z]?([2-9][0-9]*|1[0-9]+)?)(\\s+[A-Z][a-z]?([2-9][0-9]*|1[0-9]+)?)*$') THEN 'descriptive_formula_form' END,
  CASE WHEN regexp_matches(reduced, '[()]') THEN 'reduced_formula_parentheses' END,
  CASE WHEN regexp_matches(reduced, '[A-Z][a-z]?1([^0-9]|$)') THEN 'reduced_formula_ones' END,
  CASE WHEN NOT regexp_matches(reduced, '^([A-Z][a-z]?[0-9]*)+$') THEN 'reduced_formula_form' END,
  CASE WHEN last_modified IS NULL THEN 'last_modified_date' END)"""
_WRONG_VECTORS = "len(list_filter({0}, lambda v: len(v) <> 3)) > 0"
_SHAPE = f"""concat_ws(',',
  CASE WHEN len(forces) = 0 THEN NULL END,
  CASE WHEN {_WRONG_VECTORS.format('positions')} THEN 'positions_3_vectors' END,
  CASE WHEN {_WRONG_VECTORS.format('forces')} THEN 'forces_3_vectors' END,
  CASE WHEN len(stress) <> 3 OR {_WRONG_VECTORS.format('stress')} THEN 'stress_3x3' END,
  CASE WHEN len(lattice) <> 3 OR {_WRONG_VECTORS.format('lattice')} THEN 'lattice_3x3' END,
  CASE WHEN elements <> list_sort(elements) THEN 'elements_sorted' END,
  CASE WHEN dimension_types <> [1, 1, 1] THEN 'dimension_types_periodic' END,
  CASE WHEN len(moments) = 0 THEN 'optional_empty:magnetic_moments' END,
  CASE WHEN len(forces) = 0 THEN 'optional_empty:forces' END)"""
_RANGE = """concat_ws(',',
  CASE WHEN nelements <= 0 THEN 'nelements_positive' END,
  CASE WHEN nsites <= 0 THEN 'nsites_positive' END,
  CASE WHEN abs(list_sum(elements_ratios) - 1) > 1e-5 THEN 'ratios_sum_to_one' END,
  CASE WHEN space_group NOT BETWEEN 1 AND 230 THEN 'space_group_range' END,
  CASE WHEN nperiodic <> 3 THEN 'three_periodic_dimensions' END,
  CASE WHEN len(forces) = 0 OR sqrt(forces[1][1] * forces[1][1] + forces[1][2] * forces[1][2]) > 0.1
       THEN 'forces_too_high' END)"""
_CROSS = """concat_ws(',',
  CASE WHEN len(elements) <> nelements OR len(elements_ratios) <> nelements
         OR len(string_split(descriptive, ' ')) <> nelements THEN 'element_counts_agree' END,
  CASE WHEN len(positions) <> nsites THEN 'site_count:cartesian_site_positions' END,
  CASE WHEN len(species_at_sites) <> nsites THEN 'site_count:species_at_sites' END,
  CASE WHEN len(forces) <> nsites THEN 'site_count:forces' END,
  CASE WHEN len(moments) <> nsites THEN 'site_count:magnetic_moments' END)"""


def _family(t: Tables, family: str) -> DataFrame:
    checked = quality.classify(records(t), families=[family])
    return checked.select("p_partkey", F.array_join(quality.REASONS, ",").alias("reasons"))


@query(f"WITH {_RECORDS} SELECT p_partkey, {_TEXT} AS reasons FROM v_records")
def quality_text(t: Tables) -> DataFrame:
    return _family(t, "text")


@query(f"WITH {_RECORDS} SELECT p_partkey, {_SHAPE} AS reasons FROM v_records")
def quality_shape(t: Tables) -> DataFrame:
    return _family(t, "shape")


@query(f"WITH {_RECORDS} SELECT p_partkey, {_RANGE} AS reasons FROM v_records")
def quality_range(t: Tables) -> DataFrame:
    return _family(t, "range")


@query(f"WITH {_RECORDS} SELECT p_partkey, {_CROSS} AS reasons FROM v_records")
def quality_cross(t: Tables) -> DataFrame:
    return _family(t, "cross")


_ALL = f"""{_RECORDS},
v_reasons AS (
  SELECT p_partkey, list_filter(string_split(concat_ws(',', nullif({_TEXT}, ''), nullif({_SHAPE}, ''),
           nullif({_RANGE}, ''), nullif({_CROSS}, '')), ','), lambda r: r <> '') AS reasons
  FROM v_records)"""


@query(
    f"""WITH {_ALL}
    SELECT reason, count(*) AS n_rows FROM (SELECT unnest(reasons) AS reason FROM v_reasons) GROUP BY reason"""
)
def quality_rejects(t: Tables) -> DataFrame:
    """How many records each rule rejects."""
    return quality.reject_counts(quality.classify(records(t)))


@query(
    f"""WITH {_ALL},
    docs AS (SELECT p_partkey // 2 AS document, count(*) FILTER (len(reasons) > 0) AS bad FROM v_reasons GROUP BY 1)
    SELECT p_partkey, len(reasons) = 0 AND bad = 0 AS accepted, len(reasons) = 0 AND bad > 0 AS fell_with_document
    FROM v_reasons JOIN docs ON p_partkey // 2 = document"""
)
def quality_scope(t: Tables) -> DataFrame:
    """Records fall together in pairs, the outputs of one source document."""
    checked = quality.classify(records(t)).withColumn("document", F.floor(F.col("p_partkey") / 2))
    scoped = quality.widen_to_document(checked, ["document"])
    return scoped.select(
        "p_partkey",
        (F.size(quality.REASONS) == 0).alias("accepted"),
        F.array_contains(quality.REASONS, "document_rejected").alias("fell_with_document"),
    )


@query(
    f"""WITH {roles.FORMULAS}
    SELECT p_partkey, array_to_string(list(el ORDER BY el), ',') AS elements,
           array_to_string(list(n::VARCHAR ORDER BY el), ',') AS amounts
    FROM v_elements GROUP BY p_partkey"""
)
def realign_ratios(t: Tables) -> DataFrame:
    aligned = quality.realign_ratios(roles.formulas(t), "els", "ns")
    return aligned.select(
        "p_partkey",
        F.array_join("els", ",").alias("elements"),
        F.array_join(F.transform("ns", lambda n: n.cast("string")), ",").alias("amounts"),
    )
