"""Task references, best-per-group selection, group rejection, lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from crystalflow import schema as S
from crystalflow.functions import text
from crystalflow.operators import selection
from crystalflow.operators.skew import join_per_key
from crystalflow.plans import dump, materials
from crystalflow.queries import Tables, query, roles


def _functional_tasks(t: Tables) -> DataFrame:
    return roles.tasks(t).withColumn("functional", text.functional_from_label(F.col("calc_type")))


_TASK_ORDER = f"not_static, neg_score, per_site, {roles.LINE_ORDER_SQL}"


@query(
    f"""WITH {roles.TASKS}
    SELECT material_id || '-' || functional AS id, task_id, task_type,
           per_site AS energy_per_site
    FROM (SELECT *, row_number() OVER (PARTITION BY material_id, functional ORDER BY {_TASK_ORDER}) AS r
          FROM v_ranked_tasks WHERE functional IS NOT NULL)
    WHERE r = 1"""
)
def best_task(t: Tables) -> DataFrame:
    best = selection.best_per_group(
        _functional_tasks(t).where(F.col("functional").isNotNull()),
        ["material_id", "functional"],
        [*selection.task_order(), *[F.col(c) for c in roles.LINE_ORDER]],
    )
    return best.select(
        F.concat_ws("-", "material_id", "functional").alias("id"),
        "task_id",
        "task_type",
        (F.col("energy") / F.col("nsites")).alias("energy_per_site"),
    )


@query(
    f"""WITH {roles.TASKS}
    SELECT material_id || '-' || functional AS id, task_id, calc_type
    FROM (SELECT *, row_number() OVER (PARTITION BY material_id, functional
            ORDER BY CASE split_part(calc_type, ' ', 1) WHEN 'GGA+U' THEN 0 ELSE 1 END, {_TASK_ORDER}) AS r
          FROM v_ranked_tasks WHERE functional IS NOT NULL)
    WHERE r = 1"""
)
def best_task_hubbard(t: Tables) -> DataFrame:
    best = selection.best_per_group(
        _functional_tasks(t).where(F.col("functional").isNotNull()),
        ["material_id", "functional"],
        [*selection.task_order(label="calc_type"), *[F.col(c) for c in roles.LINE_ORDER]],
    )
    return best.select(F.concat_ws("-", "material_id", "functional").alias("id"), "task_id", "calc_type")


@query(
    f"""WITH {roles.TASKS}
    SELECT material_id, functional, task_id,
           row_number() OVER (PARTITION BY material_id, functional ORDER BY {_TASK_ORDER}) - 1 AS trajectory_number
    FROM v_ranked_tasks WHERE functional IS NOT NULL"""
)
def rank_tasks(t: Tables) -> DataFrame:
    ranked = selection.rank_in_group(
        _functional_tasks(t).where(F.col("functional").isNotNull()),
        ["material_id", "functional"],
        [*selection.task_order(), *[F.col(c) for c in roles.LINE_ORDER]],
        keep=["material_id", "functional", "task_id"],
    )
    return ranked.select("material_id", "functional", "task_id", "trajectory_number")


_ALLOWED = "('Structure Optimization', 'Static')"


@query(
    f"""WITH {roles.MATERIAL_DOCUMENTS}
    SELECT material_id, task_pos, task_id, task_type, calc_type, segment
    FROM v_references JOIN v_task_table USING (task_id) WHERE task_type IN {_ALLOWED}"""
)
def material_tasks(t: Tables) -> DataFrame:
    named = selection.allowed_tasks(selection.explode_task_references(roles.material_documents(t)))
    return named.join(roles.task_table(t), "task_id").select(
        "material_id", "task_pos", "task_id", "task_type", "calc_type", "segment"
    )


@query(
    f"""WITH {roles.MATERIAL_DOCUMENTS},
    main AS (SELECT * FROM v_references WHERE task_type = 'Structure Optimization')
    SELECT material_id, task_id, task_type, calc_type FROM main
    UNION ALL
    SELECT material_id, task_id, task_type, calc_type FROM v_references
    WHERE task_type = 'Static' AND material_id NOT IN (SELECT material_id FROM main)"""
)
def task_fallback(t: Tables) -> DataFrame:
    references = selection.explode_task_references(roles.material_documents(t))
    return selection.allowed_or_static(references).select(
        "material_id", "task_id", "task_type", "calc_type"
    )


@query(
    f"""WITH {roles.MATERIAL_DOCUMENTS}
    SELECT material_id, task_id FROM v_references
    WHERE task_type IN {_ALLOWED} AND task_id NOT IN (SELECT task_id FROM v_task_table)"""
)
def missing_refs(t: Tables) -> DataFrame:
    named = selection.allowed_tasks(selection.explode_task_references(roles.material_documents(t)))
    return selection.missing_tasks(named, roles.task_table(t)).select("material_id", "task_id")


@query(
    f"""WITH {roles.MATERIAL_DOCUMENTS}
    SELECT material_id FROM v_labelled WHERE prio <> '5'"""
)
def license_filter(t: Tables) -> DataFrame:
    return materials.license_allows(roles.material_documents(t)).select("material_id")


# Structures are orders; several share the entry of their customer.
_STRUCTURES = """
v_structures AS (
  SELECT o_orderkey AS id, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS entry_id FROM orders)
"""


def _structures(t: Tables) -> DataFrame:
    entry = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey"))
    return t.orders.select(F.col("o_orderkey").alias("id"), entry.alias("entry_id"))


@query(
    f"""WITH {roles.CALCULATIONS}, {_STRUCTURES},
    first_static AS (
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entry_id ORDER BY {roles.LINE_ORDER_SQL}) AS r
                     FROM v_calculations WHERE label = 'static') WHERE r = 1)
    SELECT s.id, s.entry_id, c.nsteps, round(c.energy_pa * c.nsteps, 6) AS energy
    FROM v_structures s JOIN first_static c USING (entry_id) WHERE c.energy_pa IS NOT NULL"""
)
def entry_calcs(t: Tables) -> DataFrame:
    static = dump.label_calculations(roles.calculations(t), S.STATIC_LABELS)
    preferred = selection.best_per_group(static, ["entry_id"], ["label_no", *roles.LINE_ORDER])
    usable = preferred.where(F.col("energy_pa").isNotNull()).select("entry_id", "energy_pa", "nsteps")
    return join_per_key(_structures(t), usable, ["entry_id"]).select(
        "id", "entry_id", "nsteps", F.round(F.col("energy_pa") * F.col("nsteps"), 6).alias("energy")
    )


_PRIORITY = "CASE label WHEN 'relaxation' THEN 1 WHEN 'coarse_relax' THEN 2 ELSE 3 END"
_RELAX = "label IN ('relaxation', 'coarse_relax', 'fine_relax')"


@query(
    f"""WITH {roles.CALCULATIONS}
    SELECT entry_id, label, nsteps FROM (
      SELECT *, row_number() OVER (PARTITION BY entry_id ORDER BY {_PRIORITY}, {roles.LINE_ORDER_SQL}) AS r
      FROM v_calculations WHERE {_RELAX}) WHERE r = 1"""
)
def label_priority(t: Tables) -> DataFrame:
    labelled = dump.label_calculations(roles.calculations(t), S.RELAXATION_LABELS)
    first = selection.best_per_group(labelled, ["entry_id"], ["label_no", *roles.LINE_ORDER])
    return first.select("entry_id", "label", "nsteps")


@query(
    f"""WITH {roles.CALCULATIONS}, relax AS (SELECT * FROM v_calculations WHERE {_RELAX})
    SELECT entry_id, label, nsteps FROM relax
    WHERE entry_id NOT IN (SELECT entry_id FROM relax GROUP BY entry_id HAVING count(*) > count(DISTINCT label))"""
)
def reject_dup_labels(t: Tables) -> DataFrame:
    labelled = dump.label_calculations(roles.calculations(t), S.RELAXATION_LABELS)
    return selection.drop_duplicate_labels(labelled, ["entry_id"]).select("entry_id", "label", "nsteps")


@query(
    f"""WITH {roles.CALCULATIONS}
    SELECT entry_id, label, input_id, output_id FROM v_calculations
    WHERE entry_id NOT IN (SELECT entry_id FROM v_calculations WHERE input_id IS NULL OR output_id IS NULL)"""
)
def reject_null_refs(t: Tables) -> DataFrame:
    return selection.drop_null_references(roles.calculations(t), ["entry_id"]).select(
        "entry_id", "label", "input_id", "output_id"
    )


@query(
    f"""WITH {roles.CALCULATIONS},
    ends AS (
      SELECT entry_id, converged, count(*) OVER (PARTITION BY entry_id) AS n,
             row_number() OVER (PARTITION BY entry_id
               ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_shipdate DESC) AS r
      FROM v_calculations)
    SELECT entry_id, label, nsteps FROM v_calculations
    WHERE entry_id NOT IN (SELECT entry_id FROM ends WHERE r = 1 AND n > 1 AND NOT converged)"""
)
def reject_unconverged(t: Tables) -> DataFrame:
    kept = selection.drop_unconverged(roles.calculations(t), ["entry_id"], roles.LINE_ORDER)
    return kept.select("entry_id", "label", "nsteps")


_NELM = "CASE WHEN discount > 0.02 THEN 50 END"


@query(
    f"""WITH {roles.CALCULATIONS}
    SELECT entry_id, label, nsteps FROM v_calculations
    WHERE entry_id NOT IN (SELECT entry_id FROM v_calculations WHERE nsteps = {_NELM})"""
)
def reject_maxed_steps(t: Tables) -> DataFrame:
    nelm = F.when(F.col("discount") > 0.02, 50)
    maxed = selection.used_all_steps(F.col("nsteps"), nelm)
    return selection.drop_groups(roles.calculations(t), ["entry_id"], maxed).select(
        "entry_id", "label", "nsteps"
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')"""
)
def semi_by_ids(t: Tables) -> DataFrame:
    ids = t.orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("l_orderkey"))
    return selection.lookup(t.lineitem, ids, "l_orderkey").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"
    )


@query("SELECT event_id, event_type FROM events ORDER BY event_id LIMIT 400 OFFSET 300")
def slice_by_key(t: Tables) -> DataFrame:
    """A run's offset and limit, counted in key order."""
    return selection.slice_by_key(t.events.select("event_id", "event_type"), ["event_id"], 300, 400)


@query("SELECT event_type AS kind, count(*) AS n_rows FROM events GROUP BY event_type")
def count_by_kind(t: Tables) -> DataFrame:
    return selection.count_by_kind(t.events, "event_type")


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate::DATE::VARCHAR AS shipped,
           i.p_name AS input_name, i.p_size AS input_size, o.p_name AS output_name, o.p_size AS output_size
    FROM lineitem JOIN part i ON l_partkey = i.p_partkey JOIN part o ON l_suppkey = o.p_partkey"""
)
def double_role_join(t: Tables) -> DataFrame:
    structures = t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_size").alias("size"))
    calcs = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_partkey").alias("input_id"),
        F.col("l_suppkey").alias("output_id"),
        roles.day("l_shipdate").alias("shipped"),
    )
    joined = selection.join_roles(calcs, structures)
    return joined.select(
        "l_orderkey",
        "l_linenumber",
        F.col("input_id").alias("l_partkey"),
        F.col("output_id").alias("l_suppkey"),
        "shipped",
        "input_name",
        "input_size",
        "output_name",
        "output_size",
    )
