"""Trajectory frames, per-site arrays and geometry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from crystalflow.functions import arrays, chem
from crystalflow.operators import frames, segments
from crystalflow.plans import dump
from crystalflow.queries import Tables, query, roles


@query(
    f"""WITH {roles.FRAMES}
    SELECT event_id, trajectory, date_diff('day', TIMESTAMP '2024-01-01', ts) AS relaxation_number,
           row_number() OVER (PARTITION BY trajectory ORDER BY ts, event_id) - 1 AS relaxation_step
    FROM v_frames WHERE energy IS NOT NULL"""
)
def frame_index(t: Tables) -> DataFrame:
    numbered = frames.number_frames(
        roles.frames(t), ["trajectory"], roles.FRAME_ORDER, valid=F.col("energy").isNotNull()
    )
    return numbered.select(
        "event_id",
        "trajectory",
        F.datediff("ts", F.lit("2024-01-01")).cast("bigint").alias("relaxation_number"),
        "relaxation_step",
    )


@query(
    """WITH calcs AS (
      SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
             unnest(range(len(string_split(text, chr(10))))) AS calc_no FROM documents),
    steps AS (
      SELECT doc_id, calc_no, unnest(string_split(line, ' ')) AS word,
             unnest(range(len(string_split(line, ' ')))) AS step_pos FROM calcs)
    SELECT doc_id, count(*) AS n_steps, max(calc_no) + 1 AS n_calcs, max(step_pos) + 1 AS longest,
           CAST(sum((calc_no + 1) * (step_pos + 1) * length(word)) AS BIGINT) AS weight
    FROM steps GROUP BY doc_id"""
)
def frame_explode(t: Tables) -> DataFrame:
    """Lines as calculations, words as their steps, both positions kept."""
    calcs = F.transform(F.split("text", "\n"), lambda line: F.struct(F.split(line, " ").alias("steps")))
    steps = frames.explode_relaxations(t.documents.select("doc_id", "text"), calcs, "steps", ["text", "calc"])
    weight = (F.col("relaxation_number") + 1) * (F.col("step_pos") + 1) * F.length("step")
    return steps.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_steps"),
        (F.max("relaxation_number") + 1).cast("bigint").alias("n_calcs"),
        (F.max("step_pos") + 1).cast("bigint").alias("longest"),
        F.sum(weight.cast("bigint")).alias("weight"),
    )


_USABLE = f"""{roles.FRAMES},
usable AS (
  SELECT *, energy / nsites AS per_site,
         last_value(energy / nsites) OVER w AS last_energy, row_number() OVER v AS back
  FROM v_frames WHERE energy IS NOT NULL AND forces IS NOT NULL
  WINDOW w AS (PARTITION BY trajectory ORDER BY ts, event_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING),
         v AS (PARTITION BY trajectory ORDER BY ts DESC, event_id DESC))"""


@query(
    f"""WITH {_USABLE}
    SELECT event_id, trajectory, per_site FROM usable
    WHERE back > 1 AND per_site - last_energy <= 1.0"""
)
def convergence_filter(t: Tables) -> DataFrame:
    kept = frames.convergence_filter(roles.frames(t), ["trajectory"], roles.FRAME_ORDER)
    return kept.select(
        "event_id", "trajectory", (F.col("energy") / F.col("nsites")).alias("per_site")
    )


@query(
    f"""WITH {_USABLE}
    SELECT event_id, trajectory, per_site FROM usable
    WHERE per_site - last_energy <= 1.0"""
)
def convergence_filter_with_final(t: Tables) -> DataFrame:
    kept = frames.convergence_filter(
        roles.frames(t), ["trajectory"], roles.FRAME_ORDER, keep_final=True
    )
    return kept.select(
        "event_id", "trajectory", (F.col("energy") / F.col("nsites")).alias("per_site")
    )


@query(
    f"""WITH {roles.FRAMES},
    ends AS (
      SELECT trajectory, trajectory_number, energy / nsites AS last_energy FROM (
        SELECT *, row_number() OVER (PARTITION BY trajectory, trajectory_number ORDER BY ts DESC, event_id DESC) AS r
        FROM v_frames) WHERE r = 1),
    kept AS (
      SELECT e.trajectory, e.trajectory_number
      FROM ends e JOIN ends p ON p.trajectory = e.trajectory AND p.trajectory_number = 0
      WHERE e.trajectory_number = 0 OR abs(e.last_energy - p.last_energy) <= 0.02)
    SELECT event_id, trajectory, trajectory_number FROM v_frames JOIN kept USING (trajectory, trajectory_number)"""
)
def close_to_primary(t: Tables) -> DataFrame:
    kept = frames.close_to_primary(roles.frames(t), ["trajectory"], roles.FRAME_ORDER)
    return kept.select("event_id", "trajectory", "trajectory_number")


@query(
    f"""WITH {roles.FRAMES},
    own AS (
      SELECT *, CASE WHEN event_type IN ('purchase', 'view') THEN energy - nsites END AS corrected,
             sum(CASE WHEN energy IS NULL THEN 1 ELSE 0 END) OVER (
               PARTITION BY trajectory ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island
      FROM v_frames),
    carried AS (
      SELECT *, first_value(corrected - energy IGNORE NULLS) OVER (
               PARTITION BY trajectory, island ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS c FROM own)
    SELECT event_id, trajectory,
           CASE WHEN energy IS NOT NULL THEN coalesce(energy + c, corrected) END AS energy_corrected
    FROM carried"""
)
def carry_forward(t: Tables) -> DataFrame:
    own = roles.frames(t).withColumn(
        "energy_corrected",
        F.when(F.col("event_type").isin("purchase", "view"), F.col("energy") - F.col("nsites")),
    )
    carried = frames.carry_correction(own, ["trajectory"], roles.FRAME_ORDER)
    return carried.select("event_id", "trajectory", "energy_corrected")


_STEPS = f"""{roles.CALCULATIONS},
stepped AS (
  SELECT *, sum(nsteps) OVER (w ROWS UNBOUNDED PRECEDING) AS output_step,
         row_number() OVER w - 1 AS relaxation_number,
         last_value(l_suppkey) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_output
  FROM v_calculations WINDOW w AS (PARTITION BY entry_id ORDER BY {roles.LINE_ORDER_SQL}))"""


@query(
    f"""WITH {_STEPS}
    SELECT entry_id, l_linenumber, l_partkey, l_suppkey, l_shipdate::DATE::VARCHAR AS shipped,
           CAST(output_step AS BIGINT) AS output_step, last_output
    FROM stepped"""
)
def cumulative_steps(t: Tables) -> DataFrame:
    narrow = roles.calculations(t).select("entry_id", *roles.LINE_ORDER, "nsteps")  # all of it is written and joined
    stepped = frames.cumulative_steps(narrow, ["entry_id"], roles.LINE_ORDER).drop("nsteps")
    named = frames.last_value(stepped, ["entry_id"], roles.LINE_ORDER, "l_suppkey", "last_output")
    return named.select(
        "entry_id",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        roles.day("l_shipdate").alias("shipped"),
        "output_step",
        "last_output",
    )


@query(
    f"""WITH {_STEPS}
    SELECT entry_id, relaxation_number, 'input' AS role, l_partkey AS structure_id, CAST(0 AS BIGINT) AS step
    FROM stepped WHERE relaxation_number = 0
    UNION ALL
    SELECT entry_id, relaxation_number, 'output', l_suppkey, CAST(output_step AS BIGINT) FROM stepped"""
)
def frame_union(t: Tables) -> DataFrame:
    # number and step count in one pass
    sums = {"number": F.lit(1).cast("bigint"), "output_step": F.col("nsteps").cast("bigint")}
    summed = segments.running_sum(roles.calculations(t), ["entry_id"], roles.LINE_ORDER, sums)
    stepped = summed.withColumn("relaxation_number", F.col("number") - 1)

    def frame(role: str, structure: str, step: Column) -> Column:
        return F.struct(
            F.lit(role).alias("role"), F.col(structure).alias("structure_id"), step.alias("step")
        )

    both = frames.input_and_output_frames(
        stepped,
        F.col("relaxation_number") == 0,
        frame("input", "l_partkey", F.lit(0).cast("bigint")),
        frame("output", "l_suppkey", F.col("output_step")),
    )
    return both.select("entry_id", "relaxation_number", "frame.*")


_SITE = "CAST(round(l_discount * 100) AS BIGINT)"


@query(
    f"""WITH sites AS (
      SELECT l_orderkey, count(*) AS n_atoms, max(l_linenumber) AS nsites,
             string_agg(l_returnflag, '|' ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate) AS species,
             string_agg({_SITE}, '|' ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate) AS xs,
             bool_or(l_tax = 0) AS force_missing, bool_or(l_discount = 0) AS charge_missing
      FROM lineitem GROUP BY l_orderkey)
    SELECT l_orderkey AS structure_id, n_atoms, n_atoms = nsites AS complete,
           species, xs, NOT force_missing AS has_forces, NOT charge_missing AS has_charges
    FROM sites"""
)
def site_arrays(t: Tables) -> DataFrame:
    """Per-structure arrays of every structure, and whether the count is the declared one."""
    line = t.lineitem
    atoms = line.select(
        F.struct(*roles.LINE_ORDER).alias("id"),
        F.col("l_orderkey").alias("structure_id"),
        F.col("l_returnflag").alias("element_id"),
        F.round(F.col("l_discount") * 100).cast("bigint").alias("x"),
        F.lit(0).cast("bigint").alias("y"),
        F.lit(0).cast("bigint").alias("z"),
        F.when(F.col("l_tax") != 0, F.col("l_tax")).alias("fx"),
        F.lit(0.0).alias("fy"),
        F.lit(0.0).alias("fz"),
        F.when(F.col("l_discount") != 0, F.col("l_discount")).alias("charge"),
    )
    structures = line.groupBy(F.col("l_orderkey").alias("id")).agg(
        F.max("l_linenumber").alias("nsites"), F.count(F.lit(1)).alias("n_atoms")
    )
    sites = dump.site_arrays(atoms).withColumnRenamed("structure_id", "id")
    return structures.join(sites, "id", "left").select(
        F.col("id").alias("structure_id"),
        "n_atoms",
        (F.col("n_atoms") == F.col("nsites")).alias("complete"),
        F.array_join("species_at_sites", "|").alias("species"),
        F.array_join(F.transform("fractional", lambda p: p[0].cast("string")), "|").alias("xs"),
        F.col("forces").isNotNull().alias("has_forces"),
        F.col("charges").isNotNull().alias("has_charges"),
    )


_LINE_KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate::DATE::VARCHAR AS shipped"


def _line_key(*extra):
    return [
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        roles.day("l_shipdate").alias("shipped"),
        *extra,
    ]


@query(
    f"""SELECT {_LINE_KEY},
           round(l_discount * 4.0 + l_tax * 0.5 + (l_quantity / 50) * 0.25, 6) AS x,
           round(l_discount * 0.0 + l_tax * 3.0 + (l_quantity / 50) * 0.125, 6) AS y,
           round(l_discount * 0.0 + l_tax * 0.0 + (l_quantity / 50) * 5.0, 6) AS z
    FROM lineitem"""
)
def frac_to_cart(t: Tables) -> DataFrame:
    lattice = F.array(
        *[F.array(*[F.lit(v) for v in row]) for row in ((4.0, 0.0, 0.0), (0.5, 3.0, 0.0), (0.25, 0.125, 5.0))]
    )
    point = F.array("l_discount", "l_tax", F.col("l_quantity") / 50)
    placed = t.lineitem.withColumn("at", arrays.frac_to_cart(F.array(point), lattice)[0])
    return placed.select(
        *_line_key(*[F.round(F.col("at")[i], 6).alias(axis) for i, axis in enumerate("xyz")])
    )


@query(
    f"""SELECT {_LINE_KEY}, l_quantity AS m00, l_tax AS m01, l_discount AS m02,
           l_tax AS m10, l_extendedprice AS m11, l_quantity * 2 AS m12,
           l_discount AS m20, l_quantity * 2 AS m21, l_quantity * 3 AS m22
    FROM lineitem"""
)
def voigt(t: Tables) -> DataFrame:
    matrix = arrays.voigt_to_matrix(
        F.col("l_quantity"),
        F.col("l_extendedprice"),
        F.col("l_quantity") * 3,
        F.col("l_quantity") * 2,
        F.col("l_discount"),
        F.col("l_tax"),
    )
    return t.lineitem.withColumn("m", matrix).select(
        *_line_key(*[F.col("m")[i][j].alias(f"m{i}{j}") for i in range(3) for j in range(3)])
    )


@query(
    """WITH holed AS (
      SELECT vec_id, list_transform(embedding, lambda v: CASE WHEN abs(v) >= 0.0005 THEN v END) AS vals
      FROM embeddings)
    SELECT vec_id,
           CASE WHEN len(list_filter(vals, lambda v: v IS NULL)) = 0 THEN len(vals) END AS n_values,
           CASE WHEN len(list_filter(vals, lambda v: v IS NULL)) = 0 THEN 2 END AS n_rows
    FROM holed"""
)
def null_if_any_null(t: Tables) -> DataFrame:
    """Tiny components count as missing; a vector or matrix with one is dropped."""
    holed = t.embeddings.select(
        "vec_id", F.transform("embedding", lambda v: F.when(F.abs(v) >= 0.0005, v)).alias("vals")
    )
    half = F.floor(F.size("vals") / 2).cast("int")
    matrix = F.array(
        F.slice("vals", F.lit(1), half), F.slice("vals", half + 1, F.size("vals") - half)
    )
    size = lambda c: F.when(c.isNotNull(), F.size(c)).cast("bigint")
    return holed.select(
        "vec_id",
        size(arrays.null_if_any_null(F.col("vals"))).alias("n_values"),
        size(arrays.matrix_null_if_any_null(matrix)).cast("int").alias("n_rows"),
    )


@query(
    f"""SELECT {_LINE_KEY}, -l_extendedprice / 1000 * l_quantity AS energy FROM lineitem"""
)
def energy_extensive(t: Tables) -> DataFrame:
    return t.lineitem.select(
        *_line_key(chem.extensive(-F.col("l_extendedprice") / 1000, "l_quantity").alias("energy"))
    )
