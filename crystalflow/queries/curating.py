"""Whole source jobs over the supplied tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from crystalflow import schema as S
from crystalflow.operators import quality
from crystalflow.plans import dump, materials, vendor
from crystalflow.queries import Tables, query, roles
from crystalflow.queries.reading import vendor_documents

_UNIT = [[4.0, 0.0, 0.0], [0.0, 4.0, 0.0], [0.0, 0.0, 4.0]]
_CALM = [[0.01, 0.0, 0.0], [0.0, 0.0, 0.0]]


def _matrix(rows) -> Column:
    return F.array(*[F.array(*[F.lit(v) for v in row]) for row in rows])


def _structure_doc(*symbols: str) -> Column:
    sites = [
        F.struct(
            F.array(F.struct(F.lit(s).alias("element"), F.lit(1.0).alias("occu"))).alias("species"),
            F.array(F.lit(0.25 * i), F.lit(0.0), F.lit(0.0)).alias("abc"),
            F.lit(None).cast("array<double>").alias("xyz"),
            F.struct(F.lit(0.1).alias("magmom")).alias("properties"),
        )
        for i, s in enumerate(symbols)
    ]
    return F.struct(F.struct(_matrix(_UNIT).alias("matrix")).alias("lattice"), F.array(*sites).alias("sites"))


def typed_materials(t: Tables) -> DataFrame:
    """Orders as typed material documents; pending ones hold caesium."""
    metal = F.when(F.col("o_orderstatus") == "P", "Cs").otherwise("Al")
    facts = t.orders.select(
        F.concat(F.lit("mp-"), F.col("o_orderkey").cast("string")).alias("material_id"),
        F.array(metal, F.lit("O")).alias("elements"),
        F.lit(2).alias("nelements"),
        F.create_map(F.lit("O"), F.lit(1.0), metal, F.lit(1.0)).alias("composition_reduced"),
        F.lit("AB").alias("formula_anonymous"),
        _structure_doc("Al", "O").alias("structure"),
        F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("$date")).alias("build_date"),
    )
    named = roles.material_documents(t)
    joined = facts.join(named, "material_id")
    return joined.withColumn(
        "builder_meta", F.struct("build_date", F.col("builder_meta.license").alias("license"))
    ).drop("build_date")


def typed_tasks(t: Tables) -> DataFrame:
    """Customers as typed task documents of two calculations each."""
    nation = F.col("c_nationkey")

    def step(i: Column, calc: int) -> Column:
        energy = -F.col("c_acctbal") / 1000 - i * 0.25 - calc * 0.125
        start = F.when((i == 0) & (nation > 15) & (F.lit(calc) == 0), F.lit(5.0)).otherwise(F.lit(0.0))
        return F.struct(
            F.when(~((i == 1) & (nation == 7)), energy + start).alias("e_fr_energy"),
            F.when(~((i == 0) & (nation == 8)), _matrix(_CALM)).alias("forces"),
            _matrix(_UNIT).alias("stress"),
            _structure_doc("Al", "O").alias("structure"),
            F.array_repeat(F.lit("x"), i + 3).alias("electronic_steps"),
        )

    def calc(steps: Column, number: int) -> Column:
        ionic = F.transform(F.sequence(F.lit(0), steps - 1), lambda i: step(i, number))
        return F.struct(F.struct(ionic.alias("ionic_steps")).alias("output"))

    nelm = F.when(nation < 5, 5).when(nation == 6, 4).otherwise(60)
    parameters = F.struct(
        nelm.alias("NELM"),
        (nation < 12).alias("LASPH"),
        F.when(F.col("c_mktsegment") == "MACHINERY", 2).otherwise(1).alias("ISPIN"),
    )
    present = F.array(*[F.lit(k) for k in materials.REQUIRED_OUTPUT])
    return t.customer.select(
        F.concat(F.lit("t-"), F.col("c_custkey").cast("string")).alias("task_id"),
        F.when(F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING"), S.STATIC)
        .otherwise(S.STRUCTURE_OPTIMIZATION)
        .alias("task_type"),
        F.lit(2).alias("nsites"),
        F.struct(F.lit("2024-03-12").alias("$date")).alias("last_updated"),
        F.create_map(F.lit("O"), F.lit(1.0), F.lit("Al"), F.lit(1.0)).alias("composition_reduced"),
        F.array(F.lit("Al"), F.lit("O")).alias("elements"),
        F.lit(2).alias("nelements"),
        F.lit("AB").alias("formula_anonymous"),
        F.struct(F.when(nation != 24, parameters).alias("parameters")).alias("input"),
        F.struct(
            (-F.col("c_acctbal")).alias("energy"),
            _matrix(_CALM).alias("forces"),
            _matrix(_UNIT).alias("stress"),
            F.lit(0.5).alias("bandgap"),
            F.lit(1.5).alias("efermi"),
            F.struct(F.lit(0.25).alias("total_magnetization")).alias("magnetization"),
            _structure_doc("Al", "O").alias("structure"),
        ).alias("output"),
        F.array(calc(nation % 4 + 1, 0), calc(F.lit(2), 1)).alias("calcs_reversed"),
        F.when(nation == 23, F.array_remove(present, "forces")).otherwise(present).alias("output_keys"),
    )


_TASKS = f"""{roles.MATERIAL_DOCUMENTS},
v_ctasks AS (
  SELECT 't-' || c_custkey AS task_id, c_nationkey AS nation, c_acctbal,
         CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 0 ELSE 1 END AS not_static,
         CASE WHEN c_nationkey = 24 THEN 0 ELSE CAST(c_nationkey < 12 AS INTEGER)
              + CASE WHEN c_mktsegment = 'MACHINERY' THEN 2 ELSE 1 END END AS score,
         CASE WHEN c_nationkey = 24 THEN NULL WHEN c_nationkey < 5 THEN 5 WHEN c_nationkey = 6 THEN 4 ELSE 60 END AS nelm
  FROM customer),
v_candidates AS (
  SELECT r.*, t.* EXCLUDE (task_id),
         CASE split_part(calc_type, ' ', 1) WHEN 'GGA' THEN 'pbe' WHEN 'GGA+U' THEN 'pbe' WHEN 'PBEsol' THEN 'pbesol'
              WHEN 'r2SCAN' THEN 'r2scan' END AS functional
  FROM v_references r JOIN v_ctasks t USING (task_id) WHERE r.task_type IN ('Static', 'Structure Optimization'))"""
_PREFERENCE = "not_static, -score, -c_acctbal / 2, task_pos"


@query(
    f"""WITH {_TASKS},
    best AS (
      SELECT *, nation IN (6, 23, 24) AS bad FROM (
        SELECT *, row_number() OVER (PARTITION BY material_id, functional ORDER BY {_PREFERENCE}) AS r
        FROM v_candidates WHERE functional IS NOT NULL) WHERE r = 1),
    judged AS (SELECT *, bool_or(bad) OVER (PARTITION BY material_id) AS falls FROM best)
    SELECT j.material_id || '-' || functional AS id, -c_acctbal AS energy,
           CASE WHEN functional <> 'pbe' THEN -c_acctbal END AS energy_corrected,
           o.o_orderstatus <> 'P' AS cross_compatibility,
           strftime(o.o_orderdate, '%Y-%m-%d') AS last_modified,
           CASE WHEN nation = 23 THEN 'targets_missing' WHEN nation IN (6, 24) THEN 'electronic_steps_exhausted'
                WHEN falls THEN 'document_rejected' ELSE '' END AS reasons
    FROM judged j JOIN orders o ON j.material_id = 'mp-' || o.o_orderkey"""
)
def curate_material_structures(t: Tables) -> DataFrame:
    """Best tasks as structures; a bad functional takes its material along."""
    rows = materials.curate_structures(typed_materials(t), typed_tasks(t))
    return rows.select(
        "id",
        "energy",
        "energy_corrected",
        "cross_compatibility",
        F.date_format("last_modified", "yyyy-MM-dd").alias("last_modified"),
        F.array_join("reasons", ",").alias("reasons"),
    )


@query(
    f"""WITH {_TASKS},
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY material_id, functional ORDER BY {_PREFERENCE}) - 1 AS number
      FROM v_candidates JOIN (SELECT material_id, prio FROM v_labelled) l USING (material_id)
      WHERE functional IS NOT NULL AND task_type = 'Structure Optimization' AND l.prio <> '5'),
    steps AS (
      SELECT *, 0 AS calc, unnest(range(nation % 4 + 1)) AS i FROM ranked
      UNION ALL SELECT *, 1, unnest(range(2)) FROM ranked),
    frames AS (
      SELECT *, row_number() OVER (PARTITION BY material_id, functional, number ORDER BY calc, i) - 1 AS step,
             CASE WHEN NOT (i = 1 AND nation = 7) THEN -c_acctbal / 1000 - i * 0.25::DOUBLE - calc * 0.125::DOUBLE
               + CASE WHEN i = 0 AND nation > 15 AND calc = 0 THEN 5.0::DOUBLE ELSE 0.0::DOUBLE END END AS energy,
             i = 0 AND nation = 8 AS no_forces
      FROM steps WHERE (nelm IS NULL OR i + 3 <> nelm) AND NOT (i = 0 AND nation = 8)),
    usable AS (
      SELECT *, last_value(energy / 2) OVER w AS last_energy, last_value(step) OVER w AS last_step
      FROM frames WHERE energy IS NOT NULL AND NOT no_forces
      WINDOW w AS (PARTITION BY material_id, functional, number ORDER BY step
                   ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
    converged AS (SELECT * FROM usable WHERE energy / 2 - last_energy <= 1.0 AND step < last_step),
    ends AS (
      SELECT material_id, functional, number, arg_max(energy / 2, step) AS e
      FROM converged GROUP BY ALL),
    close AS (
      SELECT a.material_id, a.functional, a.number FROM ends a
      JOIN ends p ON a.material_id = p.material_id AND a.functional = p.functional AND p.number = 0
      WHERE a.number = 0 OR abs(a.e - p.e) <= 0.02)
    SELECT material_id || '-' || number || '-' || functional || '-' || step AS id, energy,
           calc AS relaxation_number, CAST(step AS INTEGER) AS relaxation_step
    FROM converged JOIN close USING (material_id, functional, number)"""
)
def curate_material_trajectories(t: Tables) -> DataFrame:
    kept, _ = materials.curate_trajectories(typed_materials(t), typed_tasks(t))
    return kept.select("id", "energy", "relaxation_number", "relaxation_step")


@query(
    f"""WITH {roles.FORMULAS},
    docs AS (
      SELECT p_partkey, els, p_size, p_retailprice,
             p_size > 3 AND p_size <> 5
               AND sqrt(0.05::DOUBLE * 0.05::DOUBLE + (p_retailprice / 20000) * (p_retailprice / 20000)) <= 0.1 AS ok
      FROM v_formulas),
    outputs AS (
      SELECT *, CASE WHEN p_size > 25 THEN 'pbesol' ELSE 'pbe' END AS functional, -p_retailprice AS energy
      FROM docs WHERE ok
      UNION ALL SELECT *, 'scan', -p_retailprice - 1 FROM docs WHERE ok AND p_size > 40)
    SELECT 'agm-' || p_partkey || '-' || functional AS id, energy,
           CASE WHEN functional <> 'pbe' THEN energy END AS energy_corrected,
           NOT list_contains(els, 'Yb') AS cross_compatibility, array_to_string(list_sort(els), ',') AS elements
    FROM outputs"""
)
def curate_vendor_structures(t: Tables) -> DataFrame:
    rows = quality.accepted(vendor.curate_structures(vendor_documents(t)))
    return rows.select(
        "id",
        "energy",
        "energy_corrected",
        "cross_compatibility",
        F.array_join("elements", ",").alias("elements"),
    )


_LETTERS = ["Al", "Ca", "Fe", "H", "O", "Si", "V"]


def snapshot(t: Tables) -> dict[str, DataFrame]:
    """Orders as dump structures, their lines as atoms, customers as calculations.

    An order declares as many sites as its highest line number; where lines
    repeat or are missing the two disagree.
    """
    letters = F.array(*[F.lit(e) for e in _LETTERS])
    atoms = t.lineitem.select(
        F.struct(*roles.LINE_ORDER).alias("id"),
        F.col("l_orderkey").alias("structure_id"),
        F.get(letters, F.col("l_linenumber") - 1).alias("element_id"),
        F.col("l_discount").alias("x"),
        F.col("l_tax").alias("y"),
        (F.col("l_quantity") / 50).alias("z"),
        F.lit(0.01).alias("fx"),
        F.when(F.col("l_tax") != 0, 0.0).alias("fy"),
        F.lit(0.0).alias("fz"),
        F.when(F.col("l_discount") != 0, F.col("l_discount")).alias("charge"),
    )
    per_element = atoms.groupBy("structure_id", "element_id").agg(F.count(F.lit(1)).alias("n"))
    # at most one row per element is collected
    formula = per_element.groupBy(F.col("structure_id").alias("id")).agg(
        F.array_sort(
            F.collect_list(F.concat("element_id", F.col("n").cast("string")))
        ).alias("terms")
    )
    declared = t.lineitem.groupBy(F.col("l_orderkey").alias("id")).agg(F.max("l_linenumber").alias("nsites"))
    lattice = {f"{a}{i + 1}": F.lit(_UNIT[i][j]) for i in range(3) for j, a in enumerate("xyz")}
    stress = {c: F.lit(0.5) for c in ("sxx", "syy", "szz", "syz", "szx", "sxy")}
    orders = t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_custkey")).alias("entry_id"),
        F.lit(None).cast("double").alias("magmom"),
        F.lit(None).cast("double").alias("energy"),
    )
    structures = orders.join(declared, "id").join(formula, "id").select(
        "*",
        F.array_join("terms", " ").alias("composition_id"),
        F.size("terms").alias("ntypes"),
        *[c.alias(k) for k, c in {**lattice, **stress}.items()],
    )
    calculations = t.customer.select(
        F.col("c_custkey").alias("entry_id"),
        F.when(F.col("c_nationkey") < 20, "static").otherwise("relaxation").alias("label"),
        F.when(F.col("c_acctbal") > 0, -F.col("c_acctbal") / 1000).alias("energy_pa"),
        F.lit(0.25).alias("band_gap"),
        F.when(F.col("c_mktsegment") == "BUILDING", "{'ispin': 1}").otherwise("{'ispin': 2}").alias("settings"),
        F.col("c_custkey").alias("input_id"),
        F.col("c_custkey").alias("output_id"),
    )
    return {"structures": structures, "calculations": calculations, "atoms": atoms}


@query(
    """WITH letters AS (
      SELECT l_orderkey, ['Al', 'Ca', 'Fe', 'H', 'O', 'Si', 'V'][l_linenumber] AS el, count(*) AS n,
             bool_or(l_tax = 0) AS no_force, bool_or(l_discount = 0) AS no_charge
      FROM lineitem GROUP BY 1, 2),
    sites AS (
      SELECT l_orderkey, list(el ORDER BY el) AS els, list(n ORDER BY el) AS ns, CAST(sum(n) AS BIGINT) AS n_atoms,
             bool_or(no_force) AS no_force, bool_or(no_charge) AS no_charge
      FROM letters GROUP BY 1),
    declared AS (SELECT l_orderkey, max(l_linenumber) AS nsites FROM lineitem GROUP BY 1),
    divided AS (
      SELECT l_orderkey, max(d) AS g FROM (SELECT l_orderkey, ns, unnest(range(1, list_min(ns) + 1)) AS d FROM sites)
      WHERE len(list_filter(ns, lambda n: n % d <> 0)) = 0 GROUP BY 1),
    small AS (
      SELECT *, list_transform(ns, lambda n: n // g * CASE WHEN array_to_string(els, '') IN ('H', 'O', 'HO') AND
                  len(list_filter(ns, lambda m: m <> g)) = 0 THEN 2 ELSE 1 END) AS rs
      FROM sites JOIN divided USING (l_orderkey) JOIN declared USING (l_orderkey) WHERE n_atoms = nsites)
    SELECT 'oqmd-' || o_orderkey || '-pbe' AS id, -c_acctbal / 1000 * nsites AS energy,
           array_to_string(list_transform(range(len(els)),
             lambda i: els[i + 1] || CASE WHEN rs[i + 1] = 1 THEN '' ELSE rs[i + 1]::VARCHAR END), '') AS formula,
           array_to_string(list_transform(range(len(els)),
             lambda i: els[i + 1] || CASE WHEN ns[i + 1] = 1 THEN '' ELSE ns[i + 1]::VARCHAR END), ' ') AS descriptive,
           c_mktsegment <> 'BUILDING' AND NOT list_has_any(els, ['Ca', 'V']) AS cross_compatibility,
           NOT no_force AS has_forces, NOT no_charge AS has_charges
    FROM small JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
    WHERE o_orderpriority <> '1-URGENT' AND c_nationkey < 20 AND c_acctbal > 0"""
)
def curate_dump_structures(t: Tables) -> DataFrame:
    rows = quality.accepted(dump.curate_structures(snapshot(t)))
    return rows.select(
        "id",
        "energy",
        F.col("chemical_formula_reduced").alias("formula"),
        F.col("chemical_formula_descriptive").alias("descriptive"),
        "cross_compatibility",
        F.col("forces").isNotNull().alias("has_forces"),
        F.col("charges").isNotNull().alias("has_charges"),
    )


@query(
    f"""WITH {roles.CALCULATIONS},
    relax AS (
      SELECT *, CASE label WHEN 'relaxation' THEN 1 WHEN 'coarse_relax' THEN 2 ELSE 3 END AS label_no
      FROM v_calculations WHERE label IN ('relaxation', 'coarse_relax', 'fine_relax')
        AND entry_id IN (SELECT o_orderkey FROM orders WHERE o_orderpriority <> '1-URGENT')),
    sound AS (
      SELECT * FROM relax WHERE entry_id NOT IN (
        SELECT entry_id FROM relax GROUP BY entry_id
        HAVING count(*) > count(DISTINCT label) OR bool_or(input_id IS NULL OR output_id IS NULL))),
    ends AS (SELECT entry_id, count(*) AS n, arg_max(converged, label_no) AS ok FROM sound GROUP BY entry_id)
    SELECT entry_id, label, row_number() OVER w - 1 AS relaxation_number,
           CAST(sum(nsteps) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS output_step,
           last_value(output_id) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_output_id
    FROM sound JOIN ends USING (entry_id) WHERE n = 1 OR ok
    WINDOW w AS (PARTITION BY entry_id ORDER BY label_no)"""
)
def dump_relaxations(t: Tables) -> DataFrame:
    """Relaxations of an entry, ready to become frames."""
    entries = t.orders.where("o_orderpriority <> '1-URGENT'").select(F.col("o_orderkey").alias("id"))
    usable = dump.relaxations(entries, roles.calculations(t))
    return usable.select("entry_id", "label", "relaxation_number", "output_step", "last_output_id")


@query(
    f"""WITH sites AS (
      SELECT l_orderkey AS k, count(*) AS n, bool_or(l_tax = 0) AS no_force,
             string_agg(['Al', 'Ca', 'Fe', 'H', 'O', 'Si', 'V'][l_linenumber], '|' ORDER BY {roles.LINE_ORDER_SQL}) AS species
      FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders) GROUP BY 1),
    entries AS (
      SELECT o_orderkey AS input, o_orderkey + 1 AS output, -o_totalprice / 100000 AS energy FROM orders
      WHERE o_orderkey IN (SELECT k FROM sites) AND o_orderkey + 1 IN (SELECT k FROM sites)),
    frames AS (
      SELECT input, output, s.*, -4.0::DOUBLE AS energy, 0 AS step FROM entries JOIN sites s ON k = input
      UNION ALL SELECT input, output, s.*, energy, 3 FROM entries JOIN sites s ON k = output),
    usable AS (
      SELECT *, arg_max(energy / n, step) OVER (PARTITION BY input) AS last FROM frames WHERE NOT no_force)
    SELECT 'oqmd-' || output || '-pbe-' || step AS id, energy, 0 AS relaxation_number, step AS relaxation_step,
           CAST(n AS INTEGER) AS nsites, species, 0.01::DOUBLE * n AS total_force
    FROM usable WHERE energy / n - last <= 1.0"""
)
def curate_dump_trajectories(t: Tables) -> DataFrame:
    """Orders as entries that relax into the next order's structure, which may declare other site counts."""
    given = snapshot(t)
    given["structures"] = given["structures"].withColumn("energy", F.lit(-4.0))
    given["entries"] = t.orders.select(F.col("o_orderkey").alias("id"))
    given["calculations"] = t.orders.select(
        F.col("o_orderkey").alias("entry_id"),
        F.lit("relaxation").alias("label"),
        (-F.col("o_totalprice") / 100000).alias("energy"),
        F.lit("{'ispin': 2}").alias("settings"),
        F.col("o_orderkey").alias("input_id"),
        (F.col("o_orderkey") + 1).alias("output_id"),
        F.lit(3).alias("nsteps"),
        F.lit(True).alias("converged"),
    )
    kept, _ = dump.curate_trajectories(given, keep_final=True)
    return kept.select(
        "id",
        "energy",
        "relaxation_number",
        "relaxation_step",
        "nsites",
        F.array_join("species_at_sites", "|").alias("species"),
        F.aggregate("forces", F.lit(0.0), lambda total, f: total + f[0] + f[1] + f[2]).alias("total_force"),
    )


@query(
    """WITH steps AS (
      SELECT p_partkey, p_size, path, unnest(range(4)) AS step FROM part, (VALUES ('pbe'), ('scan')) AS files(path)),
    frames AS (
      SELECT *, -p_size - step * 0.5::DOUBLE - CASE path WHEN 'scan' THEN 0.125::DOUBLE ELSE 0.0::DOUBLE END
                + CASE WHEN step = 0 AND p_size < 10 THEN 8.0::DOUBLE ELSE 0.0::DOUBLE END AS energy
      FROM steps WHERE NOT (path = 'pbe' AND p_size = 20))
    SELECT 'agm-' || p_partkey || '-' || path || '-' || step AS id, energy,
           CASE path WHEN 'scan' THEN energy END AS energy_corrected, CAST(step // 2 AS INTEGER) AS relaxation_number,
           CAST(step AS INTEGER) AS relaxation_step
    FROM frames WHERE step < 3 AND NOT (step = 0 AND p_size < 10)"""
)
def curate_vendor_trajectories(t: Tables) -> DataFrame:
    """Every id in a pbe and in a scan file; a bad pbe frame leaves the scan one alone."""
    size = F.col("p_size")

    def step(path: str, number: int) -> Column:
        start = F.when((size < 10) & F.lit(number == 0), 8.0).otherwise(0.0)
        stress = F.when((size == 20) & F.lit(path == "pbe"), _matrix(_UNIT[:2])).otherwise(_matrix(_UNIT))
        return F.struct(
            _structure_doc("Al", "O").alias("structure"),
            (start - size - number * 0.5 - (0.125 if path == "scan" else 0.0)).alias("energy"),
            _matrix(_CALM).alias("forces"),
            stress.alias("stress"),
        )

    def file(path: str) -> DataFrame:
        halves = [F.struct(F.lit(path).alias("functional"), F.array(*[step(path, k) for k in ks]).alias("steps")) for ks in ((0, 1), (2, 3))]
        return t.part.select(
            F.concat(F.lit("agm-"), F.col("p_partkey").cast("string")).alias("id"),
            F.array(*halves).alias("relaxations"),
            F.lit(path).alias("path"),
            F.current_timestamp().alias("last_modified"),
        )

    kept, _ = vendor.curate_trajectories(file("pbe").unionByName(file("scan")))
    return kept.select("id", "energy", "energy_corrected", "relaxation_number", "relaxation_step")
