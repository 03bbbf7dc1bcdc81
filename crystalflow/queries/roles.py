"""Role views: supplied tables as crystal-structure tables, in Spark and in SQL.

Each view exists twice, as a DataFrame function and as the text of a SQL
common table expression, and both must stay the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from crystalflow.queries import Tables


def text_key(*names: str) -> Column:
    return F.concat_ws("-", *[F.col(n).cast("string") for n in names])


def day(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


# Ties are broken by these; together with the order key they name one line.
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
LINE_ORDER_SQL = "l_linenumber, l_partkey, l_suppkey, l_shipdate"


def tasks(t: Tables) -> DataFrame:
    """Order lines as the finished calculation tasks of material ``l_orderkey``."""
    label = (
        F.when(F.col("l_returnflag") == "A", "GGA Static")
        .when(F.col("l_returnflag") == "N", "GGA+U Structure Optimization")
        .otherwise("r2SCAN Static")
    )
    return t.lineitem.select(
        F.concat(F.lit("mp-"), F.col("l_orderkey").cast("string")).alias("material_id"),
        F.concat(
            text_key("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
            F.date_format("l_shipdate", "-yyyyMMdd"),
        ).alias("task_id"),
        label.alias("calc_type"),
        F.when(F.col("l_linestatus") == "F", "Static").otherwise("Structure Optimization").alias("task_type"),
        (-F.col("l_extendedprice")).alias("energy"),
        F.col("l_quantity").cast("int").alias("nsites"),
        (F.col("l_tax") > 0.04).alias("lasph"),
        F.when(F.col("l_discount") < 0.05, 2).otherwise(1).alias("ispin"),
        *LINE_ORDER,
    )


TASKS = """
v_tasks AS (
  SELECT 'mp-' || l_orderkey AS material_id,
         l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey
           || strftime(l_shipdate, '-%Y%m%d') AS task_id,
         CASE l_returnflag WHEN 'A' THEN 'GGA Static' WHEN 'N' THEN 'GGA+U Structure Optimization'
              ELSE 'r2SCAN Static' END AS calc_type,
         CASE l_linestatus WHEN 'F' THEN 'Static' ELSE 'Structure Optimization' END AS task_type,
         -l_extendedprice AS energy, CAST(l_quantity AS INTEGER) AS nsites,
         l_tax > 0.04 AS lasph, CASE WHEN l_discount < 0.05 THEN 2 ELSE 1 END AS ispin,
         l_linenumber, l_partkey, l_suppkey, l_shipdate
  FROM lineitem),
v_ranked_tasks AS (
  SELECT *, CASE split_part(calc_type, ' ', 1) WHEN 'GGA' THEN 'pbe' WHEN 'GGA+U' THEN 'pbe'
              WHEN 'PBEsol' THEN 'pbesol' WHEN 'SCAN' THEN 'scan' WHEN 'r2SCAN' THEN 'r2scan' END AS functional,
         CASE task_type WHEN 'Static' THEN 0 ELSE 1 END AS not_static,
         -(CAST(lasph AS INTEGER) + ispin) AS neg_score, energy / nsites AS per_site
  FROM v_tasks)
"""


def frames(t: Tables) -> DataFrame:
    """Events as frames: a user's events, by time, are one trajectory.

    An error event has no energy, a signup no forces.
    """
    k = F.get_json_object("props", "$.k").cast("int")
    kinds = F.array(*[F.lit(x) for x in ("view", "signup", "error", "purchase", "click")])
    return t.events.select(
        F.col("user_id").alias("trajectory"),
        "ts",
        "event_id",
        "event_type",
        F.when(F.col("event_type") != "error", -F.col("value")).alias("energy"),
        F.when(F.col("event_type") != "signup", F.col("value")).alias("forces"),
        (k + 1).alias("nsites"),
        (F.array_position(kinds, F.col("event_type")) - 1).cast("int").alias("trajectory_number"),
    )


FRAMES = """
v_frames AS (
  SELECT user_id AS trajectory, ts, event_id, event_type,
         CASE WHEN event_type <> 'error' THEN -value END AS energy,
         CASE WHEN event_type <> 'signup' THEN value END AS forces,
         CAST(json_extract_string(props, '$.k') AS INTEGER) + 1 AS nsites,
         CASE event_type WHEN 'view' THEN 0 WHEN 'signup' THEN 1 WHEN 'error' THEN 2
              WHEN 'purchase' THEN 3 ELSE 4 END AS trajectory_number
  FROM events)
"""
FRAME_ORDER = ["ts", "event_id"]

# Eight elements; a part takes one to four of them, three places apart.
PALETTE = ["Al", "Cs", "Fe", "H", "O", "Si", "V", "Yb"]


def formulas(t: Tables) -> DataFrame:
    """Parts as compositions: elements, counts and the formula they spell."""
    palette = F.array(*[F.lit(e) for e in PALETTE])
    index = F.sequence(F.lit(0), (F.col("p_partkey") % 4).cast("int"))
    elements = F.transform(index, lambda i: F.get(palette, ((F.col("p_partkey") + i * 3) % 8).cast("int")))
    counts = F.transform(index, lambda i: (1 + (F.col("p_size") + i * 5) % 6).cast("bigint"))
    base = t.part.select("p_partkey", "p_size", "p_type", "p_retailprice", elements.alias("els"), counts.alias("ns"))
    terms = F.zip_with("els", "ns", lambda e, n: F.concat(e, n.cast("string")))
    return base.withColumn("formula", F.array_join(terms, " "))


FORMULAS = """
v_formulas AS (
  SELECT *, array_to_string(list_transform(range(len(els)), lambda i: els[i + 1] || ns[i + 1]), ' ') AS formula
  FROM (SELECT p_partkey, p_size, p_type, p_retailprice,
               list_transform(range(p_partkey % 4 + 1),
                 lambda i: ['Al','Cs','Fe','H','O','Si','V','Yb'][(p_partkey + i * 3) % 8 + 1]) AS els,
               list_transform(range(p_partkey % 4 + 1),
                 lambda i: CAST(1 + (p_size + i * 5) % 6 AS BIGINT)) AS ns
        FROM part)),
v_elements AS (
  SELECT p_partkey, p_size, p_type, p_retailprice, unnest(els) AS el, unnest(ns) AS n FROM v_formulas),
v_gcd AS (
  SELECT v.p_partkey, max(d.d) AS g
  FROM (SELECT p_partkey, ns, unnest(range(1, list_min(ns) + 1)) AS d FROM v_formulas) d
  JOIN v_formulas v USING (p_partkey)
  WHERE len(list_filter(v.ns, lambda x: x % d.d <> 0)) = 0
  GROUP BY v.p_partkey),
v_composition AS (
  SELECT p_partkey, list(el ORDER BY el) AS els, list(n ORDER BY el) AS ns, sum(n) AS total
  FROM v_elements GROUP BY p_partkey)
"""


def listing(t: Tables) -> DataFrame:
    """Documents as stored objects: some manifests, some other files."""
    name = (
        F.when(F.col("lang") == "es", F.lit("manifest.jsonl.gz"))
        .when(F.col("lang") == "de", F.concat(F.lit("data"), F.col("doc_id").cast("string"), F.lit(".txt")))
        .otherwise(F.concat(F.lit("data"), F.col("doc_id").cast("string"), F.lit(".jsonl.gz")))
    )
    return t.documents.select(
        "doc_id",
        F.concat_ws("/", F.col("source"), F.col("doc_id").cast("string"), name).alias("path"),
        F.when(
            F.col("source") != "src0",
            F.to_timestamp(F.date_add(F.lit("2023-01-01").cast("date"), F.floor(F.col("n_chars") / 50).cast("int"))),
        ).alias("last_modified"),
        F.col("n_chars").alias("length"),
    )


LISTING = """
v_listing AS (
  SELECT doc_id, source || '/' || doc_id || '/' || CASE lang WHEN 'es' THEN 'manifest.jsonl.gz'
           WHEN 'de' THEN 'data' || doc_id || '.txt' ELSE 'data' || doc_id || '.jsonl.gz' END AS path,
         CASE WHEN source <> 'src0'
              THEN CAST(DATE '2023-01-01' + CAST(floor(n_chars / 50) AS INTEGER) AS TIMESTAMP) END AS last_modified,
         n_chars AS length
  FROM documents)
"""


def calculations(t: Tables) -> DataFrame:
    """Order lines as the calculations of entry ``l_orderkey``."""
    label = (
        F.when(F.col("l_linenumber") == 1, "static")
        .when(F.col("l_linenumber") == 2, "relaxation")
        .when(F.col("l_linenumber") == 3, "coarse_relax")
        .when(F.col("l_linenumber") == 4, "fine_relax")
        .otherwise("other")
    )
    return t.lineitem.select(
        F.col("l_orderkey").alias("entry_id"),
        label.alias("label"),
        F.when(F.col("l_discount") > 0.0, F.col("l_partkey")).alias("input_id"),
        F.when(F.col("l_tax") > 0.0, F.col("l_suppkey")).alias("output_id"),
        F.col("l_quantity").cast("int").alias("nsteps"),
        (F.col("l_linestatus") == "F").alias("converged"),
        F.when(F.col("l_returnflag") != "R", -F.col("l_extendedprice") / 1000).alias("energy_pa"),
        F.col("l_discount").alias("discount"),
        *LINE_ORDER,
    )


CALCULATIONS = """
v_calculations AS (
  SELECT l_orderkey AS entry_id,
         CASE l_linenumber WHEN 1 THEN 'static' WHEN 2 THEN 'relaxation' WHEN 3 THEN 'coarse_relax'
              WHEN 4 THEN 'fine_relax' ELSE 'other' END AS label,
         CASE WHEN l_discount > 0.0 THEN l_partkey END AS input_id,
         CASE WHEN l_tax > 0.0 THEN l_suppkey END AS output_id,
         CAST(l_quantity AS INTEGER) AS nsteps, l_linestatus = 'F' AS converged,
         CASE WHEN l_returnflag <> 'R' THEN -l_extendedprice / 1000 END AS energy_pa,
         l_discount AS discount, l_linenumber, l_partkey, l_suppkey, l_shipdate
  FROM lineitem)
"""


def material_documents(t: Tables) -> DataFrame:
    """Orders as material documents naming three tasks each; see ``task_table``."""
    first, second, third = (
        F.concat(F.lit("t-"), key.cast("string"))
        for key in (F.col("o_custkey"), F.col("o_custkey") + 1, F.col("o_custkey") * 2 + 2)
    )
    rank = F.substring("o_orderpriority", 1, 1)
    label = (
        F.when(rank == "1", "GGA Static")
        .when(rank == "2", "GGA+U Static")
        .when(rank == "3", "r2SCAN Structure Optimization")
        .when(rank == "4", "PBEsol Static")
        .otherwise("HSE Static")
    )
    optimization, static = F.lit("Structure Optimization"), F.lit("Static")
    return t.orders.select(
        F.concat(F.lit("mp-"), F.col("o_orderkey").cast("string")).alias("material_id"),
        F.create_map(
            first,
            F.when(F.col("o_orderstatus") == "F", static).otherwise(optimization),
            second,
            F.when(rank.isin("1", "2"), optimization).otherwise("Deprecated"),
            third,
            F.when(rank.isin("1", "5"), static).otherwise("NMR"),
        ).alias("task_types"),
        F.create_map(first, label, second, F.lit("GGA Static"), third, label).alias("calc_types"),
        F.when(F.col("o_totalprice") > 300000, F.array(first)).otherwise(F.array().cast("array<string>")).alias(
            "deprecated_tasks"
        ),
        F.struct(F.when(rank == "5", "BY-NC").otherwise("BY-C").alias("license")).alias("builder_meta"),
    )


def task_table(t: Tables) -> DataFrame:
    return t.customer.select(
        F.concat(F.lit("t-"), F.col("c_custkey").cast("string")).alias("task_id"),
        F.col("c_mktsegment").alias("segment"),
    )


MATERIAL_DOCUMENTS = """
v_labelled AS (
  SELECT *, 'mp-' || o_orderkey AS material_id, substr(o_orderpriority, 1, 1) AS prio,
         CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'GGA Static' WHEN '2' THEN 'GGA+U Static'
              WHEN '3' THEN 'r2SCAN Structure Optimization' WHEN '4' THEN 'PBEsol Static'
              ELSE 'HSE Static' END AS label
  FROM orders),
v_references AS (
  SELECT material_id, 0 AS task_pos, 't-' || o_custkey AS task_id,
         CASE o_orderstatus WHEN 'F' THEN 'Static' ELSE 'Structure Optimization' END AS task_type, label AS calc_type
  FROM v_labelled WHERE NOT o_totalprice > 300000
  UNION ALL
  SELECT material_id, 1, 't-' || (o_custkey + 1),
         CASE WHEN prio IN ('1', '2') THEN 'Structure Optimization' ELSE 'Deprecated' END, 'GGA Static'
  FROM v_labelled
  UNION ALL
  SELECT material_id, 2, 't-' || (o_custkey * 2 + 2),
         CASE WHEN prio IN ('1', '5') THEN 'Static' ELSE 'NMR' END, label
  FROM v_labelled),
v_task_table AS (SELECT 't-' || c_custkey AS task_id, c_mktsegment AS segment FROM customer)
"""
