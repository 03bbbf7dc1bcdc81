"""Documents, vendor keys, labels, links and versions read from text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from crystalflow import schema as S
from crystalflow.functions import arrays, text
from crystalflow.operators import scratch
from crystalflow.plans import vendor
from crystalflow.queries import Tables, query, roles
from crystalflow.sources import documents, links, listing, shredded

_STAMP = "%Y-%m-%d %H:%M:%S"


@query(
    f"""SELECT event_id,
      CASE WHEN event_type IN ('view', 'click') THEN 'mp-' || event_id
           WHEN event_type IN ('signup', 'purchase') THEN 'task-' || event_id END AS id,
      CASE WHEN event_type IN ('view', 'click') THEN 'mp-material' ELSE 'mp-task' END AS type,
      CASE WHEN event_type <> 'error' THEN strftime(ts, '{_STAMP}') END AS last_modified,
      event_type <> 'error' AS parsed
    FROM events"""
)
def doc_route(t: Tables) -> DataFrame:
    """Events as document lines; error events are cut short."""
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")

    def document(key: str, prefix: str) -> Column:
        return F.concat(
            F.lit(f'{{"{key}": "{prefix}-'),
            F.col("event_id").cast("string"),
            F.lit('", "last_updated": {"$date": "'),
            stamp,
            F.lit('"}}'),
        )

    line = (
        F.when(F.col("event_type").isin("view", "click"), document("material_id", "mp"))
        .when(F.col("event_type") == "error", F.lit('{"material_id": "mp-'))
        .otherwise(document("task_id", "task"))
    )
    # the line number rides along as the origin of the line
    lines = t.events.select(F.col("event_id").alias("line_no"), line.alias("value"))
    return documents.route(lines).select(
        F.col("line_no").alias("event_id"),
        "id",
        "type",
        F.date_format("last_modified", "yyyy-MM-dd HH:mm:ss").alias("last_modified"),
        "parsed",
    )


@query(
    """SELECT vec_id, len(list_filter(embedding, lambda v: v < -0.2)) AS n_null,
           round(list_sum(list_transform(list_filter(embedding, lambda v: NOT v < -0.2),
                                         lambda v: v::DOUBLE)), 6) AS total
    FROM embeddings"""
)
def nan_to_null(t: Tables) -> DataFrame:
    """JSON number lists in which components below -0.2 are written as NaN."""
    written = F.transform(
        "embedding", lambda v: F.when(v < -0.2, F.lit("NaN")).otherwise(v.cast("double").cast("string"))
    )
    lines = t.embeddings.select(
        "vec_id", F.concat(F.lit("["), F.array_join(written, ","), F.lit("]")).alias("value")
    )
    parsed = arrays.vector_nan_to_null(F.from_json("value", "array<double>"))
    known = F.filter("vals", lambda v: v.isNotNull())
    return lines.select("vec_id", parsed.alias("vals")).select(
        "vec_id",
        (F.size("vals") - F.size(known)).cast("bigint").alias("n_null"),
        F.round(arrays.array_sum(known), 6).alias("total"),
    )


@query(
    """WITH found AS (
      SELECT url AS page, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages)
    SELECT page, regexp_extract(page, '^(https?://[^/?#]*)', 1) || href AS url,
           regexp_extract(href, '([^/]*)$', 1) AS filename,
           CAST(NULL AS VARCHAR) AS size, CAST(NULL AS VARCHAR) AS last_modified
    FROM found"""
)
def page_links(t: Tables) -> DataFrame:
    return links.extract_links(t.pages)


@query(
    """WITH found AS (
      SELECT url AS page, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages)
    SELECT regexp_extract(href, '([^/]*)$', 1) AS filename, count(*) AS n_links, count(DISTINCT page) AS n_pages
    FROM found WHERE regexp_matches(regexp_extract(href, '([^/]*)$', 1), '(?i)^an')
    GROUP BY 1"""
)
def page_links_matching(t: Tables) -> DataFrame:
    found = links.extract_links(t.pages, pattern="^an")
    return found.groupBy("filename").agg(
        F.count(F.lit(1)).alias("n_links"), F.countDistinct("page").alias("n_pages")
    )


def _modified(column: str = "n_chars") -> Column:
    return F.date_add(F.lit("2023-01-01").cast("date"), F.floor(F.col(column) / 50).cast("int"))


@query(
    """WITH prefixes AS (
      SELECT 'collections/' || CAST(DATE '2023-01-01' + CAST(floor(n_chars / 50) AS INTEGER) AS VARCHAR) AS base,
             CASE lang WHEN 'fr' THEN doc_id WHEN 'de' THEN 1 ELSE 0 END AS post, lang, source, n_chars, doc_id
      FROM documents),
    dumps AS (SELECT length(source) AS major, n_chars AS minor, doc_id,
                     'https://dump.example.org/db__v' || length(source) || '_' || n_chars || '.sql.gz?d=' || doc_id AS url
              FROM prefixes)
    SELECT 'collection' AS kind, base || CASE WHEN lang IN ('fr', 'de') THEN '-post' || post ELSE '' END
           || '/materials' AS path
    FROM (SELECT * FROM prefixes WHERE lang <> 'es' ORDER BY base DESC, post DESC LIMIT 1)
    UNION ALL
    SELECT 'dump', url FROM (SELECT * FROM dumps ORDER BY major DESC, minor DESC, url DESC LIMIT 1)"""
)
def latest_version_path(t: Tables) -> DataFrame:
    """Newest dated collection and newest dump; Spanish folders carry no date."""
    number = F.col("doc_id").cast("string")
    suffix = F.when(F.col("lang") == "fr", F.concat(F.lit("-post"), number)).when(
        F.col("lang") == "de", F.lit("-post1")
    )
    dated = F.concat(
        F.lit("collections/"), _modified().cast("string"), F.coalesce(suffix, F.lit("")), F.lit("/")
    )
    prefixes = t.documents.select(
        F.when(F.col("lang") == "es", F.lit("collections/misc/")).otherwise(dated).alias("prefix")
    )
    url = F.concat(
        F.lit("https://dump.example.org/db__v"),
        F.length("source").cast("string"),
        F.lit("_"),
        F.col("n_chars").cast("string"),
        F.lit(".sql.gz?d="),
        number,
    )
    newest = listing.latest_collection(prefixes, "materials")
    dump = listing.latest_dump(t.documents.select(url.alias("url")))
    return newest.select(F.lit("collection").alias("kind"), "path").unionByName(
        dump.select(F.lit("dump").alias("kind"), F.col("url").alias("path"))
    )


@query(
    """SELECT o_orderkey, CASE WHEN o_orderpriority NOT LIKE '5%'
         THEN CAST(date_trunc('month', o_orderdate) AS DATE)::VARCHAR END AS updated
    FROM orders"""
)
def parse_month_year(t: Tables) -> DataFrame:
    """Dates as a release page words them; low-priority orders have none."""
    worded = F.concat(
        F.lit("<b>"), F.date_format("o_orderdate", "MMMM"), F.lit(",  "), F.date_format("o_orderdate", "yyyy"), F.lit("</b> ")
    )
    stated = F.when(F.col("o_orderpriority").startswith("5"), "not yet").otherwise(worded)
    return t.orders.select("o_orderkey", text.month_year(stated).cast("string").alias("updated"))


_LABEL_FUNCTIONAL = """CASE l_returnflag WHEN 'A' THEN 'pbe' WHEN 'N' THEN 'pbe' ELSE 'r2scan' END"""


@query(
    """SELECT doc_id,
      CASE lang WHEN 'en' THEN 'pbe' WHEN 'fr' THEN 'pbesol' WHEN 'de' THEN 'scan' END AS from_text,
      CASE lang WHEN 'fr' THEN 'pbesol' END AS from_url,
      CASE lang WHEN 'en' THEN 'pbe' WHEN 'fr' THEN 'pbesol' WHEN 'de' THEN 'r2scan' END AS from_label,
      CASE lang WHEN 'en' THEN 'pbe' WHEN 'fr' THEN 'pbesol' WHEN 'de' THEN 'r2scan' ELSE 'HSE Static' END AS label_or_self
    FROM documents"""
)
def functional_map(t: Tables) -> DataFrame:
    lang = F.col("lang")
    named = F.when(lang == "en", "PBE").when(lang == "fr", "xc-pbesol").when(lang == "de", "R2SCAN").otherwise("LDA")
    label = (
        F.when(lang == "en", "GGA+U Static")
        .when(lang == "fr", "PBEsol Structure Optimization")
        .when(lang == "de", "r2SCAN Static")
        .otherwise("HSE Static")
    )
    return t.documents.select(
        "doc_id",
        text.functional_from_text(named).alias("from_text"),
        text.functional_from_text(named, case_sensitive=True).alias("from_url"),
        text.functional_from_label(label).alias("from_label"),
        text.functional_from_label(label, keep_unknown=True).alias("label_or_self"),
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           (l_returnflag = 'A' AND l_linestatus = 'F') OR (l_returnflag = 'N') AS spin_polarised
    FROM lineitem"""
)
def settings_flag(t: Tables) -> DataFrame:
    settings = (
        F.when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F"), "{'encut': 520, 'ispin': 2}")
        .when(F.col("l_returnflag") == "A", "{'ispin': 1, 'nelm': 2}")
        .when(F.col("l_returnflag") == "N", "{'ispin': '2', 'prec': 'high'}")
        .otherwise("{}")
    )
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        text.spin_polarised(settings).alias("spin_polarised"),
    )


@query(
    f"""WITH {roles.TASKS}
    SELECT task_id, material_id || '-' || functional AS structure_id,
           material_id || '-' || (l_linenumber - 1) || '-' || functional || '-' || nsites AS frame_id
    FROM v_ranked_tasks"""
)
def composite_id(t: Tables) -> DataFrame:
    functional = text.functional_from_label(F.col("calc_type"))
    number = F.col("l_linenumber") - 1
    return roles.tasks(t).select(
        "task_id",
        text.composite_id("material_id", functional).alias("structure_id"),
        text.composite_id("material_id", number, functional, "nsites").alias("frame_id"),
    )


def vendor_documents(t: Tables) -> DataFrame:
    """Parts as vendor documents.

    Large ones carry scan results, those of size 1 to 3 miss the charges key,
    and size 5 names no known functional.
    """
    total = F.aggregate("ns", F.lit(0).cast("bigint"), lambda acc, n: acc + n)
    parts = roles.formulas(t).select("*", total.cast("int").alias("nsites"))
    sites = F.flatten(F.zip_with("els", "ns", lambda e, n: F.array_repeat(e, n.cast("int"))))
    lattice = F.array(*[F.array(*[F.lit(4.0 if i == j else 0.0) for j in range(3)]) for i in range(3)])
    base = {
        "immutable_id": F.concat(F.lit("agm-"), F.col("p_partkey").cast("string")),
        "chemical_formula_reduced": F.regexp_replace("formula", r"1( |$)|\s", ""),
        "chemical_formula_anonymous": F.array_join(
            F.transform("ns", lambda n, i: F.concat(F.char(F.lit(65) + i), n.cast("string"))), ""
        ),
        "chemical_formula_descriptive": F.col("formula"),
        "cartesian_site_positions": F.transform(sites, lambda s, i: F.array(i * 0.5, i * 0.25, F.lit(0.0))),
        "elements": F.array_sort("els"),
        "elements_ratios": F.transform(
            F.array_sort(F.arrays_zip("els", "ns")), lambda p: p["ns"] / F.col("nsites")
        ),
        "nelements": F.size("els"),
        "nsites": F.col("nsites"),
        "species_at_sites": sites,
        "species": F.transform("els", lambda e: F.struct(e.alias("name"))),
        "nperiodic_dimensions": F.lit(3),
        "dimension_types": F.array(F.lit(1), F.lit(1), F.lit(1)),
        "last_modified": F.lit("2024-03-14T10:00:00Z"),
        "lattice_vectors": lattice,
    }
    energy = -F.col("p_retailprice")
    targets = {
        "forces": F.transform(sites, lambda s: F.array(F.lit(0.05), F.col("p_retailprice") / 20000, F.lit(0.0))),
        "stress_tensor": lattice,
        "dos_ef": F.lit(1.5),
        "energy": energy,
        "energy_corrected": F.lit(None).cast("double"),
        "magnetic_moments": F.transform(sites, lambda s: F.lit(0.5)),
        "magnetization": F.lit(0.5),
        "charges": F.lit(None).cast("array<double>"),
        "band_gap": F.lit(0.1),
    }
    xc = F.when(F.col("p_size") == 5, "LDA").when(F.col("p_size") > 25, "PBEsol").otherwise("PBE")

    def written(with_scan: bool, without: str | None) -> Column:
        columns = {**base, S.VENDOR_FUNCTIONAL_KEY: xc}
        columns |= {S.VENDOR_PREFIX + k: v for k, v in targets.items() if k != without}
        if with_scan:
            columns |= {
                S.VENDOR_SCAN_PREFIX + k: (energy - 1 if k == "energy" else v) for k, v in targets.items()
            }
        fields = F.struct(*[c.alias(k) for k, c in columns.items()])
        return F.to_json(fields, {"ignoreNullFields": "false"})

    document = (
        F.when(F.col("p_size") <= 3, written(False, "charges"))
        .when(F.col("p_size") > 40, written(True, None))
        .otherwise(written(False, None))
    )
    return parts.select(
        F.concat(F.lit("agm-"), F.col("p_partkey").cast("string")).alias("id"),
        document.alias("attributes"),
    )


_VENDOR = f"""{roles.FORMULAS},
v_vendor AS (
  SELECT p_partkey, 'agm-' || p_partkey AS document_id, els, ns, p_size, -p_retailprice AS energy,
         CASE WHEN p_size = 5 THEN NULL WHEN p_size > 25 THEN 'pbesol' ELSE 'pbe' END AS functional,
         p_size > 3 AS complete, p_retailprice
  FROM v_formulas
  UNION ALL
  SELECT p_partkey, 'agm-' || p_partkey, els, ns, p_size, -p_retailprice - 1, 'scan', true, p_retailprice
  FROM v_formulas WHERE p_size > 40)"""


@query(
    f"""WITH {_VENDOR}
    SELECT document_id, functional, complete, round(energy, 6) AS energy,
           CAST(list_sum(ns) AS INTEGER) AS nsites, array_to_string(list_sort(els), ',') AS elements
    FROM v_vendor"""
)
def key_mapping(t: Tables) -> DataFrame:
    mapped = vendor.fan_out(vendor_documents(t))
    return mapped.select(
        "document_id",
        "functional",
        "complete",
        F.round("energy", 6).alias("energy"),
        "nsites",
        F.array_join("elements", ",").alias("elements"),
    )


@query(f"WITH {_VENDOR} SELECT document_id, functional, round(energy, 6) AS energy FROM v_vendor")
def fanout_variant(t: Tables) -> DataFrame:
    return vendor.fan_out(vendor_documents(t)).select(
        "document_id", "functional", F.round("energy", 6).alias("energy")
    )


@query(
    """SELECT 'mp-' || p_partkey AS material_id, p_size AS nelements,
              CASE WHEN p_size % 5 <> 0 THEN p_name END AS formula_anonymous, p_size % 5 <> 0 AS strict
    FROM part"""
)
def shredded_fields(t: Tables) -> DataFrame:
    """Parts as material documents, stored as shredded variants; those with a bare NaN stay text."""
    number = F.when(F.col("p_size") % 5 == 0, F.lit("NaN")).otherwise(F.lit("1.5"))
    document = F.concat(
        F.lit('{"material_id": "mp-'), F.col("p_partkey").cast("string"), F.lit('", "nelements": '), F.col("p_size").cast("string"),
        F.lit(', "volume": '), number, F.when(F.col("p_size") % 5 == 0, F.lit("")).otherwise(F.concat(F.lit(', "formula_anonymous": "'), F.col("p_name"), F.lit('"'))),
        F.lit("}"),
    )
    raw = t.part.select(F.lit(documents.MATERIAL).alias("type"), document.alias("attributes"))
    path = scratch.new_path(t.spark)
    shredded.write_shredded(raw, path)
    fields = T.StructType.fromDDL("material_id string, nelements int, formula_anonymous string, volume double")
    read = shredded.read_shredded(t.spark, path, documents.MATERIAL, fields)
    return read.select("material_id", "nelements", "formula_anonymous", (~F.isnan("volume")).alias("strict"))
