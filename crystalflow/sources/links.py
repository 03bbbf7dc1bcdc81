"""Download links of index pages held in a ``url, html`` table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# --- fixed values: link forms that are not downloads ----------------------
PARENT_LINKS = ["..", "../", "./"]

_HREF = r"""(?is)^<a\b[^>]*?\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""
_CELL = r"(?is)<td[^>]*>\s*((?:[^<]|<(?!/?td))*?)\s*</td>"


def resolve(base: Column, href: Column) -> Column:
    """Absolute url of ``href`` found on page ``base``."""
    root = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    page = F.regexp_extract(base, r"^([^?#]*)", 1)
    page_path = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    folder = F.regexp_replace(F.when(page_path == "", F.lit("/")).otherwise(page_path), r"[^/]*$", "")
    href_path = F.regexp_extract(href, r"^([^?#]*)", 1)
    rest = F.regexp_extract(href, r"^[^?#]*(.*)$", 1)
    absolute_path = F.when(href_path.startswith("/"), href_path).otherwise(F.concat(folder, href_path))
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href == "", base)
        .when(href.startswith("#"), F.concat(F.regexp_extract(base, r"^([^#]*)", 1), href))
        .when(href.startswith("?"), F.concat(page, href))
        .otherwise(F.concat(root, without_dots(absolute_path), rest))
    )


def without_dots(path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments of an absolute path."""
    segments = F.slice(F.split(path, "/"), F.lit(2), F.size(F.split(path, "/")))
    ends_open = path.rlike(r"(^|/)\.{1,2}$")
    folded = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == ".", acc)
        .when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.concat(acc, F.array(s))),
    )
    joined = F.concat(F.lit("/"), F.array_join(folded, "/"))
    return F.when(
        path.rlike(r"(^|/)\.{1,2}(/|$)"),
        F.when(ends_open & ~joined.endswith("/"), F.concat(joined, F.lit("/"))).otherwise(joined),
    ).otherwise(path)


def file_name(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?[^?#]*?([^/?#]*)(?:[?#].*)?$", 1)


def _stamp(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit("dd-MMM-yyyy HH:mm"))


def extract_links(pages: DataFrame, pattern: str | None = None) -> DataFrame:
    """One row per download link: ``page, url, filename, size, last_modified``.

    Date and size come from the cells of the link's table row, or from the
    text right after the link. ``pattern`` is searched in the file name,
    ignoring case. Order the result by ``filename`` where order matters.
    """
    rows = pages.select(
        F.col("url").alias("page"),
        # table rows stand alone, so that a link only sees its own cells
        F.explode(F.split("html", r"(?i)(?=<tr[\s>])|(?<=</tr>)")).alias("_row"),
    ).where(F.col("_row").contains("<a") | F.col("_row").contains("<A"))
    in_table = F.col("_row").rlike(r"(?i)^<tr[\s>]")
    cells = F.when(in_table, F.regexp_extract_all("_row", F.lit(_CELL), F.lit(1)))
    anchors = rows.select(
        "page",
        F.filter(cells, lambda t: t.rlike(r"\d+[KMG]?B")).alias("_sizes"),
        F.filter(cells, lambda t: t.rlike(r"\d{2}-[A-Za-z]{3}-\d{4}|\d{4}-\d{2}-\d{2}")).alias("_dates"),
        F.explode(F.split("_row", r"(?i)(?=<a[\s])")).alias("_anchor"),
    ).where(F.col("_anchor").rlike(_HREF))
    href = F.trim(
        F.concat(*[F.regexp_extract("_anchor", _HREF, i) for i in (1, 2, 3)])
    )
    trailing = F.split(F.trim(F.regexp_extract("_anchor", r"(?is)</a>([^<]*)", 1)), r"\s+")
    trailing_date = F.when(
        F.size(trailing) >= 3, _stamp(F.concat_ws(" ", F.get(trailing, F.lit(0)), F.get(trailing, F.lit(1))))
    )
    cell_size, cell_date = F.get("_sizes", F.lit(0)), F.get("_dates", F.lit(0))
    complete = cell_size.isNotNull() & cell_date.isNotNull()
    iso = lambda ts: F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    use_text = ~complete & trailing_date.isNotNull()
    links = (
        anchors.withColumn("_href", href)
        .where(~F.col("_href").isin(PARENT_LINKS))
        .select(
            "page",
            resolve(F.col("page"), F.col("_href")).alias("url"),
            F.when(use_text, F.get(trailing, F.lit(2))).otherwise(cell_size).alias("size"),
            F.when(use_text, iso(trailing_date))
            .otherwise(F.coalesce(iso(_stamp(cell_date)), cell_date))
            .alias("last_modified"),
        )
        .withColumn("filename", file_name(F.col("url")))
    )
    if pattern is not None:
        links = links.where(F.col("filename").rlike(f"(?i){pattern}"))
    return links.select("page", "url", "filename", "size", "last_modified")
