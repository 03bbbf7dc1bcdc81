"""Text and date expressions: functionals, labels, settings, versions, links."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from crystalflow import schema as S


def functional_from_text(text: Column, case_sensitive: bool = False) -> Column:
    """Functional named in free text or a url; null when none is.

    ``pbesol`` contains ``pbe``, so it is tested first.
    """
    probe = text if case_sensitive else F.lower(text)
    found = F.when(probe.contains("pbesol"), F.lit("pbesol"))
    return found.when(probe.contains("pbe"), F.lit("pbe")).when(probe.contains("scan"), F.lit("scan"))


def label_prefix(label: Column) -> Column:
    return F.substring_index(label, " ", 1)


def functional_from_label(label: Column, keep_unknown: bool = False) -> Column:
    """Functional of a calculation label such as ``GGA+U Static``."""
    # plain comparisons: several times faster than splitting and a map lookup
    conditions = [
        ((label == prefix) | label.startswith(prefix + " "), functional)
        for prefix, functional in S.LABEL_FUNCTIONALS.items()
    ]
    known = F.when(*conditions[0])
    for condition, functional in conditions[1:]:
        known = known.when(condition, functional)
    return known.otherwise(label) if keep_unknown else known


def spin_polarised(settings: Column) -> Column:
    """True when the settings text (a dict literal) has ``ispin`` 2 or '2'."""
    value = F.regexp_extract(settings, r"""['"]ispin['"]\s*:\s*(?:'([^']*)'|"([^"]*)"|([0-9.]+))""", 0)
    quoted = F.regexp_extract(value, r""":\s*['"]?([^'"]*)""", 1)
    return F.coalesce(quoted == "2", F.lit(False))


def iso_day(text: Column) -> Column:
    """ISO text, with or without ``T``/``Z``, as midnight of its day; null if unparsable."""
    return F.date_trunc("day", F.try_to_timestamp(text))


def composite_id(*parts: str | Column) -> Column:
    """The parts joined by dashes; null parts are left out."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.concat_ws("-", *[c.cast("string") for c in columns])


def month_year(text: Column) -> Column:
    """``<b>November, 2023</b>`` as the first of that month; null if unparsable."""
    bare = F.regexp_replace(text, r"<[^>]+>", "")
    squeezed = F.trim(F.regexp_replace(F.regexp_replace(bare, r"\s+", " "), r"\s*,\s*", ", "))
    return F.try_to_date(squeezed, "MMMM, yyyy")


def dump_version(url: Column) -> Column:
    """``(major, minor)`` of the ``vMAJOR_MINOR`` in a url, ``(0, 0)`` without one."""

    def part(i: int) -> Column:
        digits = F.regexp_extract(url, r"v(\d+)_(\d+)", i)
        return F.coalesce(F.nullif(digits, F.lit("")).cast("int"), F.lit(0))

    return F.struct(part(1).alias("major"), part(2).alias("minor"))


def collection_version(prefix: Column) -> Column:
    """``(date, post)`` of a ``.../YYYY-MM-DD[-postN]/`` prefix; null for other names."""
    base = F.rtrim(prefix, F.lit("/"))
    pattern = r"(\d{4}-\d{2}-\d{2})(?:-post(\d*))?$"
    date = F.regexp_extract(base, pattern, 1)
    post = F.nullif(F.regexp_extract(base, pattern, 2), F.lit(""))
    return F.when(
        date != "",
        F.struct(date.alias("date"), F.coalesce(post.cast("int"), F.lit(0)).alias("post")),
    )
