"""Object listings: what to fetch, in which order, and which release is latest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from crystalflow.functions import text
from crystalflow.operators import segments as seg


def list_objects(spark: SparkSession, path: str) -> DataFrame:
    """``path, last_modified, length`` of every file below ``path``; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", F.col("modificationTime").alias("last_modified"), "length")


def data_files(listing: DataFrame, path: str = "path") -> DataFrame:
    """Keep ``*.jsonl.gz`` files that are not manifests."""
    return listing.where(
        F.col(path).endswith(".jsonl.gz") & ~F.col(path).contains("manifest.jsonl.gz")
    )


def modified_since(
    listing: DataFrame, version: str | Column | None, modified: str = "last_modified"
) -> DataFrame:
    """Files of the version's day or later.

    All files when the version is missing or no date; a file without a
    modification time is always kept.
    """
    if version is None:
        return listing
    since = F.try_to_date(F.lit(version) if isinstance(version, str) else version, "yyyy-MM-dd")
    return listing.where(
        since.isNull() | F.col(modified).isNull() | (F.to_date(modified) >= since)
    )


def oldest_first(
    listing: DataFrame,
    offset: int = 0,
    modified: str = "last_modified",
    path: str = "path",
    segments: int | None = None,
) -> DataFrame:
    """Number files from 0 by (modified, path) as ``file_no``; skip the first ``offset``."""
    numbered = seg.position(listing, [], [modified, path], "file_no", segments)
    return numbered.where(F.col("file_no") >= offset)


def latest_modified(listing: DataFrame, modified: str = "last_modified", by: Sequence[str] = ()) -> DataFrame:
    """The latest modification day: one row, null for an empty listing, or one per value of ``by``."""
    return listing.groupBy(*by).agg(F.max(F.date_trunc("day", modified)).alias("latest"))


def latest_collection(prefixes: DataFrame, sub_prefix: str, prefix: str = "prefix") -> DataFrame:
    """One row ``path``: the newest ``YYYY-MM-DD[-postN]`` prefix with ``sub_prefix``.

    Null when there is none; see :func:`latest_collection_path` for an error.
    """
    version = text.collection_version(F.col(prefix))
    newest = F.max_by(F.rtrim(F.col(prefix), F.lit("/")), version)
    return prefixes.where(version.isNotNull()).agg(
        F.concat(newest, F.lit(f"/{sub_prefix}")).alias("path")
    )


def latest_collection_path(prefixes: DataFrame, sub_prefix: str, prefix: str = "prefix") -> str:
    path = latest_collection(prefixes, sub_prefix, prefix).first()["path"]
    if path is None:
        raise ValueError("no dated collection found")
    return path


def latest_dump(links: DataFrame, url: str = "url") -> DataFrame:
    """One row ``url``: the link with the highest ``vMAJOR_MINOR``."""
    return links.agg(F.max_by(url, F.struct(text.dump_version(F.col(url)), F.col(url))).alias("url"))


def dump_updated(page: Column, version: Column, default: Column | None = None) -> Column:
    """Update date a page states after ``<blank><version>``; ``default`` (today) otherwise."""
    at = F.instr(page, F.concat(F.lit(" "), version))
    after = F.when(at > 0, F.substring(page, at, F.length(page)))
    stated = F.regexp_extract(after, r"(?s)^.*?Database updated on:\s*([^\n]+)", 1)
    return F.coalesce(text.month_year(stated), F.current_date() if default is None else default)
