"""JSON documents as raw rows ``id, type, attributes, last_modified``.

``attributes`` is the document's JSON text. It is parsed once more, into an
explicit type, by the job that uses it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from crystalflow import schema as S
from crystalflow.functions import arrays, text
from crystalflow.operators import segments as seg
from crystalflow.operators.scratch import materialise
from crystalflow.operators.selection import best_per_group

MATERIAL = "mp-material"
TASK = "mp-task"


#: where a line came from; later files and lines replace earlier ones
ORIGIN = ["file_modified", "file_path", "line_no"]


def with_origin(lines: DataFrame) -> DataFrame:
    """Lines with the file and position they came from.

    A compressed file is read by one task, so the increasing id follows its
    line order.
    """
    return lines.select(
        "value",
        F.col("_metadata.file_modification_time").alias("file_modified"),
        F.col("_metadata.file_path").alias("file_path"),
        F.monotonically_increasing_id().alias("line_no"),
    )


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Lines of (compressed) JSON-lines files, with their origin."""
    return with_origin(spark.read.text(paths if isinstance(paths, str) else list(paths)))


def route(lines: DataFrame, column: str = "value") -> DataFrame:
    """Parse document lines into raw rows plus ``parsed``.

    A document with a ``material_id`` is a material, any other a task. Lines
    that are not JSON, or lack their key, have ``parsed`` false.
    """
    origin = [c for c in ORIGIN if c in lines.columns]
    doc = lines.select(
        *origin, F.col(column).alias("attributes"), F.try_parse_json(F.col(column)).alias("_doc")
    )

    def field(path: str, dtype: str) -> Column:
        return F.try_variant_get("_doc", path, dtype)

    is_material = field("$.material_id", "variant").isNotNull()
    routed = doc.select(
        F.when(is_material, field("$.material_id", "string"))
        .otherwise(field("$.task_id", "string"))
        .alias("id"),
        F.when(is_material, F.lit(MATERIAL)).otherwise(F.lit(TASK)).alias("type"),
        "attributes",
        F.try_to_timestamp(field("$.last_updated['$date']", "string")).alias("last_modified"),
        *origin,
    )
    return routed.withColumn("parsed", F.col("id").isNotNull())


def unusable_lines(routed: DataFrame) -> DataFrame:
    """Lines that give no document, with where they stood; ``id`` names file and line."""
    where = F.concat_ws(":", "file_path", F.col("line_no").cast("string"))
    return routed.where("NOT parsed").select(where.alias("id"), F.col("attributes").alias("value"), "file_path", "file_modified")


def rejects_path(table_path: str) -> str:
    """Where the unusable lines of a raw table are kept."""
    return f"{table_path.rstrip('/')}_rejects"


def read_documents(spark: SparkSession, paths: str | Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Good raw rows with their origin, and the lines that could not be used."""
    routed = route(read_lines(spark, paths))
    good = routed.where("parsed").drop("parsed")
    bad = routed.where("NOT parsed").select(F.col("attributes").alias("value"), "file_path")
    return good, bad


def latest_documents(documents: DataFrame) -> DataFrame:
    """One raw row per id: the one that came last."""
    newest = [F.col(c).desc() for c in ORIGIN]
    return best_per_group(documents, ["id"], newest).select(*S.RAW.fieldNames())


def typed(raw: DataFrame, dtype, name: str = "doc") -> DataFrame:
    """Parse ``attributes`` into ``dtype``."""
    return raw.withColumn(name, F.from_json("attributes", dtype))


# --- bulk keyed files -----------------------------------------------------
KEYED = f"map<string,{S.RELAXATIONS_DOC.simpleString()}>"
CUT = "]"  # every entry of a keyed file ends in one


def _clean(relaxations: Column) -> Column:
    """NaN components become null."""
    step = lambda s: F.struct(
        s["structure"].alias("structure"),
        arrays.nan_to_null(s["energy"]).alias("energy"),
        arrays.matrix_nan_to_null(s["forces"]).alias("forces"),
        arrays.matrix_nan_to_null(s["stress"]).alias("stress"),
    )
    return F.transform(
        relaxations,
        lambda r: F.struct(
            r["functional"].alias("functional"), F.transform(r["steps"], step).alias("steps")
        ),
    )


def stamp_functional(relaxations: Column, functional: Column) -> Column:
    """Put the file's functional on every relaxation."""
    return F.transform(
        relaxations, lambda r: F.struct(functional.alias("functional"), r["steps"].alias("steps"))
    )


def read_keyed_json(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Bulk files ``{id: [relaxation, ...]}`` as ``id, relaxations, path, last_modified``.

    A bare NaN becomes null; the word NaN inside a string is left alone. Each
    file is one row until it is exploded, so files must stay under 2 GB; use
    :func:`read_keyed_json_pieces` for larger ones.
    """
    files = spark.read.text(paths if isinstance(paths, str) else list(paths), wholetext=True)
    rows = files.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_modification_time").alias("last_modified"),
        F.explode(F.from_json("value", KEYED)).alias("id", "relaxations"),
    )
    return _finish(rows)


def _finish(rows: DataFrame) -> DataFrame:
    functional = text.functional_from_text(F.col("path"), case_sensitive=True)
    relaxations = stamp_functional(_clean(F.col("relaxations")), functional)
    return rows.select("id", relaxations.alias("relaxations"), "path", "last_modified")


def _bare(piece: Column) -> Column:
    """A piece that starts outside strings, without its strings; one that is still open goes to the end."""
    return F.regexp_replace(piece, r'"[^"]*("|$)', "")


def _depth_change(outside: Column) -> Column:
    def count(mark: str) -> Column:
        return F.length(outside) - F.length(F.replace(outside, F.lit(mark), F.lit("")))

    return count("{") + count("[") - count("}") - count("]")


def keyed_pieces(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Keyed files cut after every closing bracket: ``path, last_modified, block, place, value``, and what a piece changes.

    ``(block, place)`` is the order within a file. ``quotes`` is 1 if the piece
    ends a string it did not begin, or the reverse; ``outside`` and ``inside``
    are its change of depth if it starts outside or inside a string, its closing
    bracket included. No escape crosses a cut, as none ends in a bracket.
    """
    pieces = spark.read.option("lineSep", CUT).text(paths if isinstance(paths, str) else list(paths)).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_modification_time").alias("last_modified"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        "value",
    )
    pieces = pieces.withColumn("_plain", F.regexp_replace("value", r"(?s)\\.", ""))
    quotes = F.pmod(F.length("_plain") - F.length(F.replace("_plain", F.lit('"'), F.lit(""))), F.lit(2)).cast("long")
    entered = F.regexp_replace("_plain", r'^[^"]*("|$)', "")
    return pieces.select(
        "path", "last_modified", "block", "place", "value",
        quotes.alias("quotes"),
        (_depth_change(_bare(F.col("_plain"))) - F.when(quotes == 0, 1).otherwise(0)).cast("long").alias("outside"),
        (_depth_change(_bare(entered)) - F.when(quotes == 1, 1).otherwise(0)).cast("long").alias("inside"),
    )


def read_keyed_json_pieces(spark: SparkSession, paths: str | Sequence[str], segments: int | None = None) -> DataFrame:
    """As :func:`read_keyed_json`, for files of any size, each read by as many tasks as it has splits.

    Files are cut at a fixed character into pieces. A piece's change of quote
    state and depth is known from the piece alone; running sums over the pieces
    of a file compose them, so that every piece knows where it starts. One that
    starts right within the root object begins an entry, and the pieces up to
    the next are that entry's text. Only an entry has to fit a row. Entries that
    are no valid JSON are left out.
    """
    pieces = materialise(keyed_pieces(spark, paths))
    order = ["block", "place"]
    states = pieces.select("path", *order, "quotes", "outside", "inside")
    states = seg.running_sum(states, ["path"], order, {"opened": F.col("quotes")}, segments)
    within = F.pmod(F.col("opened") - F.col("quotes"), F.lit(2)) == 1
    change = F.when(within, F.col("inside")).otherwise(F.col("outside"))
    states = states.select("path", *order, within.alias("within"), change.alias("change"))
    states = seg.running_sum(states, ["path"], order, {"depth": F.col("change")}, segments)
    begins = (~F.col("within") & (F.col("depth") - F.col("change") <= 1)).cast("long")
    states = states.select("path", *order, begins.alias("begins"))
    states = seg.running_sum(states, ["path"], order, {"entry": F.col("begins")}, segments)
    joined = pieces.join(states.select("path", *order, "entry"), ["path", *order])
    entries = joined.groupBy("path", "last_modified", "entry").agg(
        F.array_sort(F.collect_list(F.struct(*order, "value"))).alias("held")
    )
    last = states.groupBy("path").agg(F.max("entry").alias("last"))  # the end of the file: no bracket after it
    whole = F.array_join(F.transform("held", lambda p: p["value"]), CUT)
    body = F.when(F.col("entry") < F.col("last"), F.concat(whole, F.lit(CUT))).otherwise(F.regexp_replace(whole, r"\}\s*$", ""))
    body = F.regexp_replace(body, r"^[\s\uFEFF]*[{,]", "")
    rows = entries.join(last, "path").select(
        "path", "last_modified", F.explode(F.from_json(F.concat(F.lit("{"), body, F.lit("}")), KEYED)).alias("id", "relaxations")
    )
    return _finish(rows)


# --- paged services -------------------------------------------------------
class _Page(InputPartition):
    """The rows ``first`` to ``end`` (exclusive) of the page at ``offset``."""

    def __init__(self, offset: int, limit: int, first: int, end: int):
        super().__init__(offset)
        self.offset, self.limit, self.first, self.end = offset, limit, first, end


def _pages(start: int, end: int, limit: int) -> list[_Page]:
    """The pages that hold rows ``start`` to ``end``; services are asked for whole pages only."""
    return [_Page(at, limit, max(start, at), min(end, at + limit)) for at in range(start // limit * limit, end, limit)]


def _rows_of(fetch_page, page: _Page) -> Iterator[tuple]:
    import json

    served = fetch_page(page.offset, page.limit)["data"]
    for doc in served[page.first - page.offset : page.end - page.offset]:
        yield (str(doc["id"]), doc.get("type"), json.dumps(doc.get("attributes")))


def paged_source(fetch_page, name: str = "paged_documents") -> type[DataSource]:
    """A DataSource over a paged service, for batches and streams.

    ``fetch_page(offset, limit)`` gives ``{"data": [document, ...], "meta":
    {"data_available": n}}``; executors call it, one page per task. Options:
    ``limit`` (page size) and ``offset`` (rows to skip; a batch skips whole
    pages). A stream's position is the number of rows it has taken, so it
    suits services that add documents at the end.

        spark.dataSource.register(paged_source(fetch))
        spark.read.format("paged_documents").option("limit", 500).load()
    """

    def available() -> int:
        return int(fetch_page(0, 1)["meta"]["data_available"])

    class Reader(DataSourceReader):
        def __init__(self, options):
            self.limit = int(options.get("limit", 500))
            self.offset = int(options.get("offset", 0))

        def partitions(self) -> Sequence[InputPartition]:
            return _pages(self.offset // self.limit * self.limit, available(), self.limit)

        def read(self, partition: _Page) -> Iterable[tuple]:
            return _rows_of(fetch_page, partition)

    class StreamReader(DataSourceStreamReader):
        def __init__(self, options):
            self.limit = int(options.get("limit", 500))
            self.offset = int(options.get("offset", 0))

        def initialOffset(self) -> dict:
            return {"rows": self.offset}

        def latestOffset(self) -> dict:
            return {"rows": max(self.offset, available())}

        def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
            return _pages(start["rows"], end["rows"], self.limit)

        def read(self, partition: _Page) -> Iterable[tuple]:
            return _rows_of(fetch_page, partition)

    class PagedDocuments(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return "id string, type string, attributes string"

        def reader(self, schema) -> DataSourceReader:
            return Reader(self.options)

        def streamReader(self, schema) -> DataSourceStreamReader:
            return StreamReader(self.options)

    return PagedDocuments


def with_modified(raw: DataFrame) -> DataFrame:
    """Add ``last_modified``, midnight of the document's own modification time."""
    return raw.withColumn(
        "last_modified", text.iso_day(F.get_json_object("attributes", "$.last_modified"))
    )
