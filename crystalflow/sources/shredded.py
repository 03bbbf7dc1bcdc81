"""Raw documents stored as shredded variants.

A raw table's ``attributes`` is JSON text, which every job parses as a whole.
Here it is parsed once, when it is stored: the document becomes a VARIANT
column that the Parquet writer shreds into typed columns, field by field, after
the documents themselves. A job that reads a few fields reads their columns
alone.

Kinds of document have folders of their own, so that each is shredded by its
own fields. Text that is not strict JSON (a bare NaN, say) stays text, in a
folder of its own, and is parsed as before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

DOCUMENT = "document"
TEXT = "attributes"
STRICT = "strict"
KIND = "type"


def write_shredded(raw: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Store raw rows (id, type, attributes, last_modified); other columns are kept as they are."""
    parsed = raw.withColumn(DOCUMENT, F.try_parse_json(TEXT))
    strict = F.col(DOCUMENT).isNotNull()
    # as text, since folder names are read back as such
    rows = parsed.withColumns({STRICT: strict.cast("string"), TEXT: F.when(~strict, F.col(TEXT))})
    rows.write.mode(mode).partitionBy(KIND, STRICT).parquet(path)


def _path(names: tuple[str, ...]) -> str:
    return "$" + "".join(f"['{n}']" for n in names)


def present(names: tuple[str, ...]) -> Column:
    """Whether a document has a field, be its value null."""
    return F.try_variant_get(DOCUMENT, _path(names), "variant").isNotNull()


def field(names: tuple[str, ...], dtype: T.DataType) -> Column:
    """A field of the document. Structs are taken apart, so that unused parts are never read.

    A value of another type is cast, or null where it cannot be. A struct is
    never null itself; all its fields are where the document has none.
    """
    if isinstance(dtype, T.StructType) and dtype.fields:
        return F.struct(*[field((*names, f.name), f.dataType).alias(f.name) for f in dtype.fields])
    return F.try_variant_get(DOCUMENT, _path(names), dtype.simpleString())


def read_shredded(
    spark: SparkSession, path: str, kind: str, dtype: T.StructType, keys_of: tuple[tuple[str, ...], list[str]] | None = None
) -> DataFrame:
    """Rows of one kind as the columns of ``dtype``.

    ``keys_of`` asks for one more column, ``keys``: which of the listed keys the
    object at a path has (null without the object).
    """
    table = spark.read.parquet(path).where(F.col(KIND) == kind)
    columns = [field((f.name,), f.dataType).alias(f.name) for f in dtype.fields]
    loose = F.from_json(TEXT, dtype)
    rest = [loose[f.name].alias(f.name) for f in dtype.fields]
    if keys_of is not None:
        at, names = keys_of
        found = F.array_compact(F.array(*[F.when(present((*at, n)), F.lit(n)) for n in names]))
        columns.append(F.when(present(at), found).alias("keys"))
        held = F.json_object_keys(F.get_json_object(TEXT, _path(at)))
        rest.append(F.array_intersect(F.array(*map(F.lit, names)), held).alias("keys"))
    strict = F.col(STRICT) == "true"
    return table.where(strict).select(*columns).unionByName(table.where(~strict).select(*rest))
