"""Ordered per-key computation that never puts a whole key in one task.

A plain window over ``partitionBy(key)`` sends every row of a key to one task.
When one key holds a third of the data that task never ends. Here the order
key is cut into segments of about equal row count, windows run per
``(key, segment)``, and what has to cross a segment border is carried by a
table of per-segment summaries, which holds at most ``segments`` rows per key.

The cut points are literals, so a row's segment is a pure function of the row:
a retried task or a second read of the input always agrees. They come from
mergeable quantile sketches of the order columns, built in the one pass that
counts the rows; poor ones cost balance, never correctness. The local results
are written to scratch, so that the input itself is evaluated twice in all,
however dear it is.

Keys must be non-null and the order total within a key; null order keys come
first and share a segment.
"""

from __future__ import annotations

import base64
import json
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import groupby, takewhile

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from crystalflow.operators.scratch import materialise

SEGMENT = "_segment"
_SKETCH = 8_192  # items of a sketch: ranks are good to some 0.07 %
_SKETCH_GROUPS = 64  # sketches merge in so many groups first, not all in one task
_MAX_SEGMENTS = 1_000  # what such ranks can tell apart; beyond fifty million rows segments grow
ROWS_PER_SEGMENT = 50_000  # no finer: so many rows of one key fit any task
_FAN = 64  # cut points per branching level
_WINDOW = 7  # bytes of a string that a non-negative long holds
_WINDOWS = 3  # such windows per string column
_SHARE = 8  # of every so many rows one goes into the sketches
_GRID = 2_048  # shares at which sketches are asked for quantiles
_SKETCHES = {
    "bigint": (F.kll_sketch_agg_bigint, F.kll_merge_agg_bigint, F.kll_sketch_get_quantile_bigint, F.kll_sketch_get_n_bigint),
    "double": (F.kll_sketch_agg_double, F.kll_merge_agg_double, F.kll_sketch_get_quantile_double, F.kll_sketch_get_n_double),
}


def _columns(df: DataFrame, names: Sequence[str | Column]) -> list[Column]:
    return [df[n] if isinstance(n, str) else n for n in names]


@dataclass(frozen=True)
class Part:
    """A number that sorts as (a piece of) an order column does; null where that is null."""

    value: Column
    kind: str  # bigint or double
    column: int
    exact: bool  # False if rows that differ in the column may have equal numbers
    window: bool = False  # bytes of a string


def _bytes(column: Column, start: int) -> Column:
    """Seven bytes of a string from ``start`` as a number; absent ones count as zero."""
    piece = F.rpad(F.substring(F.encode(column, "utf-8"), start + 1, _WINDOW), _WINDOW, F.lit(b"\0"))
    return F.conv(F.hex(piece), 16, 10).cast("bigint")


def _parts(df: DataFrame, order: Sequence[str | Column], skip: Mapping[int, bytes]) -> list[Part]:
    """The order columns as numbers: a string as windows of its bytes behind ``skip``, others as one.

    Rows that differ may have equal numbers, but never numbers in the other order.
    """
    probe = df.select(*[c.alias(f"o{i}") for i, c in enumerate(_columns(df, order))]).schema
    out = []
    for i, (column, field) in enumerate(zip(_columns(df, order), probe.fields, strict=True)):
        kind = field.dataType
        if isinstance(kind, T.StringType):
            out += [Part(_bytes(column, len(skip.get(i, b"")) + _WINDOW * k), "bigint", i, False, True) for k in range(_WINDOWS)]
        elif isinstance(kind, T.TimestampType):
            out.append(Part(F.unix_micros(column), "bigint", i, True))
        elif isinstance(kind, T.TimestampNTZType):
            out.append(Part(F.unix_micros(column.cast("timestamp")), "bigint", i, True))
        elif isinstance(kind, T.DateType):
            out.append(Part(F.unix_date(column).cast("bigint"), "bigint", i, True))
        elif isinstance(kind, T.BooleanType):
            out.append(Part(column.cast("int").cast("bigint"), "bigint", i, True))
        elif isinstance(kind, T.IntegralType):
            out.append(Part(column.cast("bigint"), "bigint", i, True))
        elif isinstance(kind, T.DecimalType):
            out.append(Part(column.cast("double"), "double", i, kind.precision <= 15))
        elif isinstance(kind, T.FractionalType):
            out.append(Part(column.cast("double"), "double", i, True))
        else:
            raise TypeError(f"cannot order by {kind.simpleString()}")
    return out


@dataclass(frozen=True)
class Cuts:
    """Increasing cut points over the order columns; strings are given by their first bytes.

    A shorter point stands before longer ones that begin with it.
    """

    points: list[tuple]

    def __len__(self) -> int:
        return len(self.points)


def _whole(point: tuple, parts: Sequence[Part], skip: Mapping[int, bytes]) -> tuple:
    """A point over parts as one over columns."""
    out = []
    for column, values in groupby(zip(parts, point), lambda pair: pair[0].column):
        values = list(values)
        if values[0][0].window:
            out.append((skip.get(column, b"") + b"".join(v.to_bytes(_WINDOW) for _, v in values)).rstrip(b"\0"))
        else:
            out.append(values[0][1])
    return tuple(out)


def _common_bytes(low: str | None, high: str | None) -> bytes:
    a, b = (low or "").encode(), (high or "").encode()
    return a[: next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))]


def _comparable(parts: Sequence[Part], whole: set[int]) -> list[Part]:
    """The leading parts that may be compared one after another.

    A later column counts only where the one before is equal, so nothing comes
    after a column that its parts do not tell apart (``whole``: strings that
    they do).
    """
    for column in range(parts[-1].column):
        if column not in whole and not all(p.exact for p in parts if p.column == column):
            return [p for p in parts if p.column <= column]
    return list(parts)


def _points(quantiles: Sequence, segments: int, level: int = 0, prefix: tuple = ()) -> tuple[list[tuple], bool]:
    """Cut points of ``segments`` equal shares of the rows that start with ``prefix``; also: is a share left uncut?

    Where one value fills several shares, they are cut by the next column, as it
    is distributed over all rows.
    """
    out, uncut = [], False
    for value, run in groupby(quantiles[level](i / segments) for i in range(1, segments)):
        point, repeats = (*prefix, value), len(list(run))
        out.append(point)
        if repeats > 1 and level + 1 < len(quantiles):
            inner, rest = _points(quantiles, repeats, level + 1, point)
            out, uncut = out + inner, uncut or rest
        elif repeats > 1:
            uncut = True
    return out, uncut


def cut_points(df: DataFrame, order: Sequence[str | Column], segments: int | None = None, skip: Mapping[int, bytes] | None = None) -> Cuts:
    """At most ``segments - 1`` increasing order keys that split ``df`` about evenly; by default a segment per 50 000 rows.

    One pass over the order columns gives the number of rows and a quantile
    sketch of each, of every eighth row by hash where the number of segments is
    left open (there are many rows then, or no cuts). Strings are compared by their first bytes; where all
    strings of a column share those, a second pass looks at the bytes behind.
    """
    if segments is not None and segments <= 1:
        return Cuts([])
    skip = dict(skip or {})
    parts, columns = _parts(df, order, skip), _columns(df, order)
    probe = df.select(*[c.alias(f"o{i}") for i, c in enumerate(columns)]).schema
    strings = [i for i, f in enumerate(probe.fields) if isinstance(f.dataType, T.StringType)]
    facts = {"low": F.min, "high": F.max, "bytes": lambda c: F.max(F.octet_length(c)), "odd": lambda c: F.max(F.contains(c, F.lit("\0")))}
    facts = {f"{name}{i}": (f, F.min if name == "low" else F.max, f"s{i}") for i in strings for name, f in facts.items()}
    taken = F.lit(True) if segments is not None else F.pmod(F.xxhash64(*columns), F.lit(_SHARE)) == 0
    narrow = df.select(
        F.pmod(F.spark_partition_id(), F.lit(_SKETCH_GROUPS)).alias("group"),
        *[F.when(taken, p.value).alias(f"p{i}") for i, p in enumerate(parts)],
        *[columns[i].alias(f"s{i}") for i in strings],
    )
    grouped = narrow.groupBy("group").agg(
        F.count(F.lit(1)).alias("n"),
        *[f(F.col(c)).alias(name) for name, (f, _, c) in facts.items()],
        *[_SKETCHES[p.kind][0](f"p{i}", F.lit(_SKETCH)).alias(f"k{i}") for i, p in enumerate(parts)],
    )
    merged = grouped.agg(
        F.sum("n").alias("n"),
        *[f(name).alias(name) for name, (_, f, _) in facts.items()],
        *[_SKETCHES[p.kind][1](f"k{i}", F.lit(_SKETCH)).alias(f"k{i}") for i, p in enumerate(parts)],
    )
    shares = F.from_json(F.lit(json.dumps([k / _GRID for k in range(_GRID + 1)])), "array<double>")
    quantiles = [F.when(_SKETCHES[p.kind][3](f"k{i}") > 0, _SKETCHES[p.kind][2](f"k{i}", shares)).alias(f"q{i}") for i, p in enumerate(parts)]
    found = merged.where("n > 0").select("n", *facts, *quantiles).first()  # one row
    total = found["n"] if found else 0
    if segments is None:
        segments = min(_MAX_SEGMENTS, -(-total // ROWS_PER_SEGMENT))
    if total == 0 or segments <= 1:
        return Cuts([])
    whole = {i for i in strings if not found[f"odd{i}"] and (found[f"bytes{i}"] or 0) <= len(skip.get(i, b"")) + _WINDOW * _WINDOWS}
    usable = _comparable(parts, whole)
    grids = list(takewhile(lambda grid: grid is not None, (found[f"q{i}"] for i in range(len(usable)))))
    if not grids:
        return Cuts([])
    points, uncut = _points([lambda share, g=g: g[round(share * _GRID)] for g in grids], segments)
    if uncut:
        deeper = {i: _common_bytes(found[f"low{i}"], found[f"high{i}"]) for i in strings}
        if any(len(deeper[i]) >= len(skip.get(i, b"")) + _WINDOW for i in strings):
            return cut_points(df, order, segments, deeper)
    return Cuts([_whole(p, parts, skip) for p in points if all(math.isfinite(v) for v in p)])


def default_segments(df: DataFrame) -> int:
    """As many as the session has shuffle partitions."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _tree(key: Column, cuts: list[Column], low: int, high: int) -> Column:
    """Number of ``cuts`` at or below ``key``, by bisection."""
    if low == high:
        return F.lit(low)
    mid = (low + high) // 2
    return F.when(key >= cuts[mid], _tree(key, cuts, mid + 1, high)).otherwise(
        _tree(key, cuts, low, mid)
    )


def segment_of(df: DataFrame, order: Sequence[str | Column], cuts: Cuts) -> Column:
    """Segment number of each row: how many cut points are at or below its key."""
    width = max(map(len, cuts.points))  # columns behind are not needed to tell cut points apart
    values, kinds = [], []
    for column in range(width):
        part = next(p for p in _parts(df, order, {}) if p.column == column)
        values.append(_columns(df, order)[column].cast("binary") if part.window else part.value)
        kinds.append("binary" if part.window else part.kind)
    points = [(*p, *[None] * (width - len(p))) for p in cuts.points]  # null is below every value
    single = width == 1

    def literal(point: tuple) -> Column:
        literals = [F.lit(v).cast(kind).alias(f"o{i}") for i, (v, kind) in enumerate(zip(point, kinds, strict=True))]
        return literals[0] if single else F.struct(*literals)

    key = values[0] if single else F.struct(*[v.alias(f"o{i}") for i, v in enumerate(values)])
    if len(points) <= _FAN:
        return _tree(key, [literal(p) for p in points], 0, len(points))
    coarse = [literal(p) for p in points[_FAN - 1 :: _FAN]]
    blocks = _constant(points, kinds, single)
    block = _tree(key, coarse, 0, len(coarse))
    inside = F.filter(F.get(blocks, block), lambda cut: cut <= key)
    # past the last full block there is no further cut: get() gives null
    return block * _FAN + F.coalesce(F.size(inside), F.lit(0))


def _constant(points: list[tuple], kinds: list[str], single: bool) -> Column:
    """Cut points in blocks of ``_FAN``, as one constant."""
    names = [f"o{i}" for i in range(len(kinds))]
    values = [p[0] if single else dict(zip(names, p)) for p in points]
    point = kinds[0] if single else f"struct<{','.join(f'{n}:{k}' for n, k in zip(names, kinds))}>"
    text = json.dumps([values[i : i + _FAN] for i in range(0, len(values), _FAN)], default=lambda b: base64.b64encode(b).decode())
    return F.from_json(F.lit(text), f"array<array<{point}>>")


def _split(
    df: DataFrame, order: Sequence[str | Column], segments: int | None
) -> tuple[DataFrame, bool]:
    """Add the segment column; also says whether there is more than one segment.

    ``segments=1`` declares every key small; by default the number follows the
    row count alone.
    """
    cuts = cut_points(df, order, segments)
    number = segment_of(df, order, cuts) if cuts else F.lit(0)
    return df.withColumn(SEGMENT, number), bool(cuts)


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    values: Mapping[str, Column],
    segments: int | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add, per output name, the running sum of its column within the key.

    The sum includes the current row. ``keys=[]`` runs over the whole table.
    ``keep`` names the columns of the result, by default all; the keys are
    among them. Others are neither written nor joined.
    """
    columns = df.columns if keep is None else list(keep)
    parts = {name: f"_value_{name}" for name in values}
    tagged, several = _split(df, order, segments)
    cut = tagged.select("*", *[value.alias(parts[name]) for name, value in values.items()])
    group = [*keys, SEGMENT]
    here = Window.partitionBy(*group).orderBy(*_columns(cut, order)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    own = [F.col(parts[name]).alias(f"_own_{name}") for name in values] if several else []
    local = cut.select(
        *columns, SEGMENT, *own, *[F.sum(parts[name]).over(here).alias(f"_local_{name}") for name in values]
    )
    if not several:
        return local.select(*columns, *[F.col(f"_local_{n}").alias(n) for n in values])

    local = materialise(local)
    earlier = Window.partitionBy(*keys).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    before = (
        local.groupBy(*group)
        .agg(*[F.sum(f"_own_{name}").alias(f"_total_{name}") for name in values])
        .select(*group, *[F.sum(f"_total_{n}").over(earlier).alias(f"_before_{n}") for n in values])
    )
    joined = local.join(before, group, "left")
    return joined.select(
        *columns,
        *[
            F.when(F.col(f"_before_{n}").isNull(), F.col(f"_local_{n}"))
            .otherwise(F.coalesce(F.col(f"_local_{n}"), F.lit(0)) + F.col(f"_before_{n}"))
            .alias(n)
            for n in values
        ],
    )


def position(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    name: str,
    segments: int | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add the 0-based position of each row within its key, to the columns ``keep`` (default all)."""
    counted = running_sum(df, keys, order, {name: F.lit(1).cast("bigint")}, segments, keep)
    return counted.withColumn(name, F.col(name) - 1)


def between(
    df: DataFrame, order: Sequence[str | Column], start: int, end: int | None = None, segments: int | None = None
) -> DataFrame:
    """Rows at positions ``[start, end)`` of the whole table in ``order``.

    Rows are counted per segment; segments wholly inside are kept as they are,
    and only the one or two at the borders are sorted.
    """
    columns = df.columns
    tagged, several = _split(df, order, segments)
    tagged = materialise(tagged) if several else tagged
    counts = sorted(map(tuple, tagged.groupBy(SEGMENT).agg(F.count(F.lit(1))).collect())) if several else [(0, None)]
    inside, border, base = [], {}, 0
    for number, n in counts:  # at most one row per segment
        past = None if n is None else base + n
        if past is not None and start <= base and (end is None or past <= end):
            inside.append(number)
        elif (past is None or start < past) and (end is None or base < end):
            border[number] = base
        base = past
    here = Window.partitionBy(SEGMENT).orderBy(*_columns(tagged, order))
    first = F.lit(0)
    for number, at in border.items():
        first = F.when(F.col(SEGMENT) == number, F.lit(at)).otherwise(first)
    place = F.row_number().over(here) - 1 + first
    edge = tagged.where(F.col(SEGMENT).isin(list(border))).withColumn("_place", place)
    edge = edge.where((F.col("_place") >= start) & (F.lit(True) if end is None else F.col("_place") < end)).select(*columns)
    if not inside:
        return edge
    return tagged.where(F.col(SEGMENT).between(inside[0], inside[-1])).select(*columns).unionByName(edge)


def carried_first(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    value: Column,
    reset: Column,
    name: str,
    segments: int | None = None,
) -> DataFrame:
    """Add the first non-null ``value`` since the last row where ``reset`` holds.

    The current row counts: it can supply the value, and a resetting row starts
    from nothing.
    """
    columns = df.columns
    tagged, several = _split(df, order, segments)
    cut = tagged.select(
        "*", value.alias("_value"), F.coalesce(reset, F.lit(False)).cast("bigint").alias("_reset")
    )
    ordering = _columns(cut, order)
    group = [*keys, SEGMENT]
    start_to_here = (Window.unboundedPreceding, Window.currentRow)
    runs = cut.withColumn(
        "_run", F.sum("_reset").over(Window.partitionBy(*group).orderBy(*ordering).rowsBetween(*start_to_here))
    )
    in_run = Window.partitionBy(*group, "_run").orderBy(*_columns(runs, order)).rowsBetween(*start_to_here)
    local = runs.withColumn("_first", F.first("_value", ignorenulls=True).over(in_run))
    if not several:
        return local.select(*columns, F.col("_first").alias(name))

    local = materialise(local)
    last_key = F.struct(*_columns(local, order))
    tails = local.groupBy(*group).agg(
        F.max_by("_first", last_key).alias("_tail"), (F.max("_run") > 0).alias("_broken")
    )
    along = Window.partitionBy(*keys).orderBy(SEGMENT)
    runs_of_segments = tails.withColumn(
        "_chain", F.sum(F.col("_broken").cast("int")).over(along.rowsBetween(*start_to_here))
    )
    in_chain = Window.partitionBy(*keys, "_chain").orderBy(SEGMENT).rowsBetween(*start_to_here)
    carried = (
        runs_of_segments.withColumn("_out", F.first("_tail", ignorenulls=True).over(in_chain))
        .withColumn("_in", F.lag("_out").over(along))
        .select(*group, "_in")
    )
    return local.join(carried, group, "left").select(
        *columns,
        F.when(F.col("_run") == 0, F.coalesce("_in", "_first")).otherwise(F.col("_first")).alias(name),
    )
