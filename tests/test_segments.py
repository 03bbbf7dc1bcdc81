"""Segmented windows against plain Python loops, at several segment counts."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from crystalflow.operators import frames, segments as seg

HOT = "hot"


@pytest.fixture(scope="module")
def rows():
    """1200 frames; one key holds a third of them, one key has a single row."""
    draw = random.Random(11)
    out = []
    for i in range(1200):
        key = HOT if i % 3 == 0 else f"k{draw.randrange(20)}"
        energy = None if draw.random() < 0.15 else round(-draw.random() * 100, 3)
        own = None if draw.random() < 0.5 or energy is None else energy - draw.randrange(9)
        out.append((key, draw.randrange(300), i, energy, own, draw.randrange(5)))
    out.append(("single", 1, 5000, -1.0, -3.0, 2))
    return out


@pytest.fixture(scope="module")
def table(spark, rows):
    schema = "key string, at int, id int, energy double, own double, n int"
    return spark.createDataFrame(rows, schema).repartition(5)


def by_key(rows):
    groups = {}
    for row in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        groups.setdefault(row[0], []).append(row)
    return groups


@pytest.mark.parametrize("segments", [1, 2, 7, 64, 200])
def test_running_sum_and_position(table, rows, segments):
    expected = {}
    for group in by_key(rows).values():
        total = 0
        for place, row in enumerate(group):
            total += row[5]
            expected[row[2]] = (place, total)
    placed = seg.position(table, ["key"], ["at", "id"], "place", segments)
    got = seg.running_sum(placed, ["key"], ["at", "id"], {"total": F.col("n")}, segments)
    assert {r["id"]: (r["place"], r["total"]) for r in got.collect()} == expected


@pytest.mark.parametrize("segments", [1, 2, 7, 64, 200])
def test_carried_correction_matches_loop(table, rows, segments):
    expected = {}
    for group in by_key(rows).values():
        carried = None
        for _, _, ident, energy, own, _ in group:
            if energy is not None and carried is not None:
                value = energy + carried
            else:
                value = own if energy is not None else None
            carried = value - energy if value is not None and energy is not None else None
            expected[ident] = value
    got = frames.carry_correction(
        table, ["key"], ["at", "id"], "energy", "own", segments=segments
    ).collect()
    assert len(got) == len(rows)
    for row in got:
        want = expected[row["id"]]
        assert (row["own"] is None) == (want is None)
        assert want is None or row["own"] == pytest.approx(want)


def test_position_over_whole_table(table, rows):
    order = {r[2]: i for i, r in enumerate(sorted(rows, key=lambda r: (r[1], r[2])))}
    got = seg.position(table, [], ["at", "id"], "place", 9).collect()
    assert {r["id"]: r["place"] for r in got} == order


def test_segments_are_monotone_and_balanced(table):
    cuts = seg.cut_points(table, ["at", "id"], 6)
    assert cuts.points == sorted(set(cuts.points)) and len(cuts) == 5
    tagged = table.withColumn("s", seg.segment_of(table, ["at", "id"], cuts))
    spans = tagged.groupBy("s").agg(
        F.min(F.struct("at", "id")).alias("lo"), F.max(F.struct("at", "id")).alias("hi"), F.count("*").alias("n")
    ).orderBy("s").collect()
    assert all(a["hi"] < b["lo"] for a, b in zip(spans, spans[1:]))
    assert max(r["n"] for r in spans) < 1200 / 6 * 2


def test_string_timestamp_and_null_order_keys(spark):
    df = spark.sql(
        "SELECT concat('f', id % 17) AS name, CASE WHEN id % 5 > 0 THEN timestamp_seconds(id * 7919 % 1000) END AS at,"
        " id FROM range(500)"
    )
    rows = df.collect()
    want = sorted(rows, key=lambda r: (r["at"] is not None, r["at"].timestamp() if r["at"] else 0, r["name"], r["id"]))
    got = seg.position(df, [], ["at", "name", "id"], "place", 8).collect()
    assert {r["id"]: r["place"] for r in got} == {r["id"]: i for i, r in enumerate(want)}


def test_empty_input(spark):
    empty = spark.createDataFrame([], "key string, at int")
    assert seg.position(empty, ["key"], ["at"], "place", 8).count() == 0


@pytest.mark.parametrize("partitions", ["1", "4", "32"])
def test_result_does_not_depend_on_partitions(spark, table, partitions, monkeypatch):
    monkeypatch.setattr(seg, "ROWS_PER_SEGMENT", 100)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = seg.position(table, ["key"], ["at", "id"], "place").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    plain = seg.position(table, ["key"], ["at", "id"], "place", 1).collect()
    assert {(r["id"], r["place"]) for r in got} == {(r["id"], r["place"]) for r in plain}


@pytest.mark.parametrize("kind", ["string", "double", "timestamp", "date"])
@pytest.mark.parametrize("keys", [[], ["key"]])
def test_many_segments_on_other_order_types(spark, kind, keys):
    """More cut points than fit the plan one by one, for each type an order column can have."""
    number = (F.col("id") * 7919) % 3001
    order = {
        "string": F.concat(F.lit('q"\\'), F.lpad(number.cast("string"), 5, "0")),
        "double": number / 7 - 200,
        "timestamp": F.timestamp_seconds(number * 3601),
        "date": F.date_add(F.lit("1990-01-01").cast("date"), number.cast("int")),
    }[kind]
    key = F.when(F.col("id") % 3 == 0, HOT).otherwise(F.concat(F.lit("k"), (F.col("id") % 4).cast("string")))
    df = spark.range(3001).select(key.alias("key"), number.alias("number"), order.alias("at"))
    got = seg.position(df, keys, ["at"], "place", 150)
    assert len(seg.cut_points(df, ["at"], 150)) > 64
    groups = {}
    for r in sorted(got.collect(), key=lambda r: r["number"]):
        groups.setdefault(r["key"] if keys else None, []).append(r["place"])
    assert all(places == list(range(len(places))) for places in groups.values())


@pytest.mark.parametrize("segments", [1, 7, 64, 200])
@pytest.mark.parametrize("start, end", [(0, 10), (0, 0), (37, 640), (1190, None), (0, None), (5000, 6000)])
def test_between_equals_a_slice(table, rows, segments, start, end):
    got = seg.between(table, ["at", "id"], start, end, segments)
    assert got.columns == table.columns
    assert sorted(r["id"] for r in got.collect()) == sorted(r[2] for r in sorted(rows, key=lambda r: (r[1], r[2]))[start:end])


ORDERS = {
    "string": "concat('prefix/of/more/than/twenty/bytes/', lpad(cast(id AS string), 9, '0'))",
    "double": "(id * 7919 % 20011) / 7D - 200",
    "timestamp": "timestamp_seconds(id * 3601 % 100003)",
    "decimal": "cast(id / 8 AS decimal(20, 3))",
}
SHORT = "concat('k', id)"


@pytest.mark.parametrize("kind", ORDERS)
def test_sketched_cuts_are_even(spark, kind):
    df = spark.range(20_000).repartition(7).select("id", F.expr(ORDERS[kind]).alias("at"))
    cuts = seg.cut_points(df, ["at", "id"], 40)
    tagged = df.withColumn("s", seg.segment_of(df, ["at", "id"], cuts))
    spans = tagged.groupBy("s").agg(F.min(F.struct("at", "id")).alias("lo"), F.max(F.struct("at", "id")).alias("hi"), F.count("*").alias("n"))
    spans = spans.orderBy("s").collect()
    assert len(spans) >= 36 and max(r["n"] for r in spans) < 20_000 / 40 * 1.5
    assert all(a["hi"] < b["lo"] for a, b in zip(spans, spans[1:]))


def test_a_hot_first_value_is_cut_by_the_next_column(spark):
    df = spark.range(9_000).select(F.when(F.col("id") % 9 < 6, F.lit("same")).otherwise(F.col("id").cast("string")).alias("at"), "id")
    cuts = seg.cut_points(df, ["at", "id"], 30)
    counts = df.groupBy(seg.segment_of(df, ["at", "id"], cuts)).count().collect()
    assert len(counts) >= 25 and max(r["count"] for r in counts) < 2 * 9_000 / 30


def test_long_strings_with_opposite_ids(spark):
    """Strings that only differ behind the bytes compared must not be ordered by the next column."""
    text = F.concat(F.lit("x" * 30), F.when(F.col("id") % 2 == 0, "a").otherwise("b"), F.lit("y" * 30), F.lpad((5_000 - F.col("id")).cast("string"), 6, "0"))
    df = spark.range(5_000).select(text.alias("at"), "id")
    got = {r["id"]: r["place"] for r in seg.position(df, [], ["at", "id"], "place", 25).collect()}
    want = sorted(((r["at"], r["id"]) for r in df.collect()))
    assert got == {key: place for place, (_, key) in enumerate(want)}


def test_odd_values_in_order_keys(spark):
    rows = [(k, v) for k, v in enumerate([None, float("-inf"), -1.5, -0.0, 0.0, 2.5, float("inf"), float("nan")] * 40)]
    df = spark.createDataFrame(rows, "id int, at double")
    got = {r["id"]: r["place"] for r in seg.position(df, [], ["at", "id"], "place", 12).collect()}
    plain = {r["id"]: r["place"] for r in seg.position(df, [], ["at", "id"], "place", 1).collect()}
    assert got == plain
    texts = spark.createDataFrame([(k, t) for k, t in enumerate([None, "", "\0", "é", "z", "zz", "\U0001f600", "longer than seven bytes"] * 40)], "id int, at string")
    got = {r["id"]: r["place"] for r in seg.position(texts, [], ["at", "id"], "place", 12).collect()}
    assert got == {r["id"]: r["place"] for r in seg.position(texts, [], ["at", "id"], "place", 1).collect()}


@pytest.mark.parametrize("kind", ["id", *ORDERS])
@pytest.mark.parametrize("operator", ["running_sum", "carried_first", "between"])
def test_input_is_evaluated_twice(spark, monkeypatch, kind, operator):
    """Once to count and sketch, once for the local results; joins and tails read what was written."""
    monkeypatch.setattr(seg, "ROWS_PER_SEGMENT", 500)
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    at = F.expr({"id": "id", "string": SHORT}.get(kind, ORDERS.get(kind)))
    df = spark.range(4_000).mapInArrow(count, "id long").select("id", at.alias("at"), (F.col("id") % 3).alias("key"))
    if operator == "running_sum":
        out = seg.running_sum(df, ["key"], ["at", "id"], {"total": F.lit(1)})
    elif operator == "carried_first":
        out = seg.carried_first(df, ["key"], ["at", "id"], F.col("id"), F.col("id") % 5 == 0, "first")
    else:
        out = seg.between(df, ["at", "id"], 100, 3_000)
    assert out.count() == (2_900 if operator == "between" else 4_000)
    assert seen.value == 2 * 4_000
