"""Shredded raw tables against the parsed text, and bitmap prefilters."""

from __future__ import annotations

import json
import re

from pyspark.sql import functions as F, types as T

from crystalflow.operators import prefilter
from crystalflow.plans import materials, pipelines
from crystalflow.sources import documents, shredded
from test_plans import FREE, OPT, material, raw, structure, task


def test_curated_rows_equal_those_of_the_text(spark, tmp_path):
    mats = [
        material("mp-1", [("a", "Static", "GGA Static"), ("b", "Static", "GGA+U Static"), ("c", OPT, "r2SCAN x")]),
        material("mp-2", [("d", "Static", "GGA Static"), ("old", "Static", "GGA Static")], deprecated=["old"], elements=("Cs", "O")),
        material("mp-3", [("e", "Static", "GGA Static")]),
    ]
    tasks = [
        task("a", energy=-10.0), task("b", energy=-12.0), task("c", OPT, energy=-11.0),
        task("d", structure=structure("Cs", "O")), task("old", energy=-99.0), task("e", energy=float("nan")),
    ]
    rows = raw(spark, mats + tasks)
    path = f"{tmp_path}/raw"
    shredded.write_shredded(rows, path)
    by_text = pipelines.curate_structures("mp", materials.typed_materials(rows), materials.typed_tasks(rows), coefficients=FREE)
    stored = (materials.shredded_materials(spark, path), materials.shredded_tasks(spark, path))
    by_field = pipelines.curate_structures("mp", *stored, coefficients=FREE)
    for one, other in zip(by_text, by_field, strict=True):
        assert one.count() > 0 or other.count() == 0
        assert {r["id"]: r.asDict(True) for r in one.collect()} == {r["id"]: r.asDict(True) for r in other.collect()}


def test_scan_reads_the_fields_asked_for(spark, tmp_path):
    docs = [{"task_id": f"t{k}", "nsites": k, "output": {"energy": -1.5 * k, "bandgap": None}, "pad": "x" * 500} for k in range(300)]
    path = f"{tmp_path}/raw"
    shredded.write_shredded(raw(spark, docs), path)
    found = materials.shredded_tasks(spark, path).select("task_id", F.col("output.energy").alias("energy"))
    plan = found._jdf.queryExecution().toString()
    read = re.search(r"ReadSchema: (struct<document.*)", plan)[1]
    assert "pad" not in read and re.match(r"struct<document:struct<0:string,1:double>", read)
    assert {(r["task_id"], r["energy"]) for r in found.collect()} == {(f"t{k}", -1.5 * k) for k in range(300)}
    keys = materials.shredded_tasks(spark, path).select("output_keys").first()[0]
    assert keys == ["energy", "bandgap"]  # a null value counts as present


def test_odd_documents(spark, tmp_path):
    lines = [
        ("a", '{"material_id": "a", "x": NaN, "o": {"p": 1}}'), ("b", '{"material_id": "b", "x": "2.5", "o": null}'),
        ("c", '{"material_id": "c", "x": "two"}'), ("d", "[1]"), ("e", None),
    ]
    rows = spark.createDataFrame(lines, "id string, attributes string").withColumn("type", F.lit(documents.MATERIAL))
    path = f"{tmp_path}/raw"
    shredded.write_shredded(rows, path)
    kind = T.StructType.fromDDL("material_id string, x double, o struct<p: int>")
    found = shredded.read_shredded(spark, path, documents.MATERIAL, kind).collect()
    named = {r["material_id"]: (str(r["x"]), r["o"] and r["o"]["p"]) for r in found if r["material_id"]}
    assert named == {"a": ("nan", 1), "b": ("2.5", None), "c": ("None", None)}
    assert len(found) == 5
    assert shredded.read_shredded(spark, path, documents.TASK, kind).count() == 0


def test_likely_rows(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("id")).alias("key"), F.lit(1).alias("_bit"))
    wanted = spark.range(0, 2_000, 3).select(F.col("id").cast("int").alias("key")).union(spark.createDataFrame([(None,)], "key int"))
    passed = {r["key"] for r in prefilter.likely(rows.select("key"), ["key"], wanted).collect()}
    asked = {k for k in range(0, 2_000, 3) if k % 7}
    assert asked <= passed and len(passed) < len(asked) + 50
    crowded = {r["key"] for r in prefilter.likely(rows.select("key"), ["key"], wanted, bits=4).collect()}
    assert asked <= crowded
    assert prefilter.likely(rows.select("key"), ["key"], wanted.limit(0)).count() == 0


def test_document_text_is_kept_once(spark, tmp_path):
    shredded.write_shredded(raw(spark, [{"material_id": "m", "v": [1, {"w": 2}]}]), f"{tmp_path}/raw")
    row = spark.read.parquet(f"{tmp_path}/raw").select("attributes", F.to_json("document").alias("d")).first()
    assert row["attributes"] is None and json.loads(row["d"]) == {"material_id": "m", "v": [1, {"w": 2}]}
