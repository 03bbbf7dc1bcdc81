"""Upserts, the ledger, streaming ingestion, exports and the public surface."""

from __future__ import annotations

import datetime
import glob
import gzip
import json
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from crystalflow import schema as S
from crystalflow.operators import export, files, ledger, quality, selection, upsert
from crystalflow.plans import pipelines
from crystalflow.streaming.ingest import ingest_new_files


def frame(spark, rows, schema="id string, kind string, v int, at int"):
    return spark.createDataFrame(rows, schema)


def table(spark, path):
    return sorted((r["id"], r["kind"], r["v"]) for r in spark.read.parquet(path).collect())


@pytest.mark.parametrize("partition_by", [(), ("kind",)])
def test_upsert_replaces_and_inserts(spark, tmp_path, partition_by):
    path = str(tmp_path / "t")
    newest = [F.col("at").desc()]
    first = frame(spark, [("a", "x", 1, 1), ("b", "x", 2, 1), ("c", "y", 3, 1)])
    upsert.write_upsert(first, path, "id", newest, partition_by)
    batch = frame(spark, [("b", "x", 9, 1), ("b", "x", 10, 2), ("d", "x", 4, 1)])
    for _ in range(2):  # the same batch again changes nothing
        upsert.write_upsert(batch, path, "id", newest, partition_by)
        assert table(spark, path) == [("a", "x", 1), ("b", "x", 10), ("c", "y", 3), ("d", "x", 4)]
    assert not files.exists(spark, path + "__staging")


def test_untouched_partitions_are_not_rewritten(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert.write_upsert(frame(spark, [("a", "x", 1, 1), ("c", "y", 3, 1)]), path, partition_by=("kind",))
    before = set(glob.glob(path + "/kind=y/*.parquet"))
    upsert.write_upsert(frame(spark, [("a", "x", 2, 1)]), path, partition_by=("kind",))
    assert set(glob.glob(path + "/kind=y/*.parquet")) == before
    assert table(spark, path) == [("a", "x", 2), ("c", "y", 3)]


def test_interrupted_move_is_finished(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert.write_upsert(frame(spark, [("a", "x", 1, 1)]), path)
    frame(spark, [("a", "x", 5, 1), ("z", "x", 6, 1)]).write.parquet(path + "__staging")
    upsert.write_upsert(frame(spark, [("b", "x", 2, 1)]), path)
    assert table(spark, path) == [("a", "x", 5), ("b", "x", 2), ("z", "x", 6)]


def test_table_without_marker_is_not_overwritten(spark, tmp_path):
    """Another writer, or a catalog, may leave no _SUCCESS file."""
    path = str(tmp_path / "t")
    upsert.write_upsert(frame(spark, [("a", "x", 1, 1), ("b", "x", 2, 1)]), path)
    os.remove(f"{path}/_SUCCESS")
    upsert.write_upsert(frame(spark, [("b", "x", 7, 1)]), path)
    assert table(spark, path) == [("a", "x", 1), ("b", "x", 7)]
    os.makedirs(tmp_path / "marked")
    (tmp_path / "marked" / "_SUCCESS").write_text("")
    assert not files.has_data(spark, str(tmp_path / "marked"))
    assert not files.has_data(spark, str(tmp_path / "nothing"))


def test_small_batch_touches_few_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(f"k{i}", "x", i, 1) for i in range(200)]
    upsert.write_upsert(frame(spark, rows), path, buckets=16)
    before = set(glob.glob(path + "/*/*.parquet"))
    upsert.write_upsert(frame(spark, [("k5", "x", -5, 2), ("new", "x", 0, 2)]), path, buckets=16)
    after = set(glob.glob(path + "/*/*.parquet"))
    assert len({os.path.dirname(f) for f in before - after}) <= 2 and len(before & after) >= 14
    assert table(spark, path) == sorted([*[r[:3] for r in rows if r[0] != "k5"], ("k5", "x", -5), ("new", "x", 0)])


def test_many_touched_partitions_are_joined(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(upsert, "_MOST_LITERALS", 1)
    path = str(tmp_path / "t")
    upsert.write_upsert(frame(spark, [("a", "x", 1, 1), ("b", "y", 2, 1), ("c", "z", 3, 1), ("n", None, 4, 1)]), path, partition_by=("kind",))
    before = set(glob.glob(path + "/kind=z/*.parquet"))
    upsert.write_upsert(frame(spark, [("a", "x", 5, 1), ("b", "y", 6, 1), ("n", None, 7, 1)]), path, partition_by=("kind",))
    assert set(glob.glob(path + "/kind=z/*.parquet")) == before
    assert {(r["id"], r["v"]) for r in spark.read.parquet(path).collect()} == {("a", 5), ("b", 6), ("c", 3), ("n", 7)}


def test_create_table(spark, tmp_path):
    name = "created_structures"
    for _ in range(2):
        upsert.create_table(spark, name, S.STRUCTURE, ["source", "functional"], str(tmp_path / name))
    got = {f.name: f.dataType for f in spark.table(name).schema.fields}
    assert got == {f.name: f.dataType for f in S.STRUCTURE.fields}
    spark.sql(f"DROP TABLE {name}")


def test_ledger(spark, tmp_path):
    path = str(tmp_path / "ledger")
    assert ledger.read_version(spark, path, "mp") is None
    assert ledger.write_version(spark, path, "mp", "2024-01-01")
    assert ledger.write_version(spark, path, ledger.transform_key("mp"), "2024-01-02")
    assert not ledger.write_version(spark, path, "mp", "2024-01-01")
    assert ledger.write_version(spark, path, "mp", "2024-02-01")
    rows = {r["dataset_name"]: r for r in spark.read.parquet(path).collect()}
    assert {k: r["last_synced_version"] for k, r in rows.items()} == {"mp": "2024-02-01", "mp_transform": "2024-01-02"}
    assert {r["sync_status"] for r in rows.values()} == {"completed"}
    assert ledger.read_version(spark, path, "unknown") is None


def test_unreadable_ledger_does_not_stop_a_run(spark, tmp_path):
    path = tmp_path / "ledger"
    path.mkdir()
    (path / "_SUCCESS").write_text("")
    (path / "part.parquet").write_text("this is not parquet")
    assert ledger.read_version(spark, str(path), "mp") is None


def test_new_version(spark):
    df = spark.sql("SELECT timestamp'2024-03-01 23:00:00' AS last_modified UNION ALL SELECT null")
    assert ledger.new_version(df).first()["version"] == "2024-03-01"
    empty = ledger.new_version(df.where("false")).first()["version"]
    assert empty == str(spark.sql("SELECT current_date()").first()[0])


def test_source_is_loaded_only_when_url_or_date_changes(spark):
    listing = spark.createDataFrame(
        [("u1", datetime.date(2024, 1, 1)), ("u2", datetime.date(2024, 1, 1))], "url string, last_modified date"
    )
    known = spark.createDataFrame([("oqmd", "u1|2024-01-01"), ("other", "u2|2024-01-01")], "dataset_name string, last_synced_version string")
    assert [r["url"] for r in ledger.unseen_sources(listing, known, "oqmd").collect()] == ["u2"]


def write_jsonl(path, docs):
    with gzip.open(path, "wt") as out:
        out.writelines(json.dumps(d) + "\n" for d in docs)


def test_stream_takes_each_file_once(spark, tmp_path):
    source, target, check = (str(tmp_path / n) for n in ("in", "raw", "check"))
    os.mkdir(source)
    write_jsonl(f"{source}/a.jsonl.gz", [{"material_id": "m1", "v": 1}, {"task_id": "t1"}])

    def run():
        ingest_new_files(spark, source, target, check).awaitTermination()
        return {r["id"]: json.loads(r["attributes"]).get("v") for r in spark.read.parquet(target).collect()}

    assert run() == {"m1": 1, "t1": None}
    stamps = {f: os.path.getmtime(f) for f in glob.glob(target + "/*/*.parquet")}
    assert run() == {"m1": 1, "t1": None}
    assert {f: os.path.getmtime(f) for f in glob.glob(target + "/*/*.parquet")} == stamps
    write_jsonl(f"{source}/b.jsonl.gz", [{"material_id": "m1", "v": 2}, {"material_id": "m2", "v": 3}])
    assert run() == {"m1": 2, "t1": None, "m2": 3}


def test_stream_keeps_unusable_lines(spark, tmp_path):
    source, target, check = (str(tmp_path / n) for n in ("in", "raw", "check"))
    os.mkdir(source)
    with open(f"{source}/a.jsonl", "w") as out:
        out.write('{"material_id": "m1"}\nno json\n{"v": 3}\n')
    ingest_new_files(spark, source, target, check).awaitTermination()
    assert [r["id"] for r in spark.read.parquet(target).collect()] == ["m1"]
    rejects = spark.read.parquet(f"{target}_rejects").collect()
    assert sorted(r["value"] for r in rejects) == ["no json", '{"v": 3}']


def test_stream_stops_on_too_many_unusable_lines(spark, tmp_path):
    source, target, check = (str(tmp_path / n) for n in ("in", "raw", "check"))
    os.mkdir(source)
    with open(f"{source}/a.jsonl", "w") as out:
        out.write('{"material_id": "m1"}\nno json\n{"v": 3}\n')
    with pytest.raises(StreamingQueryException, match="2 of 3 rows rejected"):
        ingest_new_files(spark, source, target, check, most_unusable=0.5).awaitTermination()
    assert not os.path.exists(target)
    ingest_new_files(spark, source, target, check, most_unusable=0.7).awaitTermination()
    assert [r["id"] for r in spark.read.parquet(target).collect()] == ["m1"]


def test_curation_stops_on_too_many_rejects(spark):
    def job(df):
        return df.withColumn("reasons", F.when(F.col("id") % 4 == 0, F.array(F.lit("bad"))).otherwise(F.array()))

    pipelines.register_source("stopping", structures=job)
    with pytest.raises(quality.TooManyRejects, match="10 of 40"):
        pipelines.curate_structures("stopping", spark.range(40), most_rejected=0.2)
    good, bad = pipelines.curate_structures("stopping", spark.range(40), most_rejected=0.25)
    assert (good.count(), bad.count()) == (30, 10)
    assert quality.reject_counts(bad).first()["n_rows"] == 10


def test_ingest_is_incremental(spark, tmp_path):
    source, target, book = (str(tmp_path / n) for n in ("in", "raw", "ledger"))
    os.mkdir(source)
    write_jsonl(f"{source}/a.jsonl.gz", [{"material_id": "m1", "v": 1}])
    write_jsonl(f"{source}/manifest.jsonl.gz", [{"material_id": "m9", "v": 1}])
    os.utime(f"{source}/a.jsonl.gz", (1700000000, 1700000000))
    os.utime(f"{source}/manifest.jsonl.gz", (1700000000, 1700000000))
    run = lambda: pipelines.ingest(spark, source, target, book, "mp")
    assert run() == "2023-11-14"
    # an older file is now ignored, one of the version's day is not
    write_jsonl(f"{source}/old.jsonl.gz", [{"material_id": "m2", "v": 1}])
    write_jsonl(f"{source}/same.jsonl.gz", [{"material_id": "m3", "v": 1}])
    os.utime(f"{source}/old.jsonl.gz", (1600000000, 1600000000))
    os.utime(f"{source}/same.jsonl.gz", (1700000500, 1700000500))
    assert run() == "2023-11-14"
    assert {r["id"] for r in spark.read.parquet(target).collect()} == {"m1", "m3"}
    assert ledger.read_version(spark, book, "mp") == "2023-11-14"


def curated(spark, n=25):
    df = spark.range(n).select(
        F.format_string("s%03d", "id").alias("id"),
        F.when(F.col("id") % 5 == 0, "scan").otherwise("pbe").alias("functional"),
        (F.col("id") % 4 != 0).alias("cross_compatibility"),
        F.col("id").cast("double").alias("energy"),
        F.lit(2).alias("nelements"),
        F.array(F.struct(F.lit("Al").alias("name"), F.lit(None).cast("double").alias("mass"))).alias("species"),
        F.lit("2024-01-01").cast("timestamp").alias("last_modified"),
        F.lit(0.5).alias("band_gap_indirect"),
    )
    have = set(df.columns)
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in S.FRAME.fields if f.name not in have])


def split_of(i):
    if i % 4 == 0:
        return "non_compatible"
    return "compatible_scan" if i % 5 == 0 else "compatible_pbe"


def read_split(path, split):
    rows = []
    for name in sorted(glob.glob(f"{path}/split={split}/chunk=*/*.json")):
        with open(name) as lines:
            rows.append([json.loads(x) for x in lines])
    return rows


def test_export_writes_sorted_chunks_and_every_row(spark, tmp_path):
    path = str(tmp_path / "out")
    pipelines.export([curated(spark)], path, "trajectories", chunk_size=4)
    for split in ("non_compatible", "compatible_scan", "compatible_pbe"):
        chunks = read_split(path, split)
        ids = [r["id"] for chunk in chunks for r in chunk]
        assert ids == [f"s{i:03d}" for i in range(25) if split_of(i) == split]
        assert all(len(chunk) <= 4 for chunk in chunks)
    row = read_split(path, "non_compatible")[0][0]
    assert set(row) == set(export.FRAME_EXPORT)
    assert json.loads(row["species"]) == [{"name": "Al", "mass": None}]
    assert "band_gap_indirect" not in row and row["last_modified"].startswith("2024-01-01")
    assert not os.path.exists(f"{path}/split=compatible_r2scan")


def test_export_is_resumable(spark, tmp_path):
    path = str(tmp_path / "out")
    pipelines.export([curated(spark, 5)], path)
    pipelines.export([curated(spark, 25)], path)
    assert spark.read.json(path).count() == 5
    pipelines.export([curated(spark, 25)], path, force_refresh=True)
    assert spark.read.json(path).count() == 25
    assert "id" not in spark.read.json(path).columns


def chunk_files(path):
    return {name: os.stat(name).st_mtime_ns for name in glob.glob(f"{path}/split=*/chunk=*/*.json")}


def exported(path):
    return sorted(json.dumps(r, sort_keys=True) for name in chunk_files(path) for r in map(json.loads, open(name)))


def test_killed_export_goes_on_where_it_stopped(spark, tmp_path, monkeypatch):
    whole, path = str(tmp_path / "whole"), str(tmp_path / "out")
    pipelines.export([curated(spark)], whole, "trajectories", chunk_size=2)
    write, runs = export._write_chunks, []

    def fails_third(rows, *rest):
        runs.append(sorted(map(tuple, rows.select("split", "chunk").distinct().collect())))
        if len(runs) == 3:
            write(rows.limit(1), *rest)  # killed half way: its folders are not whole
            raise KeyboardInterrupt
        write(rows, *rest)

    monkeypatch.setattr(export, "_write_chunks", fails_third)
    with pytest.raises(KeyboardInterrupt):
        pipelines.export([curated(spark)], path, "trajectories", chunk_size=2)
    finished = {f"{path}/split={s}/chunk={c}" for s, c in runs[0] + runs[1]}
    before = {name: at for name, at in chunk_files(path).items() if os.path.dirname(name) in finished}
    assert len(before) == len(finished) > 0 and not os.path.exists(f"{path}/_SUCCESS")
    pipelines.export([curated(spark)], path, "trajectories", chunk_size=2)
    after = chunk_files(path)
    assert before.items() <= after.items()
    assert not {c for run in runs[3:] for c in run} & set(runs[0] + runs[1])
    assert exported(path) == exported(whole) and len(after) == len(chunk_files(whole))
    assert os.path.exists(f"{path}/_SUCCESS")


def test_export_of_changed_input_rewrites_changed_chunks(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = curated(spark)
    pipelines.export([rows], path, "trajectories", chunk_size=3)
    before = chunk_files(path)
    os.remove(f"{path}/_SUCCESS")
    changed = rows.withColumn("energy", F.when(F.col("id") == "s004", F.lit(-5.5)).otherwise(F.col("energy"))).where("id < 's022'")
    pipelines.export([changed], path, "trajectories", chunk_size=3)
    after = chunk_files(path)
    fresh = str(tmp_path / "fresh")
    pipelines.export([changed], fresh, "trajectories", chunk_size=3)
    assert exported(path) == exported(fresh) and len(after) == len(chunk_files(fresh))
    kept = before.items() & after.items()
    assert 0 < len(kept) < len(after) and any("chunk=00000000" in name and name not in dict(kept) for name in after)


def test_export_cap_any_and_union(spark, tmp_path):
    capped = str(tmp_path / "capped")
    pipelines.export([curated(spark)], capped, "trajectories", max_rows=3)
    counts = {r["split"]: r["count"] for r in spark.read.json(capped).groupBy("split").count().collect()}
    assert counts == {"non_compatible": 3, "compatible_scan": 3, "compatible_pbe": 3}
    free = str(tmp_path / "any")
    other = curated(spark, 3).select(F.concat(F.lit("z"), "id").alias("id"), "functional", "cross_compatibility")
    pipelines.export([curated(spark, 4), other, other.where("false")], free, "any", fmt="parquet")
    got = spark.read.parquet(free)
    assert got.count() == 7 and "band_gap_indirect" in got.columns
    assert export.is_empty(other.where("false")) and not export.is_empty(other)


def test_narrow_cast_does_not_wrap(spark):
    rows = curated(spark, 1).withColumn("nelements", F.lit(300))
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        export.export_columns(rows, {"nelements": "tinyint"}).collect()


def test_caps_and_slices(spark):
    df = spark.range(100).select(F.format_string("k%03d", "id").alias("id"))
    ids = lambda d: sorted(r["id"] for r in d.collect())
    assert ids(export.cap_rows(df, 7)) == [f"k{i:03d}" for i in range(7)]
    assert export.cap_rows(df, -1).count() == 100
    seeded = ids(export.cap_rows(df, 10, seed=3))
    assert seeded == ids(export.cap_rows(df.repartition(7), 10, seed=3)) and len(seeded) == 10
    assert seeded != ids(export.cap_rows(df, 10, seed=4))
    pages = [ids(selection.slice_by_key(df, ["id"], at, 30)) for at in (0, 30, 60, 90)]
    assert sum(pages, []) == ids(df)
    assert ids(selection.slice_by_key(df, ["id"], 95)) == [f"k{i:03d}" for i in range(95, 100)]
    assert ids(pipelines.slice_input(df, offset=10, limit=50, max_offset=12)) == ["k010", "k011"]


def test_sources_can_be_registered_and_rows_enriched(spark):
    def job(df):
        return df.withColumn("reasons", F.when(F.col("id") > 1, F.array(F.lit("big"))).otherwise(F.array()))

    pipelines.register_source("mine", structures=job)
    good, bad = pipelines.curate_structures("mine", spark.range(4))
    assert good.count() == 2 and bad.count() == 2

    def number(pdf):
        return pdf.assign(space_group_it_number=pdf["id"] + 1)

    enriched = pipelines.enrich(spark.range(5), number, "id long, space_group_it_number long")
    assert sorted(r[1] for r in enriched.collect()) == [1, 2, 3, 4, 5]


def test_store_records_the_transform(spark, tmp_path):
    rows = curated(spark, 4).withColumn("source", F.lit("mp")).select(*S.STRUCTURE.fieldNames())
    version = pipelines.store(rows, str(tmp_path / "s"), str(tmp_path / "l"), "structures")
    assert version == "2024-01-01"
    assert ledger.read_version(spark, str(tmp_path / "l"), "structures_transform") == version
    assert spark.read.parquet(str(tmp_path / "s")).count() == 4
