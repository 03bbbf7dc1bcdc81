"""Readers on small files: documents, keyed files, listings, links, pages, dumps."""

from __future__ import annotations

import bz2
import datetime
import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from crystalflow.functions import text
from crystalflow.sources import documents, links, listing, relational

DAY = datetime.datetime(2024, 3, 14)


def write_jsonl(path, docs, raw_lines=()):
    with gzip.open(path, "wt") as out:
        for doc in docs:
            out.write(json.dumps(doc) + "\n")
        for line in raw_lines:
            out.write(line + "\n")


def test_compressed_lines_are_routed_and_bad_ones_kept_apart(spark, tmp_path):
    write_jsonl(
        tmp_path / "a.jsonl.gz",
        [
            {"material_id": "mp-1", "last_updated": {"$date": "2024-03-14T10:00:00Z"}, "elements": ["Si"]},
            {"task_id": "t-1", "last_updated": {"$date": "2024-03-14"}},
            {"task_id": "t-2"},
            {"nothing": 1},
        ],
        ["{broken", ""],
    )
    good, bad = documents.read_documents(spark, str(tmp_path))
    rows = {r["id"]: r for r in good.collect()}
    assert {k: r["type"] for k, r in rows.items()} == {"mp-1": "mp-material", "t-1": "mp-task", "t-2": "mp-task"}
    assert rows["mp-1"]["last_modified"] == datetime.datetime(2024, 3, 14, 10)
    assert rows["t-1"]["last_modified"] == DAY and rows["t-2"]["last_modified"] is None
    assert json.loads(rows["mp-1"]["attributes"])["elements"] == ["Si"]
    assert bad.count() == 3


def test_later_file_and_line_win(spark, tmp_path):
    write_jsonl(tmp_path / "a.jsonl.gz", [{"task_id": "t", "v": 1}, {"task_id": "t", "v": 2}])
    write_jsonl(tmp_path / "b.jsonl.gz", [{"task_id": "u", "v": 3}, {"task_id": "t", "v": 4}, {"task_id": "t", "v": 5}])
    os.utime(tmp_path / "b.jsonl.gz", (1, 1))
    good, _ = documents.read_documents(spark, str(tmp_path))
    latest = {r["id"]: json.loads(r["attributes"])["v"] for r in documents.latest_documents(good).collect()}
    assert latest == {"t": 2, "u": 3}


KEYED = """{"agm1": [{"steps": [{"structure": {"sites": []}, "energy": -1.0, "forces": [[0.1, NaN, 0.0]], "stress": null}]}],
 "agm NaN 2": [], "agm\\"3": [{"steps": []}, {"steps": [{"energy": NaN, "forces": null, "stress": [[1, 2, 3]]}]}]}"""


@pytest.fixture()
def keyed_file(tmp_path):
    folder = tmp_path / "pbesol"
    folder.mkdir()
    (folder / "geo.json.bz2").write_bytes(bz2.compress(KEYED.encode()))
    return str(folder)


def check_keyed(df):
    rows = {r["id"]: r["relaxations"] for r in df.collect()}
    assert set(rows) == {"agm1", "agm NaN 2", 'agm"3'}
    first = rows["agm1"][0]
    assert first["functional"] == "pbesol"
    assert first["steps"][0]["forces"] == [[0.1, None, 0.0]] and first["steps"][0]["energy"] == -1.0
    assert rows["agm NaN 2"] == []
    second = rows['agm"3'][1]["steps"][0]
    assert second["energy"] is None and second["forces"] is None and second["stress"] == [[1.0, 2.0, 3.0]]


def test_keyed_file(spark, keyed_file):
    check_keyed(documents.read_keyed_json(spark, keyed_file))


def test_keyed_file_in_pieces(spark, keyed_file):
    check_keyed(documents.read_keyed_json_pieces(spark, keyed_file))


ODD_KEYS = ["plain", "", 'quote"d', "back\\slash", "br]ack[et}s{", 'end\\"', ", comma: colon", "uni\u00e9\u2028", "new\nline", "]", '"]"', "\\]"]


@pytest.mark.parametrize("split, segments, indent", [(128 << 20, None, None), (700, 3, 2), (150, 1, None)])
def test_pieces_equal_whole_files_at_any_split(spark, tmp_path, split, segments, indent):
    for f, functional in enumerate(["pbe", "scan"]):
        step = lambda k: {"structure": None, "energy": -0.5 * k if k % 4 else float("nan"), "forces": [[k, 0.0, float("nan")]] * (k % 3), "stress": None}  # noqa: B023, E731
        docs = {f"{key}{n}": [{"functional": key, "steps": [step(k) for k in range(n % 5)]} for _ in range(n % 3)] for n, key in enumerate(ODD_KEYS * (3 + f))}
        (tmp_path / functional).mkdir()
        (tmp_path / functional / "geo.json").write_text(" \n" * (f == 1) + json.dumps(docs, indent=indent, ensure_ascii=f == 0))
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "none.json").write_text("{ }\n")
    paths = [str(tmp_path / n) for n in ("pbe", "scan", "empty")]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    plain = documents.read_keyed_json(spark, paths).collect()
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        cut = documents.read_keyed_json_pieces(spark, paths, segments).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(plain) == 7 * len(ODD_KEYS)
    assert sorted(map(repr, cut)) == sorted(map(repr, plain))


def test_pieces_of_an_entry_that_is_no_json(spark, tmp_path):
    (tmp_path / "geo.json").write_text('{"a": [], "b": [nonsense], "c": [{"steps": []}]}')
    assert sorted(r["id"] for r in documents.read_keyed_json_pieces(spark, str(tmp_path)).collect()) == ["a", "c"]


def test_paged_source(spark):
    docs = [
        {"id": f"agm{i}", "type": "structures", "attributes": {"nsites": i, "last_modified": "2024-03-14T10:00:00Z"}}
        for i in range(25)
    ]

    def fetch(offset, limit):
        return {"data": docs[offset : offset + limit], "meta": {"data_available": len(docs)}}

    spark.dataSource.register(documents.paged_source(fetch, "test_pages"))
    df = spark.read.format("test_pages").option("limit", 10).load()
    assert df.rdd.getNumPartitions() == 3
    rows = documents.with_modified(df).collect()
    assert sorted(r["id"] for r in rows) == sorted(d["id"] for d in docs)
    assert {r["last_modified"] for r in rows} == {DAY}
    later = spark.read.format("test_pages").option("limit", 10).option("offset", 12).load()
    assert later.count() == 15


def test_listing_reads_names_not_content(spark, tmp_path):
    for name in ("data1.jsonl.gz", "manifest.jsonl.gz", "data2.txt", "sub/data3.jsonl.gz"):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(b"1234")
    df = listing.list_objects(spark, str(tmp_path))
    assert df.columns == ["path", "last_modified", "length"]
    names = {os.path.basename(r["path"]): r["length"] for r in listing.data_files(df).collect()}
    assert names == {"data1.jsonl.gz": 4, "data3.jsonl.gz": 4}


def files(spark):
    rows = [("new", DAY), ("old", datetime.datetime(2024, 3, 12)), ("edge", datetime.datetime(2024, 3, 13, 1)), ("none", None)]
    return spark.createDataFrame(rows, "path string, last_modified timestamp")


@pytest.mark.parametrize(
    "version, kept",
    [
        (None, {"new", "old", "edge", "none"}),
        ("not a date", {"new", "old", "edge", "none"}),
        ("2024-03-13", {"new", "edge", "none"}),
        ("2024-03-15", {"none"}),
    ],
)
def test_modified_since(spark, version, kept):
    assert {r["path"] for r in listing.modified_since(files(spark), version).collect()} == kept


def test_oldest_first_and_offset(spark):
    rows = listing.oldest_first(files(spark), offset=1).orderBy("file_no").collect()
    assert [(r["file_no"], r["path"]) for r in rows] == [(1, "old"), (2, "edge"), (3, "new")]
    assert listing.latest_modified(files(spark)).first()["latest"] == DAY


def prefixes(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "prefix string")


def test_latest_collection(spark):
    plain = prefixes(spark, "collections/2023-01-01/", "collections/2023-03-01/", "collections/2023-02-01/", "collections/x/")
    assert listing.latest_collection_path(plain, "materials") == "collections/2023-03-01/materials"
    posts = prefixes(spark, *[f"collections/2023-03-01{s}/" for s in ("", "-post1", "-post10", "-post2", "-post")])
    assert listing.latest_collection_path(posts, "materials") == "collections/2023-03-01-post10/materials"
    with pytest.raises(ValueError):
        listing.latest_collection_path(prefixes(spark, "collections/x/"), "materials")


def test_latest_dump_and_its_date(spark):
    urls = spark.createDataFrame([("/d/db__v1_5.sql.gz",), ("/d/db__v1_10.sql.gz",), ("/d/other.gz",)], "url string")
    assert listing.latest_dump(urls).first()["url"] == "/d/db__v1_10.sql.gz"
    page = "OQMD v1.5 ... Database updated on: May, 2022\nOQMD v1.6 text\nDatabase updated on: <b>November,\t2023</b>\nend"
    row = spark.range(1).select(
        listing.dump_updated(F.lit(page), F.lit("v1.6")).alias("found"),
        listing.dump_updated(F.lit(page), F.lit("v1.5")).alias("older"),
        listing.dump_updated(F.lit(page), F.lit("v9.9"), F.to_date(F.lit("2000-01-01"))).alias("missing"),
    ).first()
    assert [str(v) for v in row] == ["2023-11-01", "2022-05-01", "2000-01-01"]


def test_month_year_and_days(spark):
    values = ["November, 2023", "<b>May,  2022</b>", "Smarch, 2020", "2020", None]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] and str(r[0]) for r in df.select(text.month_year(F.col("v"))).collect()]
    assert got == ["2023-11-01", "2022-05-01", None, None, None]
    stamps = spark.createDataFrame([("2024-03-14T10:00:00Z",), ("2024-03-14",), ("2024-13-13",)], "v string")
    assert [r[0] for r in stamps.select(text.iso_day(F.col("v"))).collect()] == [DAY, DAY, None]


PAGE = """<html><a href="../">Up</a><a href='..'>x</a><a href="x.json.bz2">x.json.bz2</a> 21-Mar-2024 09:20 1.2M
<A class="k" HREF='/abs/y.json.bz2'>y</A> junk text here
<table><tr><th>n</th></tr><tr><td><a href="z.sql.gz">z</a></td><td>2023-11-01</td><td>15MB</td></tr>
<tr><td><a href="./w/../q.sql.gz?x=1">z</a></td><td>03-Nov-2023 10:00</td><td>7GB</td></tr></table>
<a href="http://o.org/k.TXT#top">k</a><a href="?page=2">next</a><a name="no-link">n</a></html>"""


def test_links(spark):
    pages = spark.createDataFrame([("http://h.org/a/b.html?s=1", PAGE)], "url string, html string")
    rows = {r["url"]: (r["filename"], r["size"], r["last_modified"]) for r in links.extract_links(pages).collect()}
    assert rows == {
        "http://h.org/a/x.json.bz2": ("x.json.bz2", "1.2M", "2024-03-21T09:20:00"),
        "http://h.org/abs/y.json.bz2": ("y.json.bz2", None, None),
        "http://h.org/a/z.sql.gz": ("z.sql.gz", "15MB", "2023-11-01"),
        "http://h.org/a/q.sql.gz?x=1": ("q.sql.gz", "7GB", "2023-11-03T10:00:00"),
        "http://o.org/k.TXT#top": ("k.TXT", None, None),
        "http://h.org/a/b.html?page=2": ("b.html", None, None),
    }
    matching = links.extract_links(pages, r"\.(bz2|txt)$").collect()
    assert sorted(r["filename"] for r in matching) == ["k.TXT", "x.json.bz2", "y.json.bz2"]


def test_snapshot_tables(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "entries"))
    for name in ("structures", "calculations", "atoms"):
        spark.createDataFrame([], relational.S.dump_tables()[name]).write.parquet(str(tmp_path / name))
    tables = relational.read_snapshot(spark, str(tmp_path))
    assert set(tables) == {"entries", "structures", "calculations", "atoms"}
    assert tables["entries"].count() == 3
