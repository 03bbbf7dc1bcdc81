"""Ingestion from keyed files, paged services, index pages and dump listings."""

from __future__ import annotations

import datetime
import json

import pytest
from pyspark.errors import StreamingQueryException

from crystalflow.operators import ledger
from crystalflow.plans import pipelines
from crystalflow.sources import documents
from crystalflow.streaming.ingest import ingest_new_pages

STEP = {"structure": None, "energy": -1.0, "forces": None, "stress": None}


def test_keyed_files(spark, tmp_path):
    source, table, versions = (str(tmp_path / n) for n in ("in", "raw", "ledger"))

    def write(folder, content):
        target = tmp_path / "in" / folder
        target.mkdir(parents=True, exist_ok=True)
        (target / "part.json").write_text(json.dumps(content))

    def held():
        rows = spark.read.parquet(table).collect()
        return sorted((r["id"], r["relaxations"][0]["functional"], len(r["relaxations"][0]["steps"])) for r in rows)

    write("geo_opt_pbe", {"agm1": [{"steps": [STEP]}], "agm2": [{"steps": [STEP]}]})
    write("geo_opt_scan", {"agm1": [{"steps": [STEP, STEP]}]})
    day = pipelines.ingest_keyed(spark, source, table, versions, "keyed")
    assert day == datetime.datetime.now(datetime.UTC).date().isoformat() == ledger.read_version(spark, versions, "keyed")
    assert held() == [("agm1", "pbe", 1), ("agm1", "scan", 2), ("agm2", "pbe", 1)]
    write("geo_opt_scan", {"agm1": [{"steps": [STEP] * 3}]})
    pipelines.ingest_keyed(spark, source, table, versions, "keyed")
    assert held() == [("agm1", "pbe", 1), ("agm1", "scan", 3), ("agm2", "pbe", 1)]


def test_paged_service(spark, tmp_path):
    docs = [{"id": f"agm{i}", "type": "structures", "attributes": {"last_modified": f"2024-03-{i + 1:02d}T10:00:00Z"}} for i in range(9)]
    table, versions = str(tmp_path / "raw"), str(tmp_path / "ledger")

    def fetch(offset, limit):
        return {"data": docs[offset : offset + limit], "meta": {"data_available": len(docs)}}

    spark.dataSource.register(documents.paged_source(fetch, "ingest_pages_test"))
    assert pipelines.ingest_pages(spark, "ingest_pages_test", table, versions, "paged", {"limit": "4"}) == "2024-03-09"
    assert spark.read.parquet(table).count() == 9
    assert pipelines.ingest_pages(spark, "ingest_pages_test", table, versions, "paged", {"limit": "4"}) == "2024-03-09"
    assert spark.read.parquet(table).count() == 9


def test_pages_as_a_stream(spark, tmp_path):
    """The second run asks for new pages only, and a page that failed is asked for again."""
    table, check, log, held = (str(tmp_path / n) for n in ("raw", "check", "log", "held.json"))

    def serve(n, fails=False):
        docs = [{"id": f"agm{i}", "type": "structures", "attributes": {"last_modified": "2024-03-01T10:00:00Z", "v": i}} for i in range(n)]
        (tmp_path / "held.json").write_text(json.dumps({"docs": docs, "fails": fails}))
        (tmp_path / "log").write_text("")

    def fetch(offset, limit):
        import json

        with open(held) as text:
            state = json.load(text)
        if limit > 1:
            with open(log, "a") as out:
                out.write(f"{offset} ")
            if state["fails"] and offset == 12:
                raise ConnectionError("page lost")
        return {"data": state["docs"][offset : offset + limit], "meta": {"data_available": len(state["docs"])}}

    def run():
        ingest_new_pages(spark, "stream_pages_test", table, check, {"limit": "4"}).awaitTermination()
        asked = sorted(map(int, (tmp_path / "log").read_text().split()))
        return asked, sorted(r["id"] for r in spark.read.parquet(table).collect())

    spark.dataSource.register(documents.paged_source(fetch, "stream_pages_test"))
    serve(10)
    assert run() == ([0, 4, 8], sorted(f"agm{i}" for i in range(10)))
    serve(10)
    assert run() == ([], sorted(f"agm{i}" for i in range(10)))
    serve(15, fails=True)
    with pytest.raises(StreamingQueryException):
        run()
    assert spark.read.parquet(table).count() == 10
    serve(15)
    assert run() == ([8, 12], sorted(f"agm{i}" for i in range(15)))


def test_due_downloads_and_dumps(spark, tmp_path):
    versions = str(tmp_path / "ledger")
    html = (
        '<table><tr><td><a href="a.json.bz2">a</a></td><td>01-Mar-2024 10:00</td><td>5M</td></tr>'
        '<tr><td><a href="b.json.bz2">b</a></td><td>09-Mar-2024 10:00</td><td>5M</td></tr></table>'
    )
    pages = spark.createDataFrame([("http://host/dir/", html)], "url string, html string")
    names = lambda: sorted(r["filename"] for r in pipelines.due_downloads(pages, versions, "links", "json").collect())
    assert names() == ["a.json.bz2", "b.json.bz2"]
    ledger.write_version(spark, versions, "links", "2024-03-05")
    assert names() == ["b.json.bz2"]
    dumps = spark.createDataFrame([("u1", datetime.date(2024, 1, 1))], "url string, last_modified date")
    assert pipelines.due_dumps(dumps, str(tmp_path / "none"), "d").count() == 1
    ledger.write_version(spark, versions, "d", "u1|2024-01-01")
    assert pipelines.due_dumps(dumps, versions, "d").count() == 0
