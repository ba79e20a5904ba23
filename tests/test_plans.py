import gzip
from datetime import datetime
from urllib.parse import parse_qs, urlparse

import duckdb
import pytest
from pyspark.sql import functions as F

from kartoteka.config import Settings, load_settings
from kartoteka.errors import AcquisitionError, ConfigError
from kartoteka.plans import pipeline as P
from kartoteka.plans import queries as Q
from kartoteka.plans import stage_queries
from kartoteka.sources import files, web
from kartoteka.sources.stores import DeadLetters, PhaseStore
from kartoteka.streaming import intake

SF = "/root/testdata/sf0.001"
TEXT = "KOWALSKI, Jan ur. 1890 w Łodzi, córka\nNOWAK, Anna zm. 1950 w roku żałoby, wdowa"


def test_pipeline_resumes(spark, tmp_path, rows):
    docs = spark.createDataFrame([("a", TEXT), ("a", TEXT), ("b", "This is purely English text"), ("c", "Pan i pani w roku"), ("d", None)], "doc_id string, text string")
    store, dead = PhaseStore(spark, f"{tmp_path}/ck"), DeadLetters(spark, f"{tmp_path}/dlq")
    run = P.Pipeline(spark, [P.acquisition(Settings()), P.classification(), P.entries()], store, dead)
    assert rows(run.run(docs), "slice_id") == [("a_p0_e0",), ("a_p0_e1",)]
    assert rows(run.summary()) == [("phase1_acquisition", 2, 0, 2, 0), ("phase2_classification", 1, 0, 1, 0), ("phase3_layout", 1, 0, 0, 0)]
    again = P.Pipeline(spark, run.phases, store, dead)
    assert rows(again.run(docs), "slice_id") == [("a_p0_e0",), ("a_p0_e1",)]
    assert {r.phase: (r.processed, r.skipped) for r in again.summary().collect()} == {"phase1_acquisition": (0, 2), "phase2_classification": (0, 1), "phase3_layout": (0, 1)}
    assert rows(store.completed("phase1_acquisition")) == [("a",), ("c",)]
    store.clear("phase1_acquisition")
    assert store.completed("phase1_acquisition").count() == 0 and store.completed("phase3_layout").count() == 1
    store.clear()
    assert store.completed("phase3_layout").count() == 0


def test_failures(spark, tmp_path, rows):
    dead = DeadLetters(spark, f"{tmp_path}/dlq")
    assert dead.failures().count() == 0
    kind = "phase string, doc_id string, error_class string, message string, input_data string"
    for message in ("first", "second"):
        dead.record(spark.createDataFrame([("p1", "doc1", "ValueError", message, None), ("p2", "doc2", "X", "y", "{}")], kind))
    (tmp_path / "dlq" / "bad.json").write_text("{not json\n")
    assert rows(dead.failures("p1"), "doc_id", "message") == [("doc1", "second")]
    assert dead.failures().count() == 2


def test_failed_documents_are_recorded(spark, tmp_path, rows):
    store, dead = PhaseStore(spark, f"{tmp_path}/ck"), DeadLetters(spark, f"{tmp_path}/dlq")
    run = P.Pipeline(spark, [P.entries()], store, dead)
    run.run(spark.createDataFrame([("short", "x"), ("long", "y" * 30)], "doc_id string, text string"))
    assert rows(run.summary(), "processed", "failed") == [(1, 1)]
    assert rows(dead.failures(), "doc_id", "message") == [("short", "no entries found")]


def test_local_documents(spark, tmp_path, rows):
    for name in ("b.pdf", "a.pdf", "c.txt"):
        (tmp_path / name).write_bytes(b"%PDF-1.4 dummy content for testing")
    found = files.local_documents(spark, str(tmp_path)).orderBy("path")
    assert [r.filename for r in found.collect()] == ["a.pdf", "b.pdf"]
    assert found.select("doc_id").distinct().count() == 1
    with pytest.raises(AcquisitionError):
        files.local_documents(spark, str(tmp_path / "none"))
    assert files.local_documents(spark, str(tmp_path / "none"), missing="empty").count() == 0


def warc(body, kind="application/pdf"):
    http = f"HTTP/1.1 200 OK\r\nContent-Type: {kind}\r\n\r\n".encode() + body
    return f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:1>\r\nContent-Length: {len(http)}\r\n\r\n".encode() + http + b"\r\n\r\n"


def test_web_archive(spark, rows):
    record = gzip.compress(warc(b"<html>", "text/html") + warc(b"%PDF"))

    def fetch(url, headers):
        if "page=0" in url and "a.example" in url:
            return 200, b'{"url":"u1","offset":0,"length":9,"filename":"f1"}\n{bad\n{"url":"u2"}\n'
        if url.endswith("f1"):
            return 206, record
        return (404, b"") if "page" in url else (500, b"")

    got = web.captures(spark, "http://index", ["b.example", "a.example"], fetch, 10)
    assert rows(got, "url", "length") == [("u1", 9), ("u2", 0)]
    assert rows(web.captures(spark, "http://index", ["a.example"], fetch, 1), "url") == [("u1",)]
    done = web.fetch_captures(got, "http://data/", fetch)
    assert rows(done.select("url", F.col("content").cast("string"), "warc_id", "error")) == [("u1", "%PDF", "<urn:1>", None), ("u2", None, None, "status 500")]
    with pytest.raises(AcquisitionError):
        web.captures(spark, "http://index", ["a.example"], lambda u, h: (503, b""), 1)


def test_settings(tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text("source: local\nocr:\n  confidence_threshold: 0.5\n")
    assert load_settings(path).ocr.confidence_threshold == 0.5
    for text in ("nonsense: 1\n", "ocr:\n  confidence_threshold: 2\n", "a: [\n", "- 1\n"):
        path.write_text(text)
        with pytest.raises(ConfigError):
            load_settings(path)
    with pytest.raises(ConfigError):
        load_settings(tmp_path / "none")


def test_stream(spark, tmp_path):
    kind = "doc_id bigint, text string, source string, n_chars bigint, acquired_at timestamp"
    now = datetime(2024, 1, 1)
    spark.createDataFrame([(1, TEXT, "s", 9, now), (2, TEXT, "s", 9, now), (3, "plain english", "s", 9, now)], kind).write.parquet(f"{tmp_path}/in")
    schema = spark.read.parquet(f"{tmp_path}/in").schema
    for _ in range(2):
        intake.intake(spark, f"{tmp_path}/in", schema, f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination()
        assert spark.read.parquet(f"{tmp_path}/out").count() == 1
    assert intake.arrivals(spark.read.parquet(f"{tmp_path}/in")).first()["documents"] == 3


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_queries_like_sql(spark, name):
    """Every query over the smallest tables; compared with its SQL where it has one."""
    import os

    got = Q.QUERIES[name](spark, SF)
    found = got.collect()
    if name in Q.ORACLES:
        db = duckdb.connect()
        db.sql("SET timezone = 'UTC'")
        for f in os.listdir(SF):
            db.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
        want = db.sql(Q.ORACLES[name])
        assert sorted(want.columns) == sorted(got.columns)

        def cell(v):
            if isinstance(v, datetime):
                return v.replace(tzinfo=None)
            return round(v, 9) if isinstance(v, float) else v

        order = sorted(got.columns)
        left = sorted(str([cell(r[c]) for c in order]) for r in found)
        at = [want.columns.index(c) for c in order]
        assert left == sorted(str([cell(r[i]) for i in at]) for r in want.fetchall())


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_queries_of_empty_tables(spark, name, tmp_path):
    import os

    for f in os.listdir(SF):
        spark.read.parquet(f"{SF}/{f}").limit(0).write.parquet(f"{tmp_path}/{f}")
    assert Q.QUERIES[name](spark, str(tmp_path)).collect() is not None


def test_captures_count_parsed_records_only(spark, rows):
    line = '{"url": "%s", "offset": "1", "length": "2", "filename": "f"}'
    pages = {("a.example", "0"): "bad\n" * 9 + line % "u0", ("a.example", "1"): "bad\n" * 9, ("a.example", "2"): line % "u1" + "\n" + line % "u2", ("b.example", "0"): line % "other"}

    def fetch(url, headers):
        query = parse_qs(urlparse(url).query)
        body = pages.get((query["url"][0].split("/")[0], query["page"][0]))
        return (200, body.encode()) if body else (404, b"")

    assert rows(web.captures(spark, "http://index", ["a.example", "b.example"], fetch, 3), "url") == [("u0",), ("u1",), ("u2",)]
    assert rows(web.captures(spark, "http://index", ["a.example", "b.example"], fetch, 9), "url") == [("other",), ("u0",), ("u1",), ("u2",)]
