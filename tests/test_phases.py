"""From a folder of files to persons and events, with stand-ins for rendering, recognition and the model."""

import json
import sys
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from kartoteka.config import CommonCrawl, Extraction, Settings
from kartoteka.errors import AcquisitionError, ExtractionError, OCRError
from kartoteka.operators import extract, images
from kartoteka.operators.bloom import BloomFilter
from kartoteka.plans import phases
from kartoteka.schemas import PHASES
from kartoteka.sources import adapters
from kartoteka.sources.resolution import ResolutionStore

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the workers cannot import tests

#: Entries, each drawn as a bar at its own place of a page, so that the stand-in for a recogniser can tell it.
TEXTS = ["KOWALSKI, Jan, ur. 1892", "NOWAK, Ewa, zm. 1950 w roku", "KOWALSKY, Adam, ur. 1901", "KOWALSKI, Jan, ur. 1892 w Łodzi", "źle", "ŻAK, Ewa, ur. 1888"]


def draw(indices):
    """A page of 400 rows with an entry of 40 rows for each index, parted by black lines."""
    page = np.full((400, 200), 255, np.uint8)
    for k, i in enumerate(indices):
        page[40 + 40 * k] = 0
        page[40 + 40 * k + 12 : 40 + 40 * k + 24, 20 * i + 20 : 20 * i + 40] = 0
    for k in range(len(indices), 8):
        page[40 + 40 * k] = 0
        page[40 + 40 * k + 12 : 40 + 40 * k + 24, 180:200] = 0
    return images.png(page)


def render(content):
    pages = json.loads(content)
    return [("\n".join([TEXTS[i] for i in p["entries"]] + p.get("lines", [])), p.get("drawings", 0), draw(p["entries"])) for p in pages]


def read(image):
    page = images.unpng(image)  # the bar is white now, and the corners, if the image was turned
    x = np.nonzero(page[page.shape[0] * 2 // 5 : page.shape[0] * 3 // 5, 8:-8] == 255)[1] + 8
    at = int(np.median(x)) // 20 - 1
    if at >= len(TEXTS):
        return [("", -1, 0, 0, 1, 1)]
    return [(w, 90, 10 * k, 0, 9, 9) for k, w in enumerate(TEXTS[at].split())]


def model(prompt):
    if prompt.startswith(extract.PATTERN_PROMPT):
        return r"(?P<surname>\p{Lu}{2,}),[ ](?P<given_names>\p{L}+),[ ]ur\.[ ](?P<birth_date>\d{4})"
    entry = prompt.removeprefix(extract.EXTRACTION_PROMPT).strip()
    if "," not in entry:
        return "no idea"
    surname, given, rest = entry.split(", ")[:3]
    year = rest.split()[1]
    return json.dumps({"surname": surname, "given_names": [given], ("birth_date" if rest.startswith("ur") else "death_date"): year, "locations": ["Łódź"] if "Łodzi" in rest else []})


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("run")
    polish = ["ur. 1890 w Łodzi, córka", "zm. 1901 w roku, żona"]
    files = {
        "a.pdf": [{"entries": [0, 1], "lines": polish}, {"entries": [2], "lines": polish}], "b.pdf": [{"entries": [3, 5], "lines": polish}], "same.pdf": [{"entries": [3, 5], "lines": polish}],
        "english.pdf": [{"entries": [], "lines": ["This is plain English text"]}], "letter.pdf": [{"entries": [], "lines": ["Pan i pani byli w roku na wsi"]}], "bad.pdf": [{"entries": [4], "lines": polish * 3}],
    }
    (at / "in").mkdir()
    for name, pages in files.items():
        (at / "in" / name).write_text(json.dumps(pages))
    (at / "in" / "broken.pdf").write_bytes(b"\x00not a document")
    (at / "in" / "empty.pdf").write_bytes(b"")
    settings = Settings(input_dir=str(at / "in"))
    bloom = BloomFilter.train(spark.createDataFrame([("Kowalski",), ("Nowak",)], "n string"), "n")
    pipeline = phases.pipeline(spark, settings, phases.Adapters(render, read, model), bloom, str(at / "out"))
    rows = adapters.inputs(spark, settings)
    first = [r.asDict() for r in pipeline.run(rows).collect()]
    summary = {r.phase: tuple(r)[1:] for r in pipeline.summary().collect()}
    again = [r.asDict() for r in pipeline.run(rows).collect()]
    return pipeline, first, summary, again, {r.phase: tuple(r)[1:] for r in pipeline.summary().collect()}, ResolutionStore(spark, f"{at}/out/resolution"), f"{at}/out"


def test_outcomes_of_all_phases(run):
    _, first, summary, again, second, _, _ = run
    assert list(summary) == list(PHASES) or set(summary) == set(PHASES)
    assert summary[PHASES[0]] == (4, 0, 1, 1)  # two files of one content are one document; the English one is discarded, empty files are not listed
    assert summary[PHASES[1]] == (3, 0, 1, 0) and summary[PHASES[2]][:3] == (3, 0, 0) and summary[PHASES[3]] == (3, 0, 0, 0)
    assert summary[PHASES[4]] == (2, 0, 0, 1) and summary[PHASES[5]] == (2, 0, 0, 0)
    assert {p: s[1] for p, s in second.items()} == {p: s[0] for p, s in summary.items()}
    key = lambda r: r["entity_id"]
    assert sorted(first, key=key) == sorted(again, key=key) and len(first) == 5


def test_persons_events_and_sources(run, rows):
    store = run[5]
    people = {r.surname: r.id for r in store.table("persons").collect()}
    assert set(people) >= {"Nowak", "Żak"} and len(people) == 3  # Kowalski and Kowalsky are one by their spelling
    events = rows(store.table("events"), "event_type", "event_date", "location")
    assert ("residence", None, "Łódź") in events and ("death", "1950", None) in events and ("birth", "1888", None) in events
    assert store.table("sources").count() == 2 and store.version() == 1


def test_failures_are_kept_with_their_input(run):
    failed = {r.phase: r for r in run[0].failures.failures().collect()}
    assert failed[PHASES[0]].error_class == "AcquisitionError" and "broken.pdf" in failed[PHASES[0]].input_data
    assert failed[PHASES[4]].error_class == "ExtractionError" and "no JSON object" in failed[PHASES[4]].message


def test_patterns_are_learned_and_used(spark, run):
    from kartoteka.operators import patterns

    assert patterns.load(spark, f"{run[6]}/patterns").count() >= 1


def test_lost_content_fails_the_document(spark, tmp_path, rows):
    from kartoteka.sources.stores import PhaseStore

    out = phases.lay_out(PhaseStore(spark, f"{tmp_path}/r"), render).run(spark.createDataFrame([("d", "directory")], "doc_id string, doc_type string"))
    assert rows(out.failed, "doc_id", "message") == [("d", "no result of the first phase")] and out.ok.count() == 0


def test_all_slices_failed(spark, rows):
    slices = spark.createDataFrame([("d", "d_p0_e0", 0, 0, b"x"), ("e", "e_p0_e0", 0, 0, bytes(draw([0])))], "doc_id string, slice_id string, page_num int, entry_index int, image_bytes binary")
    out = phases.recognise(Settings(), read).run(slices)
    assert rows(out.failed, "doc_id", "message") == [("d", "all 1 slices failed")] and rows(out.ok, "slice_id") == [("e_p0_e0",)]


def test_store_keeps_persons_over_batches(spark, tmp_path, rows):
    store = ResolutionStore(spark, str(tmp_path))
    kind = "doc_id string, page_num int, entry_index int, entity struct<entity_id:string,slice_id:string,surname:string,given_names:array<string>,birth_date:string,death_date:string,locations:array<string>,roles:array<string>,raw_text:string,confidence:double,extraction_method:string>"

    def batch(*people):
        return spark.createDataFrame([(d, 0, k, (f"{d}{k}", f"{d}_p0_e{k}", s, ["Jan"], "1890", None, [], ["lekarz"], "", 0.8, "x")) for k, (d, s) in enumerate(people)], kind)

    assert {r.is_new for r in store.add(batch(("d1", "Kowalski"), ("d1", "Nowak"))).collect()} == {True}
    got = {r.entity_id: r for r in store.add(batch(("d2", "Kowalski"), ("d2", "Nowack"), ("d2", "Zygfrydowicz"))).collect()}
    assert [got[f"d2{k}"].is_new for k in range(3)] == [False, False, True] and got["d20"].merge_confidence == 1.0 and got["d21"].merge_confidence < 1.0
    assert store.table("persons").count() == 3 and store.version() == 2 and store.table("sources").count() == 2
    assert store.table("events").count() == 6  # the same birth and occupation of one person are not added again
    assert store.add(batch().limit(0)).count() == 0


def test_inputs_by_source(spark, rows, tmp_path):
    assert adapters.inputs(spark, Settings(input_dir=f"{tmp_path}/none")).count() == 0
    with pytest.raises(ValueError):
        adapters.inputs(spark, Settings(source="ftp"))

    def fetch(url, headers):
        return (200, b'{"url":"http://x/u1.pdf","offset":0,"length":9,"filename":"f1"}\n') if "page=0" in url else (404, b"")

    got = adapters.inputs(spark, Settings(source="commoncrawl", commoncrawl=CommonCrawl(domains=("x",))), fetch, "http://index", "http://data/")
    assert rows(got, "source", "source_url", "filename", "error") == [("commoncrawl", "http://x/u1.pdf", "u1.pdf", "status 404")]


def test_local_file_tells_errors_apart(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF")
    assert adapters.local_file(spark, str(tmp_path / "a.pdf")) == b"%PDF"
    for path, word in ((tmp_path / "none", "does not exist"), (tmp_path, "is not a file")):
        with pytest.raises(AcquisitionError, match=word):
            adapters.local_file(spark, str(path))


def test_recogniser_preflight():
    with pytest.warns(UserWarning, match="pol_frak"):
        assert adapters.recogniser_ready(lambda: "5.3", lambda: ["pol"]) == "5.3"
    with pytest.raises(OCRError):
        adapters.recogniser_ready(lambda: 1 / 0, lambda: [])


def test_clients_over_http():
    class Answer(BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            self.send_response(200 if self.path == "/api/generate" else 404)
            self.end_headers()
            self.wfile.write(json.dumps({"response": body["prompt"] + "!"} if body["prompt"] != "odd" else {}).encode())

        def do_GET(self):
            self.send_response(206 if self.headers.get("Range") else 404)
            self.end_headers()
            self.wfile.write(b"part")

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Answer)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}"
    client = adapters.ModelClient(Extraction(model_url=url, timeout_s=5))
    assert client("hello") == "hello!"
    with pytest.raises(ExtractionError):
        client("odd")
    assert adapters.HttpFetch(5)(url, {"Range": "bytes=0-3"}) == (206, b"part") and adapters.HttpFetch(5)(url, {})[0] == 404
    server.shutdown()
    with pytest.raises(ExtractionError):
        adapters.ModelClient(Extraction(model_url="http://127.0.0.1:9", timeout_s=1))("x")


def test_column_counts_and_skews(spark):
    wide = np.full((30, 90), 255, np.uint8)
    for k in range(3):
        wide[:, 30 * k + 3 : 30 * k + 20] = 0
    df = spark.createDataFrame([(1, images.png(wide)), (2, b"junk"), (3, None)], "id int, b binary")
    out = {r.id: (r.c, r.s) for r in df.select("id", images.column_counts(F.col("b")).alias("c"), images.skews("b").alias("s")).collect()}
    assert out[1][0] == 3 and out[2] == (1, None) and out[3] == (1, None)
