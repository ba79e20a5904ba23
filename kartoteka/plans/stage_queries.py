"""Queries of stores, sources, page images, extraction and resolution over whole tables, and the SQL each equals. What the environment
would lend (network, rendering, a model) is stood in for by small functions over the tables' own texts."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kartoteka.cluster import cut, shared_folder
from kartoteka.config import Settings
from kartoteka.functions import json as J
from kartoteka.functions import text as X
from kartoteka.operators import bloom, classify, extract, images, ocr, patterns, resolve, review
from kartoteka.plans import pipeline as P
from kartoteka.plans.queries import _FORMS, _PLAIN, _PRINT, _SAMPLED, _SCORE, query, read, strip_sql
from kartoteka.sources import web
from kartoteka.sources.adapters import render_pages
from kartoteka.sources.stores import DeadLetters, PhaseStore

_CLEAN = f"nullif({strip_sql('detail')}, '')"


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "life_events")


# ---- functions


@query(f"SELECT id, {_CLEAN} AS detail FROM life_events")
def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    return _events(spark, sf).select("id", X.clean(F.col("detail")).alias("detail"))


@query(r"SELECT id, array_to_string(list_filter(regexp_split_to_array(coalesce(surname, ''), '\s+'), lambda x: x <> ''), '|') AS parts FROM persons")
def name_parts(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "persons").select("id", F.array_join(X.split_names(F.col("surname")), "|").alias("parts"))


@query("SELECT id, left(sha256(concat_ws('|', source_doc_id, source_slice_id)), 32) AS entity_id FROM life_events")
def entity_ids(spark: SparkSession, sf: str) -> DataFrame:
    return _events(spark, sf).select("id", X.entity_id(F.col("source_doc_id"), F.col("source_slice_id")).alias("entity_id"))


@query("SELECT doc_id, sha256(base64(encode(text))) AS coded, true AS same FROM documents WHERE text IS NOT NULL")
def base64_exchange(spark: SparkSession, sf: str) -> DataFrame:
    """Bytes as text and back."""
    docs = read(spark, sf, "documents").where("text IS NOT NULL").select("doc_id", F.col("text").cast("binary").alias("b"))
    coded = docs.withColumn("t", X.to_base64(F.col("b")))
    return coded.select("doc_id", F.sha2("t", 256).alias("coded"), (X.from_base64(F.col("t")) == F.col("b")).alias("same"))


@query("SELECT id, data_snapshot AS reply FROM review_queue")
def fences_stripped(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.concat(F.lit("```json\n"), F.col("data_snapshot"), F.lit("\n``` "))
    return read(spark, sf, "review_queue").select("id", X.strip_fences(raw).alias("reply"))


@query(f"""SELECT id, s AS surname, len(g) AS n_given, 0 AS n_roles FROM (SELECT id, regexp_replace(coalesce(surname, ''), '[^\\p{{L}}]', '', 'g') AS s,
    CASE WHEN json_valid(given_names) THEN list_filter(list_transform(from_json(given_names, '["VARCHAR"]'), lambda x: {strip_sql('x')}), lambda x: x <> '') ELSE [] END AS g FROM persons)""")
def reply_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Replies made of the stored names, some without lists, read as the six fields."""
    given = F.when(F.try_parse_json("given_names").isNotNull(), F.col("given_names")).otherwise("null")
    raw = F.concat(F.lit('```json\n{"surname": "'), F.regexp_replace(F.coalesce("surname", F.lit("")), r"[^\p{L}]", ""), F.lit('", "given_names": '), given, F.lit("}\n```"))
    fields = read(spark, sf, "persons").select("id", J.extracted_fields(raw).alias("f"))
    return fields.select("id", "f.surname", F.size("f.given_names").cast("bigint").alias("n_given"), F.size("f.roles").alias("n_roles"))


_CDX = "CASE id % 3 WHEN 0 THEN '{bad' WHEN 1 THEN '{\"url\": \"' || doc_id || '\"}' ELSE '{\"url\": \"' || doc_id || '\", \"offset\": \"' || id || '\", \"length\": \"x\", \"filename\": \"f' || id || '\"}' END"


@query("""SELECT doc_id AS url, CASE id % 3 WHEN 2 THEN id ELSE 0 END AS "offset", 0::bigint AS length, CASE id % 3 WHEN 2 THEN 'f' || id ELSE '' END AS warc_filename
  FROM sources WHERE id % 3 <> 0""")
def index_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of a capture index: whole, with fields missing, and malformed."""
    lines = read(spark, sf, "sources").select(F.expr(_CDX.replace('\\"', '"')).alias("line"))
    return lines.select(J.cdx_record(F.col("line")).alias("r")).where("r IS NOT NULL").select("r.*")


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


@query(f"""SELECT id, sha256({_literal(extract.EXTRACTION_PROMPT)} || raw_text || chr(10)) AS prompt,
    sha256({_literal(extract.PATTERN_PROMPT)} || 'Entry: ' || raw_text || chr(10) || 'Extracted: ' || '{{"id":' || id || '}}' || chr(10)) AS pattern_prompt FROM life_events WHERE raw_text IS NOT NULL""")
def model_prompts(spark: SparkSession, sf: str) -> DataFrame:
    rows = _events(spark, sf).where("raw_text IS NOT NULL")
    asked = extract.pattern_prompts(F.col("raw_text"), F.struct("id"))
    return rows.select("id", F.sha2(extract.prompts(F.col("raw_text")), 256).alias("prompt"), F.sha2(asked, 256).alias("pattern_prompt"))


@query(f"SELECT id, strip_accents(lower({strip_sql('surname')})) AS folded FROM persons WHERE surname IS NOT NULL")
def surname_folded(spark: SparkSession, sf: str) -> DataFrame:
    """The form of a surname that the filter knows."""
    return read(spark, sf, "persons").where("surname IS NOT NULL").select("id", X.fold_marks(F.col("surname")).alias("folded"))


# ---- filters, aggregates, review, cache


@query("""SELECT doc_id, count(*) FILTER (status <> 'discarded') AS succeeded, count(*) FILTER (status = 'discarded') AS failed,
    CASE WHEN count(*) FILTER (status <> 'discarded') = 0 THEN 'all ' || count(*) || ' slices failed' END AS error FROM review_queue GROUP BY doc_id""")
def slice_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """Queue items read as slices, the discarded ones as failed."""
    return ocr.outcomes(read(spark, sf, "review_queue").select("doc_id", (F.col("status") != "discarded").alias("ok")))


@query(f"""WITH k AS (SELECT DISTINCT strip_accents(lower({strip_sql('surname')})) AS s FROM persons WHERE id IN (SELECT person_id FROM person_groups))
  SELECT coalesce(avg(CASE WHEN strip_accents(lower({strip_sql('surname')})) IN (SELECT s FROM k) THEN 1.0 ELSE 0.0 END), 0) AS hit_rate FROM persons WHERE {strip_sql('surname')} <> ''""")
def bloom_hit_rate(spark: SparkSession, sf: str) -> DataFrame:
    """What part of all surnames a filter of the confirmed people's surnames knows."""
    persons = read(spark, sf, "persons").where(X.strip(F.col("surname")) != "")
    grouped = persons.join(read(spark, sf, "person_groups").select(F.col("person_id").alias("id")), "id", "left_semi")
    return bloom.hit_rate(persons, "surname", bloom.BloomFilter.train(grouped, "surname"))


@query("""SELECT status, count(*) AS n, count(DISTINCT id) AS ids FROM (SELECT id, status FROM review_queue
  UNION ALL SELECT (SELECT coalesce(max(id), 0) FROM review_queue) + row_number() OVER (), 'pending' FROM sources) GROUP BY status""")
def review_enqueued(spark: SparkSession, sf: str) -> DataFrame:
    """Every source put into the queue for review."""
    queue, now = read(spark, sf, "review_queue"), F.lit("2024-01-01").cast("timestamp")
    first = (queue.agg(F.max("id")).first()[0] or 0) + 1
    null = F.lit(None).cast("string")
    items = read(spark, sf, "sources").select("doc_id", null.alias("slice_id"), F.lit("phase1_acquisition").alias("phase_name"), F.lit("source").alias("reason"), F.lit("{}").alias("data_snapshot"), now.alias("created_at"))
    return review.enqueue(queue, items, first).groupBy("status").agg(F.count("*").alias("n"), F.countDistinct("id").alias("ids"))


@query("""SELECT fingerprint, CASE WHEN hit_count % 2 = 1 THEN '(?P<surname>x)' ELSE regex END AS regex FROM pattern_cache WHERE hit_count > 0
  UNION ALL SELECT 'new' || fingerprint, 'y+' FROM pattern_cache""")
def cache_changed(spark: SparkSession, sf: str) -> DataFrame:
    """The cache after entries were put in (of the known layouts every other pattern is invalid) and those never used were removed."""
    cache = read(spark, sf, "pattern_cache")
    later = F.col("created_at") + F.expr("INTERVAL 9000 DAYS")
    known = cache.withColumns({"regex": F.when(F.col("hit_count") % 2 == 1, "(?P<surname>x)").otherwise("("), "created_at": later})
    new = cache.withColumns({"fingerprint": F.concat(F.lit("new"), "fingerprint"), "regex": F.lit("y+")})
    changed = patterns.put(cache, known.unionByName(new))
    return patterns.remove(changed, cache.where("hit_count = 0")).select("fingerprint", "regex")


# ---- sources and stores


def _pages_of(domains: dict[str, int]) -> Callable:
    """A capture index of so many captures per domain, with malformed lines between, in pages of 50 lines."""

    def fetch(url: str, headers: dict[str, str]) -> tuple[int, bytes]:
        name, page = regex.search(r"url=([\w.]+)", url)[1], int(regex.search(r"page=(\d+)", url)[1])
        lines = [json.dumps({"url": f"{name}/{i}", "offset": i, "length": 9, "filename": f"{name}.gz"}) if i % 3 else "{bad" for i in range(page * 50, min((page + 1) * 50, domains[name]))]
        return (200, "\n".join(lines).encode()) if lines else (404, b"")

    return fetch


_CAPTURES = """SELECT d || '/' || i AS url, i AS "offset", d || '.gz' AS file FROM (VALUES ('a.example', 1, 120), ('b.example', 2, 500), ('c.example', 3, 90)) t(d, k, n), range(500) r(i)
  WHERE i < n AND i % 3 <> 0 ORDER BY k, i LIMIT 350"""


def _captured(spark: SparkSession) -> DataFrame:
    fetch = _pages_of({"a.example": 120, "b.example": 500, "c.example": 90})
    return web.captures(spark, "http://index", ["a.example", "b.example", "c.example"], fetch, 350, 50)


@query(f"""SELECT url, "offset", file AS warc_filename FROM ({_CAPTURES})""")
def index_captures(spark: SparkSession, sf: str) -> DataFrame:
    """Captures of three domains, page after page, up to a limit that ends within the last one."""
    return _captured(spark).select("url", "offset", "warc_filename")


@query(f"""SELECT url, CASE WHEN "offset" % 5 = 0 THEN NULL WHEN "offset" % 5 = 1 THEN NULL ELSE 'body ' || "offset" END AS body,
    CASE WHEN "offset" % 5 = 0 THEN 'status 503' WHEN "offset" % 5 = 1 THEN 'ValueError: no PDF response in the record' END AS error FROM ({_CAPTURES})""")
def archive_records(spark: SparkSession, sf: str) -> DataFrame:
    """Bodies of the captures' records; of some the archive answers with an error or with another type."""

    def fetch(url: str, headers: dict[str, str]) -> tuple[int, bytes]:
        at = int(regex.search(r"bytes=(\d+)-", headers["Range"])[1])
        kind = "text/html" if at % 5 == 1 else "application/PDF"
        http = f"HTTP/1.1 200 OK\r\nContent-Type: {kind}\r\n\r\nbody {at}".encode()
        return (503, b"") if at % 5 == 0 else (206, f"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: {len(http)}\r\n\r\n".encode() + http + b"\r\n\r\n")

    return web.fetch_captures(_captured(spark), "http://data/", fetch).select("url", F.col("content").cast("string").alias("body"), "error")


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


@query("SELECT doc_id, reason || '!' AS reason FROM (SELECT doc_id, max_by(reason, id) AS reason FROM review_queue GROUP BY doc_id)")
def stored_results(spark: SparkSession, sf: str) -> DataFrame:
    """Results saved twice and loaded: those of the later run count."""
    store = PhaseStore(spark, _folder(spark))
    rows = cut(read(spark, sf, "review_queue").groupBy("doc_id").agg(F.max_by("reason", "id").alias("reason")))
    store.save("p", rows)
    store.save("p", rows.withColumn("reason", F.concat("reason", F.lit("!"))))
    return store.load("p", rows.schema)


@query("""SELECT phase, count(*) FILTER (done) AS completed, count(*) FILTER (NOT done) AS todo
  FROM (SELECT phase_name AS phase, doc_id, bool_or(status <> 'pending') AS done FROM review_queue GROUP BY 1, 2) GROUP BY phase""")
def resume(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of each phase with a result in the store, and those still to do."""
    store = PhaseStore(spark, _folder(spark))
    queue = cut(read(spark, sf, "review_queue").select(F.col("phase_name").alias("phase"), "doc_id", "status"))
    out = None
    for (phase,) in queue.select("phase").distinct().collect():  # the phases of a pipeline
        mine = queue.where(F.col("phase") == phase)
        every = mine.select("doc_id").distinct()
        store.save(phase, mine.where("status <> 'pending'").select("doc_id").distinct())
        one = store.completed(phase).join(every, "doc_id", "left_semi").select(F.lit(1).alias("c"), F.lit(0).alias("t")).unionByName(store.todo(phase, every).select(F.lit(0).alias("c"), F.lit(1).alias("t")))
        one = one.select(F.lit(phase).alias("phase"), "c", "t")
        out = one if out is None else out.unionByName(one)
    if out is None:
        return spark.createDataFrame([], "phase string, completed bigint, todo bigint")
    return out.groupBy("phase").agg(F.sum("c").alias("completed"), F.sum("t").alias("todo"))


@query("SELECT phase_name AS phase, doc_id, 'late' AS message, NULL::varchar AS traceback, '{\"n\":' || count(*) || '}' AS input_data FROM review_queue GROUP BY 1, 2")
def recorded_failures(spark: SparkSession, sf: str) -> DataFrame:
    """Failures recorded twice: the later one of each phase and document comes back, with its input."""
    dead = DeadLetters(spark, _folder(spark))
    rows = read(spark, sf, "review_queue").groupBy(F.col("phase_name").alias("phase"), "doc_id").agg(F.count("*").alias("n"))
    rows = cut(rows.select("phase", "doc_id", F.lit("X").alias("error_class"), F.to_json(F.struct("n")).alias("input_data")))
    for message in ("early", "late"):
        dead.record(rows.withColumn("message", F.lit(message)))
    return dead.failures().select("phase", "doc_id", "message", "traceback", "input_data")


_LINES = "list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: length(x) >= 20)"


@query(f"""WITH s AS (SELECT doc_id, {_SCORE} AS v FROM ({_SAMPLED})), k AS (SELECT d.doc_id, len({_LINES}) AS n FROM documents d JOIN s USING (doc_id) WHERE v >= 0.3)
  SELECT 'phase1_acquisition' AS phase, count(*) FILTER (v >= 0.3) AS processed, 0 AS skipped, count(*) FILTER (v < 0.3) AS discarded, 0 AS failed FROM s
  UNION ALL SELECT 'phase3_layout', count(*) FILTER (n > 0), 0, 0, count(*) FILTER (n = 0) FROM k""")
def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    """What a run of two phases over all documents did."""
    at = _folder(spark)
    run = P.Pipeline(spark, [P.acquisition(Settings()), P.entries()], PhaseStore(spark, f"{at}/r"), DeadLetters(spark, f"{at}/f"))
    run.run(read(spark, sf, "documents").select(F.col("doc_id").cast("string"), "text"))
    return run.summary()


@query(f"""WITH s AS (SELECT doc_id, {_SCORE} AS v FROM ({_SAMPLED}))
  SELECT 'phase1_acquisition' AS phase, 0 AS processed, count(*) FILTER (v >= 0.3) AS skipped, count(*) FILTER (v < 0.3) AS discarded, 0 AS failed FROM s""")
def run_again(spark: SparkSession, sf: str) -> DataFrame:
    """The second run over the same documents: results are taken from the store, and only what has none is tried again."""
    at = _folder(spark)
    run = P.Pipeline(spark, [P.acquisition(Settings())], PhaseStore(spark, f"{at}/r"), DeadLetters(spark, f"{at}/f"))
    docs = read(spark, sf, "documents").select(F.col("doc_id").cast("string"), "text")
    run.run(docs)
    run.run(docs)
    return run.summary()


@query("""SELECT 'phase9' AS phase, count(DISTINCT doc_id) AS documents, min('builtins.ZeroDivisionError') AS error_class, true AS traced, true AS has_input FROM documents HAVING count(*) > 0""")
def phase_that_raises(spark: SparkSession, sf: str) -> DataFrame:
    """A phase that raises fails its documents, each with traceback and input, and not the run."""
    dead = DeadLetters(spark, f"{_folder(spark)}/f")

    def broken(rows: DataFrame) -> P.PhaseOutput:
        raise ZeroDivisionError("broken")

    docs = read(spark, sf, "documents").select(F.col("doc_id").cast("string"))
    P.Pipeline(spark, [P.Phase("phase9", docs.schema, broken)], PhaseStore(spark, f"{_folder(spark)}/r"), dead).run(docs)
    by = dead.failures().groupBy("phase").agg(F.countDistinct("doc_id").alias("documents"), F.min("error_class").alias("error_class"), F.bool_and(F.contains("traceback", F.lit("ZeroDivisionError"))).alias("traced"), F.bool_and(F.contains("input_data", "doc_id")).alias("has_input"))
    return by


# ---- page images: texts drawn with one pixel for each sign


def raster(text: str) -> np.ndarray:
    """One row per line, one pixel per character, black where it is no space."""
    lines = text.split("\n")
    out = np.full((len(lines), max(1, max(map(len, lines)))), 255, np.uint8)
    for y, line in enumerate(lines):
        out[y, : len(line)] = np.where(np.frombuffer(line.encode("utf-32-le"), np.uint32) == ord(" "), 255, 0)
    return out


def _draw(content: bytes) -> list[tuple[str, int, bytes]]:
    """Pages of a text, parted by form feeds; each line end counts as a drawn line."""
    return [(page, page.count("\n"), images.png(raster(page))) for page in content.decode().split("\f")]


def _rendered(spark: SparkSession, sf: str, key: str = "doc_id") -> DataFrame:
    docs = read(spark, sf, "documents").where("length(text) > 0")
    return render_pages(docs.select(F.col(key).cast("string").alias("doc_id"), F.col("text").cast("binary").alias("content")), _draw)


_INK = """SELECT doc_id, x, count(*) FILTER (c <> ' ') AS ink FROM (SELECT doc_id, x, substr(l, x::int, 1) AS c FROM (SELECT doc_id, l, unnest(range(1, length(l) + 1)) AS x
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM documents WHERE length(text) > 0 AND NOT contains(text, chr(12))))) GROUP BY doc_id, x"""
_COLUMNS = f"""WITH i AS ({_INK}), m AS (SELECT *, ink > max(ink) OVER (PARTITION BY doc_id) * 0.15 AS dark FROM i),
  s AS (SELECT doc_id, dark AND NOT coalesce(lag(dark) OVER (PARTITION BY doc_id ORDER BY x), false) AS st FROM m)
  SELECT doc_id, greatest(count(*) FILTER (st), 1)::int AS column_count FROM s GROUP BY doc_id"""


@query(f"SELECT d.doc_id::varchar AS doc_id, coalesce(c.column_count, 1) AS column_count FROM documents d LEFT JOIN ({_COLUMNS}) c USING (doc_id) WHERE length(text) > 0")
def page_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Columns of each drawn page, by the runs of its ink profile."""
    return _rendered(spark, sf).select("doc_id", images.column_counts("image_bytes").alias("column_count"))


@query("SELECT doc_id::varchar AS doc_id, length(regexp_replace(text, '[ \\n]', '', 'g')) * 255 AS ink FROM documents WHERE length(text) > 0")
def page_ink(spark: SparkSession, sf: str) -> DataFrame:
    """All ink of each drawn page, after the image was written and read."""
    return _rendered(spark, sf).select("doc_id", images.ink_sums("image_bytes").alias("ink"))


@query("""WITH l AS (SELECT doc_id, generate_subscripts(ls, 1) - 1 AS y, unnest(ls) AS t, len(ls) AS h, list_max(list_transform(ls, lambda x: length(x))) AS w FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE length(text) > 0)),
  s AS (SELECT doc_id, y, h, (greatest(w, 1) - length(replace(t, ' ', ''))) * 255 AS v FROM l), g AS (SELECT *, v < quantile_cont(v, 0.1) OVER (PARTITION BY doc_id) AS gap FROM s),
  f AS (SELECT *, coalesce(max(CASE WHEN gap THEN y + 1 END) OVER (PARTITION BY doc_id ORDER BY y ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS y1 FROM g)
  SELECT doc_id::varchar AS doc_id, y1::int AS y1, y::int AS y2 FROM f WHERE gap AND y - y1 > 5
  UNION ALL SELECT doc_id::varchar, y1::int, h::int FROM (SELECT doc_id, h, coalesce(max(CASE WHEN gap THEN y + 1 END), 0) AS y1 FROM g GROUP BY doc_id, h) WHERE y1 < h - 1""")
def page_bands(spark: SparkSession, sf: str) -> DataFrame:
    """Bands of rows between the darkest rows of each drawn page."""
    return _rendered(spark, sf).select("doc_id", F.explode(images.bands("image_bytes")).alias("b")).select("doc_id", "b.y1", "b.y2")


_KINDS = """(VALUES ('dense columns', 6, 2, 0, 'x'), ('dense', 6, 1, 0, 'x'), ('some', 3, 1, 0, 'x'), ('table', 0, 1, 16, 'KSIĘGA ZGONÓW'), ('lines', 0, 1, 15, 'KSIĘGA'), ('no words', 0, 1, 16, 'x'), ('wide', 1, 3, 0, 'x'), ('two', 0, 2, 0, 'x'))"""


@query(f"""SELECT n AS doc_id, CASE WHEN d > 2 THEN 'directory' WHEN t > 15 AND w LIKE 'KSI%' THEN 'civil_record' WHEN c >= 3 THEN 'newspaper' ELSE 'unknown' END AS doc_type,
    CASE WHEN d > 5 AND c >= 2 THEN 0.95 WHEN d > 2 THEN 0.70 WHEN t > 15 AND w LIKE 'KSI%' THEN 0.85 WHEN c >= 3 THEN 0.80 ELSE 0.0 END::double AS confidence FROM {_KINDS} k(n, d, c, t, w)""")
def classify_kinds(spark: SparkSession, sf: str) -> DataFrame:
    """One page of every kind: entries, columns of ink, drawn lines and words as the rules ask for; all four types come out."""
    kinds = spark.sql(f"SELECT * FROM {_KINDS} AS k(n, d, c, t, w)")
    content = F.to_json(F.struct("d", "c", "t", "w")).cast("binary")

    def page(data: bytes) -> list[tuple[str, int, bytes]]:
        k = json.loads(data)
        image = np.full((30, 20 * k["c"]), 255, np.uint8)
        for i in range(k["c"]):
            image[:, 20 * i + 2 : 20 * i + 15] = 0
        return [("\n".join([k["w"]] + ["zm. 1890"] * k["d"]), k["t"], images.png(image))]

    pages = render_pages(kinds.select(F.col("n").alias("doc_id"), content.alias("content")), page)
    return classify.classify(classify.features(pages)).select("doc_id", "doc_type", "confidence")


@query("""SELECT n_pages, count(*) AS documents FROM (SELECT CASE WHEN length(text) > 0 THEN 1 + length(text) - length(replace(text, chr(12), '')) ELSE 0 END AS n_pages FROM documents) GROUP BY n_pages""")
def page_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Documents by their pages; those without content have none."""
    docs = read(spark, sf, "documents").select(F.monotonically_increasing_id().cast("string").alias("doc_id"), F.col("text").cast("binary").alias("content"))
    return render_pages(docs, _draw).where("coalesce(page_num, 0) = 0").groupBy(F.col("n_pages").cast("bigint").alias("n_pages")).agg(F.count("*").alias("documents"))


# ---- extraction


#: One pattern for directory entries, as a model would give it (blanks in brackets, as new patterns are tried in the verbose syntax);
#: DuckDB reads the same one.
ENTRY = r"^(?P<surname>[A-ZĄĆĘŁŃÓŚŹŻ]{3,}),?[ ]+(?P<given_names>[A-ZĄĆĘŁŃÓŚŹŻ][a-ząćęłńóśźż]+)"
_ENTRIES = f"SELECT source_slice_id AS slice_id, min(source_doc_id) AS doc_id, {strip_sql('min(raw_text)')} AS text FROM life_events WHERE raw_text IS NOT NULL GROUP BY 1"
_FINGERPRINTED = f"SELECT *, {_PRINT.replace('raw_text', 'text')} AS fingerprint FROM ({_ENTRIES}) WHERE text <> ''"
_TITLED = r"array_to_string(list_transform(regexp_extract_all(s, '[\p{L}\p{M}]+|[^\p{L}\p{M}]+'), lambda x: upper(x[1]) || lower(x[2:])), '')"
_KNOWN = f"strip_accents(lower(s)) IN (SELECT strip_accents(lower({strip_sql('surname')})) FROM persons WHERE surname IS NOT NULL)"


def _entries(spark: SparkSession, sf: str) -> DataFrame:
    rows = _events(spark, sf).where("raw_text IS NOT NULL")
    return rows.groupBy(F.col("source_slice_id").alias("slice_id")).agg(F.min("source_doc_id").alias("doc_id"), F.min("raw_text").alias("text"))


def _own_cache(spark: SparkSession, sf: str) -> DataFrame:
    """A cache with :data:`ENTRY` for each layout whose fingerprint begins with a digit."""
    prints = _entries(spark, sf).select(X.fingerprint(X.strip(F.col("text"))).alias("fingerprint")).where(F.col("fingerprint").rlike("^[0-9]")).distinct()
    now = F.lit("2024-01-01").cast("timestamp")
    return prints.select("fingerprint", F.lit(ENTRY).alias("regex"), now.alias("created_at"), F.lit(0).alias("hit_count"), F.lit(None).cast("timestamp").alias("last_used"))


@query(f"SELECT slice_id, fingerprint, '{ENTRY}' AS regex FROM ({_FINGERPRINTED}) WHERE regexp_matches(fingerprint, '^[0-9]')")
def pattern_lookup(spark: SparkSession, sf: str) -> DataFrame:
    rows = _entries(spark, sf).withColumn("text", X.strip(F.col("text"))).where("text <> ''").withColumn("fingerprint", X.fingerprint(F.col("text")))
    return patterns.lookup(rows, _own_cache(spark, sf)).where("regex IS NOT NULL").select("slice_id", "fingerprint", "regex")


@query(f"""SELECT slice_id, doc_id, CASE WHEN hit THEN {_TITLED} END AS surname, CASE WHEN hit THEN 0.8::double END AS confidence
  FROM (SELECT *, s <> '' AND regexp_matches(fingerprint, '^[0-9]') AND {_KNOWN} AS hit FROM (SELECT *, regexp_extract(text, '{ENTRY}', 1) AS s FROM ({_FINGERPRINTED})))""")
def cached_entities(spark: SparkSession, sf: str) -> DataFrame:
    """The cached-pattern tier over all entries, with a filter of all stored surnames."""
    tier = extract.cached_tier(_entries(spark, sf), _own_cache(spark, sf), bloom.BloomFilter.train(read(spark, sf, "persons"), "surname"))
    return tier.select("slice_id", "doc_id", F.col("entity.surname").alias("surname"), F.col("entity.confidence").alias("confidence"))


def _answer(prompt: str) -> str:
    """A model that knows one kind of entry, has nothing to say of some others and is late with the rest."""
    if prompt.startswith(extract.PATTERN_PROMPT):
        return json.dumps({"regex": ENTRY})
    entry = prompt.removeprefix(extract.EXTRACTION_PROMPT)
    found = regex.match(ENTRY, entry)
    if found:
        return "Sure: " + json.dumps(found.groupdict(), ensure_ascii=False)
    if entry[0].isupper():
        return '{"surname": ""}'
    raise TimeoutError("late")


@query(f"""SELECT slice_id, CASE WHEN s <> '' THEN {_TITLED} END AS surname, CASE WHEN s = '' THEN NULL WHEN {_KNOWN} AND regexp_matches(fingerprint, '^[0-9]') THEN 0.8 WHEN {_KNOWN} THEN 0.6 ELSE 0.4 END::double AS confidence,
    CASE WHEN s = '' THEN 'TimeoutError: late' WHEN {_KNOWN} AND regexp_matches(fingerprint, '^[0-9]') THEN 'regex_cached' ELSE 'llm_ollama' END AS said
  FROM (SELECT *, regexp_extract(text, '{ENTRY}', 1) AS s FROM ({_FINGERPRINTED})) WHERE s <> '' OR NOT regexp_matches(text, '^\\p{{Lu}}')""")
def extracted_entities(spark: SparkSession, sf: str) -> DataFrame:
    """Both tiers over all entries: cached patterns first, the model for the rest, and its failures."""
    entities, failures, _ = extract.extract(_entries(spark, sf), _own_cache(spark, sf), bloom.BloomFilter.train(read(spark, sf, "persons"), "surname"), _answer)
    e = entities.select("entity.*").select("slice_id", "surname", "confidence", F.col("extraction_method").alias("said"))
    return e.unionByName(failures.select("slice_id", F.lit(None).cast("string").alias("surname"), F.lit(None).cast("double").alias("confidence"), F.col("error").alias("said")))


@query(f"""WITH e AS (SELECT *, regexp_extract(text, '{ENTRY}', 1) AS s FROM ({_FINGERPRINTED})), a AS (SELECT * FROM e WHERE s <> '' AND NOT (regexp_matches(fingerprint, '^[0-9]') AND {_KNOWN})),
  o AS (SELECT fingerprint, min((text, doc_id)) AS f FROM a GROUP BY fingerprint), n AS (SELECT fingerprint, f[1] AS text, f[2] AS doc_id FROM o WHERE NOT regexp_matches(fingerprint, '^[0-9]')),
  p AS (SELECT n.fingerprint, list_sort(list_distinct(list(e.text) FILTER (e.text IS NOT NULL)))[1:5] AS peers FROM n LEFT JOIN e ON e.fingerprint = n.fingerprint AND e.doc_id = n.doc_id AND e.text <> n.text GROUP BY n.fingerprint),
  h AS (SELECT fingerprint, peers, unnest(CASE WHEN len(peers) > 0 THEN peers ELSE [''] END) AS t FROM p), r AS (SELECT fingerprint, coalesce(len(peers), 0) AS n, sum(CASE WHEN s <> '' AND {_KNOWN} THEN 1 ELSE 0 END) AS k FROM (SELECT *, regexp_extract(t, '{ENTRY}', 1) AS s FROM h) GROUP BY 1, 2)
  SELECT fingerprint FROM r WHERE n = 0 OR k / n >= 0.3 UNION SELECT DISTINCT fingerprint FROM ({_FINGERPRINTED}) WHERE regexp_matches(fingerprint, '^[0-9]')""")
def learned_patterns(spark: SparkSession, sf: str) -> DataFrame:
    """The cache after the run of :func:`extracted_entities`: the patterns that the model gave and their layouts' peers bear out."""
    _, _, cache = extract.extract(_entries(spark, sf), _own_cache(spark, sf), bloom.BloomFilter.train(read(spark, sf, "persons"), "surname"), _answer)
    return cache.select("fingerprint")


# ---- resolution


@query(f"""WITH p AS (SELECT id AS seq, {_PLAIN} AS s FROM persons), f AS (SELECT s, min(seq) AS person FROM p GROUP BY s)
  SELECT seq, person, seq = person AS is_new, CASE WHEN seq > person THEN 1.0::double END AS merge_confidence FROM p JOIN f USING (s)""")
def resolved_exactly(spark: SparkSession, sf: str) -> DataFrame:
    """All person rows in the order of their ids resolved into an empty store, equal surnames only."""
    rows = read(spark, sf, "persons").select(F.col("id").alias("seq"), X.plain_surname(F.coalesce("surname", F.lit(""))).alias("surname"))
    return resolve.resolve(rows, 1.0).select("seq", "person", "is_new", "merge_confidence")


@query(f"""WITH p AS (SELECT id, {_PLAIN} AS s FROM persons), k AS (SELECT min(id) AS id, s FROM p WHERE id IN (SELECT person_id FROM person_groups) GROUP BY s),
  r AS (SELECT p.s, min(k.id) AS old, min(p.id) AS first FROM p LEFT JOIN k USING (s) GROUP BY p.s)
  SELECT id, s AS surname_normalized FROM k UNION ALL SELECT (SELECT coalesce(max(id), 0) FROM k) + 1 + first, s FROM r WHERE old IS NULL""")
def persons_inserted(spark: SparkSession, sf: str) -> DataFrame:
    """A store of the confirmed people's surnames after all person rows were resolved into it by equal surnames."""
    people = read(spark, sf, "persons").withColumn("surname_normalized", X.plain_surname(F.coalesce("surname", F.lit(""))))
    known = people.join(read(spark, sf, "person_groups").select(F.col("person_id").alias("id")), "id", "left_semi")
    store = cut(known.groupBy("surname_normalized").agg(F.min("id").alias("id")))
    null = F.lit(None).cast("timestamp")
    store = store.select("id", F.col("surname_normalized").alias("surname"), F.array().cast("array<string>").alias("given_names"), "surname_normalized", null.alias("created_at"), null.alias("updated_at"))
    entities = people.select(F.col("id").alias("seq"), "surname", F.array().cast("array<string>").alias("given_names"), "surname_normalized")
    found = resolve.resolve(entities.select("seq", F.col("surname_normalized").alias("surname")), 1.0, store.select("id", F.col("surname_normalized").alias("surname")))
    return resolve.insert_persons(store, found, entities.select("seq", "surname", "given_names")).select("id", "surname_normalized")


@query("SELECT DISTINCT source_doc_id AS doc_id FROM life_events WHERE source_doc_id IS NOT NULL AND source_doc_id NOT IN (SELECT doc_id FROM sources WHERE filename IS NOT NULL)")
def new_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of the events that are not among the sources with a file."""
    known = read(spark, sf, "sources").where("filename IS NOT NULL")
    return resolve.new_sources(known, _events(spark, sf).select(F.col("source_doc_id").alias("doc_id")))
