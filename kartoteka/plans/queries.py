"""Queries of the document-to-entity operators over whole tables, and the SQL each equals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kartoteka.functions import json as J
from kartoteka.functions import text as X
from kartoteka.operators import classify as C
from kartoteka.operators import ocr, patterns, profiles, resolve, review
from kartoteka.operators.bloom import BloomFilter
from kartoteka.operators.extract import peers
from kartoteka.operators.numbering import numbered
from kartoteka.plans.pipeline import line_entries
from kartoteka.sources.stores import last_failures
from kartoteka.streaming.intake import arrivals as arrival_windows

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL if SQL can say it."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


_SPACE = r"[\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def strip_sql(text: str) -> str:
    return f"regexp_replace({text}, '^{_SPACE}+|{_SPACE}+$', '', 'g')"


_RUN = r"[\p{L}\p{M}\p{N}_]+"
_WORDS = ", ".join(f"'{w}'" for w in X.FUNCTION_WORDS)
_SCORE = f"""CASE WHEN length(s) = 0 THEN 0.0 ELSE round(
    least(length(regexp_replace(s, '[^{X.DIACRITICS}]', '', 'g')) / length(s) / 0.06, 1.0) * 0.6 +
    CASE WHEN len(regexp_extract_all(s, '[^\\s\\x{{A0}}\\x{{2007}}\\x{{202F}}]+')) > 0 THEN
      least(len(list_filter(regexp_extract_all(s, '{_RUN}'), lambda w: lower(w) IN ({_WORDS}))) / len(regexp_extract_all(s, '[^\\s\\x{{A0}}\\x{{2007}}\\x{{202F}}]+')) / 0.20, 1.0)
    ELSE 0.0 END * 0.4, 4) END"""
_SAMPLED = "SELECT doc_id, lang, source, left(coalesce(text, ''), 500) AS s FROM documents"


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents")
    return docs.select("doc_id", "lang", "source", X.lang_score(X.sample_text(F.col("text"))).alias("lang_score"))


@query(f"SELECT doc_id, {_SCORE} AS lang_score FROM ({_SAMPLED})")
def lang_score(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf).select("doc_id", "lang_score")


@query(f"SELECT doc_id FROM (SELECT doc_id, {_SCORE} AS v FROM ({_SAMPLED})) WHERE v >= 0.3")
def lang_filter(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf).where("lang_score >= 0.3").select("doc_id")


@query(f"""SELECT lang, source, count(*) AS n_docs, count(*) FILTER (v >= 0.3) AS n_kept, round(avg(v), 6) AS mean_score
  FROM (SELECT lang, source, {_SCORE} AS v FROM ({_SAMPLED})) GROUP BY lang, source""")
def lang_summary(spark: SparkSession, sf: str) -> DataFrame:
    by = _scored(spark, sf).groupBy("lang", "source")
    return by.agg(F.count("*").alias("n_docs"), F.count_if(F.col("lang_score") >= 0.3).alias("n_kept"), F.round(F.avg("lang_score"), 6).alias("mean_score"))


@query("SELECT doc_id, left(sha256(text), 16) AS content_id FROM documents")
def content_id(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "documents").select("doc_id", X.content_id(F.col("text")).alias("content_id"))


@query("""SELECT left(sha256(text), 16) AS content_id, min(doc_id) AS doc_id, count(*) AS n FROM documents
  WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1""")
def content_repeats(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents").where("text IS NOT NULL").select("doc_id", X.content_id(F.col("text")).alias("content_id"))
    return docs.groupBy("content_id").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n")).where("n > 1")


@query(r"""SELECT doc_id, coalesce(list_filter(string_split(regexp_extract(source_url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '')[-1],
    nullif(regexp_extract(source_url, '^[a-z]+://([^/?#]*)', 1), ''), source_url) AS slug FROM sources WHERE source_url IS NOT NULL""")
def url_slug(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "sources").where("source_url IS NOT NULL").select("doc_id", X.url_slug(F.col("source_url")).alias("slug"))


_MARKED = f"regexp_replace({strip_sql('raw_text')}, '({_RUN})', chr(1) || '\\1' || chr(2), 'g')"
for _pattern, _letter in X.TEMPLATE:
    _MARKED = f"regexp_replace({_MARKED}, '\\x01{_pattern}\\x02', '{_letter}', 'g')"
_PRINT = f"left(sha256(regexp_replace({_MARKED}, '[\\x01\\x02]', '', 'g')), 16)"


@query(f"SELECT id, {_PRINT} AS fingerprint FROM life_events WHERE raw_text IS NOT NULL")
def fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    rows = read(spark, sf, "life_events").where("raw_text IS NOT NULL")
    return rows.select("id", X.fingerprint(X.strip(F.col("raw_text"))).alias("fingerprint"))


@query(f"""WITH e AS (SELECT DISTINCT source_doc_id AS doc_id, {_PRINT} AS fingerprint, {strip_sql('raw_text')} AS text FROM life_events WHERE {strip_sql('raw_text')} <> '')
  SELECT a.doc_id, a.fingerprint, sha256(a.text) AS text_id, coalesce(len(list(b.text)[1:5]), 0) AS n_peers, sha256(coalesce(array_to_string(list_sort(list(b.text))[1:5], chr(0)), '')) AS peers_id
  FROM e a LEFT JOIN e b ON a.doc_id = b.doc_id AND a.fingerprint = b.fingerprint AND a.text <> b.text GROUP BY a.doc_id, a.fingerprint, a.text""".replace("coalesce(len(list(b.text)[1:5]), 0)", "least(count(b.text), 5)").replace("list_sort(list(b.text))", "list_sort(list(b.text) FILTER (b.text IS NOT NULL))"))
def fingerprint_peers(spark: SparkSession, sf: str) -> DataFrame:
    rows = read(spark, sf, "life_events").where(X.strip(F.col("raw_text")) != "")
    texts = rows.select(F.col("source_doc_id").alias("doc_id"), X.strip(F.col("raw_text")).alias("text")).distinct()  # a text is worked on once
    found = peers(texts.withColumn("fingerprint", F.coalesce(X.fingerprint(F.col("text")), F.lit(""))))
    return found.select("doc_id", "fingerprint", F.sha2("text", 256).alias("text_id"), F.size("peers").cast("bigint").alias("n_peers"), F.sha2(F.array_join("peers", "\0"), 256).alias("peers_id"))


_DENSITY = (
    "(len(regexp_extract_all(t, '(^|[^\\p{L}\\p{M}\\p{N}_])[A-ZĄĆĘŁŃÓŚŹŻ]{2,},\\s+[A-ZĄĆĘŁŃÓŚŹŻ][a-ząćęłńóśźż]+($|[^\\p{L}\\p{M}\\p{N}_])')) + "
    "len(regexp_extract_all(t, '(?:ur\\.|zm\\.|[*†])\\s*\\d{4}')) + "
    "len(regexp_extract_all(t, '(?i)(^|[^\\p{L}\\p{M}\\p{N}_])(ul|pl|al)\\.[\\p{L}\\p{M}\\p{N}_]')))"
)
_KEYWORDS = f"len(list_filter(regexp_extract_all(t, '{_RUN}'), lambda w: upper(w) IN ('SPIS', 'KSIĘGA', 'REJESTR', 'ZGONÓW', 'URODZEŃ', 'MAŁŻEŃSTW'))) > 0"


@query(f"SELECT doc_id, {_DENSITY} AS entry_density, {_KEYWORDS} AS keywords_present FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)")
def page_features(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents")
    return docs.select("doc_id", C.entry_density(F.col("text")).cast("bigint").alias("entry_density"), C.has_keywords(F.col("text")).alias("keywords_present"))


_PAGES = """SELECT book_id, doc_id, text, row_number() OVER (PARTITION BY book_id ORDER BY doc_id) - 1 AS page, count(*) OVER (PARTITION BY book_id) AS n_pages
  FROM documents WHERE book_id IS NOT NULL"""


def _book_pages(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents").where("book_id IS NOT NULL").select("book_id", "doc_id", "text")
    sizes = docs.groupBy("book_id").agg(F.count("*").alias("n_pages"))
    return numbered(docs, ["book_id"], "doc_id", "page").join(sizes, "book_id").where(C.sampled(F.col("page"), F.col("n_pages")))


@query(f"SELECT book_id, page, doc_id, n_pages FROM ({_PAGES}) WHERE page = 0 OR page = n_pages - 1 OR n_pages > 2 AND page = n_pages // 2")
def page_sample(spark: SparkSession, sf: str) -> DataFrame:
    return _book_pages(spark, sf).select("book_id", "page", "doc_id", "n_pages")


@query(f"""WITH f AS (SELECT book_id, {_DENSITY} AS d, {_KEYWORDS} AS k, len(regexp_extract_all(t, '\\n')) > 15 AS tab, 1 + len(regexp_extract_all(t, '\\n\\n')) AS c
    FROM (SELECT *, coalesce(text, '') AS t FROM ({_PAGES})) WHERE page = 0 OR page = n_pages - 1 OR n_pages > 2 AND page = n_pages // 2),
  a AS (SELECT book_id, avg(d) AS avg_density, max(c) AS max_columns, bool_or(tab) AS tab, bool_or(k) AS k FROM f GROUP BY book_id)
  SELECT book_id, avg_density, CASE WHEN avg_density > 5 AND max_columns >= 2 OR avg_density > 2 THEN 'directory' WHEN tab AND k THEN 'civil_record'
      WHEN max_columns >= 3 AND avg_density <= 2 THEN 'newspaper' ELSE 'unknown' END AS doc_type,
    CASE WHEN avg_density > 5 AND max_columns >= 2 THEN 0.95 WHEN avg_density > 2 THEN 0.7 WHEN tab AND k THEN 0.85 WHEN max_columns >= 3 AND avg_density <= 2 THEN 0.8 ELSE 0.0 END::double AS confidence FROM a""")
def classify_books(spark: SparkSession, sf: str) -> DataFrame:
    """Books by their sampled pages; these pages have no drawings, so line ends stand for lines and blank lines for gutters."""
    text = F.coalesce("text", F.lit(""))
    pages = _book_pages(spark, sf).select(
        F.col("book_id").alias("doc_id"), C.entry_density(text).alias("entry_density"), (F.regexp_count(text, F.lit(r"\n\n")) + 1).alias("column_count"),
        (F.regexp_count(text, F.lit(r"\n")) > C.TABLE_LINES).alias("table_structure"), C.has_keywords(text).alias("keywords_present"),
    )
    return C.classify(pages).select(F.col("doc_id").alias("book_id"), "avg_density", "doc_type", "confidence")


@query("""SELECT doc_id, doc_id || '_p0_e' || (i - 1) AS slice_id, i - 1 AS entry_index, length(l[i]) AS n_chars
  FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: length(x) >= 20) AS l FROM documents))""")
def line_layout(spark: SparkSession, sf: str) -> DataFrame:
    lines = line_entries(read(spark, sf, "documents"), "doc_id", "text")
    return lines.select("doc_id", "slice_id", F.col("entry_index").cast("bigint"), F.length("text").cast("bigint").alias("n_chars"))


_HOURS = "SELECT event_type, datediff('day', date '2024-01-01', ts) AS x, count(*) AS v FROM events GROUP BY 1, 2"


def _profile(spark: SparkSession, sf: str) -> DataFrame:
    x = F.date_diff(F.to_date("ts"), F.lit("2024-01-01").cast("date"))
    return read(spark, sf, "events").groupBy("event_type", x.alias("x")).agg(F.count("*").alias("v"))


@query(f"""WITH p AS ({_HOURS}), m AS (SELECT *, v > max(v) OVER (PARTITION BY event_type) * 0.15 AS on_ FROM p),
  s AS (SELECT event_type, on_ AND NOT coalesce(lag(on_) OVER (PARTITION BY event_type ORDER BY x), false) AS st FROM m)
  SELECT event_type, greatest(count(*) FILTER (st), 1) AS runs FROM s GROUP BY event_type""")
def ink_runs(spark: SparkSession, sf: str) -> DataFrame:
    return profiles.heavy_runs(_profile(spark, sf), ["event_type"], "x", "v")


@query(f"""WITH p AS ({_HOURS}), m AS (SELECT *, v < quantile_cont(v, 0.1) OVER (PARTITION BY event_type) AS gap, max(x) OVER (PARTITION BY event_type) + 1 AS e FROM p),
  f AS (SELECT *, coalesce(max(CASE WHEN gap THEN x + 1 END) OVER (PARTITION BY event_type ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first FROM m)
  SELECT event_type, first, x AS last FROM f WHERE gap AND x - first > 5 UNION ALL
  SELECT event_type, first, last FROM (SELECT event_type, e AS last, coalesce(max(CASE WHEN gap THEN x + 1 END), 0) AS first FROM m GROUP BY event_type, e) WHERE first < last - 1""")
def ink_bands(spark: SparkSession, sf: str) -> DataFrame:
    bands = profiles.entry_bands(_profile(spark, sf), ["event_type"], "x", "v")
    return bands.select("event_type", F.col("first").cast("bigint"), F.col("last").cast("bigint"))


@query("""WITH w AS (SELECT l_orderkey, l_linenumber, l_returnflag || l_linestatus AS word, (l_quantity * 2 - 5)::int AS conf, l_linenumber * 10 AS x FROM lineitem)
  SELECT l_orderkey AS slice_id, coalesce(string_agg(word, ' ' ORDER BY l_linenumber, word) FILTER (conf >= 0), '') AS text,
    round(coalesce(sum(conf) FILTER (conf >= 0) / (count(*) FILTER (conf >= 0) * 100), 0.0), 4) AS confidence_score,
    count(*) FILTER (conf >= 0) AS n_boxes, coalesce(max(x + 8) FILTER (conf >= 0), 0) AS right_edge,
    coalesce(sum(conf) FILTER (conf >= 0) / (count(*) FILTER (conf >= 0) * 100), 0.0) < 0.65 AS needs_review FROM w GROUP BY l_orderkey""")
def ocr_assembly(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines stand for recognised words: an order is a slice, a line a word, its quantity the confidence."""
    words = read(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("slice_id"), F.col("l_linenumber").alias("position"), F.concat("l_returnflag", "l_linestatus").alias("word"),
        (F.col("l_quantity") * 2 - 5).cast("int").alias("conf"), (F.col("l_linenumber") * 10).alias("left"), F.lit(0).alias("top"), F.lit(8).alias("width"), F.lit(12).alias("height"),
    )
    out = ocr.assemble(words)
    edge = F.coalesce(F.array_max(F.transform("bboxes", lambda b: b["x2"])), F.lit(0)).cast("bigint")
    return out.select("slice_id", "text", "confidence_score", F.size("bboxes").cast("bigint").alias("n_boxes"), edge.alias("right_edge"), "needs_review")


_FORMS = "CASE id % 3 WHEN 0 THEN data_snapshot WHEN 1 THEN 'Reply:' || chr(10) || '```json' || chr(10) || data_snapshot || chr(10) || '```' ELSE 'Sure: ' || data_snapshot || ' ok' END"


@query(f"""WITH r AS (SELECT id, {_FORMS} AS raw FROM review_queue), p AS (SELECT id,
    CASE WHEN json_valid(raw) THEN raw WHEN json_valid(nullif(regexp_extract(raw, '(?s)```(?:json)?\\s*(\\{{.*?\\}})\\s*```', 1), '')) THEN regexp_extract(raw, '(?s)```(?:json)?\\s*(\\{{.*?\\}})\\s*```', 1)
      WHEN json_valid(nullif(regexp_extract(raw, '(?s)\\{{.*\\}}'), '')) THEN regexp_extract(raw, '(?s)\\{{.*\\}}') END AS j FROM r)
  SELECT id, j ->> '$.slice_id' AS slice_id, (j ->> '$.confidence_score')::double AS confidence_score, (j ->> '$.needs_review')::boolean AS needs_review FROM p WHERE j IS NOT NULL""")
def json_recovery(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshots written in the three forms in which replies come: bare, fenced, and within other words."""
    raw = read(spark, sf, "review_queue").select("id", F.expr("CASE id % 3 WHEN 0 THEN data_snapshot WHEN 1 THEN concat('Reply:\\n```json\\n', data_snapshot, '\\n```') ELSE concat('Sure: ', data_snapshot, ' ok') END").alias("raw"))
    data = F.from_json(J.recover_object(F.col("raw")), "slice_id string, confidence_score double, needs_review boolean")
    return raw.select("id", data.alias("d")).where("d IS NOT NULL").select("id", "d.*")


_PLAIN = strip_sql(f"translate(lower(coalesce(surname, '')), '{X.PLAIN_FROM}', '{X.PLAIN_TO}')")


@query(f"SELECT id, {_PLAIN} AS plain FROM persons WHERE surname IS NOT NULL")
def surname_plain(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "persons").where("surname IS NOT NULL").select("id", X.plain_surname(F.col("surname")).alias("plain"))


@query(rf"""SELECT id, array_to_string(list_transform(regexp_extract_all({strip_sql('surname')}, '[\p{{L}}\p{{M}}]+|[^\p{{L}}\p{{M}}]+'), lambda x: upper(x[1]) || lower(x[2:])), '') AS titled FROM persons WHERE surname IS NOT NULL""")
def surname_titled(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "persons").where("surname IS NOT NULL").select("id", X.title_case(F.col("surname")).alias("titled"))


_DATE = strip_sql("event_date")
_ISO = rf"""CASE WHEN regexp_matches({_DATE}, '^\d{{2}}\.\d{{2}}\.\d{{4}}') THEN regexp_replace(left({_DATE}, 10), '(\d{{2}})\.(\d{{2}})\.(\d{{4}})', '\3-\2-\1')
    ELSE nullif(regexp_extract(event_date, '(\d{{4}})', 1), '') END"""


@query(f"SELECT id, {_ISO} AS iso FROM life_events")
def date_iso(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "life_events").select("id", X.iso_date(F.col("event_date")).alias("iso"))


_DETAILS = f"list_filter(list_transform(string_split(detail, ','), lambda x: {strip_sql('x')}), lambda x: x <> '')"


@query(f"SELECT id, coalesce(array_to_string({_DETAILS}, '|'), '') AS items FROM life_events")
def list_items(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "life_events").select("id", F.array_join(X.to_list(F.col("detail")), "|").alias("items"))


@query("""SELECT count(*) FILTER (status = 'pending') AS pending, count(*) FILTER (status = 'accepted') AS accepted, count(*) FILTER (status = 'corrected') AS corrected,
  count(*) FILTER (status = 'discarded') AS discarded, count(*) AS total FROM review_queue""")
def review_stats(spark: SparkSession, sf: str) -> DataFrame:
    return review.stats(read(spark, sf, "review_queue"))


@query("SELECT id, doc_id, slice_id, reason, created_at FROM review_queue WHERE status = 'pending' ORDER BY created_at, id LIMIT 10")
def review_next(spark: SparkSession, sf: str) -> DataFrame:
    return review.dequeue(read(spark, sf, "review_queue")).select("id", "doc_id", "slice_id", "reason", "created_at")


@query("SELECT doc_id, slice_id, phase_name, reason, min(id) AS first_id, count(*) AS n FROM review_queue GROUP BY ALL HAVING count(*) > 1")
def review_repeats(spark: SparkSession, sf: str) -> DataFrame:
    return review.repeated(read(spark, sf, "review_queue"))


@query("""SELECT id, CASE WHEN status <> 'pending' THEN status WHEN reason = 'low_confidence' THEN 'corrected' ELSE 'accepted' END AS status,
    CASE WHEN status <> 'pending' THEN resolved_at ELSE created_at + INTERVAL 1 DAY END AS resolved_at,
    CASE WHEN status <> 'pending' THEN corrected_data WHEN reason = 'low_confidence' THEN data_snapshot END AS corrected_data, resolution_notes FROM review_queue""")
def review_resolved(spark: SparkSession, sf: str) -> DataFrame:
    """Every pending item decided a day after it came: low confidences are corrected, others accepted with an empty correction."""
    queue = read(spark, sf, "review_queue")
    low = F.col("reason") == "low_confidence"
    decisions = queue.where("status = 'pending'").select(
        "id", F.when(low, "corrected").otherwise("accepted").alias("status"), F.when(low, F.col("data_snapshot")).otherwise("").alias("corrected_data"),
        (F.col("created_at") + F.expr("INTERVAL 1 DAY")).alias("resolved_at"),
    )
    return review.resolve(queue, decisions).select("id", "status", "resolved_at", "corrected_data", "resolution_notes")


@query("SELECT count(*) AS total, min(created_at) AS oldest, max(created_at) AS newest, coalesce(sum(hit_count), 0)::bigint AS hits FROM pattern_cache")
def pattern_summary(spark: SparkSession, sf: str) -> DataFrame:
    return patterns.summary(read(spark, sf, "pattern_cache"))


@query("SELECT fingerprint, hit_count, created_at FROM pattern_cache ORDER BY hit_count DESC, created_at, fingerprint LIMIT 10")
def pattern_top(spark: SparkSession, sf: str) -> DataFrame:
    return patterns.most_used(read(spark, sf, "pattern_cache"))


@query(f"""WITH e AS (SELECT {_PRINT} AS fingerprint, created_at AS seen FROM life_events WHERE raw_text IS NOT NULL), h AS (SELECT fingerprint, count(*) AS n, max(seen) AS seen FROM e GROUP BY 1)
  SELECT c.fingerprint, (c.hit_count + coalesce(h.n, 0))::int AS hit_count, greatest(c.last_used, h.seen) AS last_used FROM pattern_cache c LEFT JOIN h USING (fingerprint)""")
def pattern_hits(spark: SparkSession, sf: str) -> DataFrame:
    rows = read(spark, sf, "life_events").where("raw_text IS NOT NULL")
    texts = rows.groupBy("raw_text").agg(F.count("*").alias("n"), F.max("created_at").alias("at"))  # a text is worked on once
    # never null, so that no filter for nulls computes it a second time
    hits = texts.select(F.coalesce(X.fingerprint(X.strip(F.col("raw_text"))), F.lit("")).alias("fingerprint"), "n", "at")
    return patterns.record_hits(read(spark, sf, "pattern_cache"), hits).select("fingerprint", "hit_count", "last_used")


@query("SELECT count(*) AS trained, count(*) AS known FROM (SELECT DISTINCT surname FROM persons WHERE trim(surname) <> '')")
def bloom_recall(spark: SparkSession, sf: str) -> DataFrame:
    """Every trained surname must be found again."""
    names = read(spark, sf, "persons").where(X.strip(F.col("surname")) != "").select("surname").distinct()
    bloom = BloomFilter.train(names, "surname")
    return names.select(bloom.check(F.col("surname"), names).alias("hit")).agg(F.count("*").alias("trained"), F.count_if("hit").alias("known"))


def _entities(spark: SparkSession, sf: str) -> DataFrame:
    given = F.from_json("given_names", "array<string>")
    return read(spark, sf, "persons").select(F.col("id").alias("seq"), X.plain_surname(F.coalesce("surname", F.lit(""))).alias("surname"), X.clean_list(given).alias("given"))


@query()
def resolved_persons(spark: SparkSession, sf: str) -> DataFrame:
    """All person rows in the order of their ids resolved into an empty store."""
    return resolve.resolve(_entities(spark, sf)).select("seq", "person", "is_new", "merge_confidence")


@query(f"""WITH p AS (SELECT id, {_PLAIN} AS s,
    CASE WHEN json_valid(given_names) THEN list_distinct(list_filter(list_transform(from_json(given_names, '["VARCHAR"]'), lambda x: trim(x)), lambda x: x <> '')) ELSE [] END AS g FROM persons),
  j AS (SELECT a.id AS seq, b.id AS person, CASE WHEN len(list_distinct(a.g || b.g)) > 0 THEN len(list_intersect(a.g, b.g)) / len(list_distinct(a.g || b.g)) ELSE 0.0 END AS v FROM p a JOIN p b USING (s))
  SELECT seq, person FROM j QUALIFY row_number() OVER (PARTITION BY seq ORDER BY v DESC, person) = 1""")
def namesake(spark: SparkSession, sf: str) -> DataFrame:
    """For each person row the row of the same surname with the most similar given names, itself included."""
    rows = _entities(spark, sf)
    return resolve.best_namesake(rows, rows.select(F.col("seq").alias("id"), "surname", "given"))


_EVENTS = f"""SELECT person_id, 'birth' AS event_type, {_ISO} AS event_date, NULL::varchar AS location, NULL::varchar AS detail FROM life_events WHERE length(event_date) > 0
  UNION ALL SELECT person_id, 'residence', NULL, location, NULL FROM life_events WHERE {strip_sql('location')} <> ''
  UNION ALL SELECT person_id, 'occupation', NULL, NULL, d FROM (SELECT person_id, unnest({_DETAILS}) AS d FROM life_events)"""


def _as_entities(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "life_events").select(
        "person_id", F.col("event_date").alias("birth_date"), F.lit(None).cast("string").alias("death_date"),
        F.when(X.strip(F.col("location")) != "", F.array("location")).otherwise(F.array().cast("array<string>")).alias("locations"), X.to_list(F.col("detail")).alias("roles"),
    )


@query(_EVENTS)
def entity_events(spark: SparkSession, sf: str) -> DataFrame:
    """Each stored event read as an entity with one date, one place and a list of roles, and written as events, repeats kept."""
    return resolve.entity_events(_as_entities(spark, sf), dedup="literal")


@query(f"SELECT DISTINCT * FROM ({_EVENTS})")
def entity_events_once(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.entity_events(_as_entities(spark, sf), dedup="intended")


@query("""SELECT p.id, greatest(p.updated_at, e.at) AS updated_at FROM persons p LEFT JOIN (SELECT person_id, max(created_at) AS at FROM life_events GROUP BY 1) e ON e.person_id = p.id""")
def touched_persons(spark: SparkSession, sf: str) -> DataFrame:
    seen = read(spark, sf, "life_events").select(F.col("person_id").alias("id"), F.col("created_at").alias("at"))
    return resolve.touch(read(spark, sf, "persons"), seen).select("id", "updated_at")


@query("SELECT phase_name AS phase, doc_id, max_by(reason, (created_at, id)) AS message, max(created_at) AS \"timestamp\" FROM review_queue GROUP BY 1, 2")
def dead_letters(spark: SparkSession, sf: str) -> DataFrame:
    """Queue items read as failures: the last one of each phase and document."""
    rows = read(spark, sf, "review_queue").groupBy("phase_name", "doc_id", "created_at").agg(F.max_by("reason", "id").alias("message"))
    return last_failures(rows.select(F.col("phase_name").alias("phase"), "doc_id", F.col("created_at").alias("timestamp"), "message"))


@query("""SELECT time_bucket(INTERVAL 30 DAYS, acquired_at::timestamp, timestamp '1970-01-01') AS window_start, source, count(*) AS documents, sum(n_chars)::bigint AS chars
  FROM documents WHERE acquired_at IS NOT NULL GROUP BY 1, 2""")
def arrivals(spark: SparkSession, sf: str) -> DataFrame:
    return arrival_windows(read(spark, sf, "documents"))
