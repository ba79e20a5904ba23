"""Queries of the training-data operators, and the SQL they equal where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kartoteka.cluster import cut
from kartoteka.llm import p1_copies, p2_scans, p3_names, p4_forms, p5_best, p6_places, p7_packing, p8_mixing, p9_personal


def _read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def _copies(spark: SparkSession, sf: str) -> DataFrame:
    fields = ("event_date", "location", "detail")
    return p1_copies.find_copies(_read(spark, sf, "life_events"), "id", ("person_id", "event_type"), fields, dates=("event_date",))


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return _copies(spark, sf).where("id <> first_id").select("first_id", "id")


def p1_facts(spark: SparkSession, sf: str) -> DataFrame:
    return p1_copies.collapse(_copies(spark, sf))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return p2_scans.find_noise(_read(spark, sf, "life_events"), "id", "raw_text")


def p2_repaired(spark: SparkSession, sf: str) -> DataFrame:
    return p2_scans.repair(_read(spark, sf, "life_events"), "id", "raw_text")


def p3_classes(spark: SparkSession, sf: str) -> DataFrame:
    return p3_names.link(_read(spark, sf, "persons"), "id", "surname", "given_names", _read(spark, sf, "person_groups"))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return p3_names.pairs(p3_classes(spark, sf))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return p4_forms.irregular_values(_read(spark, sf, "persons"), "id", ("surname", "surname_normalized"))


def p4_canonical(spark: SparkSession, sf: str) -> DataFrame:
    persons = _read(spark, sf, "persons").select("id", "surname", "surname_normalized")
    return p4_forms.canonicalise(persons, ("surname", "surname_normalized"))


def _groups(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(_read(spark, sf, t) for t in ("person_groups", "persons", "life_events"))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return p5_best.best_members(*_groups(spark, sf))


def p5_checked(spark: SparkSession, sf: str) -> DataFrame:
    """The two fields of :func:`p5_found` whose values SQL can check: time and confidence."""
    return p5_best.best_members(*_groups(spark, sf)).where("field <> 'given_names'")


def p5_records(spark: SparkSession, sf: str) -> DataFrame:
    return p5_best.records(*_groups(spark, sf))


def _places(spark: SparkSession, sf: str) -> DataFrame:
    return p6_places.map_to_reference(_read(spark, sf, "life_events"), "id", "location", _read(spark, sf, "place_ref"))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return _places(spark, sf).where("NOT exact").select("id", "place_id")


def p6_misses(spark: SparkSession, sf: str) -> DataFrame:
    return p6_places.misses(_places(spark, sf))


def p7_containers(spark: SparkSession, sf: str) -> DataFrame:
    return p7_packing.pack(_read(spark, sf, "documents"), _read(spark, sf, "pack_sizes"))


def p7_report(spark: SparkSession, sf: str) -> DataFrame:
    return p7_packing.report(p7_containers(spark, sf), _read(spark, sf, "pack_sizes"))


def p7_checks(spark: SparkSession, sf: str) -> DataFrame:
    """``pack_id, documents, overfull, cut``: documents packed; containers beyond the capacity and texts cut that would fit whole
    (none)."""
    sizes = _read(spark, sf, "pack_sizes")
    packed = cut(p7_packing.pack(_read(spark, sf, "documents"), sizes)).join(F.broadcast(sizes), "pack_id")
    filled = packed.groupBy("pack_id", "container_id").agg(F.sum("n_tokens").alias("n"), F.first("capacity_tokens").alias("most"))
    whole = packed.groupBy("pack_id", "doc_id").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("pieces"), F.first("capacity_tokens").alias("most"))
    over = filled.groupBy("pack_id").agg(F.count_if(F.expr("n > most")).alias("overfull"))
    return over.join(whole.groupBy("pack_id").agg(F.count("*").alias("documents"), F.count_if(F.expr("pieces > 1 AND n <= most")).alias("cut")), "pack_id").select("pack_id", "documents", "overfull", "cut")


def p8_mixed(spark: SparkSession, sf: str) -> DataFrame:
    return p8_mixing.mix(_read(spark, sf, "documents"), _read(spark, sf, "mix_targets"))


def p8_shares(spark: SparkSession, sf: str) -> DataFrame:
    return p8_mixing.report(p8_mixed(spark, sf), _read(spark, sf, "mix_targets"))


def p8_checks(spark: SparkSession, sf: str) -> DataFrame:
    """``source, repeated, astray``: for each source that has a target and documents the documents that appear more often than it
    allows, and whether its share is off by a block or more, of which at most ``MAX_BLOCKS`` make up the whole (neither)."""
    documents, targets = _read(spark, sf, "documents"), _read(spark, sf, "mix_targets")
    mixed = cut(p8_mixing.mix(documents, targets)).join(F.broadcast(targets), "source")
    times = mixed.groupBy("source", "doc_id").agg(F.count("*").alias("times"), F.sum("n_tokens").alias("n"), F.max("n_tokens").alias("longest"), F.first("max_repeats").alias("most"), F.first("target_share").alias("share"))
    by = times.groupBy("source").agg(F.count_if(F.expr("times > most")).alias("repeated"), F.sum("n").alias("n"), F.max("longest").alias("longest"), F.first("share").alias("share"))
    whole = by.agg(F.sum("n").alias("whole"), F.sum("share").alias("shares"), F.max("longest").alias("text"))
    block = F.greatest(F.lit(p8_mixing.BLOCK_TOKENS), F.col("whole") / p8_mixing.MAX_BLOCKS) + F.col("text")  # the last text of a share may overhang
    off = F.abs(F.col("n") - F.col("share") / F.col("shares") * F.col("whole")) >= block
    return by.crossJoin(F.broadcast(whole)).select("source", "repeated", off.cast("int").alias("astray"))  # whole has one row


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    found = p9_personal.pseudonymise(_read(spark, sf, "documents"), "doc_id", "text", p9_personal.session_key(spark), _read(spark, sf, "persons"))
    return found.where(F.col("kind").isin(*p9_personal.KINDS)).select("doc_id", "kind", "start_pos").distinct()


def p9_redacted(spark: SparkSession, sf: str) -> DataFrame:
    return p9_personal.redact(_read(spark, sf, "documents"), "doc_id", "text", p9_personal.session_key(spark), _read(spark, sf, "persons"))


QUERIES = {f.__name__: f for f in (p1_found, p1_facts, p2_found, p2_repaired, p3_found, p3_classes, p4_found, p4_canonical, p5_found, p5_checked, p5_records, p6_found, p6_misses, p7_containers, p7_report, p7_checks, p8_mixed, p8_shares, p8_checks, p9_found, p9_redacted)}

_WORDS = (
    "array_to_string(list_sort(list_filter(regexp_split_to_array(regexp_replace(regexp_replace(lower(coalesce({c}, '')), "
    "'^0+([0-9])', '\\1'), '([^\\p{{L}}\\p{{M}}\\p{{N}}])0+([\\p{{N}}])', '\\1\\2', 'g'), '[^\\p{{L}}\\p{{M}}\\p{{N}}]+'), lambda w: w <> '')), ' ')"
)
_SEP = r"[^\p{L}\p{N}]"
_DMY, _YMD = rf"^{_SEP}*(\d{{1,2}}){_SEP}+(\d{{1,2}}){_SEP}+(\d{{4}}){_SEP}*$", rf"^{_SEP}*(\d{{4}}){_SEP}+(\d{{1,2}}){_SEP}+(\d{{1,2}}){_SEP}*$"


def _part(pattern: str, group: int) -> str:
    return f"regexp_extract(event_date, '{pattern}', {group})::int::varchar"


_P1_KEYS = f"""SELECT id, person_id, event_type,
    CASE WHEN regexp_matches(event_date, '{_DMY}') THEN concat_ws('-', {_part(_DMY, 3)}, {_part(_DMY, 2)}, {_part(_DMY, 1)})
         WHEN regexp_matches(event_date, '{_YMD}') THEN concat_ws('-', {_part(_YMD, 1)}, {_part(_YMD, 2)}, {_part(_YMD, 3)})
         ELSE {_WORDS.format(c="event_date")} END AS d,
    {_WORDS.format(c="location")} AS l, {_WORDS.format(c="detail")} AS t
  FROM life_events"""

#: An independent statement of which values are irregular: hidden or combining characters, other spaces, compatibility forms,
#: dashes and quotes that look like the usual ones, and letters of two alphabets in one value.
_ODD = (
    r"[\p{Cf}\p{Cc}\p{M}\x{115F}\x{1160}\x{17B4}\x{17B5}\x{3164}\x{FFA0}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FF01}-\x{FF5E}\x{FB00}-\x{FB06}"
    r"\x{1D400}-\x{1D7FF}\x{2010}-\x{2013}\x{2212}\x{FE63}\x{FF0D}\x{2043}\x{2018}\x{2019}\x{2BC}\x{2B9}\x{2032}\x{B4}\x60\x{251}\x{261}\x{131}\x{196}\x{269}\x{1C0}\x{26A}\x{2070}-\x{209C}\x{2100}-\x{214F}\x{2160}-\x{217F}\x{AA}\x{BA}]"
)

ORACLES = {
    "p4_found": f"""SELECT id, field FROM (SELECT id, unnest(['surname', 'surname_normalized']) AS field, unnest([surname, surname_normalized]) AS v FROM persons)
  WHERE regexp_matches(v, '{_ODD}') OR nfc_normalize(v) <> v OR regexp_matches(v, '\\p{{Latin}}') AND regexp_matches(v, '[\\p{{Cyrillic}}\\p{{Greek}}]')""",
    "p5_checked": """WITH q AS (SELECT quantile_disc(epoch(created_at), 0.01) - 9 * 31557600 AS low, quantile_disc(epoch(created_at), 0.99) + 9 * 31557600 AS high FROM persons),
  m AS (SELECT DISTINCT group_id, person_id FROM person_groups WHERE group_id IS NOT NULL),
  t AS (SELECT group_id, 'updated_at' AS field, arg_max(person_id, (updated_at, -person_id)) AS person_id FROM m JOIN persons p ON p.id = m.person_id, q
    WHERE floor(epoch(updated_at)) BETWEEN low AND high GROUP BY group_id),
  c AS (SELECT group_id, 'confidence' AS field, arg_max(m.person_id, (best, -m.person_id)) AS person_id FROM m JOIN persons p ON p.id = m.person_id
    JOIN (SELECT person_id, max(confidence) AS best FROM life_events WHERE confidence BETWEEN 0 AND 1 GROUP BY person_id) e ON e.person_id = m.person_id GROUP BY group_id)
  SELECT * FROM t UNION ALL SELECT * FROM c""",
    "p7_checks": """SELECT pack_id, (SELECT count(DISTINCT doc_id) FROM documents WHERE length(text) > 0) AS documents, 0::bigint AS overfull, 0::bigint AS cut FROM pack_sizes""",
    "p8_checks": """SELECT DISTINCT source, 0::bigint AS repeated, 0 AS astray FROM documents JOIN mix_targets USING (source) WHERE length(text) > 0 AND target_share > 0""",
    "p1_found": f"""WITH k AS ({_P1_KEYS}),
  f AS (SELECT id, min(id) OVER (PARTITION BY person_id, event_type, d, l, t) AS first_id FROM k)
  SELECT first_id, id FROM f WHERE id <> first_id""",
    "p1_facts": f"""WITH k AS ({_P1_KEYS})
  SELECT min(id) AS first_id, count(*) AS n_copies FROM k GROUP BY person_id, event_type, d, l, t HAVING count(*) > 1""",
}
