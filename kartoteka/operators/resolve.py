"""Persons resolved by surname: exact first, then the most similar earlier one, else a new person."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kartoteka.cluster import attach, cut
from kartoteka.functions.text import iso_date
from kartoteka.operators.segments import SegmentTables, by_subsequence, candidates, code_points, indel_budget, letters, subsequence_pairs


def indel_similarity(a: str, b: str) -> float:
    """``1 - (insertions + deletions) / (len(a) + len(b))``; 1 for two empty strings."""
    return float(indel_similarities([a], [b])[0])


def indel_similarities(a: list[str], b: list[str]) -> np.ndarray:
    """:func:`indel_similarity` of many pairs, those of like length at once."""
    sizes = np.array([(len(x), len(y)) for x, y in zip(a, b)], dtype=np.int64).reshape(-1, 2)
    out, order, at = np.ones(len(a)), np.argsort(sizes.max(axis=1, initial=0), kind="stable"), 0
    while at < len(order):
        take = 4096
        while take > 1 and take * sizes[order[at : at + take]].max() > 1_000_000:
            take //= 2
        some = order[at : at + take]
        wide, high = sizes[some].max(axis=0)
        left = np.ascontiguousarray(code_points([a[i] for i in some], wide, 0xFFFFFFFE).T)
        right = np.ascontiguousarray(code_points([b[i] for i in some], high, 0xFFFFFFFF).T)  # what fills up is never equal
        row = np.zeros((high + 1, len(some)), dtype=np.int32)
        for c in left:
            row[1:] = np.maximum.accumulate(np.where(right == c, row[:-1] + 1, row[1:]), axis=0)
        total = sizes[some].sum(axis=1)
        out[some] = np.where(total > 0, 1.0 - (total - 2 * row[-1]) / np.maximum(total, 1), 1.0)
        at += take
    return out


@F.pandas_udf(T.DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    there = (a.notna() & b.notna()).to_numpy()
    out = np.full(len(a), np.nan)
    out[there] = indel_similarities(a[there].tolist(), b[there].tolist())
    return pd.Series(out).astype(object).where(there, None)


def similar_texts(names: DataFrame, threshold: float) -> DataFrame:
    """``a, b, score`` (each pair once) for the distinct ``text`` values with a similarity of ``threshold`` or more. Candidates by
    common subsequences or, for long texts, by segments; letters that differ and the Levenshtein distance as bounds within the join; then
    the exact score."""
    spark, (edits, widest) = names.sparkSession, indel_budget(threshold)
    rows, longest = names.agg(F.count("*"), F.max(F.length("text"))).first()
    longest = longest or 1
    parts = max(spark.sparkContext.defaultParallelism, rows // 32_000)  # by rows, as AQE counts bytes, not pairs; the keys of a text compress where they meet
    names = names.select("text").repartition(parts, "text").select("text", F.length("text").alias("chars"), letters("text").alias("letters"))
    most = F.floor((F.col("a_chars") + F.col("b_chars")) * (1 - threshold) + 1e-9)
    ordered = (F.col("a_chars") < F.col("b_chars")) | ((F.col("a_chars") == F.col("b_chars")) & (F.col("a") < F.col("b")))
    near = ordered & (F.bit_count(F.col("a_letters").bitwiseXOR(F.col("b_letters"))) <= most) & (F.levenshtein("a", "b") <= most)

    def by_segments(n: int, m: int) -> int:
        k = edits(n, m)
        return -1 if k < 1 or by_subsequence(n, m, k) else k

    names = cut(names)
    tables = SegmentTables.upto(spark, longest, by_segments, widest)
    pairs = subsequence_pairs(names, longest, edits, widest, near, parts).unionByName(candidates(names, tables, near, parts)).distinct()
    return pairs.withColumn("score", similarity("a", "b")).where(F.col("score") >= threshold)


def leaders(names: DataFrame, pairs: DataFrame) -> DataFrame:
    """``text, seq`` of the names that become persons: those without a similar leader that came before. Names with a negative
    ``seq`` are stored already and lead in any case.

    Decided in rounds: a name all of whose earlier similar names are known to follow someone leads; a name with an earlier
    leader follows. Every round decides at least the earliest open names of all chains at once; each is a written table.
    """
    both = pairs.select(F.col("a").alias("x"), F.col("b").alias("y")).unionByName(pairs.select(F.col("b").alias("x"), F.col("a").alias("y")))
    x, y = names.select(F.col("text").alias("x"), F.col("seq").alias("sx")), names.select(F.col("text").alias("y"), F.col("seq").alias("sy"))
    earlier = cut(both.join(x, "x").join(y, "y").where("sy < sx AND sx >= 0").select("x", "y"))  # y came before x; stored names lead
    free = names.join(earlier.select(F.col("x").alias("text")).distinct(), "text", "left_anti")
    leading = cut(free)
    open_ = earlier
    while True:  # every round decides the earliest open names, so it ends
        heads = leading.select(F.col("text").alias("y"))
        follow = open_.join(heads, "y", "left_semi").select("x").distinct()
        rest = open_.join(follow, "x", "left_anti")
        rest = cut(rest.join(follow.select(F.col("x").alias("y")), "y", "left_anti"))  # names that follow block nobody
        waiting = rest.select("x").distinct()
        freed = open_.select("x").distinct().join(follow, "x", "left_anti").join(waiting, "x", "left_anti")
        freed = cut(freed.select(F.col("x").alias("text")).join(names, "text").select("text", "seq"))
        if freed.isEmpty() and rest.isEmpty():
            return leading
        leading = cut(leading.unionByName(freed))
        open_ = rest
        if rest.isEmpty():
            return leading


def resolve(entities: DataFrame, threshold: float = 0.85, store: DataFrame | None = None) -> DataFrame:
    """``seq, surname, person, is_new, merge_confidence`` for entities (``seq bigint`` unique and not negative, ``surname`` in its plain
    form) taken in the order of ``seq`` into a store: an empty one, or persons with ``id, surname`` (plain form, too).

    With a store, ``person`` is a stored id where one matches (of equal surnames the smallest), and a new person's is
    ``largest id + 1 + seq``.

    The first occurrence of a leading name is a new person (its ``person`` is its own ``seq``); later equal names merge with
    confidence 1, similar ones with the most similar leader so far (ties: the earlier). Null surnames count as empty ones.
    """
    rows = entities.select("seq", F.coalesce("surname", F.lit("")).alias("text"))
    names = rows.groupBy("text").agg(F.min("seq").alias("seq"), F.count("*").alias("n"))
    base = 0
    if store is not None:
        base = (store.agg(F.max("id")).first()[0] or 0) + 1
        stored = store.groupBy(F.coalesce("surname", F.lit("")).alias("text")).agg((F.min("id") - base).alias("seq"), F.lit(0).cast("bigint").alias("n"))
        names = names.unionByName(stored).groupBy("text").agg(F.min("seq").alias("seq"), F.sum("n").alias("n"))
    names = cut(names)
    pairs = cut(similar_texts(names.where("text <> ''"), threshold))
    lead = cut(leaders(names.select("text", "seq"), pairs))
    n = entities.count()
    own = attach(rows, lead.withColumnRenamed("seq", "person").join(names.select("text", "n"), "text"), ["text"], "n", n).drop("n")
    exact = own.select("seq", F.col("text").alias("surname"), "person", (F.col("seq") == F.col("person")).alias("is_new"), F.when(F.col("seq") > F.col("person"), F.lit(1.0)).alias("merge_confidence"))
    both = pairs.select(F.col("a").alias("text"), F.col("b").alias("other"), "score").unionByName(pairs.select(F.col("b").alias("text"), F.col("a").alias("other"), "score"))
    near = both.join(lead.select(F.col("text").alias("other"), F.col("seq").alias("person")), "other").join(lead.select("text"), "text", "left_anti")
    options = near.groupBy("text").agg(F.collect_list(F.struct("score", "person")).alias("options")).join(names.select("text", "n"), "text")  # similar leaders of one name
    later = attach(rows, options, ["text"], "n", n)
    fits = F.filter("options", lambda o: o["person"] < F.col("seq"))
    best = F.reduce(fits, F.struct(F.lit(-1.0).alias("score"), F.lit(0).cast("bigint").alias("person")), lambda acc, o: F.when((o["score"] > acc["score"]) | ((o["score"] == acc["score"]) & (o["person"] < acc["person"])), F.struct(o["score"].alias("score"), o["person"].alias("person"))).otherwise(acc))
    fuzzy = later.withColumn("best", best).select("seq", F.col("text").alias("surname"), F.col("best.person").alias("person"), F.lit(False).alias("is_new"), F.col("best.score").alias("merge_confidence"))
    return exact.unionByName(fuzzy).withColumn("person", F.col("person") + base)


def insert_persons(persons: DataFrame, resolved: DataFrame, entities: DataFrame) -> DataFrame:
    """``persons`` (``id, surname, given_names, surname_normalized, created_at, updated_at``) plus the new ones of ``resolved``, whose
    ``entities`` have ``seq, surname, given_names``; both times are now."""
    new = resolved.where("is_new").select("seq", F.col("person").alias("id"), F.col("surname").alias("surname_normalized")).join(entities.select("seq", "surname", "given_names"), "seq")
    now = F.current_timestamp()
    return persons.unionByName(new.select("id", "surname", "given_names", "surname_normalized", now.alias("created_at"), now.alias("updated_at")))


def jaccard(a: Column, b: Column) -> Column:
    """Shared part of two lists of names; 0 for two empty ones."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(0.0)


def best_namesake(entities: DataFrame, persons: DataFrame) -> DataFrame:
    """``seq, person`` for entities (``seq, surname, given``) whose plain surname a stored person (``id, surname, given``) has: the
    one with the most similar given names, ties by the smaller id. Equal spellings are compared once, and only those that share a
    given name; without any the smallest id is taken."""
    left = entities.groupBy("surname", "given").agg(F.count("*").alias("n"))
    right = persons.groupBy("surname", F.array_distinct("given").alias("theirs")).agg(F.min("id").alias("id"))
    mine = left.select("surname", "given", F.explode(F.array_distinct("given")).alias("name"))
    others = right.select("surname", "id", F.size("theirs").alias("m"), F.explode("theirs").alias("name"))
    shared = mine.join(others, ["surname", "name"]).groupBy("surname", "given", "id").agg(F.count("*").alias("c"), F.first("m").alias("m"))
    score = F.col("c") / (F.size(F.array_distinct("given")) + F.col("m") - F.col("c"))
    best = shared.groupBy("surname", "given").agg(F.max_by("id", F.struct(score, -F.col("id"))).alias("best"))
    first = right.groupBy("surname").agg(F.min("id").alias("first")).join(left.groupBy("surname").agg(F.sum("n").alias("_n")), "surname")
    n = entities.count()
    named = attach(left.select("surname", "given", "n"), first, ["surname"], "_n", n).drop("_n").join(best, ["surname", "given"], "left")
    named = named.select("surname", "given", "n", F.coalesce("best", "first").alias("person"))
    return attach(entities.select("seq", "surname", "given"), named, ["surname", "given"], "n", n).select("seq", "person")


def entity_events(entities: DataFrame, dedup: str = "intended", keep: Sequence[str] = ()) -> DataFrame:
    """``person_id, event_type, event_date, location, detail`` for entities with ``person_id, birth_date, death_date, locations,
    roles``: one row for a birth or death with a date, for each location and each role. Columns in ``keep`` go along.

    ``dedup="literal"`` keeps repeats, as a store whose key has nulls does; ``"intended"`` drops them, nulls being alike.
    """
    null = F.lit(None).cast("string")

    def event(kind: str, date: Column = null, location: Column = null, detail: Column = null) -> Column:
        return F.struct(F.lit(kind).alias("event_type"), date.alias("event_date"), location.alias("location"), detail.alias("detail"))

    def dated(kind: str, date: str) -> Column:
        return F.when(F.length(date) > 0, F.array(event(kind, iso_date(F.col(date))))).otherwise(F.array().cast(_EVENTS))

    places = F.transform(F.coalesce("locations", F.array().cast("array<string>")), lambda x: event("residence", location=x))
    jobs = F.transform(F.coalesce("roles", F.array().cast("array<string>")), lambda x: event("occupation", detail=x))
    every = F.concat(dated("birth", "birth_date"), dated("death", "death_date"), places, jobs)
    rows = entities.select(*keep, "person_id", F.inline(every))
    if dedup not in ("literal", "intended"):
        raise ValueError("dedup is literal or intended")
    return rows if dedup == "literal" else rows.distinct()


_EVENTS = "array<struct<event_type:string,event_date:string,location:string,detail:string>>"


def new_sources(known: DataFrame, doc_ids: DataFrame) -> DataFrame:
    """``doc_id`` of documents that ``known`` lacks, each once."""
    return doc_ids.where("doc_id IS NOT NULL").select("doc_id").distinct().join(known.select("doc_id"), "doc_id", "left_anti")


def touch(persons: DataFrame, seen: DataFrame) -> DataFrame:
    """``persons`` with ``updated_at`` raised to the latest ``at`` of ``seen`` (``id, at``)."""
    last = seen.groupBy("id").agg(F.max("at").alias("_at"))
    return persons.join(last, "id", "left").withColumn("updated_at", F.greatest("updated_at", "_at")).select(*persons.columns)
