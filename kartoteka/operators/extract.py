"""Entities from entries: cached patterns first, a language model for the rest."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kartoteka.cluster import attach, cut
from kartoteka.functions import json as J
from kartoteka.functions import text as X
from kartoteka.operators import patterns as P
from kartoteka.operators.bloom import BloomFilter

#: Confidence of a pattern hit, and of a model's entity with and without a known surname.
CACHED, KNOWN, UNKNOWN = 0.8, 0.6, 0.4
#: Entries of the same layout that a new pattern is tried on, and in what part of them it must find a known surname.
PEERS, HIT_RATE = 5, 0.3

#: What the model is asked; the reply must hold an object with the six fields, or one pattern with groups of their names.
FIELDS = "surname, given_names, birth_date, death_date, locations, roles"
EXTRACTION_PROMPT = (
    f"Below is one entry of a Polish directory. Answer with a single JSON object with the keys {FIELDS}. given_names, locations and "
    "roles are lists of strings, the others strings or null; dates are written as a year or as year-month-day.\n\n"
)
PATTERN_PROMPT = (
    f"Below are one entry of a Polish directory and what was found in it. Answer with one Python regular expression and nothing "
    f"else; it must find the same in entries of the same structure, with groups named {FIELDS}.\n\n"
)


def prompts(text: Column) -> Column:
    return F.concat(F.lit(EXTRACTION_PROMPT), text, F.lit("\n"))


def pattern_prompts(text: Column, fields: Column) -> Column:
    return F.concat(F.lit(PATTERN_PROMPT), F.lit("Entry: "), text, F.lit("\nExtracted: "), F.to_json(fields), F.lit("\n"))


def ask(df: DataFrame, prompt: Column, client: Callable[[str], str]) -> DataFrame:
    """``df`` with ``reply`` and ``error`` of a model call per row; an exception becomes the error text. ``client`` is made on the
    driver and sent to the workers, so it must be picklable."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            replies, errors = [], []
            for p in batch.pop("_prompt"):
                try:
                    replies.append(client(p))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001 - one bad call must not end the job
                    replies.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield batch.assign(reply=pd.Series(replies, dtype=object, index=batch.index), error=pd.Series(errors, dtype=object, index=batch.index))

    rows = df.withColumn("_prompt", prompt)
    kinds = ", ".join(f"`{c}` {t}" for c, t in df.dtypes)
    return rows.mapInPandas(run, f"{kinds}, reply string, error string")


def entity(fields: Column, doc_id: Column, slice_id: Column, text: Column, confidence: Column, method: str) -> Column:
    """An entity struct from a struct of the six fields."""
    return F.struct(
        X.entity_id(doc_id, slice_id).alias("entity_id"), slice_id.alias("slice_id"), X.title_case(F.coalesce(fields["surname"], F.lit(""))).alias("surname"),
        X.clean_list(fields["given_names"]).alias("given_names"), X.clean(fields["birth_date"]).alias("birth_date"), X.clean(fields["death_date"]).alias("death_date"),
        X.clean_list(fields["locations"]).alias("locations"), X.clean_list(fields["roles"]).alias("roles"), text.alias("raw_text"),
        confidence.cast("double").alias("confidence"), F.lit(method).alias("extraction_method"),
    )


def cached_tier(entries: DataFrame, cache: DataFrame, bloom: BloomFilter) -> DataFrame:
    """``doc_id, slice_id, text, fingerprint, entity`` of entries (``doc_id, slice_id, text``): the entity where the pattern cached for
    the entry's layout finds a surname that the filter knows, else null. Blank entries are left out."""
    rows = entries.withColumn("text", X.strip(F.col("text"))).where("text <> ''").withColumn("fingerprint", X.fingerprint(F.col("text")))
    found = P.apply_patterns(P.lookup(rows, cache)).withColumn("surname", X.strip(F.col("surname"))).where("surname <> ''")
    known = found.where(bloom.check(F.col("surname"), found))
    fields = F.struct(
        "surname", X.split_names(F.col("given_names")).alias("given_names"), "birth_date", "death_date",
        X.to_list(F.col("locations")).alias("locations"), X.to_list(F.col("roles")).alias("roles"),
    )
    joined = rows.join(known.select("slice_id", fields.alias("f")), "slice_id", "left")
    made = entity(F.col("f"), F.col("doc_id"), F.col("slice_id"), F.col("text"), F.lit(CACHED), "regex_cached")
    return joined.select("doc_id", "slice_id", "text", "fingerprint", F.when(F.col("f").isNotNull(), made).alias("entity"))


def model_tier(rest: DataFrame, bloom: BloomFilter, client: Callable[[str], str]) -> DataFrame:
    """``doc_id, slice_id, text, fingerprint, fields, entity, error`` of entries that no cached pattern served. A reply without an object
    is an error, one without a surname gives no entity."""
    asked = ask(rest.select("doc_id", "slice_id", "text", "fingerprint"), prompts(F.col("text")), client)
    parsed = cut(asked.withColumn("fields", J.extracted_fields(F.col("reply"))))
    surname = F.coalesce(X.strip(F.col("fields.surname")), F.lit(""))
    checked = parsed.withColumn("_known", bloom.check(surname, parsed))
    confidence = F.when(F.col("_known"), KNOWN).otherwise(UNKNOWN)
    made = entity(F.col("fields"), F.col("doc_id"), F.col("slice_id"), F.col("text"), confidence, "llm_ollama")
    error = F.coalesce("error", F.when(F.col("fields").isNull(), F.concat(F.lit("no JSON object in reply: "), F.substring("reply", 1, 200))))
    return checked.select("doc_id", "slice_id", "text", "fingerprint", "fields", F.when(surname != "", made).alias("entity"), error.alias("error"))


def extract(
    entries: DataFrame, cache: DataFrame, bloom: BloomFilter, client: Callable[[str], str] | None = None, threshold: float = HIT_RATE
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Entities ``doc_id, entity``, failures ``doc_id, slice_id, error``, and the cache with its hits and with the patterns learned. Without
    a ``client`` the cached tier works alone."""
    first = cut(cached_tier(entries, cache, bloom))
    entities = first.where("entity IS NOT NULL").select("doc_id", "entity")
    hits = first.where("entity IS NOT NULL").select("fingerprint", F.current_timestamp().alias("at"))
    used = P.record_hits(cache, hits)
    if client is None:
        return entities, first.limit(0).select("doc_id", "slice_id", F.lit("").alias("error")), used
    second = cut(model_tier(first.where("entity IS NULL"), bloom, client))
    found = second.where("entity IS NOT NULL").select("doc_id", "entity")
    learned = learn_patterns(first, second, used, bloom, client, threshold)
    return entities.unionByName(found), second.where("error IS NOT NULL").select("doc_id", "slice_id", "error"), learned


def learn_patterns(entries: DataFrame, answered: DataFrame, cache: DataFrame, bloom: BloomFilter, client: Callable[[str], str], threshold: float = HIT_RATE) -> DataFrame:
    """``cache`` with a pattern for each layout that it lacks and the model has answered for: the model is asked for one on the
    alphabetically first of the layout's entries, and it is kept if it matches there and finds known surnames in enough of the
    entry's peers. A call that fails teaches nothing."""
    pick = F.min_by(F.struct("doc_id", "text", "fields"), F.struct("text", "doc_id"))
    one = answered.where("entity IS NOT NULL").groupBy("fingerprint").agg(pick.alias("e")).select("fingerprint", "e.*")
    new = cut(one.join(cache.select("fingerprint"), "fingerprint", "left_anti"))
    asked = ask(new, pattern_prompts(F.col("text"), F.col("fields")), client).where("error IS NULL")
    others = peers(entries.join(new.select("fingerprint"), "fingerprint", "left_semi"))
    candidates = asked.join(others, ["doc_id", "fingerprint", "text"], "left").withColumn("regex", F.coalesce(J.pattern_reply(F.col("reply")), F.col("reply")))
    good = accepted_patterns(candidates, bloom, threshold)
    null = F.lit(None).cast("timestamp")
    return P.put(cache, good.select("fingerprint", "regex", F.current_timestamp().alias("created_at"), F.lit(0).alias("hit_count"), null.alias("last_used")).select(*cache.columns))


def peers(entries: DataFrame, n: int = PEERS) -> DataFrame:
    """``doc_id, fingerprint, text, peers``: for each entry text up to ``n`` other texts of its document with the same layout, the
    alphabetically first. Only the first ``n + 1`` texts of a layout are kept at any time."""
    distinct = cut(entries.select("doc_id", "fingerprint", "text").distinct())
    n_rows = distinct.count()
    firsts = distinct.withColumn("_h", F.pmod(F.xxhash64("text"), F.lit(32))).groupBy("doc_id", "fingerprint", "_h").agg(F.slice(F.array_sort(F.collect_set("text")), 1, n + 1).alias("t"))
    firsts = firsts.groupBy("doc_id", "fingerprint").agg(F.slice(F.array_sort(F.flatten(F.collect_list("t"))), 1, n + 1).alias("t"))
    sizes = distinct.groupBy("doc_id", "fingerprint").agg(F.count("*").alias("_n"))
    joined = attach(distinct, firsts.join(sizes, ["doc_id", "fingerprint"]), ["doc_id", "fingerprint"], "_n", n_rows)
    return joined.select("doc_id", "fingerprint", "text", F.slice(F.array_remove(F.col("t"), F.col("text")), 1, n).alias("peers"))


def accepted_patterns(candidates: DataFrame, bloom: BloomFilter, threshold: float = HIT_RATE) -> DataFrame:
    """``fingerprint, regex`` of candidates (``fingerprint, text, regex, peers``) that compile, match their own entry, and whose hit
    rate on the peers is ``threshold`` or more: the part of peers in which they find a known surname. No peers, no test."""
    book = candidates.sparkSession.sparkContext.broadcast(bloom)

    @F.pandas_udf(T.BooleanType())
    def good(texts: pd.Series, found: pd.Series, others: pd.Series) -> pd.Series:
        from kartoteka.functions.text import fold_marks

        fold = fold_marks.func

        def one(text, pattern, peers_):
            try:
                compiled = regex.compile(pattern, regex.VERBOSE)
            except (regex.error, TypeError):
                return False
            if not compiled.search(text or ""):
                return False
            if peers_ is None or not len(peers_):
                return True
            names = [((m := compiled.search(p)) and m.groupdict().get("surname") or "").strip() for p in peers_]
            return sum(book.value.has(f) for f in fold(pd.Series(names))) / len(peers_) >= threshold

        return pd.Series([one(t, p, o) for t, p, o in zip(texts, found, others)])

    kept = candidates.withColumn("regex", X.strip_fences(F.col("regex"))).where("regex <> ''").where(good("text", "regex", "peers"))
    return kept.groupBy("fingerprint").agg(F.min("regex").alias("regex"))
