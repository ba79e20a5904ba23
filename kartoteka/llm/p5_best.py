"""Best representative of each group: a latent two-sided quality model of the sources, fitted by expectation-maximisation."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kartoteka.cluster import attach, cut
from kartoteka.llm.given_names import Names, plain, seed
from kartoteka.llm.learned_names import learn
from kartoteka.llm.p3_names import given_tokens

ROUNDS = 12
#: Pseudo-counts: true names are spelled out by half of the sources, false ones by few; as many names are true as not.
SENSITIVITY, FALSE_CLAIMS, TRUTH = (2.0, 2.0), (1.0, 99.0), (5.0, 1.0)
#: Parameters of at most so many sources are broadcast to the evidence; more are joined by shuffle.
BROADCAST_SOURCES = 100_000
#: A time this many years before or after nearly all rows were created is a placeholder.
PLACEHOLDER_YEARS = 9


def full_names(value: str | None, known: Names | None = None) -> tuple[list[str], list[str]]:
    """Different given names spelled out in full, and the letters of initials. Short, foreign and mistyped forms count as the
    name they stand for."""
    words, known = given_tokens(value), known or seed()
    full = {(known.of(w) or (plain(w),))[0] for w in words if len(plain(w)) > 1}
    return sorted(full), sorted({plain(w) for w in words if len(plain(w)) == 1})


def _members(groups: DataFrame, persons: DataFrame, known: Names) -> DataFrame:
    """``group_id, person_id, names, inits, updated_at`` of the groups' members; repeated members count once."""
    book = groups.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parsed = [full_names(v, book.value) for v in batch.pop("given_names")]
            batch["names"], batch["inits"] = [p[0] for p in parsed], [p[1] for p in parsed]
            yield batch

    rows = groups.where("group_id IS NOT NULL").select(F.col("group_id").cast("bigint"), F.col("person_id").cast("bigint")).distinct()
    side = persons.select(F.col("id").cast("bigint").alias("person_id"), "given_names", "updated_at")
    return rows.join(side, "person_id").select("group_id", "person_id", "updated_at", "given_names").mapInPandas(
        run, "group_id bigint, person_id bigint, updated_at timestamp, names array<string>, inits array<string>"
    )


def _evidence(events: DataFrame) -> DataFrame:
    """``person_id, source, best``: by which method most of a person's events were extracted, and the highest confidence within
    [0, 1]. Partial aggregates only, so that persons with very many events meet in no task."""
    valid = F.when(F.col("confidence").between(0, 1), F.col("confidence"))
    rows = events.where("person_id IS NOT NULL").groupBy(F.col("person_id").cast("bigint").alias("person_id"), "extraction_method").agg(F.count("*").alias("n"), F.max(valid).alias("best"))
    method = F.coalesce("extraction_method", F.lit(""))
    return rows.groupBy("person_id").agg(F.max_by(method, F.struct("n", method)).alias("source"), F.max("best").alias("best"))


def facts(members: DataFrame) -> DataFrame:
    """``group_id, name, evidence`` with one ``source, pos, neg`` for each source heard on the name: how many of its members claim
    the name, and how many spell their names without it. A member with an initial of the same letter says neither.

    A group's sources and names, not its members, meet in one row: members are added up by partial aggregates first.
    """
    keys = ["group_id", "source"]
    claims = members.select(*keys, F.explode("names").alias("name")).groupBy(*keys, "name").agg(F.count("*").alias("pos"))
    speakers = members.where("size(names) > 0").groupBy(*keys).agg(F.count("*").alias("all"))
    unsure = members.where("size(names) > 0").select(*keys, F.explode("inits").alias("letter")).groupBy(*keys, "letter").agg(F.count("*").alias("unsure"))
    named = claims.select("group_id", "name").distinct().withColumn("letter", F.substring("name", 1, 1))
    heard = named.join(speakers, "group_id").join(unsure, [*keys, "letter"], "left").join(claims, [*keys, "name"], "left")
    pos = F.coalesce("pos", F.lit(0))
    neg = F.greatest(F.col("all") - pos - F.coalesce("unsure", F.lit(0)), F.lit(0))
    return heard.groupBy("group_id", "name").agg(F.collect_list(F.struct("source", pos.alias("pos"), neg.alias("neg"))).alias("evidence"))


def _judge(table: DataFrame, rates: DataFrame, truth: float) -> DataFrame:
    """``table`` with ``p``, the probability that a name is true, from the log odds of each source's ``yes`` and ``no``."""
    rows = table.select("group_id", "name", F.inline("evidence"))
    if rates.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        rows = rows.join(F.broadcast(rates.drop("n")), "source")
    else:
        rows = attach(rows, rates, ["source"], "n", rates.agg(F.sum("n")).first()[0])
    odds = F.sum(F.col("pos") * F.col("yes") + F.col("neg") * F.col("no")) + F.lit(math.log(truth / (1 - truth)))
    heard = F.collect_list(F.struct("source", "pos", "neg")).alias("evidence")
    by = rows.groupBy("group_id", "name").agg(odds.alias("odds"), heard)
    return by.select("group_id", "name", "evidence", (1 / (1 + F.exp(-F.col("odds")))).alias("p"))


def _rates(sens: Column, fpr: Column) -> list[Column]:
    return [sens.alias("sens"), fpr.alias("fpr"), F.ln(sens / fpr).alias("yes"), F.ln((1 - sens) / (1 - fpr)).alias("no")]


def fit(table: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, float]:
    """``source, n, sens, fpr, yes, no`` for every source, and the share of true names, by expectation-maximisation. Each round judges
    every name and adds the evidence up by source, with any number of sources; the driver gets the share alone."""
    truth = 0.8
    sources = table.select(F.inline("evidence")).groupBy("source").agg(F.count("*").alias("n"))
    rates = cut(sources.select("source", "n", *_rates(F.lit(0.6), F.lit(0.02))))
    for _ in range(rounds):
        judged = _judge(table, rates, truth)
        every = F.concat("evidence", F.array(F.struct(F.lit(None).cast("string").alias("source"), F.lit(1).cast("bigint").alias("pos"), F.lit(0).cast("bigint").alias("neg"))))
        rows = judged.select("p", F.inline(every))  # the row without a source adds up the names themselves
        p, q, pos, neg = F.col("p"), 1 - F.col("p"), F.col("pos"), F.col("neg")
        sums = cut(rows.groupBy("source").agg(F.count("*").alias("n"), F.sum(p * pos).alias("tp"), F.sum(p * neg).alias("tn"), F.sum(q * pos).alias("fp"), F.sum(q * neg).alias("fn")))
        names = sums.where("source IS NULL").select("tp", "fp").first()
        if names is None:
            break
        truth = (names[0] + TRUTH[0]) / (names[0] + names[1] + sum(TRUTH))
        sens = (F.col("tp") + SENSITIVITY[0]) / (F.col("tp") + F.col("tn") + sum(SENSITIVITY))
        fpr = (F.col("fp") + FALSE_CLAIMS[0]) / (F.col("fp") + F.col("fn") + sum(FALSE_CLAIMS))
        rates = sums.where("source IS NOT NULL").select("source", "n", *_rates(sens, fpr))
    return rates, truth


def _judged(groups: DataFrame, persons: DataFrame, events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members with their source and best confidence; names with the probability that they are true."""
    known, _ = learn(persons, "surname", "given_names")
    members = _members(groups, persons, known).join(_evidence(events), "person_id", "left")
    members = cut(members.withColumn("source", F.coalesce("source", F.lit(""))))
    table = cut(facts(members))
    return members, _judge(table, *fit(table)).select("group_id", "name", "p")


def _real_time(persons: DataFrame) -> Column:
    """``updated_at`` where it is no placeholder: within some years of the time when nearly all rows were created."""
    low, high = persons.agg(F.percentile_approx(F.unix_timestamp("created_at"), [0.01, 0.99], 1000)).first()[0] or (None, None)
    if low is None:
        return F.col("updated_at")
    years = PLACEHOLDER_YEARS * 31_557_600
    return F.when(F.unix_timestamp("updated_at").between(int(low) - years, int(high) + years), F.col("updated_at"))


def best_members(groups: DataFrame, persons: DataFrame, events: DataFrame) -> DataFrame:
    """``group_id, field, person_id``: for given_names the member that spells out the most names judged true, for updated_at the
    one with the latest real time, for confidence the one with the highest confidence within [0, 1] among its events.

    Names are judged by the fitted model; ties go to the higher summed probability, then to the smaller person id. A group
    without any value for a field has no row for it; members missing from ``persons`` are left out.
    """
    members, judged = _judged(groups, persons, events)
    accepted = judged.where("p >= 0.5")
    claims = members.select("group_id", "person_id", F.explode("names").alias("name"))
    named = claims.join(accepted, ["group_id", "name"]).groupBy("group_id", "person_id").agg(F.count("*").alias("n"), F.sum("p").alias("p"))

    def winner(df: DataFrame, field: str, *order: Column) -> DataFrame:
        pick = F.max_by("person_id", F.struct(*order, -F.col("person_id")))
        return df.groupBy("group_id").agg(pick.alias("person_id")).select("group_id", F.lit(field).alias("field"), "person_id")

    timed = members.withColumn("t", _real_time(persons)).where("t IS NOT NULL")
    return (
        winner(named, "given_names", F.col("n"), F.round("p", 6))
        .unionByName(winner(timed, "updated_at", F.col("t")))
        .unionByName(winner(members.where("best IS NOT NULL"), "confidence", F.col("best")))
    )


def records(groups: DataFrame, persons: DataFrame, events: DataFrame) -> DataFrame:
    """``group_id, given_names, updated_at, confidence``: one record per group, built field by field. Every name judged true is
    kept (sorted), the latest real time, and the highest valid confidence; a field without a value is null or empty."""
    members, judged = _judged(groups, persons, events)
    names = judged.where("p >= 0.5").groupBy("group_id").agg(F.array_sort(F.collect_set("name")).alias("given_names"))
    rest = members.withColumn("t", _real_time(persons)).groupBy("group_id").agg(F.max("t").alias("updated_at"), F.max("best").alias("confidence"))
    out = rest.join(names, "group_id", "left")
    return out.select("group_id", F.coalesce("given_names", F.array().cast("array<string>")).alias("given_names"), "updated_at", "confidence")
