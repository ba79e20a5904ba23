"""The cache of extraction patterns as a table."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kartoteka.cluster import path_exists
from kartoteka.schemas import PATTERNS

#: A cache up to this many entries is broadcast to the entries it is looked up for.
BROADCAST_ENTRIES = 100_000


@F.pandas_udf(T.BooleanType())
def compiles(patterns: pd.Series) -> pd.Series:
    """Whether each text is a regular expression."""

    def one(p: str | None) -> bool:
        try:
            regex.compile(p)
            return True
        except (regex.error, TypeError):
            return False

    return patterns.map(one).astype(bool)


def put(cache: DataFrame, entries: DataFrame) -> DataFrame:
    """``cache`` with ``entries`` (same columns) put in; invalid patterns are left out and the newest entry of a fingerprint wins."""
    both = cache.withColumn("_new", F.lit(0)).unionByName(entries.where(compiles("regex")).withColumn("_new", F.lit(1)))
    pick = F.max_by(F.struct(*cache.columns), F.struct("_new", "created_at", "regex"))
    return both.groupBy("fingerprint").agg(pick.alias("e")).select("e.*")


def save(cache: DataFrame, folder: str) -> None:
    """Write the cache as JSON lines."""
    cache.write.mode("overwrite").json(folder)


def load(spark: SparkSession, folder: str) -> DataFrame:
    """The cache written by :func:`save`, without malformed lines and invalid patterns; empty if the folder is missing."""
    if not path_exists(spark, folder):
        return spark.createDataFrame([], PATTERNS)
    rows = spark.read.schema(PATTERNS).option("mode", "DROPMALFORMED").json(folder)
    return rows.where("fingerprint IS NOT NULL").where(compiles("regex"))


def remove(cache: DataFrame, fingerprints: DataFrame) -> DataFrame:
    return cache.join(fingerprints.select("fingerprint"), "fingerprint", "left_anti")


def lookup(entries: DataFrame, cache: DataFrame) -> DataFrame:
    """``entries`` (with ``fingerprint``) and the cached ``regex``, null where there is none."""
    side = cache.select("fingerprint", "regex")
    small = cache.limit(BROADCAST_ENTRIES + 1).count() <= BROADCAST_ENTRIES
    return entries.join(F.broadcast(side) if small else side, "fingerprint", "left")


def record_hits(cache: DataFrame, hits: DataFrame) -> DataFrame:
    """``cache`` with each fingerprint's ``hits`` (``fingerprint, at``, and ``n`` for so many at once) added up and the last one's time."""
    number = F.sum("n") if "n" in hits.columns else F.count("*")
    by = hits.groupBy("fingerprint").agg(number.cast("int").alias("_n"), F.max("at").alias("_at"))
    joined = cache.join(by, "fingerprint", "left")
    return joined.withColumn("hit_count", F.col("hit_count") + F.coalesce("_n", F.lit(0))).withColumn("last_used", F.greatest("last_used", "_at")).select(*cache.columns)


def summary(cache: DataFrame) -> DataFrame:
    """One row: number of patterns, first and last creation."""
    return cache.agg(F.count("*").alias("total"), F.min("created_at").alias("oldest"), F.max("created_at").alias("newest"), F.coalesce(F.sum("hit_count"), F.lit(0)).alias("hits"))


def most_used(cache: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` patterns with the most hits; equal ones in the order of their creation."""
    return cache.select("fingerprint", "hit_count", "created_at").orderBy(F.desc("hit_count"), "created_at", "fingerprint").limit(n)


def apply_patterns(entries: DataFrame) -> DataFrame:
    """``slice_id`` and the named groups of the row's own ``regex`` in ``text``, for rows whose pattern matches.

    A pattern is compiled once per batch; an invalid one matches nothing. Groups that a pattern lacks are null.
    """
    groups = ("surname", "given_names", "birth_date", "death_date", "locations", "roles")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            known: dict[str, regex.Pattern | None] = {}
            out = []
            for slice_id, text, pattern in zip(batch["slice_id"], batch["text"], batch["regex"]):
                if pattern not in known:
                    try:
                        known[pattern] = regex.compile(pattern)
                    except regex.error:
                        known[pattern] = None
                match = known[pattern] and known[pattern].search(text)
                if match:
                    found = match.groupdict()
                    out.append((slice_id, *(found.get(g, found.get("given") if g == "given_names" else None) for g in groups)))
            yield pd.DataFrame(out, columns=["slice_id", *groups])

    rows = entries.where("regex IS NOT NULL AND text IS NOT NULL").select("slice_id", "text", "regex")
    return rows.mapInPandas(run, "slice_id string, " + ", ".join(f"{g} string" for g in groups))
