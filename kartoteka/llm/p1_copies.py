"""Duplicates hidden by formatting: progressive partition refinement from cheap to exact keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kartoteka.cluster import attach, cut

#: Fixed patterns: a date with the day first, and one with the year first, among any signs that are no letters or digits.
DAY_FIRST = r"^[^\p{L}\p{N}]*(\d{1,2})[^\p{L}\p{N}]+(\d{1,2})[^\p{L}\p{N}]+(\d{4})[^\p{L}\p{N}]*$"
YEAR_FIRST = r"^[^\p{L}\p{N}]*(\d{4})[^\p{L}\p{N}]+(\d{1,2})[^\p{L}\p{N}]+(\d{1,2})[^\p{L}\p{N}]*$"
#: Zeros before a number: 03 and 3 are the same number.
LEADING_ZEROS = r"(?<![\p{L}\p{M}\p{N}])0+(?=\p{N})"


def stripped(field: Column) -> Column:
    """Letters and digits of a field in lower case; null is the empty string. Zeros are left out, as leading ones do not count."""
    return F.regexp_replace(F.lower(F.coalesce(field, F.lit(""))), r"[^\p{L}\p{M}\p{N}]|0", "")


def words_key(field: Column) -> Column:
    """The field's words and numbers as a sorted multiset; null, blank and punctuation alone give the empty string."""
    text = F.regexp_replace(F.lower(F.coalesce(field, F.lit(""))), LEADING_ZEROS, "")
    words = F.filter(F.split(text, r"[^\p{L}\p{M}\p{N}]+"), lambda w: w != "")
    return F.array_join(F.array_sort(words), " ")


def date_key(field: Column) -> Column:
    """As :func:`words_key`, but full dates become year-month-day, so that a day never changes places with a month."""
    text = F.coalesce(field, F.lit(""))

    def ymd(pattern: str, y: int, m: int, d: int) -> Column:
        return F.concat_ws("-", *(F.regexp_extract(text, pattern, g).cast("int").cast("string") for g in (y, m, d)))

    return (
        F.when(text.rlike(DAY_FIRST), ymd(DAY_FIRST, 3, 2, 1))
        .when(text.rlike(YEAR_FIRST), ymd(YEAR_FIRST, 1, 2, 3))
        .otherwise(words_key(field))
    )


def find_copies(df: DataFrame, id_col: str, same: Sequence[str], fields: Sequence[str], dates: Sequence[str] = ()) -> DataFrame:
    """Rows that state the same thing in another format.

    Two rows are copies if the ``same`` columns are equal (null equals null) and each of ``fields`` has the same words and
    numbers in any order, case, spacing and punctuation; ``dates`` are those fields that may hold a date. Accents count.
    Returns ``first_id, id, n_copies`` for **every** member of a set of two or more rows, its smallest row included;
    rows of an id that is null are left out, repeated ids count as one row each.

    Refinement: classes are first cut by the lengths of the stripped fields, then, among classes with several members
    only, by the letter histograms, and only what is left computes the exact keys. A class is never collected: sizes are
    partial aggregates, and hot classes are joined back by broadcast (their number is bounded, see ``cluster.attach``).
    """
    inner = [f"_f{i}" for i in range(len(fields))]
    base = df.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"),
        F.xxhash64(*[F.col(c) for c in same], *[F.isnull(c) for c in same]).alias("_same"),
        *[F.col(c).alias(f"_s{i}") for i, c in enumerate(same)],
        *[F.col(c).alias(i) for c, i in zip(fields, inner)],
    )
    n = df.count()
    lengths = F.xxhash64("_same", *[F.length(stripped(F.col(c))) for c in inner])
    rows = base.withColumn("_k", lengths)
    # 1: stripped lengths
    rows = _several(rows, n)
    # 2: letter histograms, a hash of the sorted letters; only for members of classes that are left
    def histogram(c: str) -> Column:
        return F.xxhash64(F.array_sort(F.split(stripped(F.col(c)), "")))

    rows = cut(_several(rows.withColumn("_k", F.xxhash64("_k", *[histogram(c) for c in inner])), n))
    # 3: exact keys
    exact = [date_key(F.col(i)) if c in dates else words_key(F.col(i)) for c, i in zip(fields, inner)]
    parts = [F.coalesce(F.col(f"_s{i}").cast("string"), F.lit("\x01")) for i in range(len(same))] + exact
    rows = rows.select("id", F.md5(F.concat_ws("\x00", *parts)).alias("_k"))
    classes = rows.groupBy("_k").agg(F.count("*").alias("n_copies"), F.min("id").alias("first_id")).where("n_copies > 1")
    return attach(rows, classes, ["_k"], "n_copies", n).select("first_id", "id", "n_copies")


def _several(rows: DataFrame, n: int) -> DataFrame:
    """Rows whose class ``_k`` has several members."""
    classes = rows.groupBy("_k").agg(F.count("*").alias("_n")).where("_n > 1")
    return attach(rows, classes, ["_k"], "_n", n).drop("_n")


def collapse(copies: DataFrame) -> DataFrame:
    """One row per set with several members: ``first_id, n_copies``."""
    return copies.where("id = first_id").select("first_id", "n_copies").distinct()
