"""Document types from the features of sampled pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kartoteka.operators import images

# Fixed patterns of directory entries and civil records.
SURNAME_NAME = r"(?U)\b[A-ZĄĆĘŁŃÓŚŹŻ]{2,},\s+[A-ZĄĆĘŁŃÓŚŹŻ][a-ząćęłńóśźż]+\b"
DATES = r"(?:ur\.|zm\.|[*†])\s*\d{4}"
ADDRESSES = r"(?iU)\b(?:ul\.|pl\.|al\.)\b"
ADDRESSES_SPACED = r"(?iU)\b(?:ul\.|pl\.|al\.)"
KEYWORDS = r"(?iU)\b(?:SPIS|KSIĘGA|REJESTR|ZGONÓW|URODZEŃ|MAŁŻEŃSTW)\b"
# Drawn lines and rectangles beyond which a page counts as a table; thresholds and confidences of the rules.
TABLE_LINES = 15
DENSE, SOME, COLUMNS, MANY_COLUMNS = 5, 2, 2, 3
SURE, LIKELY, CIVIL, NEWS = 0.95, 0.70, 0.85, 0.80


def entry_density(text: Column, spaced_addresses: bool = False) -> Column:
    """Surname-and-name pairs, dates and address words of a page. An address word counts only with a word right behind its dot,
    unless ``spaced_addresses``."""
    address = ADDRESSES_SPACED if spaced_addresses else ADDRESSES
    return sum((F.regexp_count(F.coalesce(text, F.lit("")), F.lit(p)) for p in (DATES, address)), F.regexp_count(F.coalesce(text, F.lit("")), F.lit(SURNAME_NAME)))


def has_keywords(text: Column) -> Column:
    return F.coalesce(text.rlike(KEYWORDS), F.lit(False))


def features(pages: DataFrame) -> DataFrame:
    """``doc_id, page_num, column_count, entry_density, table_structure, keywords_present`` of rendered pages (``doc_id, page_num, text,
    drawings, image_bytes``). A page whose image cannot be read has one column."""
    counted = pages.withColumn("column_count", images.column_counts("image_bytes"))
    return counted.select(
        "doc_id", "page_num", "column_count", entry_density(F.col("text")).alias("entry_density"),
        (F.coalesce("drawings", F.lit(0)) > TABLE_LINES).alias("table_structure"), has_keywords(F.col("text")).alias("keywords_present"),
    )


def sampled(index: Column, n_pages: Column) -> Column:
    """Whether a page is the first, the middle or the last one of its document."""
    return (index == 0) | (index == F.floor(n_pages / 2)) & (n_pages > 2) | (index == n_pages - 1)


def sample_indices(n_pages: Column) -> Column:
    """First, middle and last page: [0], [0, 1] or [0, n // 2, n - 1]; empty for no pages."""
    pages = F.array(F.lit(0).cast("bigint"), F.floor(n_pages / 2), n_pages - 1)
    return F.when(n_pages > 0, F.array_distinct(pages)).otherwise(F.array().cast("array<bigint>"))


def rule(density: Column, columns: Column, table: Column, keywords: Column) -> Column:
    """Type and confidence by the first rule that holds."""

    def of(kind: str, confidence: float) -> Column:
        return F.struct(F.lit(kind).alias("doc_type"), F.lit(confidence).alias("confidence"))

    return (
        F.when((density > DENSE) & (columns >= COLUMNS), of("directory", SURE))
        .when(density > SOME, of("directory", LIKELY))
        .when(table & keywords, of("civil_record", CIVIL))
        .when((columns >= MANY_COLUMNS) & (density <= SOME), of("newspaper", NEWS))
        .otherwise(of("unknown", 0.0))
    )


def classify(pages: DataFrame) -> DataFrame:
    """``doc_id, doc_type, confidence, avg_density, max_columns, has_table, has_keywords`` from sampled pages with ``doc_id,
    entry_density, column_count, table_structure, keywords_present``. Partial aggregates; documents without pages have no row."""
    by = pages.groupBy("doc_id").agg(
        F.avg("entry_density").alias("avg_density"),
        F.greatest(F.max("column_count"), F.lit(1)).alias("max_columns"),
        F.coalesce(F.bool_or("table_structure"), F.lit(False)).alias("has_table"),
        F.coalesce(F.bool_or("keywords_present"), F.lit(False)).alias("has_keywords"),
    )
    kind = rule(F.col("avg_density"), F.col("max_columns"), F.col("has_table"), F.col("has_keywords"))
    return by.withColumn("kind", kind).select("doc_id", "kind.*", "avg_density", "max_columns", "has_table", "has_keywords")
