"""Recognised words put together to entries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kartoteka.functions.text import strip


def assemble(words: DataFrame, threshold: float = 0.65) -> DataFrame:
    """``slice_id, text, confidence_score, bboxes, needs_review`` from words with ``slice_id, position, word, conf`` (0 to 100) and
    ``left, top, width, height``.

    Words with a negative confidence or without text are left out; a slice whose words all are keeps a row with empty text and
    confidence 0. The review flag is taken before rounding. A slice is one image, so its words fit into one row.
    """
    kept = (F.col("conf") >= 0) & (strip(F.col("word")) != "")
    box = F.struct(F.col("left").alias("x1"), F.col("top").alias("y1"), (F.col("left") + F.col("width")).alias("x2"), (F.col("top") + F.col("height")).alias("y2"))
    item = F.struct("position", strip(F.col("word")).alias("word"), box.alias("box"))
    by = words.groupBy("slice_id").agg(
        F.array_sort(F.collect_list(F.when(kept, item))).alias("items"), F.sum(F.when(kept, F.col("conf").cast("bigint"))).alias("s"), F.count(F.when(kept, 1)).alias("n")
    )
    mean = F.coalesce(F.try_divide(F.col("s"), F.col("n") * 100), F.lit(0.0))
    return by.select(
        "slice_id",
        F.array_join(F.transform("items", lambda x: x["word"]), " ").alias("text"),
        F.round(mean, 4).alias("confidence_score"),
        F.transform("items", lambda x: x["box"]).alias("bboxes"),
        (mean < threshold).alias("needs_review"),
    )


def outcomes(slices: DataFrame) -> DataFrame:
    """``doc_id, succeeded, failed, error`` from slices with ``doc_id, ok``: a document all of whose slices failed gets an error."""
    by = slices.groupBy("doc_id").agg(F.count_if("ok").alias("succeeded"), F.count_if(~F.col("ok")).alias("failed"))
    message = F.concat(F.lit("all "), F.col("failed").cast("string"), F.lit(" slices failed"))
    return by.withColumn("error", F.when((F.col("succeeded") == 0) & (F.col("failed") > 0), message))
