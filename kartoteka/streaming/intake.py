"""Documents taken in as a stream: scored, filtered and written once per content."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from kartoteka.functions import text as X


def score(rows: DataFrame, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """``rows`` with ``content_id`` and ``lang_score``, those below the threshold left out; the same for tables and streams."""
    scored = rows.withColumn("content_id", X.content_id(F.col(text))).withColumn("lang_score", X.lang_score(X.sample_text(F.col(text))))
    return scored.where(F.col("lang_score") >= threshold)


def intake(spark: SparkSession, folder: str, schema: StructType, out: str, checkpoint: str, time: str = "acquired_at", late: str = "90 days", threshold: float = 0.3) -> StreamingQuery:
    """Take in Parquet files that arrive in ``folder``: score, filter, keep one row per content among those at most ``late`` apart in
    event time, and append to ``out``. Runs until all present files are done; ``checkpoint`` makes a restart go on exactly there."""
    stream = spark.readStream.schema(schema).parquet(folder)
    kept = score(stream, threshold=threshold).withWatermark(time, late).dropDuplicatesWithinWatermark(["content_id"])
    return kept.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def arrivals(stream: DataFrame, time: str = "acquired_at", window: str = "30 days", late: str = "90 days") -> DataFrame:
    """Documents and characters per window of event time and source, for a table or a stream."""
    rows = stream.withWatermark(time, late) if stream.isStreaming else stream
    by = rows.groupBy(F.window(time, window).alias("w"), "source").agg(F.count("*").alias("documents"), F.sum("n_chars").alias("chars"))
    return by.select(F.col("w.start").alias("window_start"), "source", "documents", "chars")
