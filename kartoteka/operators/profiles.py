"""Runs and gaps in ink profiles, as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def heavy_runs(profile: DataFrame, keys: Sequence[str], position: str, value: str, share: float = 0.15) -> DataFrame:
    """``keys, runs``: how many runs of neighbouring positions exceed ``share`` of the group's largest value; at least 1.

    A profile has one row per position of one image, so a group is bounded by the image's width.
    """
    most = profile.groupBy(*keys).agg(F.max(value).alias("_most"))
    marked = profile.join(most, list(keys)).withColumn("_on", F.col(value) > F.col("_most") * share)
    before = F.lag("_on").over(W.partitionBy(*keys).orderBy(position))
    starts = marked.withColumn("_start", F.col("_on") & ~F.coalesce(before, F.lit(False)))
    return starts.groupBy(*keys).agg(F.greatest(F.count_if("_start"), F.lit(1)).alias("runs"))


def entry_bands(profile: DataFrame, keys: Sequence[str], position: str, value: str, share: float = 0.10, least: int = 5) -> DataFrame:
    """``keys, first, last`` (exclusive) of the bands between gap rows, a gap being a value below the group's ``share`` percentile.

    A band that a gap closes must be longer than ``least``; the band at the end needs two rows.
    """
    cut = profile.groupBy(*keys).agg(F.percentile(value, F.lit(share)).alias("_cut"), (F.max(position) + 1).alias("_end"))
    marked = profile.join(cut, list(keys)).withColumn("_gap", F.col(value) < F.col("_cut"))
    window = W.partitionBy(*keys).orderBy(position)
    start = F.coalesce(F.max(F.when(F.col("_gap"), F.col(position) + 1)).over(window.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    marked = marked.withColumn("first", start)
    closed = marked.where(F.col("_gap") & (F.col(position) - F.col("first") > least)).select(*keys, "first", F.col(position).alias("last"))
    tail = marked.groupBy(*keys, "_end").agg(F.coalesce(F.max(F.when(F.col("_gap"), F.col(position) + 1)), F.lit(0)).alias("first"))
    tail = tail.where(F.col("first") < F.col("_end") - 1).select(*keys, "first", F.col("_end").alias("last"))
    return closed.unionByName(tail)
