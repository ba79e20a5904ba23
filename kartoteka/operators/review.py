"""The review queue as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kartoteka.schemas import STATUSES


def enqueue(queue: DataFrame, items: DataFrame, first_id: int) -> DataFrame:
    """``queue`` plus ``items`` (``doc_id, slice_id, phase_name, reason, data_snapshot, created_at``) as pending, numbered from
    ``first_id`` on without gaps only within each partition; ids are unique."""
    ids = F.monotonically_increasing_id() + first_id
    null = F.lit(None)
    new = items.select(
        ids.alias("id"), "doc_id", "slice_id", "phase_name", "reason", "data_snapshot", "created_at", F.lit("pending").alias("status"),
        null.cast("timestamp").alias("resolved_at"), null.cast("string").alias("resolution_notes"), null.cast("string").alias("corrected_data"),
    )
    return queue.unionByName(new)


def dequeue(queue: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` pending items that wait longest; equal times by id. Items stay in the queue."""
    return queue.where("status = 'pending'").orderBy("created_at", "id").limit(n)


def resolve(queue: DataFrame, decisions: DataFrame) -> DataFrame:
    """``queue`` with decisions (``id, status, corrected_data, resolved_at``) applied.

    Only accepted, corrected and discarded are decisions; others, and unknown ids, change nothing. The latest decision of an
    item counts. Empty corrections become null; notes stay as they are.
    """
    valid = decisions.where(F.col("status").isin(*STATUSES[1:])).groupBy("id").agg(F.max_by(F.struct("status", "corrected_data", "resolved_at"), F.struct("resolved_at", "status")).alias("d"))
    keep = [c for c in queue.columns if c not in ("status", "resolved_at", "corrected_data")]
    decided = F.col("d").isNotNull()
    return queue.join(valid, "id", "left").select(
        *keep,
        F.when(decided, F.col("d.status")).otherwise(F.col("status")).alias("status"),
        F.when(decided, F.col("d.resolved_at")).otherwise(F.col("resolved_at")).alias("resolved_at"),
        F.when(decided, F.nullif(F.col("d.corrected_data"), F.lit(""))).otherwise(F.col("corrected_data")).alias("corrected_data"),
    ).select(*queue.columns)


def stats(queue: DataFrame) -> DataFrame:
    """One row: items per status, 0 where there are none, and all items."""
    return queue.agg(*[F.count_if(F.col("status") == s).alias(s) for s in STATUSES], F.count("*").alias("total"))


def repeated(queue: DataFrame) -> DataFrame:
    """``doc_id, slice_id, phase_name, reason, first_id, n`` of items enqueued more than once; null slices are alike."""
    keys = ["doc_id", "slice_id", "phase_name", "reason"]
    return queue.groupBy(*keys).agg(F.min("id").alias("first_id"), F.count("*").alias("n")).where("n > 1")
