"""Positions within a group, also where one group holds a third of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

#: Rows that are numbered together.
BUCKET_ROWS = 50_000


def numbered(df: DataFrame, keys: Sequence[str], order: str, name: str = "index", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``df`` with the position, from 0, of each row among those with equal ``keys`` (null equals null) in the order of the
    numeric column ``order`` (nulls first, ties in any order).

    The range of ``order`` is cut into equal buckets; rows are numbered within their bucket, and the buckets before are added
    from counts. No task gets a whole group.
    """
    low, high, n = df.agg(F.min(order), F.max(order), F.count("*")).first()
    keys, buckets = list(keys), max(1, -(-n // bucket_rows))
    span = float(high - low) + 1 if low is not None else 1.0
    place = F.floor((F.col(order) - F.lit(low)).cast("double") / F.lit(span) * buckets) if low is not None else F.lit(0)
    rows = df.withColumn("_b", F.coalesce(place.cast("int"), F.lit(-1)))
    inside = F.row_number().over(W.partitionBy(*keys, "_b").orderBy(F.col(order).asc_nulls_first())) - 1
    rows = rows.withColumn("_i", inside)
    sums = rows.groupBy(*keys, "_b").agg(F.count("*").alias("_n"))
    before = W.partitionBy(*keys).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_b").alias("_kb"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)] + [F.col("_b") == F.col("_kb")]
    joined = rows.join(sums, on)
    return joined.select(*df.columns, (F.col("_i") + F.col("_o")).cast("bigint").alias(name))
