"""Sources mixed to target weights: Pfair block windows, earliest deadline first."""

from __future__ import annotations

import heapq
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from kartoteka.cluster import cut
from kartoteka.llm.tokens import VOCABULARY, with_tokens

#: Least size of a block in tokens, and the most blocks of a schedule: blocks grow with the data, the schedule does not.
BLOCK_TOKENS, MAX_BLOCKS = 4_096, 100_000
#: Texts of one source that are added up in one task.
BUCKET_ROWS = 50_000


def schedule(weights: dict[str, Fraction], blocks: dict[str, int]) -> list[tuple[str, int]]:
    """``(source, block number)`` for each slot. Block ``j`` of a source of weight ``w`` may start from slot ``floor(j / w)`` on
    and is due at ``ceil((j + 1) / w)``; each slot takes the block that may start and is due first (ties: by name). A slot for
    which no block may start yet takes the one that may start first. Every source is then less than one block away from its
    share at every slot, as long as it has blocks."""

    def window(s: str, j: int) -> tuple[int, int]:
        return int(j / weights[s]), -(-(j + 1) * weights[s].denominator // weights[s].numerator)

    waiting = [(*window(s, 0), s, 0) for s in sorted(weights) if blocks.get(s, 0) > 0]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    out: list[tuple[str, int]] = []
    while waiting or ready:
        now = len(out)
        while waiting and (waiting[0][0] <= now or not ready):
            _, due, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (due, s, j))
            if not (waiting and waiting[0][0] <= now):
                break
        _, s, j = heapq.heappop(ready)
        out.append((s, j))
        if j + 1 < blocks[s]:
            heapq.heappush(waiting, (*window(s, j + 1), s, j + 1))
    return out


def mix(documents: DataFrame, targets: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", path: str = VOCABULARY) -> DataFrame:
    """``slot, source, doc_id, repeat_no, n_tokens``: the mixed corpus; reading by ``slot`` interleaves the sources.

    ``targets`` has ``source, target_share, max_repeats``. Shares are taken among the sources that have tokens and a positive
    share; the size is the largest one at which every share can be met without using a text more than ``max_repeats`` times.
    Texts of other sources, and null or empty ones, are left out. A source's texts follow one another in the order of a hash,
    round after round; the running size within a source is summed up by hash ranges, so no source meets in one task. The
    driver gets one row per target and schedules at most about ``MAX_BLOCKS`` blocks.
    """
    spark = documents.sparkSession
    goal = targets.where("source IS NOT NULL AND target_share > 0 AND max_repeats > 0").groupBy("source").agg(F.max("target_share").alias("share"), F.max("max_repeats").alias("most"))
    wanted = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(source).alias("source")).join(F.broadcast(goal.select("source")), "source", "left_semi")
    counted = cut(with_tokens(wanted, "text", path).where("n_tokens > 0"))
    have = counted.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n")).join(goal, "source").collect()  # one row per target
    total = sum(Fraction(r["share"]).limit_denominator(10**6) for r in have)
    weights = {r["source"]: Fraction(r["share"]).limit_denominator(10**6) / total for r in have}
    size = min((r["most"] * r["tokens"] / weights[r["source"]] for r in have), default=Fraction(0))
    block = max(BLOCK_TOKENS, int(size / MAX_BLOCKS) + 1)
    parts = {r["source"]: int(weights[r["source"]] * size) for r in have}
    slots = schedule(weights, {s: -(-n // block) for s, n in parts.items()})
    plan = spark.createDataFrame([(k, s, j) for k, (s, j) in enumerate(slots)] or [], "slot bigint, source string, block bigint")
    rows = [(r["source"], parts[r["source"]], int(r["tokens"]), -(-parts[r["source"]] // int(r["tokens"]))) for r in have]
    need = spark.createDataFrame(rows, "source string, part bigint, tokens bigint, rounds bigint")

    buckets = max(1, -(-sum(r["n"] for r in have) // BUCKET_ROWS))
    spread = counted.withColumn("h", F.xxhash64(F.lit("mix"), "doc_id"))
    spread = spread.withColumn("bucket", F.floor((F.col("h") / F.lit(2.0**64) + 0.5) * buckets).cast("int"))
    sums = spread.groupBy("source", "bucket").agg(F.sum("n_tokens").alias("t"))
    before = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select("source", "bucket", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("offset"))
    inside = W.partitionBy("source", "bucket").orderBy("h", "doc_id").rowsBetween(W.unboundedPreceding, -1)
    placed = spread.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(offsets, ["source", "bucket"])
    placed = placed.join(F.broadcast(need), "source").withColumn("repeat_no", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("rounds") - 1)))
    start = F.col("offset") + F.col("inside") + F.col("repeat_no") * F.col("tokens")
    placed = placed.withColumn("start", start).where("start < part").withColumn("block", (F.col("start") / F.lit(block)).cast("bigint"))
    return placed.join(F.broadcast(plan), ["source", "block"]).select("slot", "source", "doc_id", F.col("repeat_no").cast("int"), "n_tokens")


def report(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """``source, target_share, tokens, actual_share, texts, most_times`` for every target; a source without texts has share 0."""
    times = mixed.groupBy("source", "doc_id").agg(F.count("*").alias("times"), F.sum("n_tokens").alias("t"))
    by = times.groupBy("source").agg(F.sum("t").alias("tokens"), F.count("*").alias("texts"), F.max("times").alias("most_times"))
    whole = by.agg(F.sum("tokens").alias("whole"))
    joined = targets.select("source", "target_share").join(by, "source", "left").crossJoin(F.broadcast(whole))  # whole has one row
    tokens = F.coalesce("tokens", F.lit(0))
    share = F.coalesce(tokens / F.col("whole"), F.lit(0.0))
    return joined.select("source", "target_share", tokens.alias("tokens"), share.alias("actual_share"), F.coalesce("texts", F.lit(0)).alias("texts"), F.coalesce("most_times", F.lit(0)).alias("most_times"))
