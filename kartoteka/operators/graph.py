"""Connected components by alternating star contractions, without collecting links or components to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kartoteka.cluster import attach, cut


def connected_components(edges: DataFrame) -> DataFrame:
    """Components of an undirected graph.

    ``edges`` has ``a bigint, b bigint``; loops, repeats and null ends are ignored. Returns ``node, root`` for every node
    that has a link to another one; ``root`` is the smallest node of the component. Alternates large-star and small-star
    rounds until the links no longer change; each round is one shuffle and a durable cut. Every node's neighbours are only
    aggregated (minimum), never collected. The number of rounds grows with the logarithm of the nodes.
    """
    links = cut(
        edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    n, seen = links.count(), None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low"), F.count("*").alias("degree"))
        low = low.withColumn("low", F.least("u", "low"))
        large = attach(both.where("v > u"), low, ["u"], "degree", 2 * n).select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = large.where("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("low"), F.count("*").alias("degree"))
        small = (
            attach(large, down, ["u"], "degree", 2 * n)
            .select(F.when(F.col("v") == F.col("low"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("low").alias("v"))
            .where("u <> v")
            .distinct()
        )
        links = cut(small)
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == seen:
            break
        n, seen = now[0], tuple(now)
    nodes = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return nodes.unionByName(roots)
