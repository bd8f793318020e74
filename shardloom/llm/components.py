"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.llm.common import cut


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``: root is the smallest node reachable.

    Each step hangs the neighbours of a node on its smallest neighbour: first the larger ones, then
    the smaller ones.  It ends when a round changes nothing, with every node on its root.
    """
    edges = cut(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(low.select("u", F.col("m").alias("v")).unionByName(hung).distinct())
        # Exact sums of both ends: equal before and after means that nothing moved.
        now = tuple(
            edges.agg(
                F.count(F.lit(1)),
                F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
            ).first()
        )
        if now == before:
            break
        before = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
