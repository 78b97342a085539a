"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, settle, spread_join


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``links`` (a, b).

    Only minima are aggregated for a node, never its neighbours, and the edges of a node with many are
    dealt over shares to meet its minimum, so no node is too hot.
    """
    edges = settle(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    sign, n = None, edges.count()
    count = F.count(F.lit(1)).alias("n")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        around = settle(both.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m"), count), "cc-least", tidy=False)
        large = spread_join(both, around, "u", "n", "v", 2 * n).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = settle(large, "cc-large", tidy=False)
        least = settle(large.groupBy("u").agg(F.min("v").alias("m"), count), "cc-least", tidy=False)
        small = spread_join(large, least, "u", "n", "v", n).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before, edges = edges, settle(small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "cc", tidy=False)
        discard(before, around, large, least)  # a round reads its predecessor's edges only
        now = edges.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first()
        if now == sign:
            break
        sign, n = now, now[0]
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
