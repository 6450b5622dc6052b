"""Connected components over links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import persist


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, component`` (the smallest node reachable) of links ``(a, b)`` of longs; null ends and loops are dropped.

    A round links every node's larger neighbours to its smallest one, then its
    smaller ones; it moves as many rows as there are links, and a node's minimum
    is summed up before the shuffle. It ends when a round changes nothing.
    """
    pairs = links.select(F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u")).filter("v < u").distinct()
    state = persist(pairs, "links")
    mark = None
    for _ in range(max_rounds):
        both = state.select("u", "v").unionAll(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").filter("u != v").distinct()
        state = persist(small, "links")
        now = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    stars = state.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionAll(stars.select(F.col("component").alias("node"), "component").distinct())
