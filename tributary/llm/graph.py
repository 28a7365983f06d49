"""Connected components of an edge table by alternating large-star and small-star rounds.

Every round is two groupings and two equi-joins; the smallest label of a component spreads in a number of rounds that
grows with the logarithm of its diameter. Each round is written to the shared folder in place of the last, so the plan doesn't grow and a lost executor
costs one round at most. Edges and components never pass through the driver: only a count and a checksum do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
    return both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v")
    low = down.groupBy("u").agg(F.min("v").alias("low"))
    linked = down.join(low, "u").filter("v != low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return linked.unionByName(low.select("u", F.col("low").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of each node of ``edges`` (u long, v long) that isn't the smallest of its component.

    Loops and repeated edges change nothing; no edges give an empty result.
    """
    now = materialise(edges.filter("u != v").distinct(), "edges")
    mark = lambda df: df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    seen = None
    for _ in range(ROUNDS):
        now = materialise(_small_star(_large_star(now)), "stars", replaces=now)
        new = mark(now)
        if new == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = new
    raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
