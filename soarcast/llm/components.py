"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``node, root`` for every node of ``edges (u, v)``: the root is the least node it reaches.

    Each round groups and joins on one node's links with partial aggregation; a node with
    very many links is split by the adaptive skew join. Rounds grow with the logarithm of
    the longest path; every round is written to the shared folder.
    """
    oriented = edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = scratch.table(oriented, f"{name}-0")
    state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    round_no = 0
    while state[0]:
        round_no += 1
        large = scratch.table(_large(now), f"{name}-{round_no}a")
        now = scratch.table(_small(large), f"{name}-{round_no}b")
        before, state = state, now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if before == state:
            break
    members = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return members.unionByName(members.select(F.col("root").alias("node"), "root").distinct())
