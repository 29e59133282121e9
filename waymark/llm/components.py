"""Connected components of an edge table by alternating star contractions.

Every round points the larger neighbours of a node at its smallest neighbour, then the smaller ones; the
edges become stars around each component's smallest node after a number of rounds that grows with the
logarithm of the longest path. All steps are joins and grouped minima of distinct edges; a node with very
many edges is split by the skew join. Rounds are cut by tables in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.session import Scratch

MAX_ROUNDS = 60


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``node, component`` (the smallest node reachable) of every node in ``edges(a, b)`` but the smallest itself."""
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now, before = scratch.keep(now, "edges"), None
    for _ in range(MAX_ROUNDS):
        state = _state(now)
        if state == before or state[0] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        after = scratch.keep(small.select("e.u", "e.v").where("u <> v").distinct(), "edges")
        scratch.drop(now)
        now, before = after, state
    raise RuntimeError("components did not settle")
