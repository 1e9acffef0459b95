"""Connected components of a distributed edge list by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import cut, drop


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction of edges (u > v): links neighbours of each node to its smallest neighbour.

    The minimum is pre-aggregated before its shuffle and the join back is an inner equi-join, so a
    node with very many neighbours is split by adaptive execution and never gathered in one place.
    """
    near = edges.select("u", "v")
    if large:
        near = near.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    moved = near.join(least, "u")
    if large:
        moved = moved.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return moved.where("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (u, v): root is the smallest node reachable.

    Self loops and repeated edges are allowed; an empty edge list gives an empty result. The number
    of rounds grows with the logarithm of the longest shortest path; each round's edges are
    checkpointed, which also cuts the lineage, and the round's before are removed.
    """
    now = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = None
    while True:
        before, now = now, cut(_star(_star(now, large=True), large=False))
        drop(before)
        new = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if new == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = new
