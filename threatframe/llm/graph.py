"""Connected components of a graph given as edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threatframe.session import stage


def fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row.n, row.x


def minima(edges: DataFrame) -> DataFrame:
    """(u, m): the smallest neighbour of each u. Written, so that the join with it can be split at a node with many edges."""
    return stage(edges.groupBy("u").agg(F.min("v").alias("m")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b, of one orderable type); component is the smallest node reachable.

    Large star: every node's larger neighbours move to its smallest neighbour. Small star: its smaller ones do, and itself.
    A round is linear in the edges, and rounds grow with the logarithm of a component's size. It ends when a round changes
    nothing. Null nodes and loops are ignored; repeated edges count once.
    """
    pairs = stage(edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = fingerprint(pairs)
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = stage(both.join(minima(both), "u").where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        small = large.join(minima(large), "u")
        # (u, m) comes from v = m itself, (v, m) from the others
        pairs = stage(small.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).distinct())
        now = fingerprint(pairs)
        if now == before:
            break
        before = now
    roots = pairs.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
