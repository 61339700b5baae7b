"""Connected components of a graph, as joins and aggregations.

Alternating large-star and small-star rounds (Kiveris et al., "Connected
Components in MapReduce and Beyond").  The number of edges never grows, rounds
grow with the logarithm of the number of nodes, and every round is staged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsift.session import stage, unstage


def _directed(edges: DataFrame) -> DataFrame:
    ways = F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))
    return edges.select(F.explode(ways).alias("e")).select("e.u", "e.v")


def _least(edges: DataFrame) -> DataFrame:
    """Least neighbour of a node, or itself.  Staged, so that the join below can split a hub's edges."""
    return stage(edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))


def _large_star(edges: DataFrame, least: DataFrame) -> DataFrame:
    near = _directed(edges).join(least, "u").filter(F.col("v") > F.col("u"))
    return near.select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame, least: DataFrame) -> DataFrame:
    ends = F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))
    moved = edges.join(least, "u").select(F.explode(ends).alias("e")).select("e.v", "e.m")
    return moved.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()


def connected(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component) for every node with an edge; the component is its least node.

    Edges with a null end and loops count as none.  Repeated edges are harmless.
    """
    a, b = F.col(left), F.col(right)
    now = stage(edges.filter(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    before, state = None, _state(now)
    while state != before and state["n"]:
        least = _least(_directed(now))
        large = stage(_large_star(now, least).distinct())
        below = _least(large)
        after = stage(_small_star(large, below).distinct())
        before, state = state, _state(after)
        for used in (now, least, large, below):
            unstage(used)
        now = after
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
