"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.session import cut_lineage

STARS_PER_CUT = 2


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the smallest of node and neighbours."""
    ways = _both_ways(edges)
    least = cut_lineage(ways.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low")))
    return ways.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours move to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("low"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.filter("a <> b").unionByName(least.select("a", F.col("low").alias("b"))).distinct()


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``node, component`` for ``nodes(node)`` and ``edges(a, b)``; a component is named by its smallest node.

    Alternating star contraction: the rounds grow with the logarithm of the number
    of nodes, not with the length of paths. Every few rounds are
    written to the checkpoint folder, and so are the smallest neighbours of the large star:
    a join with written rows shuffles both sides, so a hub's edges can be split among tasks.
    After it, no node has many smaller neighbours.
    """
    current = cut_lineage(edges.filter("a <> b").distinct())
    state = None
    while True:
        for _ in range(STARS_PER_CUT):
            current = _small_star(_large_star(current))
        current = cut_lineage(current)
        row = current.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(row) == state:
            break
        state = tuple(row)
    named = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.join(named, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
