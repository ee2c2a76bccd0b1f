"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import Table


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("high", "low")), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node that a link joins to a smaller one; ``root`` is the smallest node reachable.

    ``edges`` has columns ``a`` and ``b`` of one orderable type; directions, repeats, loops and nulls do not matter.
    A node that is not in the result is its own root. Each round hangs neighbours under the smallest one seen, first
    those above a node, then those below it; the rounds grow with the logarithm of a component's width.
    Smallest neighbours are written before they are joined, so that a hub's rows can be split among tasks.
    """
    linked = edges.where("a <> b").select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct()
    now = Table(linked)
    mark = _mark(now.rows)
    while mark[0]:
        used = [now]
        both = now.rows.select(F.col("low").alias("node"), F.col("low").alias("near")).unionByName(
            now.rows.select(F.col("low").alias("node"), F.col("high").alias("near"))
        ).unionByName(now.rows.select(F.col("high").alias("node"), F.col("low").alias("near")))
        least = Table(both.groupBy("node").agg(F.min("near").alias("least")))
        used.append(least)
        hung = now.rows.join(least.rows.withColumnRenamed("node", "low"), "low").select("high", F.col("least").alias("low"))
        hung = Table(hung.where("high <> low").distinct())
        used.append(hung)
        below = Table(hung.rows.groupBy("high").agg(F.min("low").alias("least")))
        used.append(below)
        small = hung.rows.join(below.rows, "high").where("low <> least").select(F.col("low").alias("high"), F.col("least").alias("low"))
        now = Table(small.unionByName(below.rows.select("high", F.col("least").alias("low"))).distinct())
        for table in used:
            table.drop()
        before, mark = mark, _mark(now.rows)
        if mark == before:
            break
    return now.rows.select(F.col("high").alias("node"), F.col("low").alias("root"))
