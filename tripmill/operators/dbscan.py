"""Density clustering on a grid.

Cells are so small that all points of a cell are neighbours. A cell with enough
points is therefore dense as a whole, however many rows it holds, and no pair of
its rows is ever formed. What is left to decide - points of thin cells, and which
cells touch - is decided on bounding boxes: two boxes are surely within reach,
surely apart, or open, and open boxes are halved until nothing is open. A box with
one distinct point is never open, so the result is exact.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.operators.components import connected_components
from tripmill.operators.numbering import number_rows
from tripmill.session import cut_lineage

NOISE = -1
# Slightly below the largest cell whose points are all neighbours, for rounding.
SLACK = 0.999
# Halvings after which the points themselves are compared.
LAST_LEVEL = 40
# Open boxes that hold no more pairs of points than this are settled by the points at once.
PAIR_BUDGET = 1_000_000
# Dimensions that take part in finding near cells; the others are checked by distance.
GRID_DIMENSIONS = 5


def _total(parts: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, parts)


class _Grid:
    def __init__(self, dimensions: int, eps: float):
        self.d = dimensions
        self.eps = eps
        self.side = SLACK * eps / math.sqrt(dimensions)
        self.x = [f"x{i}" for i in range(dimensions)]

    def key(self, level: int) -> Column:
        """Box of a point after so many halvings; the points themselves at the last."""
        if level >= LAST_LEVEL:
            return F.array(*self.x).cast("array<string>")
        scale = float(2**level)
        return F.array(*[F.floor(F.col(x) / self.side * scale) for x in self.x]).cast("array<string>")

    def boxes(self, points: DataFrame, level: int, within: DataFrame | None = None, above: int = 0) -> DataFrame:
        """Tight boxes of a level: ``key``, rows ``w``, distinct points ``m``, corners.

        With ``within``, only those inside the given boxes of the level above, and their ``parent``.
        """
        keyed = points.withColumn("key", self.key(level))
        keys = ["key"]
        if within is not None:
            keyed = keyed.withColumn("parent", self.key(above))
            keyed = keyed.join(within, "parent", "left_semi")
            keys.append("parent")
        corners = [part for i, x in enumerate(self.x) for part in (F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"))]
        return keyed.groupBy(*keys).agg(F.sum("w").alias("w"), F.count(F.lit(1)).alias("m"), *corners)

    def corners(self) -> list[str]:
        return ["m", *[name for i in range(self.d) for name in (f"lo{i}", f"hi{i}")]]

    def point_corners(self, side: str) -> dict[str, Column]:
        """The columns of a box that is a single point."""
        columns = {f"{side}_{e}{i}": F.col(x) for i, x in enumerate(self.x) for e in ("lo", "hi")}
        return {f"{side}_m": F.lit(1).cast("bigint"), **columns}

    def side_of(self, boxes: DataFrame, side: str, *keep: str) -> DataFrame:
        """Boxes with their columns named for one side of a pair."""
        return boxes.select(*[F.col(c).alias(f"{side}_{c}") for c in (*keep, *self.corners())])

    def gaps(self) -> tuple[Column, Column]:
        """Smallest and largest squared distance between the points of boxes l and r."""
        low, high = [], []
        for i in range(self.d):
            a0, a1, b0, b1 = (F.col(f"{s}_{e}{i}") for s in "lr" for e in ("lo", "hi"))
            least = F.greatest(a0 - b1, b0 - a1, F.lit(0.0))
            most = F.greatest(F.abs(a1 - b0), F.abs(b1 - a0))
            low.append(least * least)
            high.append(most * most)
        return _total(low), _total(high)

    def judge(self, pairs: DataFrame) -> DataFrame:
        """Pairs not surely apart, with a flag for those surely within reach."""
        low, high = self.gaps()
        limit = F.lit(self.eps * self.eps)
        return pairs.filter(low <= limit).withColumn("sure", high <= limit)

    def near(self, left: DataFrame, right: DataFrame) -> DataFrame:
        """Pairs of different cells that may hold neighbours: ``l_key, r_key`` and corners.

        Cells meet in blocks as wide as the reach, each cell in its own block and the
        blocks around it, so a block joins a bounded number of cells.
        """
        reach = math.ceil(self.eps / self.side)
        used = min(self.d, GRID_DIMENSIONS)

        def block(side: str, i: int) -> Column:
            return F.floor(F.floor(F.col(f"{side}_lo{i}") / self.side) / reach)

        wide = self.side_of(left, "l", "key")
        for i in range(used):
            at = block("l", i)
            wide = wide.select("*", F.explode(F.array(at - 1, at, at + 1)).alias(f"b{i}"))
        placed = self.side_of(right, "r", "key", "w").withColumns({f"b{i}": block("r", i) for i in range(used)})
        blocks = [f"b{i}" for i in range(used)]
        pairs = wide.join(placed, blocks).drop(*blocks).filter("l_key <> r_key")
        return self.judge(pairs).drop("sure")


def _next_level(pairs: DataFrame, level: int) -> int | None:
    """Half the box size, or the points when they are few enough; None when nothing is open."""
    row = pairs.agg(F.sum(F.col("l_m").cast("double") * F.col("r_m"))).first()
    if row[0] is None:
        return None
    return LAST_LEVEL if row[0] <= PAIR_BUDGET else level + 1


def _halve(grid: _Grid, pairs: DataFrame, points: DataFrame, side: str, above: int, level: int, *keep: str) -> DataFrame:
    """Pairs with the boxes of one side replaced by the smaller boxes inside them."""
    parents = pairs.select(F.col(f"{side}_key").alias("parent")).distinct()
    boxes = cut_lineage(grid.boxes(points, level, parents, above))
    inside = grid.side_of(boxes, side, "parent", "key", *keep)
    dropped = [f"{side}_{c}" for c in ("key", *keep, *grid.corners())]
    joined = pairs.withColumnRenamed(f"{side}_key", f"{side}_parent").drop(*dropped[1:])
    return joined.join(inside, f"{side}_parent").drop(f"{side}_parent")


def _core_points(grid: _Grid, pairs: DataFrame, points: DataFrame, least: int) -> DataFrame:
    """Points among ``pairs(x*, own, l_*, r_*, r_w)`` with enough neighbours.

    A point is settled once its sure neighbours suffice, or once sure and open ones
    together do not.
    """
    found, level = None, 0
    each = Window.partitionBy(*grid.x)
    while True:
        judged = grid.judge(pairs)
        gain = F.sum(F.when(F.col("sure"), F.col("r_w")).otherwise(0)).over(each)
        rest = F.sum(F.when(~F.col("sure"), F.col("r_w")).otherwise(0)).over(each)
        judged = judged.withColumns({"gain": gain, "rest": rest}).withColumn("own", F.col("own") + F.col("gain"))
        judged = cut_lineage(judged.drop("gain"))
        core = judged.filter(F.col("own") >= least).select(*grid.x).distinct()
        found = core if found is None else found.unionByName(core)
        pairs = judged.filter((F.col("own") < least) & (F.col("own") + F.col("rest") >= least) & ~F.col("sure"))
        pairs = pairs.drop("rest", "sure")
        above, level = level, _next_level(pairs, level)
        if level is None:
            return found
        pairs = _halve(grid, pairs, points, "r", above, level, "w")


def _merge_cells(grid: _Grid, pairs: DataFrame, core: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, component`` of core cells, from ``pairs(a, b, l_*, r_*)`` of near cells.

    Cells are merged as soon as boxes are surely within reach. Pairs already in one
    component are dropped before the rest is halved, which leaves the few pairs
    along the gaps between clusters.
    """
    named = nodes.withColumn("component", F.col("node"))
    level = 0
    while True:
        judged = cut_lineage(grid.judge(pairs))
        links = judged.filter("sure").select("a", "b")
        known = named.filter("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
        named = cut_lineage(connected_components(nodes, links.unionByName(known)))
        pairs = judged.filter("not sure").drop("sure")
        for end in ("a", "b"):
            pairs = pairs.join(named.select(F.col("node").alias(end), F.col("component").alias(f"{end}_in")), end)
        pairs = cut_lineage(pairs.filter("a_in <> b_in").drop("a_in", "b_in"))
        above, level = level, _next_level(pairs, level)
        if level is None:
            return named
        pairs = grid.judge(_halve(grid, pairs, core, "r", above, level)).drop("sure")
        pairs = _halve(grid, pairs, core, "l", above, level)


def _reached(grid: _Grid, pairs: DataFrame, ids: Sequence[str], core: DataFrame) -> DataFrame:
    """The ids of point and cell pairs with a core point of the cell within reach of the point.

    A pair is settled by the first box surely within reach.
    """
    found, level = None, 0
    each = Window.partitionBy(*ids)
    while True:
        judged = cut_lineage(grid.judge(pairs).withColumn("linked", F.max("sure").over(each)))
        done = judged.filter("linked").select(*ids).distinct()
        found = done if found is None else found.unionByName(done)
        pairs = judged.filter("not linked").drop("linked", "sure")
        above, level = level, _next_level(pairs, level)
        if level is None:
            return found
        pairs = _halve(grid, pairs, core, "r", above, level)


def dbscan(df: DataFrame, features: Sequence[str], eps: float = 0.5, min_points: int = 10) -> DataFrame:
    """Rows with ``cluster`` (0, 1, ..., noise -1) and ``is_core``.

    A point is core when at least ``min_points`` points, itself included, lie within
    ``eps``. A border point joins the smallest of the clusters it touches. Rows with
    a missing feature get NULL.
    """
    grid = _Grid(len(features), eps)
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in features])
    placed = df.withColumns({x: F.col(c).cast("double") for x, c in zip(grid.x, features, strict=True)})
    points = cut_lineage(placed.filter(known).groupBy(*grid.x).agg(F.count(F.lit(1)).alias("w")))

    cells = cut_lineage(grid.boxes(points, 0))
    thin = cells.filter(F.col("w") < min_points)
    keyed = points.withColumn("cell", grid.key(0))
    own = thin.select(F.col("key").alias("cell"), F.col("w").alias("own"))
    lone = cut_lineage(keyed.join(own, "cell"))

    around = grid.near(thin, cells)
    at = grid.point_corners("l")
    meetings = lone.drop("w").withColumnRenamed("cell", "l_key").join(
        around.drop(*at), "l_key"
    ).withColumns(at)
    core_lone = _core_points(grid, meetings.drop("l_key"), points, min_points)
    core_lone = cut_lineage(lone.join(core_lone.distinct(), grid.x, "left_semi"))

    heavy = cells.filter(F.col("w") >= min_points).select(F.col("key").alias("cell"))
    core = cut_lineage(
        keyed.join(heavy, "cell", "left_semi")
        .select(*grid.x, "w", "cell")
        .unionByName(core_lone.select(*grid.x, "w", "cell"))
    )
    core_cells = cut_lineage(grid.boxes(core, 0))
    touching = grid.near(core_cells, core_cells).filter("l_key < r_key").drop("r_w")
    touching = touching.withColumns({"a": F.col("l_key"), "b": F.col("r_key")})
    named = _merge_cells(grid, touching, core, core_cells.select(F.col("key").alias("node")))
    roots = number_rows(named.select("component").distinct(), "component", name="cluster", start=0)
    labels = cut_lineage(named.join(roots, "component").select(F.col("node").alias("cell"), "cluster"))

    edge_points = lone.join(core_lone.select(*grid.x), grid.x, "left_anti").drop("w", "own")
    beside = grid.near(cells.filter(F.col("w") < min_points), core_cells).drop("r_w", *at)
    beside = edge_points.withColumnRenamed("cell", "l_key").join(beside, "l_key").withColumns(at)
    beside = beside.withColumn("cell", F.col("r_key")).drop("l_key")
    reached = _reached(grid, beside, [*grid.x, "cell"], core)
    # Points of one cell are neighbours, so a core point in the own cell is in reach.
    border = (
        reached.unionByName(edge_points.select(*grid.x, "cell"))
        .join(labels, "cell")
        .groupBy(*grid.x)
        .agg(F.min("cluster").alias("cluster"))
        .withColumn("core", F.lit(False))
    )
    single = core_lone.join(labels, "cell").select(*grid.x, "cluster", F.lit(True).alias("core"))
    singles = cut_lineage(border.unionByName(single)).withColumnRenamed("cluster", "one")
    whole = cut_lineage(labels.join(heavy, "cell", "left_semi")).withColumnRenamed("cluster", "all")

    result = placed.withColumn("cell", F.when(known, grid.key(0)))
    result = result.join(whole, "cell", "left").join(singles, grid.x, "left")
    cluster = F.coalesce("all", "one", F.lit(NOISE)).cast("bigint")
    core_flag = F.coalesce(F.col("all").isNotNull() | F.col("core"), F.lit(False))
    return result.select(
        *df.columns, F.when(known, cluster).alias("cluster"), F.when(known, core_flag).alias("is_core")
    )
