"""Boosted trees grown from gradient histograms.

A round of softmax boosting grows a tree for each class on the residuals of the softmax, a round for numbers one tree on
plain residuals. All trees of a round grow together, a level at a time: tasks add up counts, residuals and curvatures
for each open node, feature and bin, Spark adds those up in one aggregate, and the driver, which sees only these sums,
picks the splits. Nothing depends on the number of rows but the scan.

First-order trees split by least squares and set their leaves by one Newton step, as gradient boosting does;
second-order trees split and set leaves by gradients and curvatures with a penalty. Fitted models are Spark's own
tree ensembles, so that they score in the JVM and are saved like any other stage.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.session import checkpoint_folder, cut_lineage

#: Scores of rows are written again after so many rounds; between, tasks add the trees grown since.
CUT_ROUNDS = 10
ACCURACY = 10_000
# What a second-order split must gain, and the least curvature of a row.
LEAST_GAIN, LEAST_CURVATURE = 1e-6, 1e-16


@dataclass
class Cells:
    """Rows held at once: labels, bins, scores and how many rows each stands for."""

    y: np.ndarray
    bins: np.ndarray
    scores: np.ndarray
    weights: np.ndarray


@dataclass
class Tree:
    """Nodes in arrays; a leaf has feature -1. Rows with a bin up to ``cut`` go left. ``sums``: rows, residuals, curvatures."""

    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    sums: list[tuple[float, float, float]] = field(default_factory=list)

    def add(self, value: float, sums) -> int:
        for column, one in zip((self.feature, self.cut, self.left, self.right, self.gain, self.value, self.sums), (-1, -1, -1, -1, 0.0, value, tuple(sums)), strict=True):
            column.append(one)
        self.sums[-1] = tuple(map(float, sums))
        return len(self.feature) - 1

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The node where each row ends."""
        node, rows = np.zeros(len(bins), dtype=np.int64), np.arange(len(bins))
        feature, cut, left, right = (np.array(column, dtype=np.int64) for column in (self.feature, self.cut, self.left, self.right))
        while len(node) and (open_ := feature[node] >= 0).any():
            goes = bins[rows, np.maximum(feature[node], 0)] <= cut[node]
            node = np.where(open_, np.where(goes, left[node], right[node]), node)
        return node

    def scores(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.leaves(bins)]


def softmax(scores: np.ndarray) -> np.ndarray:
    powers = np.exp(scores - scores.max(axis=1, keepdims=True))
    return powers / powers.sum(axis=1, keepdims=True)


def _rows_of(column: pa.Array, kind) -> np.ndarray:
    """Lists of equal length as a matrix."""
    flat = np.asarray(column.flatten(), dtype=kind)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


class BoostedTrees(Estimator):
    """Boosting for classes (``loss="softmax"``) or numbers (``loss="squared"``), of first or second order.

    ``penalty`` is added to a leaf's curvature and ``least_weight`` is the curvature that a leaf must have, both for
    second order. Cut points are the midpoints of neighbouring values of a column; of a column with more than ``bins``
    values, of its quantiles. Ties go to the first column and the lowest cut. Rows without a label are left out; no
    rows at all are an error. Features must be numbers, as ``TripFeatures`` gives them. With ``weight``, a column of
    numbers of rows, the rows given are few cells, which the driver holds: of residuals and curvatures only sums count, so
    the trees are those of the rows (of numbers, a cell has the mean).
    """

    def __init__(
        self, features: str, label: str, prediction: str, loss: str = "softmax", order: int = 1, rounds: int = 100, depth: int = 3,
        rate: float = 0.1, bins: int = 64, penalty: float = 1.0, least_weight: float = 1.0, weight: str | None = None,
    ):
        super().__init__()
        if loss not in ("softmax", "squared") or order not in (1, 2) or not 2 <= bins <= 1_024:
            raise ValueError(f"loss {loss}, order {order}, bins {bins}")
        self.features, self.label, self.prediction = features, label, prediction
        self.loss, self.order, self.rounds, self.depth, self.rate = loss, order, rounds, depth, rate
        self.bins, self.penalty, self.least_weight, self.weight = bins, penalty, least_weight, weight

    def on_cells(self, weight: str) -> BoostedTrees:
        """The same on rows that stand for as many as ``weight`` says."""
        return BoostedTrees(
            self.features, self.label, self.prediction, self.loss, self.order, self.rounds, self.depth, self.rate, self.bins, self.penalty, self.least_weight, weight
        )

    # What a row, a leaf and a split are worth.

    def slopes(self, labels: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Residuals and curvatures of rows, a column for each tree of a round."""
        if self.loss == "squared":
            return labels[:, None] - scores, np.ones_like(scores)
        chance = softmax(scores)
        residual = (labels[:, None] == np.arange(scores.shape[1])) - chance
        if self.order == 1:
            return residual, np.abs(residual) * (1 - np.abs(residual))
        return residual, np.maximum(2 * chance * (1 - chance), LEAST_CURVATURE)

    def leaf(self, sums: np.ndarray, trees: int) -> float:
        rows, residual, curvature = map(float, sums)
        if self.order == 2:
            return self.rate * residual / (curvature + self.penalty)
        if abs(curvature) < 1e-150:
            return 0.0
        return self.rate * residual / curvature * ((trees - 1) / trees if self.loss == "softmax" else 1.0)

    def gains(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """What splits gain; sums are in the last axis. Nothing where a side is too small."""
        with np.errstate(divide="ignore", invalid="ignore"):
            if self.order == 1:
                rows = [left[..., 0], right[..., 0]]
                between = left[..., 1] / rows[0] - right[..., 1] / rows[1]
                gain = rows[0] * rows[1] / (rows[0] + rows[1]) * between**2
                good = (rows[0] > 0) & (rows[1] > 0)
            else:
                worth = lambda s: s[..., 1] ** 2 / (s[..., 2] + self.penalty)
                gain = (worth(left) + worth(right) - worth(left + right)) / 2
                good = (left[..., 2] >= self.least_weight) & (right[..., 2] >= self.least_weight) & (left[..., 0] > 0) & (right[..., 0] > 0)
        return np.where(good, gain, 0.0)

    def best_split(self, sums: np.ndarray, cuts: list[np.ndarray]) -> tuple[int, int, float, np.ndarray, np.ndarray] | None:
        """Column, bin, gain and both sides' sums of a node's best split; ``sums`` by column, bin and kind of sum."""
        left = np.cumsum(sums, axis=1)
        right = left[:, -1:, :] - left
        gain = self.gains(left, right)
        for column, points in enumerate(cuts):
            gain[column, len(points) :] = 0.0
        most = gain.max(initial=0.0)
        if most <= (LEAST_GAIN if self.order == 2 else 1e-12):
            return None
        # Sums of tasks arrive in any order; what differs only by that is a tie.
        column, at = np.unravel_index(int(np.argmax(gain >= most * (1 - 1e-9))), gain.shape)
        return int(column), int(at), float(gain[column, at]), left[column, at], right[column, at]

    # Fitting.

    def cut_points(self, rows: DataFrame, width: int) -> list[np.ndarray]:
        shares = [i / self.bins for i in range(self.bins + 1)]
        found = rows.agg(*[F.percentile_approx(F.col("x")[i], shares, ACCURACY).alias(f"c{i}") for i in range(width)]).first()
        values = [np.unique(found[i]) for i in range(width)]
        return [(one[1:] + one[:-1]) / 2 for one in values]

    def _binned(self, rows: DataFrame, cuts: list[np.ndarray], start: list[float]) -> DataFrame:
        def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _rows_of(batch.column("x"), np.float64)
                bins = np.stack([np.searchsorted(points, x[:, i], "left") for i, points in enumerate(cuts)], axis=1).astype(np.int16)
                scores = np.tile(np.array(start), (len(x), 1))
                lists = [pa.array(list(matrix)) if len(x) else pa.array([], kind) for matrix, kind in ((bins, pa.list_(pa.int16())), (scores, pa.list_(pa.float64())))]
                yield pa.RecordBatch.from_arrays([batch.column("y"), *lists], ["y", "bins", "scores"])

        return rows.mapInArrow(binned, "y double, bins array<smallint>, scores array<double>")

    def _scored(self, rows: DataFrame, rounds: list[list[Tree]]) -> DataFrame:
        def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                scores = _now(batch, rounds)[1]
                yield pa.RecordBatch.from_arrays([batch.column("y"), batch.column("bins"), pa.array(list(scores), pa.list_(pa.float64()))], ["y", "bins", "scores"])

        return rows.mapInArrow(scored, rows.schema)

    def _sums(self, rows: DataFrame | Cells, rounds: list[list[Tree]], growing: list[Tree], open_: list[list[int]], width: int) -> np.ndarray:
        """Sums by tree, open node, column, bin and kind; one aggregate over the rows."""
        most, bins = max(map(len, open_)), self.bins + 1
        shape = (len(growing), most, width, bins)
        places = []
        for tree, nodes in zip(growing, open_, strict=True):
            place = np.full(len(tree.feature), -1, dtype=np.int64)
            place[nodes] = np.arange(len(nodes))
            places.append(place)

        def add(total: np.ndarray, binned: np.ndarray, scores: np.ndarray, y: np.ndarray, times: np.ndarray | None = None) -> None:
            residual, curvature = self.slopes(y, scores)
            if times is not None:
                residual, curvature = residual * times[:, None], curvature * times[:, None]
            for k, tree in enumerate(growing):
                place = places[k][tree.leaves(binned)]
                here = place >= 0
                slot = (((k * most + place[here])[:, None] * width + np.arange(width)) * bins + binned[here]).ravel()
                low, high = k * most * width * bins, (k + 1) * most * width * bins
                weights = [None if times is None else times[here], residual[here, k], curvature[here, k]]
                for kind, weight in enumerate(weights):
                    spread = None if weight is None else np.repeat(weight, width)
                    total[kind, low:high] += np.bincount(slot - low, spread, minlength=high - low)

        if isinstance(rows, Cells):
            whole = np.zeros((3, int(np.prod(shape))))
            add(whole, rows.bins, rows.scores, rows.y, rows.weights)
            return whole.T.reshape(*shape, 3)

        def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((3, int(np.prod(shape))))
            for batch in batches:
                add(total, *_now(batch, rounds), batch.column("y").to_numpy())
            used = np.flatnonzero(total[0])
            for start in range(0, len(used), 10_000):
                part = used[start : start + 10_000]
                yield pa.RecordBatch.from_arrays([pa.array(part), *[pa.array(total[kind, part]) for kind in range(3)]], ["slot", "n", "g", "h"])

        partial = rows.mapInArrow(summed, "slot bigint, n double, g double, h double")
        table = partial.groupBy("slot").agg(F.sum("n").alias("n"), F.sum("g").alias("g"), F.sum("h").alias("h")).toArrow()
        sums = np.zeros((int(np.prod(shape)), 3))
        sums[table.column("slot").to_numpy()] = np.stack([table.column(c).to_numpy() for c in ("n", "g", "h")], axis=1)
        return sums.reshape(*shape, 3)

    def _round(self, rows: DataFrame | Cells, rounds: list[list[Tree]], trees: int, cuts: list[np.ndarray]) -> list[Tree]:
        growing = [Tree() for _ in range(trees)]
        for tree in growing:
            tree.add(0.0, (0.0, 0.0, 0.0))
        open_ = [[0] for _ in growing]
        for level in range(self.depth):
            if not any(open_):
                break
            sums = self._sums(rows, rounds, growing, open_, len(cuts))
            for k, tree in enumerate(growing):
                if not level:
                    whole = sums[k, 0, 0].sum(axis=0)
                    tree.sums[0], tree.value[0] = tuple(map(float, whole)), self.leaf(whole, trees)
                new = []
                for place, node in enumerate(open_[k]):
                    found = self.best_split(sums[k, place], cuts)
                    if found is None:
                        continue
                    tree.feature[node], tree.cut[node], tree.gain[node], *sides = found
                    tree.left[node], tree.right[node] = (tree.add(self.leaf(side, trees), side) for side in sides)
                    new += [tree.left[node], tree.right[node]]
                open_[k] = new
        return growing

    def boost(self, df: DataFrame) -> tuple[list[float], list[list[Tree]], list[np.ndarray]]:
        """Start scores, the trees of every round and the cut points of every column."""
        if self.weight is not None:
            return self._boost_cells(df)
        rows = df.where(F.col(self.label).isNotNull()).select(F.col(self.label).cast("double").alias("y"), vector_to_array(F.col(self.features)).alias("x"))
        head = rows.first()
        if head is None:
            raise ValueError("no rows to fit on")
        width = len(head["x"])
        if self.loss == "softmax":
            counts = {int(r["y"]): r["count"] for r in rows.groupBy("y").count().collect()}
            classes, n = max(counts) + 1, sum(counts.values())
            start = [float(np.log(max(counts.get(k, 0) / n, 1e-15))) if self.order == 1 else 0.0 for k in range(classes)]
        else:
            start = [rows.agg(F.avg("y")).first()[0]]
        cuts = self.cut_points(rows, width)
        state = cut_lineage(self._binned(rows, cuts, start))
        grown: list[list[Tree]] = []
        for number in range(self.rounds):
            since = number % CUT_ROUNDS
            if number and not since:
                state = cut_lineage(self._scored(state, grown[-CUT_ROUNDS:]))
            grown.append(self._round(state, grown[number - since :], len(start), cuts))
        return start, grown, cuts

    def _boost_cells(self, df: DataFrame) -> tuple[list[float], list[list[Tree]], list[np.ndarray]]:
        known = df.where(F.col(self.label).isNotNull())
        table = known.select(F.col(self.label).cast("double").alias("y"), vector_to_array(F.col(self.features)).alias("x"), F.col(self.weight).cast("double").alias("n")).toArrow()
        if not len(table):
            raise ValueError("no rows to fit on")
        y, x, n = table.column("y").to_numpy(), _rows_of(table.column("x").combine_chunks(), np.float64), table.column("n").to_numpy()
        order = np.lexsort((y, *x.T))
        y, x, n = y[order], x[order], n[order]
        if self.loss == "softmax":
            share = np.bincount(y.astype(np.int64), n) / n.sum()
            start = [float(np.log(max(one, 1e-15))) if self.order == 1 else 0.0 for one in share]
        else:
            start = [float((y * n).sum() / n.sum())]
        cuts = [self._cuts_of(column, n) for column in x.T]
        bins = np.stack([np.searchsorted(points, column, "left") for points, column in zip(cuts, x.T, strict=True)], axis=1)
        cells, grown = Cells(y, bins, np.tile(np.array(start), (len(y), 1)), n), []
        for _ in range(self.rounds):
            grown.append(self._round(cells, [], len(start), cuts))
            for k, tree in enumerate(grown[-1]):
                cells.scores[:, k] += tree.scores(bins)
        return start, grown, cuts

    def _cuts_of(self, column: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Cut points of weighted values: between all of few ones, else between their quantiles."""
        values, place = np.unique(column, return_inverse=True)
        if len(values) > self.bins:
            upto = np.cumsum(np.bincount(place, weights))
            ranks = np.ceil(np.arange(self.bins + 1) / self.bins * upto[-1])
            values = np.unique(values[np.minimum(np.searchsorted(upto, ranks, "left"), len(values) - 1)])
        return (values[1:] + values[:-1]) / 2

    def _fit(self, df: DataFrame):
        start, grown, cuts = self.boost(df)
        spark, names = df.sparkSession, [f"{self.prediction}_score{k}__" for k in range(len(start))]
        ensembles = [
            ensemble(spark, [_constant(one), *[trees[k] for trees in grown]], cuts, self.features, name if self.loss == "softmax" else self.prediction)
            for k, (one, name) in enumerate(zip(start, names, strict=True))
        ]
        if self.loss == "squared":
            return ensembles[0]
        scores = f"array({', '.join(names)})"
        choice = f"SELECT *, CAST(array_position({scores}, array_max({scores})) - 1 AS DOUBLE) AS {self.prediction} FROM __THIS__"
        return PipelineModel([*ensembles, SQLTransformer(statement=choice)])


def _now(batch: pa.RecordBatch, rounds: list[list[Tree]]) -> tuple[np.ndarray, np.ndarray]:
    """Bins and scores of rows after rounds that their written scores do not have yet."""
    bins, scores = _rows_of(batch.column("bins"), np.int64), _rows_of(batch.column("scores"), np.float64).copy()
    for trees in rounds:
        for k, tree in enumerate(trees):
            scores[:, k] += tree.scores(bins)
    return bins, scores


def _constant(value: float) -> Tree:
    tree = Tree()
    tree.add(value, (0.0, 0.0, 0.0))
    return tree


def ensemble(spark: SparkSession, trees: list[Tree], cuts: list[np.ndarray], features: str, prediction: str) -> GBTRegressionModel:
    """The trees as Spark's own ensemble, by way of the format in which Spark saves one."""
    rows = []
    for number, tree in enumerate(trees):
        for node, column in enumerate(tree.feature):
            n, residual, _ = tree.sums[node]
            split = (column, [float(cuts[column][tree.cut[node]])], -1) if column >= 0 else (-1, [], -1)
            stats = [n, residual, residual * residual / n if n else 0.0]
            gain = tree.gain[node] / n if column >= 0 else -1.0
            rows.append((number, (node, tree.value[node], 0.0, stats, int(n), gain, tree.left[node], tree.right[node], split)))
    path = f"{checkpoint_folder(spark)}/trees-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)

    def described(kind: str, **more) -> str:
        name = f"org.apache.spark.ml.regression.{kind}"
        params = {"featuresCol": features, "predictionCol": prediction, "impurity": "variance"}
        return json.dumps({"class": name, "timestamp": 0, "sparkVersion": spark.version, "uid": f"boosted_{uuid.uuid4().hex[:12]}", "paramMap": params, "defaultParamMap": {}, **more})

    node_data = (
        "struct<id int, prediction double, impurity double, impurityStats array<double>, rawCount bigint, gain double, leftChild int, rightChild int, "
        "split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>>"
    )
    spark.createDataFrame(rows, f"treeID int, nodeData {node_data}").coalesce(1).write.parquet(f"{path}/data")
    one = described("DecisionTreeRegressionModel", numFeatures=len(cuts))
    spark.createDataFrame([(i, one, 1.0) for i in range(len(trees))], "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    whole = described("GBTRegressionModel", numFeatures=len(cuts), numTrees=len(trees))
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    return GBTRegressionModel.load(path)
