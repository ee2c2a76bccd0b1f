"""Forests for rows of which many have the same features.

Splits weigh sums, and leaves are means: of rows with the same features a tree needs only how often its bootstrap drew
them and the mean of their labels. One scan draws how often each tree takes each row and adds up draws and labels for each
combination of feature values, a cell. Spark's own forest then grows every tree on the cells, weighted by their draws. The
gain of a split is that of the rows, as the scatter inside a cell is on the same side of every split; the least rows of a
leaf become a least weight. Where cells are not few, a forest is grown on the rows.

Cells of groups of rows, as folds are, add up to the cells of any of them together: one scan serves all training sets that
are made of such groups. Rows of a cell have one prediction, so rows are scored by a join with their cells.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.session import cut_lineage

#: Beyond so many different combinations of features a forest is grown on the rows.
MOST_CELLS = 50_000
PARALLEL = 8
WEIGHT = "__weight"
#: How many rows a cell holds, and the sum of their labels.
ROWS, TOTAL = "__rows", "__total"
#: Draws of so many trees are added up in one scan: sums of more are beyond what Spark compiles.
SCANNED = 20
# Chances of a Poisson count of mean one: a bootstrap of many rows takes each so many times. Higher counts are beyond a double.
CHANCES = [math.exp(-1) / math.factorial(n) for n in range(19)]


def few_cells(rows: DataFrame, inputs: Sequence[str]) -> bool:
    found = rows.agg(F.approx_count_distinct(F.xxhash64(*inputs)).alias("n")).first()["n"] if inputs else 1
    return found <= MOST_CELLS


def _drawn(unit: Column) -> Column:
    """How often a bootstrap takes a row, from a number in [0, 1)."""
    result, below = None, 0.0
    for n, chance in enumerate(CHANCES[:-1]):
        below += chance
        test = unit < below
        result = F.when(test, float(n)) if result is None else result.when(test, float(n))
    return result.otherwise(float(len(CHANCES) - 1))


def cells(rows: DataFrame, inputs: Sequence[str], label: str, trees: int, seed: int, by: Sequence[str] = ()) -> DataFrame:
    """A row for each combination of inputs and of the groups ``by``: its rows and the sum of their labels, and for every tree how
    often it draws rows of it (w0, ...) and the sum of their labels (s0, ...)."""
    keys = [*inputs, *by]
    known = rows.select(*keys, F.col(label).cast("double").alias("y__"))
    table = _drawn_cells(known, keys, range(min(trees, SCANNED)), seed)
    for start in range(SCANNED, trees, SCANNED):
        more = _drawn_cells(known, keys, range(start, min(trees, start + SCANNED)), seed).drop(ROWS, TOTAL)
        names = [c for c in more.columns if c not in keys]
        other = cut_lineage(more.withColumnsRenamed({key: f"{key}__other" for key in keys}))
        same = [F.col(key).eqNullSafe(F.col(f"{key}__other")) for key in keys]
        table = cut_lineage(table.join(other, same).select(*table.columns, *names))
    return table


def _drawn_cells(rows: DataFrame, keys: Sequence[str], numbers: range, seed: int) -> DataFrame:
    # Seeds far apart, as Spark adds the number of the partition to each.
    units = rows.select(*keys, "y__", *[F.rand(seed + 1_000_003 * (n + 1)).alias(f"u{n}") for n in numbers])
    draws = units.select(*keys, "y__", *[_drawn(F.col(f"u{n}")).alias(f"w{n}") for n in numbers])
    sums = [f for n in numbers for f in (F.sum(f"w{n}").alias(f"w{n}"), F.sum(F.col(f"w{n}") * F.col("y__")).alias(f"s{n}"))]
    return draws.groupBy(*keys).agg(F.count(F.lit(1)).alias(ROWS), F.sum("y__").alias(TOTAL), *sums)


def together(table: DataFrame, inputs: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Cells of groups as the cells of all their rows."""
    return table.groupBy(*inputs).agg(*[F.sum(c).alias(c) for c in table.columns if c not in (*inputs, *by)])


def with_predictions(rows: DataFrame, predictions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows with the predictions of their cells; few cells are a table that every task holds."""
    known = predictions.withColumnsRenamed({key: f"{key}__cell" for key in keys})
    same = [F.col(key).eqNullSafe(F.col(f"{key}__cell")) for key in keys]
    return rows.join(F.broadcast(known), same).drop(*[f"{key}__cell" for key in keys])


def as_forest(trees: Sequence, estimator: RandomForestRegressor, features: int, prediction: str, spark: SparkSession) -> RandomForestRegressionModel:
    """Trees of Spark's forests as one forest."""
    kinds = spark._jvm.org.apache.spark.ml.regression
    some = spark.sparkContext._gateway.new_array(kinds.DecisionTreeRegressionModel, len(trees))
    for n, tree in enumerate(trees):
        some[n] = tree
    uid = f"{estimator.uid}_{uuid.uuid4().hex[:12]}"
    made = RandomForestRegressionModel(kinds.RandomForestRegressionModel(uid, some, features))
    made._resetUid(uid)
    made._set(numTrees=len(trees), featuresCol=estimator.getFeaturesCol(), labelCol=estimator.getLabelCol(), predictionCol=prediction)
    made._transfer_params_to_java()
    return made


def as_classifier(trees: Sequence, estimator: RandomForestClassifier, features: int, classes: int, spark: SparkSession) -> RandomForestClassificationModel:
    """Trees of Spark's classifying forests as one forest."""
    kinds = spark._jvm.org.apache.spark.ml.classification
    some = spark.sparkContext._gateway.new_array(kinds.DecisionTreeClassificationModel, len(trees))
    for n, tree in enumerate(trees):
        some[n] = tree
    uid = f"{estimator.uid}_{uuid.uuid4().hex[:12]}"
    made = RandomForestClassificationModel(kinds.RandomForestClassificationModel(uid, some, features, classes))
    made._resetUid(uid)
    made._set(
        numTrees=len(trees), featuresCol=estimator.getFeaturesCol(), labelCol=estimator.getLabelCol(), predictionCol=estimator.getPredictionCol(),
        probabilityCol=estimator.getProbabilityCol(), rawPredictionCol=estimator.getRawPredictionCol(),
    )
    made._transfer_params_to_java()
    return made


def grow_classifier(estimator: RandomForestClassifier, table: DataFrame) -> RandomForestClassificationModel:
    """The forest of ``estimator`` from cells with their vectors, labels and numbers of rows. All rows of a cell are alike, so
    a bootstrap draws as many of them as one Poisson number with their count as its mean."""
    count, least, spark = estimator.getNumTrees(), estimator.getMinInstancesPerNode(), table.sparkSession
    features, label = estimator.getFeaturesCol(), estimator.getLabelCol()
    rows = sorted(table.select(features, label, ROWS).collect(), key=lambda r: (r[label], r[features].toArray().tolist()))
    classes = int(max(r[label] for r in rows)) + 1
    draws = np.random.default_rng(estimator.getSeed()).poisson([r[ROWS] for r in rows], (count, len(rows))).astype(float)
    # The column of labels says how many categories there are; a tree that draws none of the last must know it too.
    shape = T.StructType([*table.select(features, label).schema.fields, T.StructField("draws", T.ArrayType(T.DoubleType()))])
    drawn = spark.createDataFrame([(r[features], r[label], draws[:, i].tolist()) for i, r in enumerate(rows)], shape).coalesce(1).cache()
    subset = estimator.getFeatureSubsetStrategy()
    if subset == "auto" and count > 1:
        subset = "sqrt"

    def one(n: int) -> RandomForestClassificationModel:
        some = drawn.withColumn(WEIGHT, F.col("draws")[n]).filter(F.col(WEIGHT) > 0).select(features, label, WEIGHT)
        share = min((least - 0.5) / draws[n].sum(), 0.4999) if least > 1 else 0.0
        alone = estimator.copy().setNumTrees(1).setBootstrap(False).setFeatureSubsetStrategy(subset).setWeightCol(WEIGHT)
        return alone.setMinInstancesPerNode(1).setMinWeightFractionPerNode(share).setSeed(estimator.getSeed() + n).fit(some)

    with ThreadPool(PARALLEL) as pool:
        grown = pool.map(one, range(count))
    drawn.unpersist()
    trees = [model._java_obj.trees()[0] for model in grown]
    return as_classifier(trees, estimator, grown[0].numFeatures, classes, spark)


def grow(estimator: RandomForestRegressor, table: DataFrame) -> RandomForestRegressionModel:
    """The forest of ``estimator`` from cells with their feature vectors; ``table`` holds draws for all its trees."""
    count, least = estimator.getNumTrees(), estimator.getMinInstancesPerNode()
    weights = table.agg(*[F.sum(f"w{n}").alias(f"w{n}") for n in range(count)]).first()
    subset = estimator.getFeatureSubsetStrategy()
    if subset == "auto" and count > 1:
        subset = "onethird"

    def one(n: int) -> RandomForestRegressionModel:
        drawn = table.filter(F.col(f"w{n}") > 0).select(
            estimator.getFeaturesCol(), (F.col(f"s{n}") / F.col(f"w{n}")).alias(estimator.getLabelCol()), F.col(f"w{n}").alias(WEIGHT)
        )
        # Half a row less, so that rounding does not forbid a leaf of just the least rows.
        share = min((least - 0.5) / weights[f"w{n}"], 0.4999) if least > 1 else 0.0
        alone = estimator.copy().setNumTrees(1).setBootstrap(False).setFeatureSubsetStrategy(subset).setWeightCol(WEIGHT)
        return alone.setMinInstancesPerNode(1).setMinWeightFractionPerNode(share).setSeed(estimator.getSeed() + n).fit(drawn)

    with ThreadPool(PARALLEL) as pool:
        grown = pool.map(one, range(count))
    trees = [model._java_obj.trees()[0] for model in grown]
    return as_forest(trees, estimator, grown[0].numFeatures, estimator.getPredictionCol(), table.sparkSession)
