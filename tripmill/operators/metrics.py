"""Scores of classifications, regressions and clusterings, from prediction columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.operators.joins import lookup_map


def accuracy(df: DataFrame, actual: str, predicted: str, weight: str | None = None) -> DataFrame:
    """Share of hits; a row counts ``weight`` times."""
    hit = F.coalesce((F.col(actual) == F.col(predicted)).cast("double"), F.lit(0.0))
    share = F.avg(hit) if weight is None else F.try_divide(F.sum(hit * F.col(weight)), F.sum(weight))
    return df.agg(share.alias("accuracy"))


def confusion_counts(df: DataFrame, actual: str, predicted: str, weight: str | None = None) -> DataFrame:
    keys = [F.col(actual).alias("actual"), F.col(predicted).alias("predicted")]
    return df.groupBy(*keys).agg((F.count(F.lit(1)) if weight is None else F.sum(weight)).alias("n"))


def _class_scores(df: DataFrame, actual: str, predicted: str, weight: str | None = None) -> DataFrame:
    """Precision, recall, F1 and support of each class, from the confusion counts."""
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(F.col("actual").alias("class"), hit.alias("hit"), F.col("n").alias("true"), F.lit(0).cast("bigint").alias("said")),
        F.struct(F.col("predicted").alias("class"), F.lit(0).cast("bigint").alias("hit"), F.lit(0).cast("bigint").alias("true"), F.col("n").alias("said")),
    )
    totals = (
        confusion_counts(df, actual, predicted, weight)
        .select(F.inline(sides))
        .filter(F.col("class").isNotNull())
        .groupBy("class")
        .agg(F.sum("hit").alias("hit"), F.sum("true").alias("true"), F.sum("said").alias("said"))
    )
    none = F.lit(0.0)
    scored = totals.select(
        "class",
        F.coalesce(F.try_divide(F.col("hit"), F.col("said")), none).alias("precision"),
        F.coalesce(F.try_divide(F.col("hit"), F.col("true")), none).alias("recall"),
        F.coalesce(F.try_divide(F.col("hit") * 2.0, F.col("said") + F.col("true")), none).alias("f1"),
        F.col("true").alias("support"),
    )
    return scored


def classification_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Scores per class with macro and weighted averages; no predictions scores zero."""
    scores = _class_scores(df, actual, predicted)
    measures = ["precision", "recall", "f1"]
    macro = scores.agg(*[F.avg(m).alias(m) for m in measures], F.sum("support").alias("support"))
    weight = F.sum("support")
    weighted = scores.agg(
        *[F.try_divide(F.sum(F.col(m) * F.col("support")), weight).alias(m) for m in measures],
        weight.alias("support"),
    )
    columns = ["class", *measures, "support"]
    return (
        scores.select(columns)
        .unionByName(macro.withColumn("class", F.lit("macro avg")).select(columns))
        .unionByName(weighted.withColumn("class", F.lit("weighted avg")).select(columns))
    )


def weighted_f1(df: DataFrame, actual: str, predicted: str, weight: str | None = None) -> DataFrame:
    scores = _class_scores(df, actual, predicted, weight)
    total = F.sum(F.col("f1") * F.col("support"))
    return scores.agg(F.try_divide(total, F.sum("support")).alias("weighted_f1"))


def confusion_matrix(df: DataFrame, actual: str, predicted: str, labels: Sequence[str]) -> DataFrame:
    table = df.groupBy(F.col(actual).alias("actual")).pivot(predicted, list(labels)).agg(F.count(F.lit(1)))
    return table.fillna(0, list(labels))


def _regression_parts(actual: Column, predicted: Column) -> dict[str, Column]:
    miss = predicted - actual
    squares = F.sum(miss * miss)
    spread = F.var_pop(actual) * F.count(actual)
    return {
        "mae": F.avg(F.abs(miss)),
        "mse": F.avg(miss * miss),
        "rmse": F.sqrt(F.avg(miss * miss)),
        "r2": F.lit(1.0) - F.try_divide(squares, spread),
    }


def regression_metrics(df: DataFrame, actual: str, predicted: str, *by: str) -> DataFrame:
    parts = _regression_parts(F.col(actual), F.col(predicted))
    parts["mape"] = F.avg(F.abs(F.try_divide(F.col(predicted) - F.col(actual), F.col(actual)))) * 100
    return df.groupBy(*by).agg(*[part.alias(name) for name, part in parts.items()])


def _within_parts(actual: Column, predicted: Column, tolerances: Sequence[float]) -> dict[str, Column]:
    near = F.abs(predicted - actual)
    return {f"within_{t:g}": F.avg((near <= t).cast("double")) * 100 for t in tolerances}


def within_tolerance(df: DataFrame, actual: str, predicted: str, tolerances: Sequence[float] = (1, 2, 5)) -> DataFrame:
    parts = _within_parts(F.col(actual), F.col(predicted), tolerances)
    return df.agg(*[part.alias(name) for name, part in parts.items()])


def compare_models(
    df: DataFrame, actual: str, predictions: Mapping[str, str], tolerances: Sequence[float] = (1, 2, 5)
) -> DataFrame:
    """One row of scores per model; all prediction columns are read in one pass."""
    cells = [F.struct(F.lit(m).alias("model"), F.col(c).cast("double").alias("p")) for m, c in predictions.items()]
    long = df.select(F.col(actual).cast("double").alias("y"), F.inline(F.array(*cells)))
    parts = {**_regression_parts(F.col("y"), F.col("p")), **_within_parts(F.col("y"), F.col("p"), tolerances)}
    parts.pop("mse")
    return long.groupBy("model").agg(*[part.alias(name) for name, part in parts.items()])


def mae_reduction(comparison: DataFrame, model: str, baseline: str) -> DataFrame:
    """Percent by which a model's mean absolute error is below the baseline's."""
    def mae(name: str) -> Column:
        return F.max(F.when(F.col("model") == name, F.col("mae")))

    return comparison.agg(
        mae(model).alias("model_mae"),
        mae(baseline).alias("baseline_mae"),
        (F.try_divide(mae(baseline) - mae(model), mae(baseline)) * 100).alias("reduction_percent"),
    )


def fold_summary(scores: DataFrame, group: str, measures: Sequence[str]) -> DataFrame:
    """Mean and population deviation of fold scores."""
    parts = [f for m in measures for f in (F.avg(m).alias(f"{m}_mean"), F.stddev_pop(m).alias(f"{m}_std"))]
    return scores.groupBy(group).agg(*parts)


def best_row(df: DataFrame, name: str, score: str, smallest: bool = False) -> DataFrame:
    pick = F.min_by if smallest else F.max_by
    return df.agg(pick(name, score).alias(name), (F.min if smallest else F.max)(score).alias(score))


def error_by_group(df: DataFrame, group: str, actual: str, predicted: str) -> DataFrame:
    return df.groupBy(group).agg(F.avg(F.abs(F.col(predicted) - F.col(actual))).alias("mean_abs_error"))


def _total(parts: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, parts)


def _distance(left: Sequence[Column], right: Sequence[Column]) -> Column:
    return F.sqrt(_total([(a - b) * (a - b) for a, b in zip(left, right, strict=True)]))


#: By cluster column and cluster: its rows, the sum of their squared norms and the sums of their features.
Sums = Mapping[str, Mapping[int, np.ndarray]]


def _numbered(labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different labels, the labels, and each one's place among the different ones."""
    low, high = int(labels.min()), int(labels.max())
    if high - low > 10_000:
        known, own = np.unique(labels, return_inverse=True)
        return known, labels, own
    own = labels.astype(np.int64) - low
    used = np.bincount(own) > 0
    return np.flatnonzero(used) + low, labels, (np.cumsum(used) - 1)[own]


def _added(df: DataFrame, features: Sequence[str], clusters: Sequence[str], values: Callable[[str, np.ndarray, np.ndarray], np.ndarray]) -> dict[str, dict[int, np.ndarray]]:
    """Values of rows, a row of the matrix for each, added up by cluster; one scan for all cluster columns."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            if not len(batch):
                continue
            x = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in features], axis=1)
            for number, name in enumerate(clusters):
                known, labels, own = _numbered(batch.column(name).to_numpy())
                of = values(name, x, labels)
                parts = np.stack([np.bincount(own, column, len(known)) for column in of.T], axis=1)
                for label, part in zip(known.tolist(), parts, strict=True):
                    sums[number, label] = sums.get((number, label), 0.0) + part
        rows = [(number, label, i, value) for (number, label), part in sums.items() for i, value in enumerate(part.tolist())]
        kinds = (pa.int32(), pa.int64(), pa.int32(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], ["of", "cluster", "i", "value"])

    partial = df.select(*features, *clusters).mapInArrow(summed, "of int, cluster bigint, i int, value double")
    found: dict[str, dict[int, dict[int, float]]] = {name: {} for name in clusters}
    for r in partial.groupBy("of", "cluster", "i").agg(F.sum("value").alias("value")).collect():
        found[clusters[r["of"]]].setdefault(r["cluster"], {})[r["i"]] = r["value"]
    return {name: {label: np.array([parts[i] for i in range(len(parts))]) for label, parts in sorted(some.items())} for name, some in found.items()}


def cluster_sums(df: DataFrame, features: Sequence[str], clusters: Sequence[str]) -> Sums:
    """What the measures of several clusterings need to know of their clusters. Few come to the driver, however many rows there are."""
    return _added(df, features, clusters, lambda _, x, labels: np.concatenate([np.ones((len(x), 1)), (x**2).sum(axis=1, keepdims=True), x], axis=1))


def _as_row(df: DataFrame, values: Mapping[str, float | None]) -> DataFrame:
    return df.sparkSession.createDataFrame([tuple(None if v is None else float(v) for v in values.values())], ", ".join(f"`{name}` double" for name in values))


def _davies_bouldin_of(df: DataFrame, features: Sequence[str], clusters: Sequence[str], sums: Sums) -> dict[str, float | None]:
    centres = {name: {label: one[2:] / one[0] for label, one in some.items()} for name, some in sums.items()}

    def off(name: str, x: np.ndarray, labels: np.ndarray) -> np.ndarray:
        known, _, own = _numbered(labels)
        of = np.array([centres[name][label] for label in known.tolist()])
        return np.sqrt(((x - of[own]) ** 2).sum(axis=1, keepdims=True))

    found: dict[str, float | None] = {}
    for name, some in _added(df, features, clusters, off).items():
        scatter = {label: float(total[0] / sums[name][label][0]) for label, total in some.items()}
        gap = lambda a, b, of=centres[name]: float(np.sqrt(((of[a] - of[b]) ** 2).sum()))
        ratios = [[(scatter[a] + scatter[b]) / gap(a, b) for b in scatter if a != b and gap(a, b)] for a in scatter]
        found[name] = sum(map(max, ratios)) / len(ratios) if ratios and all(ratios) else None
    return found


def _silhouettes_of(df: DataFrame, features: Sequence[str], clusters: Sequence[str], sums: Sums) -> dict[str, float | None]:
    known = {name: (np.array(list(some)), np.array(list(some.values()))) for name, some in sums.items() if some}

    def values(name: str, x: np.ndarray, labels: np.ndarray) -> np.ndarray:
        names, of = known[name]
        own, rows = np.searchsorted(names, labels), np.arange(len(x))
        n = of[:, 0]
        # Sums of squared distances to the rows of every cluster.
        spread = (x**2).sum(axis=1)[:, None] * n + of[:, 1] - 2 * (x @ of[:, 2:].T)
        with np.errstate(divide="ignore", invalid="ignore"):
            inside = np.maximum(spread[rows, own] / (n[own] - 1), 0.0)
            others = np.maximum(spread / n, 0.0)
            others[rows, own] = np.inf
            nearest = others.min(axis=1)
            value = (nearest - inside) / np.maximum(inside, nearest)
        return np.where((n[own] > 1) & np.isfinite(value), value, 0.0)[:, None]

    totals = _added(df, features, clusters, values)
    return {name: sum(float(t[0]) for t in some.values()) / sum(one[0] for one in sums[name].values()) if some else None for name, some in totals.items()}


def davies_bouldin(df: DataFrame, features: Sequence[str], cluster: str | Sequence[str] = "cluster", sums: Sums | None = None) -> DataFrame:
    """Mean over clusters of the worst ratio of scatter to centre distance.

    The k centres travel as one map in a scalar subquery: rows find their own centre
    by key, so neither the rows nor the clusters need a join. Of several cluster columns (whole numbers) each has its
    measure under its own name, all from one scan; ``sums`` are their ``cluster_sums``, if known.
    """
    if not isinstance(cluster, str):
        return _as_row(df, _davies_bouldin_of(df, features, cluster, sums or cluster_sums(df, features, cluster)))
    centre = F.struct(*[F.avg(c).alias(c) for c in features])
    centres = lookup_map(df.groupBy(cluster).agg(centre.alias("centre")), cluster, "centre")
    rows = df.select(cluster, *features).withColumn("centre", centres[F.col(cluster)])
    own = _distance([F.col(c) for c in features], [F.col(f"centre.{c}") for c in features])
    clusters = rows.groupBy(cluster).agg(F.avg(own).alias("scatter"), F.first("centre").alias("centre"))
    packed = clusters.agg(F.array_sort(F.collect_list(F.struct(cluster, "scatter", "centre"))).alias("all"))

    def ratio(a: Column, b: Column) -> Column:
        gap = _distance([a["centre"][c] for c in features], [b["centre"][c] for c in features])
        return F.when(a[cluster] != b[cluster], F.try_divide(a["scatter"] + b["scatter"], gap))

    worst = F.transform("all", lambda a: F.array_max(F.transform("all", lambda b: ratio(a, b))))
    total = F.aggregate(worst, F.lit(0.0), lambda total, one: total + one)
    return packed.select(F.try_divide(total, F.size("all")).alias("davies_bouldin"))


def silhouette(df: DataFrame, features: Sequence[str], cluster: str | Sequence[str] = "cluster", sums: Sums | None = None) -> DataFrame:
    """Mean silhouette under squared Euclidean distance, without comparing rows.

    The mean squared distance of a row to a cluster follows from the cluster's
    size, sum vector and sum of squared norms, so k small summaries are enough. Of several cluster columns (whole
    numbers) each has its measure under its own name, all from one scan; ``sums`` are their ``cluster_sums``, if known.
    """
    if not isinstance(cluster, str):
        return _as_row(df, _silhouettes_of(df, features, cluster, sums or cluster_sums(df, features, cluster)))
    norm = _total([F.col(c) * F.col(c) for c in features])
    sums = df.groupBy(cluster).agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.sum(norm).alias("sq"),
        *[F.sum(c).alias(f"s_{c}") for c in features],
    )
    packed = sums.agg(F.array_sort(F.collect_list(F.struct(cluster, "n", "sq", *[f"s_{c}" for c in features]))))
    rows = df.select(F.col(cluster).alias("own"), *features, norm.alias("norm"), packed.scalar().alias("all"))

    def spread(one: Column) -> Column:
        dot = _total([F.col(c) * one[f"s_{c}"] for c in features])
        return F.col("norm") * one["n"] + one["sq"] - 2 * dot

    mine = F.element_at(F.filter("all", lambda one: one[cluster] == F.col("own")), 1)
    others = F.filter("all", lambda one: one[cluster] != F.col("own"))
    inside = F.greatest(F.try_divide(spread(mine), mine["n"] - 1), F.lit(0.0))
    nearest = F.array_min(F.transform(others, lambda one: F.greatest(spread(one) / one["n"], F.lit(0.0))))
    scored = rows.select(inside.alias("a"), nearest.alias("b"), mine["n"].alias("n"))
    value = F.when(F.col("n") > 1, F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0)))
    return scored.agg(F.avg(value.otherwise(0.0)).alias("silhouette"))
