from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tripmill.models import boosting, classify, regress
from tripmill.models.boosting import BoostedTrees
from tripmill.sources import store


def table(n=90, seed=4):
    """Columns with ties, one of two values, one that tells nothing; labels 0 to 2 and a number."""
    draw = random.Random(seed)
    rows = []
    for _ in range(n):
        x = [draw.randrange(12) / 2, float(draw.randrange(2)), round(draw.uniform(-3, 3), 1)]
        label = float((x[0] > 3) + (x[1] > 0 and x[2] > 0)) if draw.random() < 0.9 else float(draw.randrange(3))
        rows.append((x, label, 2 * x[0] - x[2] ** 2 + draw.gauss(0, 0.3)))
    return rows


@pytest.fixture(scope="module")
def small(spark):
    rows = spark.createDataFrame(table(), "x array<double>, label double, fare double")
    return rows.select(array_to_vector("x").alias("f"), "x", "label", "fare").repartition(5).cache()


def one_tree(x, residual, curvature, depth, worth, leaf):
    """A tree as nested tuples, by trying every cut of every column on the rows themselves."""
    value = leaf(len(x), sum(residual), sum(curvature))
    best = None
    if depth:
        for column in range(len(x[0])):
            values = sorted({row[column] for row in x})
            for low, high in zip(values, values[1:]):
                sides = [[i for i, row in enumerate(x) if (row[column] <= low) == left] for left in (True, False)]
                gain = worth(*[[(1, residual[i], curvature[i]) for i in side] for side in sides])
                if gain is not None and (best is None or gain > best[0] * (1 + 1e-9)):
                    best = gain, column, (low + high) / 2, sides
    if best is None or best[0] <= 1e-6:
        return value
    _, column, cut, sides = best
    grown = [one_tree([x[i] for i in side], [residual[i] for i in side], [curvature[i] for i in side], depth - 1, worth, leaf) for side in sides]
    return column, cut, *grown


def walk(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def total(side, kind):
    return sum(one[kind] for one in side)


def least_squares(left, right):
    means = [total(side, 1) / len(side) for side in (left, right)]
    return len(left) * len(right) / (len(left) + len(right)) * (means[0] - means[1]) ** 2


def second_order(left, right, penalty=1.0, least=1.0):
    if min(total(left, 2), total(right, 2)) < least:
        return None
    part = lambda side: total(side, 1) ** 2 / (total(side, 2) + penalty)
    return (part(left) + part(right) - part(left + right)) / 2


def brute(rows, order, loss, rounds, depth, rate):
    """Scores of every row after a plain boosting loop over lists."""
    x, labels = [row[0] for row in rows], [row[1 if loss == "softmax" else 2] for row in rows]
    k = 3 if loss == "softmax" else 1
    if loss == "softmax":
        start = [math.log(labels.count(float(c)) / len(labels)) if order == 1 else 0.0 for c in range(k)]
    else:
        start = [sum(labels) / len(labels)]
    scores = [list(start) for _ in rows]
    for _ in range(rounds):
        trees = []
        for c in range(k):
            if loss == "softmax":
                chance = [math.exp(s[c]) / sum(map(math.exp, s)) for s in scores]
                residual = [(y == c) - p for y, p in zip(labels, chance, strict=True)]
                curvature = [abs(r) * (1 - abs(r)) for r in residual] if order == 1 else [2 * p * (1 - p) for p in chance]
            else:
                residual, curvature = [y - s[0] for y, s in zip(labels, scores, strict=True)], [1.0] * len(x)
            if order == 1:
                leaf = lambda n, g, h: rate * g / h * ((k - 1) / k if loss == "softmax" else 1)
                trees.append(one_tree(x, residual, curvature, depth, least_squares, leaf))
            else:
                trees.append(one_tree(x, residual, curvature, depth, second_order, lambda n, g, h: rate * g / (h + 1)))
        for row, s in zip(x, scores, strict=True):
            for c, tree in enumerate(trees):
                s[c] += walk(tree, row)
    return scores


@pytest.mark.parametrize("order", [1, 2])
@pytest.mark.parametrize("loss", ["softmax", "squared"])
def test_like_a_plain_boosting_loop(small, order, loss):
    rows = [(list(r.x), r.label, r.fare) for r in small.collect()]
    wanted = brute(rows, order, loss, 12, 3, 0.3)
    label = "label" if loss == "softmax" else "fare"
    model = BoostedTrees("f", label, "p", loss, order, rounds=12, depth=3, rate=0.3, bins=200).fit(small)
    scored = model.transform(small)
    names = [f"p_score{k}__" for k in range(3)] if loss == "softmax" else ["p"]
    found = [list(r) for r in scored.select(*names).collect()]
    np.testing.assert_allclose(found, wanted, rtol=1e-8, atol=1e-8)
    if loss == "softmax":
        assert [r.p for r in scored.collect()] == [max(range(3), key=s.__getitem__) for s in found]


def test_histograms_are_sums_over_rows(small):
    made = BoostedTrees("f", "label", "p", order=2, rounds=2, depth=2, bins=200)
    start, grown, cuts = made.boost(small)
    state = [(r.x, r.label) for r in small.collect()]
    bins = np.stack([np.searchsorted(points, [x[i] for x, _ in state], "left") for i, points in enumerate(cuts)], axis=1)
    scores = np.array([[*start]] * len(state)) + np.stack([tree.scores(bins) for tree in grown[0]], axis=1)
    residual, curvature = made.slopes(np.array([y for _, y in state]), scores)
    for k, tree in enumerate(grown[1]):
        leaf = tree.leaves(bins)
        children = {n: [n] for n in range(len(tree.feature))}
        for node in reversed(range(len(tree.feature))):
            if tree.feature[node] >= 0:
                children[node] += children[tree.left[node]] + children[tree.right[node]]
        for node, sums in enumerate(tree.sums):
            here = np.isin(leaf, children[node])
            np.testing.assert_allclose(sums, [here.sum(), residual[here, k].sum(), curvature[here, k].sum()], atol=1e-9)


def test_cut_points_take_rare_values(spark):
    rows = spark.createDataFrame([([float(i == 7)],) for i in range(5000)], "x array<double>")
    assert [list(one) for one in BoostedTrees("f", "y", "p", bins=8).cut_points(rows, 1)] == [[0.5]]


def test_guards(small, spark):
    with pytest.raises(ValueError):
        BoostedTrees("f", "label", "p", order=3)
    with pytest.raises(ValueError):
        BoostedTrees("f", "label", "p").fit(small.limit(0))
    one = small.withColumn("label", F.lit(0.0))
    assert {r.p for r in BoostedTrees("f", "label", "p", rounds=2).fit(one).transform(one).collect()} == {0.0}
    gaps = small.withColumn("fare", F.when(F.col("label") > 0, F.col("fare")))
    model = BoostedTrees("f", "fare", "p", "squared", 2, rounds=2).fit(gaps)
    assert model.transform(gaps).where("p IS NULL").count() == 0


def test_arms_save_load_and_score_without_python(spark, small, tmp_path):
    rows = small.select(F.element_at("x", 1).alias("a"), F.element_at("x", 3).alias("b"), F.concat(F.lit("c"), F.col("label")).alias("fare_category"), F.col("fare").alias("fare_amount"))
    arms = classify.default_arms(4)
    assert list(arms) == ["random_forest", "gradient_boosting", "second_order_boosting"]
    for name in list(arms)[1:]:
        model = classify.fit_classifier(rows, [], ["a", "b"], arms[name])
        store.save_model(model, str(tmp_path / name))
        loaded = store.load_model(spark, str(tmp_path / name))
        before, after = (classify.classify(m, rows).collect() for m in (model, loaded))
        assert sorted(before) == sorted(after)
        assert sum(r.fare_category == r.predicted_fare_category for r in before) > 60
        assert "Python" not in classify.classify(loaded, rows)._jdf.queryExecution().executedPlan().toString()
    arm = regress.default_arms(30)["second_order_boosting"]
    model = regress.fit_regressor(rows, [], ["a", "b"], arm)
    assert regress.score(model, rows).first().r2 > 0.95
    table = {r.feature: r.importance for r in regress.feature_importances(model, spark=spark).collect()}
    assert sum(table.values()) == pytest.approx(1) and table["a"] > 0.3


@pytest.mark.parametrize("order", [1, 2])
@pytest.mark.parametrize("loss", ["softmax", "squared"])
def test_cells_boost_as_their_rows_do(spark, order, loss):
    draw = random.Random(6)
    rows = spark.createDataFrame([([float(draw.randrange(4)), float(draw.randrange(3))], float(draw.randrange(3)), draw.gauss(0, 3)) for _ in range(400)], "x array<double>, label double, noise double")
    rows = rows.select(array_to_vector("x").alias("f"), "x", "label", (F.col("noise") + F.element_at("x", 1) * 2).alias("fare"))
    label = "label" if loss == "softmax" else "fare"
    if loss == "softmax":
        cells = rows.groupBy("x", "label").agg(F.count("*").alias("n"))
    else:
        cells = rows.groupBy("x").agg(F.count("*").alias("n"), F.avg("fare").alias("fare"))
    made = BoostedTrees("f", label, "p", loss, order, rounds=8, depth=3, rate=0.3)
    one = made.fit(rows)
    two = made.on_cells("n").fit(cells.withColumn("f", array_to_vector("x")))
    names = [f"p_score{k}__" for k in range(3)] if loss == "softmax" else ["p"]
    found = [np.array([list(r) for r in model.transform(rows).orderBy("x", "label", "fare").select(*names).collect()]) for model in (one, two)]
    np.testing.assert_allclose(*found, atol=1e-9)


def test_weighted_cuts_are_quantiles_of_rows():
    made = BoostedTrees("f", "y", "p", bins=8)
    values = np.array([float(i * i) for i in range(30)])
    weights = np.array([1 + i % 5 for i in range(30)])
    taken = np.unique(np.quantile(np.repeat(values, weights), np.arange(9) / 8, method="inverted_cdf"))
    np.testing.assert_allclose(made._cuts_of(values, weights), (taken[1:] + taken[:-1]) / 2)
    np.testing.assert_allclose(made._cuts_of(values[:5], weights[:5]), [0.5, 2.5, 6.5, 12.5])
