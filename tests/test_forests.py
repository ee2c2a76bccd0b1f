"""Forests grown on cells of equal features, weighted by the rows that each tree draws."""

from __future__ import annotations

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from checks import learning
from tripmill.models import classify, forests, prep, regress, selection
from tripmill.operators import metrics
from tripmill.operators.sampling import split

KINDS = ["id % 20 AS n", "IF(id % 3 = 0, 'a', 'b') AS kind", "CAST(id AS STRING) AS key"]
FARE = "CAST(3 * (id % 20) + 10 * (id % 3) + pmod(xxhash64(id), 1000) / 100.0 AS DOUBLE) AS fare_amount"


@pytest.fixture(scope="module")
def fares(spark):
    return spark.range(6_000).selectExpr(*KINDS, FARE).cache()


def test_cells_split_as_their_rows_do(spark, fares):
    features = prep.TripFeatures(["kind"], ["n"], regress.FEATURES).fit(fares)
    for least in (1, 350):
        estimator = regress.forest_regressor(1, 5, least)
        rows = estimator.copy().setBootstrap(False).fit(features.transform(fares))
        cells = fares.groupBy("kind", "n").agg(F.count("*").cast("double").alias("w0"), F.sum("fare_amount").alias("s0"))
        grown = forests.grow(estimator, features.transform(cells))
        both = grown.transform(features.transform(cells)).withColumnRenamed(regress.PREDICTED, "grown")
        assert rows.transform(both).where(f"abs(grown - {regress.PREDICTED}) > 1e-6").count() == 0
        assert grown.trees[0].numNodes == rows.trees[0].numNodes
        assert grown.featureImportances.toArray() == pytest.approx(rows.featureImportances.toArray())


def test_draws_are_a_bootstrap(fares):
    sums = forests.cells(fares, ["kind", "n"], "fare_amount", 3, 42).agg(*[F.sum(f"w{n}") for n in range(3)]).first()
    assert all(abs(total - 6_000) < 400 for total in sums) and len(set(sums)) == 3


@pytest.fixture
def fitted(monkeypatch):
    """Rows of every fit of Spark's forest."""
    counts, fit = [], RandomForestRegressor._fit
    monkeypatch.setattr(RandomForestRegressor, "_fit", lambda self, df: (counts.append(df.count()), fit(self, df))[1])
    return counts


def test_forest_grows_on_cells(spark, fares, fitted, tmp_path):
    model = regress.fit_regressor(fares, ["kind"], ["n"], regress.forest_regressor(4, 6, 2).setFeatureSubsetStrategy("all"))
    assert fitted and max(fitted) <= 40
    assert model.stages[1].getNumTrees == 4
    # What is left is noise and the two parts of kind b, five off each on average; the fares' own deviation is 19.
    assert regress.score(model, fares).first().mae < 6
    model.save(str(tmp_path / "forest"))
    loaded = type(model).load(str(tmp_path / "forest"))
    again = [regress.predict(m, fares).select("key", regress.PREDICTED) for m in (model, loaded)]
    assert again[0].exceptAll(again[1]).count() == 0


def test_many_cells_are_rows(fares, fitted, monkeypatch):
    monkeypatch.setattr(forests, "MOST_CELLS", 10)
    regress.fit_regressor(fares, ["kind"], ["n"], regress.forest_regressor(2, 3))
    assert fitted == [6_000]


def test_search_grows_on_cells(fares, fitted):
    _, table = selection.grid_search(fares, "key", ["kind"], ["n"], {"trees": [2, 3], "depth": [4], "min_rows": [2]}, folds=2)
    assert max(fitted) <= 40 and table.count() == 2


def test_rows_of_one_file_are_dealt_to_all_cores(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(forests, "MOST_CELLS", 10)
    names = [f"x{i}" for i in range(12)]
    numbers = [f"xxhash64(id, {i}) / 1e18D AS {name}" for i, name in enumerate(names)]
    spark.range(300_000).selectExpr(*numbers, "IF(id % 3 = 0, 'low', 'high') AS fare_category", "id % 91 + 0.5D AS fare_amount").coalesce(1).write.parquet(str(tmp_path / "one"))
    rows, held = spark.read.parquet(str(tmp_path / "one")), []

    def look(self, df):
        held.append(df.rdd.mapPartitions(lambda some: [sum(1 for _ in some)]).collect())
        raise InterruptedError

    for kind, fit in ((RandomForestRegressor, regress.fit_regressor), (RandomForestClassifier, classify.fit_classifier)):
        monkeypatch.setattr(kind, "_fit", look)
        estimator = regress.forest_regressor(1, 2) if kind is RandomForestRegressor else classify.forest_classifier(1, 2)
        with pytest.raises(InterruptedError):
            fit(rows, [], names, estimator)
    assert [sum(counts) for counts in held] == [300_000, 300_000]
    assert all(sum(n > 0 for n in counts) >= 4 for counts in held)


@pytest.fixture
def scans(monkeypatch):
    """How often rows were made cells, and the models fitted on cells."""
    count, models, cells, fit = [], [], forests.cells, regress.fit_on_cells
    monkeypatch.setattr(forests, "cells", lambda *a: (count.append(1), cells(*a))[1])
    monkeypatch.setattr(regress, "fit_on_cells", lambda *a, **k: (models.append(fit(*a, **k)), models[-1])[1])
    return count, models


def test_search_reads_rows_once_for_all_folds(fares, scans, monkeypatch):
    first = selection.first_trees
    kept = []
    monkeypatch.setattr(selection, "first_trees", lambda model, *a: (kept.append(model), first(model, *a))[1])
    monkeypatch.setattr(selection, "errors_by_trees", None)
    _, table = selection.grid_search(fares, "key", ["kind"], ["n"], {"trees": [2, 3], "depth": [4], "min_rows": [2]}, folds=3, parallelism=1)
    assert len(scans[0]) == 1 and len(kept) == 3
    parts, errors = selection.with_folds(fares, "key", 3), []
    for fold, forest in enumerate(kept):
        held, others = parts.filter(f"{selection.FOLD} = {fold}"), parts.filter(f"{selection.FOLD} <> {fold}")
        features = prep.TripFeatures(["kind"], ["n"], regress.FEATURES, categorical_strategy="mode").fit(others)
        errors.append(forest.transform(features.transform(held)).selectExpr(f"avg(abs({regress.PREDICTED} - fare_amount)) m").first().m)
    assert table.filter("trees = 3").first().mae == pytest.approx(sum(errors) / 3)


def test_folds_read_rows_once(fares, scans):
    scores = selection.cross_validate(fares, "key", ["kind"], ["n"], regress.forest_regressor(2, 4), 3).collect()
    assert len(scans[0]) == 1
    parts = selection.with_folds(fares, "key", 3)
    for row, model in zip(scores, scans[1], strict=True):
        want = regress.score(model, parts.filter(f"{selection.FOLD} = {row.fold}")).first()
        assert [row.mae, row.rmse, row.r2] == pytest.approx([want.mae, want.rmse, want.r2])


def test_curve_reads_rows_once(fares, scans):
    curve = selection.learning_curve(fares, "key", ["kind"], ["n"], regress.forest_regressor(2, 4), (100.0, 32.5), 2).collect()
    assert len(scans[0]) == 1 and [r.percent for r in curve] == [32.5, 100.0]
    place = selection.fold_number(F.concat_ws(":", F.lit("curve"), F.col("key")), 1000)
    parts = selection.with_folds(fares, "key", 2).withColumn("place", place)
    for row, models in zip(curve, (scans[1][:2], scans[1][2:]), strict=True):
        held = [regress.score(m, parts.filter(f"{selection.FOLD} = {f}")).first().mae for f, m in enumerate(models)]
        seen = [regress.score(m, parts.filter(f"{selection.FOLD} <> {f} AND place < {row.percent * 10}")).first().mae for f, m in enumerate(models)]
        assert [row.train_mae_mean, row.test_mae_mean] == pytest.approx([sum(seen) / 2, sum(held) / 2])


@pytest.mark.parametrize("numeric", ["median", "mean"])
def test_features_of_cells_are_those_of_their_rows(spark, numeric):
    rows = spark.range(999).selectExpr("IF(id % 7 = 0, NULL, CASE WHEN id % 5 < 2 THEN 'a' WHEN id % 5 < 4 THEN 'b' ELSE 'c' END) kind", "IF(id % 11 = 0, NULL, pmod(id * id, 13)) n")
    cells = rows.groupBy("kind", "n").agg(F.count("*").alias("rows"))
    one = prep.TripFeatures(["kind"], ["n"], "v", numeric, "mode").fit(rows).transform(cells)
    two = prep.TripFeatures(["kind"], ["n"], "w", numeric, "mode", "rows").fit(cells).transform(one)
    assert two.count() > 30
    for row in two.select("v", "w").collect():
        assert row.v.toArray() == pytest.approx(row.w.toArray())


def test_forest_by_category_learns_from_cells(fares, monkeypatch):
    monkeypatch.setattr(prep, "quantiles", None)
    rows = fares.withColumn("fare_category", F.expr("IF(n < 10, 'low', 'high')"))
    _, scores = regress.fit_by_category(rows, "key", ["kind"], ["n"], trees=2, depth=4)
    assert sorted(r.category for r in scores.collect()) == ["high", "low"]


def test_many_trees_draw_in_several_scans(fares, monkeypatch):
    monkeypatch.setattr(forests, "SCANNED", 2)
    gaps = fares.withColumn("kind", F.expr("IF(n = 3, NULL, kind)"))
    table = forests.cells(gaps, ["kind", "n"], "fare_amount", 5, 42)
    assert table.columns[-2:] == ["w4", "s4"] and table.count() == gaps.select("kind", "n").distinct().count()
    sums = table.agg(F.sum(forests.ROWS), F.sum(forests.TOTAL), *[F.sum(f"w{n}") for n in range(5)]).first()
    assert sums[0] == 6_000 and sums[1] == pytest.approx(fares.agg(F.sum("fare_amount")).first()[0])
    assert all(abs(total - 6_000) < 400 for total in sums[2:]) and len(set(sums[2:])) == 5


def test_classifiers_are_compared_on_cells(fares, monkeypatch):
    counts, fit = [], RandomForestClassifier._fit
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda self, df: (counts.append(df.count()), fit(self, df))[1])
    rows = fares.withColumn("fare_category", F.expr("CASE WHEN n < 7 OR xxhash64(key) % 9 = 0 THEN 'low' WHEN n < 14 THEN 'medium' ELSE 'high' END"))
    train, test = classify.classification_rows(rows, "key")
    arms = {"random_forest": classify.forest_classifier(6, 6, 2), "gradient_boosting": classify.boosted_classifier(8), "second_order_boosting": classify.second_order_classifier(4)}
    scores, models = classify.compare_classifiers(train, test, ["kind"], ["n"], arms)
    assert len(counts) == 6 and max(counts) <= 120
    assert models["random_forest"].stages[1].getNumTrees == 6
    for r in scores.collect():
        scored = classify.classify(models[r.classifier], test)
        want = [of(scored, classify.LABEL, classify.PREDICTED).first()[0] for of in (metrics.accuracy, metrics.weighted_f1)]
        assert [r.accuracy, r.weighted_f1] == pytest.approx(want) and r.accuracy > 0.8


def test_regressors_are_selected_on_cells(fares, fitted, monkeypatch):
    rows = fares.withColumn("predicted_fare_category", F.expr("IF(n < 10, 'low', 'high')"))
    arms = {"linear_regression": regress.linear_regressor(), "random_forest": regress.forest_regressor(3, 4), "gradient_boosting": regress.boosted_regressor(5), "second_order_boosting": regress.second_order_regressor(3)}
    best, table = regress.select_by_category(rows, "key", ["kind"], ["n"], arms=arms)
    found = {(r.category, r.regressor): r for r in table.collect()}
    assert len(found) == 8 and len(fitted) == 6 and max(fitted) <= 20
    monkeypatch.setattr(forests, "MOST_CELLS", 1)
    _, by_rows = regress.select_by_category(rows, "key", ["kind"], ["n"], arms={name: one for name, one in arms.items() if name != "random_forest"})
    for r in by_rows.collect():
        one = found[r.category, r.regressor]
        assert [one.mae, one.rmse, one.r2, one.mape] == pytest.approx([r.mae, r.rmse, r.r2, r.mape])
    for name, model in best.items():
        _, test = split(rows.filter(F.col("predicted_fare_category") == name), "key")
        assert regress.score(model, test).first().mae == pytest.approx(min(r.mae for (c, _), r in found.items() if c == name))


def test_regressors_are_selected_at_full_settings(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(regress, "select_by_category", lambda *a, **k: (asked.append(k.get("arms") or regress.default_arms()), (None, None))[1])
    monkeypatch.setattr(learning, "_guessed", lambda *a: spark.range(1).select(*[F.lit(1).alias(c) for c in (learning.KEY, "fare_amount", "predicted_fare_category", *learning.CATEGORICAL, *learning.NUMERIC)]))
    learning.select_regressor_by_category(spark, "")
    arms = asked[0]
    assert list(arms) == ["linear_regression", "random_forest", "gradient_boosting", "second_order_boosting"]
    assert arms["random_forest"].getNumTrees() == 100 and arms["random_forest"].getMaxDepth() == regress.DEEPEST
    assert [(arms[n].rounds, arms[n].depth) for n in list(arms)[2:]] == [(100, 3), (100, 6)]
