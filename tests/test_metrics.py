from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripmill.operators import charts, metrics, profiling, reports, setops


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(c, 0.6, (30, 2)) for c in ((0, 0), (3, 1), (1, 4))])
    labels = np.repeat([0, 1, 2], 30)
    df = spark.createDataFrame([(float(a), float(b), int(k)) for (a, b), k in zip(x, labels, strict=True)], "x double, y double, cluster int")
    return x, labels, df


def test_davies_bouldin(blobs):
    x, labels, df = blobs
    centres = np.array([x[labels == k].mean(0) for k in range(3)])
    scatter = [np.linalg.norm(x[labels == k] - centres[k], axis=1).mean() for k in range(3)]
    worst = [max((scatter[i] + scatter[j]) / np.linalg.norm(centres[i] - centres[j]) for j in range(3) if j != i) for i in range(3)]
    assert metrics.davies_bouldin(df, ["x", "y"]).first()[0] == pytest.approx(np.mean(worst))


def test_silhouette(blobs):
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.feature import VectorAssembler

    x, labels, df = blobs
    gaps = ((x[:, None] - x[None]) ** 2).sum(-1)
    scores = []
    for i, k in enumerate(labels):
        a = gaps[i, labels == k].sum() / ((labels == k).sum() - 1)
        b = min(gaps[i, labels == o].mean() for o in range(3) if o != k)
        scores.append((b - a) / max(a, b))
    found = metrics.silhouette(df, ["x", "y"]).first()[0]
    assert found == pytest.approx(np.mean(scores))
    vectors = VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(df)
    assert found == pytest.approx(ClusteringEvaluator(predictionCol="cluster").evaluate(vectors))


def test_report_scores_zero_for_a_class_never_predicted(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "a"), ("b", "b"), ("c", "b")], "t string, p string")
    report = {r["class"]: r for r in metrics.classification_report(df, "t", "p").collect()}
    assert report["c"].precision == 0.0 and report["c"].recall == 0.0 and report["c"].f1 == 0.0
    assert report["macro avg"].recall == pytest.approx((1 + 0.5 + 0) / 3)
    assert report["weighted avg"].recall == pytest.approx(0.5)


def test_perfect_prediction(spark):
    df = spark.createDataFrame([(1.0, 1.0), (0.0, 0.0), (3.0, 3.0)], "y double, p double")
    row = metrics.regression_metrics(df, "y", "p").first()
    assert (row.mae, row.mse, row.r2, row.mape) == (0.0, 0.0, 1.0, 0.0)


def test_histogram_puts_the_largest_in_the_last_bin(spark):
    df = spark.createDataFrame([("a", 0.0, float(i)) for i in range(51)], "c string, y double, p double")
    rows = charts.error_histogram(df, "y", "p", "c", 50).collect()
    assert max(r.bin for r in rows) == 49 and sum(r.n for r in rows) == 51


def test_quality_report_counts(spark):
    df = spark.sql("SELECT * FROM VALUES (1, TIMESTAMP_NTZ '2020-01-01'), (NULL, TIMESTAMP_NTZ '2023-02-02'), (3, NULL) AS t(n, pickup_datetime)")
    cells = {(r.column, r.metric): r.value for r in profiling.quality_report(df, "t", 2022, 2024).collect()}
    assert cells["", "rows"] == 3 and cells["n", "nulls"] == 1
    assert cells["pickup_datetime", "outliers"] == 1 and cells["pickup_datetime", "rows_in_2023"] == 1


def test_union_without_common_columns(spark):
    left, right = spark.range(1), spark.range(1).withColumnRenamed("id", "other")
    assert setops.union_common(left, right) is None
    assert setops.create_union_view(left, None, "nothing") is None
    assert not spark.catalog.tableExists("nothing")


def test_top_zones(spark):
    df = spark.createDataFrame([(1, 2), (1, 3), (2, 2)], "PULocationID int, DOLocationID int")
    assert {(r["end"], r.zone, r.trips) for r in reports.top_zones(df, 1).collect()} == {("pickup", 1, 2), ("dropoff", 2, 2)}


def test_hot_route_stays_one_row(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).cast("int").alias("PULocationID"),
        F.lit(1).alias("DOLocationID"), F.lit(10.0).alias("fare_amount"), F.lit(2.0).alias("trip_distance"),
    )
    hot = reports.route_table(df).filter("PULocationID = 7").collect()
    assert len(hot) == 1 and hot[0].trips >= 1000 and hot[0].cost_per_mile == 5.0
