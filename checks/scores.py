"""Scores of fixed predictions, and the tables behind the charts.

The fare category is guessed from the distance and the fare from a linear rule, so
SQL can make the same predictions.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixture as fx
from checks.features import CUTS, FARE
from checks.registry import check, rounded, with_sql
from tripmill import schema
from tripmill.operators import charts, features, metrics, sampling

LABELS = schema.FARE_LABELS
GUESSED = (
    f"guessed AS (SELECT *, {FARE} AS fare_category, "
    "CASE WHEN trip_distance < 8 THEN 'low' WHEN trip_distance < 16 THEN 'medium' ELSE 'high' END AS predicted_fare_category, "
    "2.5 + 4.0 * trip_distance AS predicted_fare, 52.0::DOUBLE AS constant_fare FROM trips, cuts)"
)
VIEWS = with_sql(fx.TRIPS, CUTS.format(t="trips"), GUESSED)
PAIR = ("fare_category", "predicted_fare_category")


def _guessed(spark, folder):
    distance = F.col("trip_distance")
    guess = F.when(distance < 8, "low").when(distance < 16, "medium").otherwise("high")
    return features.add_fare_category(fx.trips(spark, folder)).withColumns(
        {
            "predicted_fare_category": guess,
            "predicted_fare": F.lit(2.5) + F.lit(4.0) * distance,
            "constant_fare": F.lit(52.0),
        }
    )


@check("e1_accuracy", VIEWS + "SELECT round(avg(CAST(fare_category = predicted_fare_category AS INTEGER)), 6) AS accuracy FROM guessed")
def accuracy(spark, folder):
    return rounded(metrics.accuracy(_guessed(spark, folder), *PAIR))


CLASS_SCORES = (
    "classes AS (SELECT unnest(['low', 'medium', 'high']) AS class), "
    "tallies AS (SELECT class, count(*) FILTER (WHERE fare_category = class AND predicted_fare_category = class) AS hit, "
    "count(*) FILTER (WHERE fare_category = class) AS support, count(*) FILTER (WHERE predicted_fare_category = class) AS said "
    "FROM guessed, classes GROUP BY 1), "
    "scores AS (SELECT class, hit / said AS precision, hit / support AS recall, 2.0::DOUBLE * hit / (said + support) AS f1, support FROM tallies) "
)
SCORED = VIEWS.rstrip() + ", " + CLASS_SCORES


@check(
    "e2_classification_report",
    SCORED
    + "SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM scores "
    "UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), sum(support)::BIGINT FROM scores "
    "UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6), "
    "round(sum(f1 * support) / sum(support), 6), sum(support)::BIGINT FROM scores",
)
def classification_report(spark, folder):
    return rounded(metrics.classification_report(_guessed(spark, folder), *PAIR))


@check("e3_weighted_f1", SCORED + "SELECT round(sum(f1 * support) / sum(support), 6) AS weighted_f1 FROM scores")
def weighted_f1(spark, folder):
    return rounded(metrics.weighted_f1(_guessed(spark, folder), *PAIR))


@check(
    "e4_confusion_matrix",
    VIEWS + "SELECT fare_category AS actual, " + ", ".join(f"count(*) FILTER (WHERE predicted_fare_category = '{v}') AS {v}" for v in LABELS) + " FROM guessed GROUP BY 1",
)
def confusion_matrix(spark, folder):
    return metrics.confusion_matrix(_guessed(spark, folder), *PAIR, LABELS)


MISS = "(predicted_fare - fare_amount)"


@check(
    "e5_regression_metrics",
    VIEWS
    + f"SELECT round(avg(abs({MISS})), 6) AS mae, round(avg({MISS} * {MISS}), 5) AS mse, round(sqrt(avg({MISS} * {MISS})), 6) AS rmse, "
    f"round(1 - sum({MISS} * {MISS}) / (var_pop(fare_amount) * count(*)), 6) AS r2 FROM guessed",
)
def regression_metrics(spark, folder):
    return rounded(metrics.regression_metrics(_guessed(spark, folder), "fare_amount", "predicted_fare").drop("mape"), mse=5)


@check("e6_mape", VIEWS + f"SELECT round(avg(abs({MISS} / fare_amount)) * 100, 5) AS mape FROM guessed")
def mape(spark, folder):
    return rounded(metrics.regression_metrics(_guessed(spark, folder), "fare_amount", "predicted_fare").select("mape"), 5)


@check(
    "e7_within_tolerance",
    VIEWS + "SELECT " + ", ".join(f"round(avg(CAST(abs({MISS}) <= {t} AS INTEGER)) * 100, 6) AS within_{t}" for t in (1, 2, 5)) + " FROM guessed",
)
def within_tolerance(spark, folder):
    return rounded(metrics.within_tolerance(_guessed(spark, folder), "fare_amount", "predicted_fare"))


def _scores_sql(model: str, column: str) -> str:
    miss = f"({column} - fare_amount)"
    within = ", ".join(f"round(avg(CAST(abs({miss}) <= {t} AS INTEGER)) * 100, 6) AS within_{t}" for t in (1, 2, 5))
    return (
        f"SELECT '{model}' AS model, round(avg(abs({miss})), 6) AS mae, round(sqrt(avg({miss} * {miss})), 6) AS rmse, "
        f"round(1 - sum({miss} * {miss}) / (var_pop(fare_amount) * count(*)), 6) AS r2, {within} FROM guessed"
    )


BOTH = _scores_sql("by_distance", "predicted_fare") + " UNION ALL " + _scores_sql("constant", "constant_fare")
MODELS = {"by_distance": "predicted_fare", "constant": "constant_fare"}


def _comparison(spark, folder):
    return metrics.compare_models(_guessed(spark, folder), "fare_amount", MODELS)


@check("e8_compare_models", VIEWS + BOTH)
def compare_models(spark, folder):
    return rounded(_comparison(spark, folder))


@check(
    "e12_mae_reduction",
    VIEWS
    + "SELECT round(avg(abs(predicted_fare - fare_amount)), 6) AS model_mae, round(avg(abs(constant_fare - fare_amount)), 6) AS baseline_mae, "
    "round((avg(abs(constant_fare - fare_amount)) - avg(abs(predicted_fare - fare_amount))) / avg(abs(constant_fare - fare_amount)) * 100, 6) AS reduction_percent FROM guessed",
)
def mae_reduction(spark, folder):
    return rounded(metrics.mae_reduction(_comparison(spark, folder), "by_distance", "constant"))


FOLDS = fx.BUCKET.format(key="'fold:' || trip_key", n=5)


@check(
    "e11_fold_summary",
    VIEWS.rstrip()
    + f", folds AS (SELECT fare_category AS category, {FOLDS} AS fold, avg(abs({MISS})) AS mae, avg({MISS} * {MISS}) AS mse FROM guessed GROUP BY 1, 2) "
    "SELECT category, round(avg(mae), 6) AS mae_mean, round(stddev_pop(mae), 6) AS mae_std, round(avg(mse), 5) AS mse_mean, round(stddev_pop(mse), 5) AS mse_std FROM folds GROUP BY 1",
)
def fold_summary(spark, folder):
    miss = F.col("predicted_fare") - F.col("fare_amount")
    folded = _guessed(spark, folder).withColumn("fold", sampling.fold_number(F.col("trip_key"), 5))
    scores = folded.groupBy(F.col("fare_category").alias("category"), "fold").agg(F.avg(F.abs(miss)).alias("mae"), F.avg(miss * miss).alias("mse"))
    return rounded(metrics.fold_summary(scores, "category", ["mae", "mse"]), mse_mean=5, mse_std=5)


SPLIT = fx.BUCKET.format(key="trip_key", n=100)


@check("m5_hash_split", VIEWS + f"SELECT trip_key, CASE WHEN {SPLIT} < 80 THEN 'train' ELSE 'test' END AS side FROM guessed")
def hash_split(spark, folder):
    train, test = sampling.split(fx.trips(spark, folder).select("trip_key"), "trip_key")
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))


PLACE = fx.HASH48.format(key="trip_key")


@check(
    "m6_stratified_split",
    VIEWS.rstrip()
    + f", placed AS (SELECT trip_key, fare_category, {PLACE} AS place FROM guessed), "
    "ranked AS (SELECT *, row_number() OVER (PARTITION BY fare_category ORDER BY place) AS rank, count(*) OVER (PARTITION BY fare_category) AS n FROM placed), "
    "cut AS (SELECT fare_category, max(place) AS top FROM ranked WHERE rank <= floor(n * 0.8 + 1e-9) GROUP BY 1) "
    "SELECT trip_key, p.fare_category, CASE WHEN place <= top THEN 'train' ELSE 'test' END AS side FROM placed p JOIN cut c ON p.fare_category = c.fare_category",
)
def stratified_split(spark, folder):
    rows = _guessed(spark, folder).select("trip_key", "fare_category")
    train, test = sampling.stratified_split(rows, "trip_key", "fare_category")
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))


@check(
    "v1_error_histogram",
    VIEWS.rstrip()
    + f", e AS (SELECT predicted_fare_category, {MISS} AS error FROM guessed), r AS (SELECT min(error) AS lo, max(error) AS hi FROM e) "
    "SELECT predicted_fare_category, CAST(least(floor((error - lo) / (hi - lo) * 50), 49) AS INTEGER) AS bin, count(*) AS n FROM e, r GROUP BY 1, 2",
)
def error_histogram(spark, folder):
    return charts.error_histogram(_guessed(spark, folder), "fare_amount", "predicted_fare", "predicted_fare_category")


@check(
    "v2_fare_points",
    VIEWS + f"SELECT trip_key, trip_distance, fare_amount, fare_category FROM guessed ORDER BY {PLACE}, trip_key LIMIT 1000",
)
def fare_points(spark, folder):
    return charts.fare_points(_guessed(spark, folder), "trip_key")


@check(
    "v4_score_bars",
    VIEWS.rstrip()
    + f", b AS ({BOTH}) "
    + " UNION ALL ".join(f"SELECT model, '{m}' AS measure, round({m}, 6) AS score FROM b" for m in ("mae", "rmse", "r2", "within_1")),
)
def score_bars(spark, folder):
    return charts.score_bars(rounded(_comparison(spark, folder)), ["model"], ["mae", "rmse", "r2", "within_1"])
