"""Model training, selection and scoring; forests are kept small."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks import fixture as fx
from checks.features import CUTS, FARE
from checks.registry import check, rounded, with_sql
from tripmill import schema
from tripmill.models import classify, prep, regress, selection
from tripmill.operators import features, metrics, sampling
from tripmill.operators.cleaning import clean_trips
from tripmill.plans import scoring, training

TREES, DEPTH = 8, 5
CATEGORICAL = ["payment_category", "time_of_day"]
NUMERIC = ["trip_distance", "passenger_count"]
KEY = "trip_key"


def _trips(spark, folder):
    return fx.trips(spark, folder)


def _featured(spark, folder):
    return features.add_fare_category(features.add_features(_trips(spark, folder), "pickup_datetime"))


def _guessed(spark, folder):
    """Feature rows with a category guessed from the distance, as a classifier would give."""
    distance = F.col("trip_distance")
    guess = F.when(distance < 8, "low").when(distance < 16, "medium").otherwise("high")
    return _featured(spark, folder).withColumn("predicted_fare_category", guess)


@check(
    "m2_one_hot",
    with_sql(fx.TRIPS, "known AS (SELECT DISTINCT passenger_count AS p FROM trips WHERE passenger_count <= 5)")
    + "SELECT passenger_count, "
    + ", ".join(f"CASE WHEN passenger_count = {p} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_{p}" for p in range(1, 6))
    + ", count(*) AS trips FROM trips GROUP BY 1",
)
def one_hot(spark, folder):
    """Fitted on trips of up to five passengers; six and seven are not known to it."""
    trips = _trips(spark, folder)
    fitted = prep.TripFeatures(["passenger_count"], []).fit(trips.filter("passenger_count <= 5"))
    slots = vector_to_array(F.col("features"))
    return (
        fitted.transform(trips)
        .groupBy("passenger_count", *[slots[i].alias(f"is_{i + 1}") for i in range(5)])
        .agg(F.count(F.lit(1)).alias("trips"))
    )


@check(
    "m3_impute",
    with_sql(
        fx.GAPS,
        f"train AS (SELECT * FROM gaps WHERE {fx.BUCKET.format(key='trip_key', n=100)} < 80)",
        "v AS (SELECT median(fare_amount) AS f, avg(passenger_count) AS p FROM train)",
        "c AS (SELECT payment_label AS l FROM train WHERE payment_label IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)",
    )
    + "SELECT trip_key, round(coalesce(fare_amount, f), 6) AS fare_amount, round(coalesce(passenger_count, p), 6) AS passenger_count, coalesce(payment_label, l) AS payment_label FROM gaps, v, c",
)
def impute(spark, folder):
    """Fills learnt from the training rows, used on all rows."""
    gaps = fx.trips_with_gaps(spark, folder)
    train, _ = sampling.split(gaps, KEY)
    fills = {**prep.numeric_fill(train, ["fare_amount"], "median"), **prep.numeric_fill(train, ["passenger_count"], "mean")}
    label = prep.text_fill(train, ["payment_label"], "most_frequent")["payment_label"]
    return rounded(
        gaps.select(
            KEY,
            F.coalesce("fare_amount", F.lit(fills["fare_amount"])).alias("fare_amount"),
            F.coalesce(F.col("passenger_count").cast("double"), F.lit(fills["passenger_count"])).alias("passenger_count"),
            F.coalesce("payment_label", F.lit(label)).alias("payment_label"),
        )
    )


LABELS_SQL = [f"'{v}'" for v in ("credit_card", "cash", "no_charge", "dispute", "unknown", "voided")]


@check(
    "m4_feature_matrix",
    with_sql(
        fx.TRIPS,
        f"p AS (SELECT *, {fx.PAYMENT.format(c='payment_type')} AS payment_category, {fx.TIME_OF_DAY.format(h='hour(pickup_datetime)')} AS time_of_day FROM trips)",
        "s AS (SELECT avg(trip_distance) AS md, stddev_pop(trip_distance) AS sd, avg(passenger_count) AS mp, stddev_pop(passenger_count) AS sp FROM p)",
    )
    + "SELECT VendorID, 'trip_distance' AS slot, round(sum((trip_distance - md) / sd), 4) AS total FROM p, s GROUP BY 1 "
    "UNION ALL SELECT VendorID, 'passenger_count', round(sum((passenger_count - mp) / sp), 4) FROM p, s GROUP BY 1 "
    "UNION ALL SELECT VendorID, 'payment_category=' || payment_category, count(*)::DOUBLE FROM p GROUP BY 1, 2 "
    "UNION ALL SELECT VendorID, 'time_of_day=' || time_of_day, count(*)::DOUBLE FROM p GROUP BY 1, 2",
)
def feature_matrix(spark, folder):
    """Sums of every slot of the feature vector by vendor."""
    rows = _featured(spark, folder)
    fitted = prep.TripFeatures(CATEGORICAL, NUMERIC).fit(rows)
    names = F.array(*[F.lit(n) for n in prep.slot_names(fitted)])
    cells = fitted.transform(rows).select("VendorID", F.posexplode(vector_to_array(F.col("features"))).alias("i", "v"))
    totals = cells.groupBy("VendorID", "i").agg(F.sum("v").alias("total"))
    return rounded(totals.select("VendorID", names[F.col("i")].alias("slot"), "total"), 4)


@check(
    "m7_label_encoding",
    with_sql(fx.TRIPS, CUTS.format(t="trips"), f"c AS (SELECT trip_key, {FARE} AS fare_category FROM trips, cuts)")
    + "SELECT trip_key, fare_category, CASE fare_category WHEN 'high' THEN 0.0::DOUBLE WHEN 'low' THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS label, fare_category AS decoded FROM c",
)
def label_encoding(spark, folder):
    from pyspark.ml.feature import IndexToString

    rows = features.add_fare_category(_trips(spark, folder)).select(KEY, "fare_category")
    model = prep.label_indexer(rows, "fare_category")
    decode = IndexToString(inputCol="label", outputCol="decoded", labels=model.labels)
    return decode.transform(model.transform(rows)).select(KEY, "fare_category", "label", "decoded")


@check("m8_transform_trips")
def transform_trips(spark, folder):
    settings = training.TrainingSettings(pickup="pickup_datetime", key=KEY)
    made = training.transform_trips(_trips(spark, folder), settings)
    return made.features.transform(made.rows).select(KEY, F.size(vector_to_array("features")).alias("slots"))


def _split(spark, folder):
    return classify.classification_rows(_featured(spark, folder), KEY)


@check("m15_forest_classifier")
def forest_classifier(spark, folder):
    train, test = _split(spark, folder)
    model = classify.fit_classifier(train, CATEGORICAL, NUMERIC, classify.forest_classifier(TREES, DEPTH))
    return classify.classify(model, test).select(KEY, "fare_category", "predicted_fare_category")


@check(
    "m16_classification_rows",
    with_sql(fx.TRIPS, CUTS.format(t="trips"), f"c AS (SELECT trip_key, {FARE} AS fare_category FROM trips, cuts)")
    + f"SELECT trip_key, fare_category, CASE WHEN {fx.BUCKET.format(key='trip_key', n=100)} < 80 THEN 'train' ELSE 'test' END AS side FROM c",
)
def classification_rows(spark, folder):
    train, test = _split(spark, folder)
    both = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    return both.select(KEY, "fare_category", "side")


@check("m17_classification_scores")
def classification_scores(spark, folder):
    train, test = _split(spark, folder)
    categorical, numeric = classify.classification_columns(train.drop(KEY, "VendorID"))
    model = classify.fit_classifier(train, categorical, numeric, classify.forest_classifier(TREES, DEPTH))
    return metrics.classification_report(classify.classify(model, test), "fare_category", "predicted_fare_category")


@check("m18_compare_classifiers")
def compare_classifiers(spark, folder):
    rows = _featured(spark, folder).select(KEY, "fare_category", *CATEGORICAL, *NUMERIC)
    train, test = classify.classification_rows(rows, KEY, stratified=True)
    arms = {
        "random_forest": classify.forest_classifier(TREES, DEPTH, 1),
        "gradient_boosting": classify.boosted_classifier(5),
        "second_order_boosting": classify.second_order_classifier(5),
    }
    scores, _ = classify.compare_classifiers(train, test, CATEGORICAL, NUMERIC, arms)
    return scores


@check("m19_regressor_per_category")
def regressor_per_category(spark, folder):
    _, scores = regress.fit_by_category(_featured(spark, folder), KEY, CATEGORICAL, NUMERIC, trees=TREES, depth=DEPTH)
    return scores


def _fares(spark, folder):
    return sampling.split(_featured(spark, folder), KEY)


def _forest():
    return regress.forest_regressor(TREES, DEPTH, 2)


@check("m20_global_regressor")
def global_regressor(spark, folder):
    train, test = _fares(spark, folder)
    return regress.score(regress.fit_regressor(train, CATEGORICAL, NUMERIC, _forest()), test)


@check("m21_regression_columns")
def regression_columns(spark, folder):
    train, test = _fares(spark, folder)
    categorical, numeric = regress.regression_columns(train.drop(KEY, "VendorID", "tip_amount", "tolls_amount"))
    model = regress.fit_regressor(train, categorical, numeric, _forest())
    return regress.predict(model, test).select(KEY, "fare_amount", "predicted_fare")


LINEAR = (
    "fits AS (SELECT predicted_fare_category AS category, regr_slope(fare_amount, trip_distance) AS slope, regr_intercept(fare_amount, trip_distance) AS base FROM g "
    f"WHERE {fx.BUCKET.format(key='trip_key', n=100)} < 80 GROUP BY 1)"
)


@check(
    "m22_linear_regressor_by_category",
    with_sql(
        fx.TRIPS,
        "g AS (SELECT *, CASE WHEN trip_distance < 8 THEN 'low' WHEN trip_distance < 16 THEN 'medium' ELSE 'high' END AS predicted_fare_category FROM trips)",
        LINEAR,
    )
    + "SELECT category, round(avg(abs(base + slope * trip_distance - fare_amount)), 4) AS mae FROM g JOIN fits ON predicted_fare_category = category "
    f"WHERE {fx.BUCKET.format(key='trip_key', n=100)} >= 80 GROUP BY 1",
)
def linear_regressor_by_category(spark, folder):
    _, table = regress.select_by_category(
        _guessed(spark, folder), KEY, [], ["trip_distance"], arms={"linear_regression": regress.linear_regressor()}
    )
    return rounded(table.select("category", "mae"), 4)


@check("m22_select_regressor_by_category")
def select_regressor_by_category(spark, folder):
    """All algorithms at the study's settings: 100 trees without a limit, 100 rounds."""
    rows = _guessed(spark, folder).select(KEY, "fare_amount", "predicted_fare_category", *CATEGORICAL, *NUMERIC)
    _, table = regress.select_by_category(rows, KEY, CATEGORICAL, NUMERIC)
    return table


@check("m23_baseline_forest")
def baseline_forest(spark, folder):
    train, test = _fares(spark, folder)
    model = regress.fit_regressor(train, CATEGORICAL, NUMERIC, regress.forest_regressor(TREES, DEPTH), "mode")
    return regress.score(model, test)


@check("m24_feature_importances")
def feature_importances(spark, folder):
    train, _ = _fares(spark, folder)
    return regress.feature_importances(regress.fit_regressor(train, CATEGORICAL, NUMERIC, _forest()), spark=spark)


@check("t2_top_importances")
def top_importances(spark, folder):
    train, _ = _fares(spark, folder)
    return regress.feature_importances(regress.fit_regressor(train, CATEGORICAL, NUMERIC, _forest()), 5, spark)


SMALL_GRID = {"trees": [5, 10, 20], "depth": [5, 10], "min_rows": [2, 5, 10]}


def _medium(spark, folder):
    rows = _guessed(spark, folder).filter("predicted_fare_category = 'medium'")
    return sampling.split(rows.select(KEY, "fare_amount", *CATEGORICAL, *NUMERIC), KEY)


@check("m25_grid_search")
def grid_search(spark, folder):
    train, _ = _medium(spark, folder)
    _, table = selection.grid_search(train, KEY, CATEGORICAL, NUMERIC, SMALL_GRID)
    return table


@check("m26_tuned_against_default")
def tuned_against_default(spark, folder):
    train, test = _medium(spark, folder)
    tuned, _ = selection.grid_search(train, KEY, CATEGORICAL, NUMERIC, {"trees": [5, 10], "depth": [5, 10], "min_rows": [2]})
    default = regress.fit_regressor(train, CATEGORICAL, NUMERIC, regress.forest_regressor(TREES, DEPTH), "mode")
    return selection.compare_tuned(test, tuned, default)


@check("m27_cross_validation")
def cross_validation(spark, folder):
    rows = _guessed(spark, folder).select(KEY, "fare_amount", "predicted_fare_category", *CATEGORICAL, *NUMERIC)
    estimators = {name: regress.forest_regressor(4, 4) for name in schema.FARE_LABELS}
    scores = selection.cross_validate_categories(rows, KEY, CATEGORICAL, NUMERIC, estimators)
    return selection.summarise_folds(scores)


@check("m28_learning_curve")
def learning_curve(spark, folder):
    rows = _guessed(spark, folder).filter("predicted_fare_category = 'medium'").select(KEY, "fare_amount", *CATEGORICAL, *NUMERIC)
    return selection.learning_curve(rows, KEY, CATEGORICAL, NUMERIC, regress.forest_regressor(4, 4))


SETTINGS = training.TrainingSettings(
    trees=5, class_depth=4, fare_depth=4, pickup="pickup_datetime", key=KEY
)


_RUNS: dict[tuple[str, str], training.TrainingRun] = {}


def _trained(spark, folder):
    """One training run per session and folder; the scoring queries share it."""
    where = (spark.sparkContext.applicationId, folder)
    if where not in _RUNS:
        _RUNS[where] = training.train(clean_trips(_trips(spark, folder)), SETTINGS)
    return _RUNS[where]


@check("m29_train_all_stages")
def train_all_stages(spark, folder):
    return _trained(spark, folder).metrics


M30_MEDIAN = 30.0


@check(
    "m30_prepare_new_trips",
    with_sql(fx.TRIPS)
    + "SELECT trip_key, CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour, "
    f"{fx.TIME_OF_DAY.format(h='hour(pickup_datetime)')} AS time_of_day, {fx.PASSENGERS.format(p='passenger_count')} AS passenger_group, "
    f"{fx.DISTANCE.format(d='coalesce(nullif(trip_distance, 1.0), 5.0)')} AS distance_category, "
    f"round(coalesce(coalesce(nullif(trip_distance, 1.0), 5.0) / (nullif(trip_time_in_secs, 0) / 3600.0::DOUBLE), {M30_MEDIAN}), 6) AS speed FROM trips",
)
def prepare_new_trips(spark, folder):
    """Training features on rows without a fare; medians are those of the training."""
    trips = _trips(spark, folder).drop("fare_amount").withColumn("trip_distance", F.nullif(F.col("trip_distance"), F.lit(1.0)))
    made = scoring.prepare(trips, {"speed": M30_MEDIAN}, "pickup_datetime")
    return rounded(made.select(KEY, "pickup_hour", "time_of_day", "passenger_group", "distance_category", "speed"))


def _prepared(spark, folder, scorer):
    return scoring.prepare(_trips(spark, folder).drop("fare_amount"), scorer.medians, "pickup_datetime")


@check("m31_predict_cluster")
def predict_cluster(spark, folder):
    scorer = _trained(spark, folder).scorer
    return scorer.predict_cluster(_prepared(spark, folder, scorer)).select(KEY, "cluster")


@check("m32_predict_category")
def predict_category(spark, folder):
    scorer = _trained(spark, folder).scorer
    clustered = scorer.predict_cluster(_prepared(spark, folder, scorer))
    return scorer.predict_category(clustered).select(KEY, "predicted_fare_category")


@check(
    "m33_dispatch",
    with_sql(
        fx.TRIPS,
        "g AS (SELECT *, CASE WHEN trip_distance < 8 THEN 'low' WHEN trip_distance < 16 THEN 'medium' END AS predicted_fare_category FROM trips)",
        LINEAR,
    )
    + "SELECT trip_key, round(coalesce(CASE WHEN category <> 'medium' THEN base + slope * trip_distance END, 0.0), 5) AS predicted_fare "
    "FROM g LEFT JOIN fits ON predicted_fare_category = category",
)
def dispatch(spark, folder):
    """One linear model, for low fares; medium has no model and long trips no category."""
    distance = F.col("trip_distance")
    rows = _trips(spark, folder).withColumn(
        "predicted_fare_category", F.when(distance < 8, "low").when(distance < 16, "medium")
    )
    train, _ = sampling.split(rows.filter("predicted_fare_category = 'low'"), KEY)
    models = {"low": regress.fit_regressor(train, [], ["trip_distance"], regress.linear_regressor())}
    return rounded(regress.dispatch(rows, models).select(KEY, "predicted_fare"), 5)


@check("m34_score_trips")
def score_trips(spark, folder):
    scorer = _trained(spark, folder).scorer
    scored = scorer.predict(_trips(spark, folder).drop("fare_amount"))
    return scored.select(KEY, "cluster", "predicted_fare_category", "predicted_fare")
