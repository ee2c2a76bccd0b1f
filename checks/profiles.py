"""Counts, ranges, shares and quality reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixture as fx
from checks.features import CUTS, FARE
from checks.registry import check, rounded, with_sql
from tripmill import schema
from tripmill.functions import bins
from tripmill.operators import features, metrics, profiling, quantiles, sampling
from tripmill.operators.cleaning import keep_years
from tripmill.sources.tables import get_sample

LO, HI = fx.START_YEAR, fx.END_YEAR
OUTSIDE = f"(year({{c}}) < {LO} OR year({{c}}) > {HI})"


def _clustered(spark, folder):
    return fx.trips(spark, folder).withColumn("cluster", bins.distance_cluster(F.col("trip_distance")))


CLUSTERED = f"clustered AS (SELECT *, {fx.RULE_CLUSTER.format(d='trip_distance')} AS cluster FROM trips)"


@check("a1_row_count", "SELECT count(*) AS rows FROM lineitem")
def row_count(spark, folder):
    return profiling.row_count(fx.trips(spark, folder))


@check("a2_date_range", with_sql(fx.GAPS) + "SELECT min(pickup_datetime) AS min_date, max(pickup_datetime) AS max_date FROM gaps")
def date_range(spark, folder):
    return profiling.date_range(fx.trips_with_gaps(spark, folder), "pickup_datetime")


@check(
    "a3_removal_report",
    with_sql(fx.GAPS, f"c AS (SELECT count(*) AS n, count(*) FILTER (WHERE {OUTSIDE.format(c='pickup_datetime')}) AS r FROM gaps)")
    + "SELECT n AS rows_before, n - r AS rows_after, r AS rows_removed, round(r * 100.0::DOUBLE / n, 6) AS percent_removed FROM c",
)
def removal_report(spark, folder):
    return rounded(profiling.removal_report(fx.trips_with_gaps(spark, folder), "pickup_datetime", LO, HI))


MONTH = (
    "CAST(date_trunc('month', pickup_datetime) AS TIMESTAMP) AS month, CAST(year(pickup_datetime) AS INTEGER) AS year, "
    "CAST(month(pickup_datetime) AS INTEGER) AS month_number"
)


@check("a4_monthly_counts", with_sql(fx.TRIPS) + f"SELECT {MONTH}, count(*) AS trips FROM trips GROUP BY 1, 2, 3")
def monthly_counts(spark, folder):
    return profiling.monthly_counts(fx.trips(spark, folder), "pickup_datetime")


@check(
    "a5_monthly_fares",
    with_sql(fx.TRIPS)
    + f"SELECT {MONTH}, count(*) AS trips, round(sum(fare_amount), 2) AS total_fare, round(avg(fare_amount), 6) AS avg_fare, "
    "round(sum(tip_amount), 2) AS total_tips, round(avg(tip_amount), 6) AS avg_tip FROM trips "
    f"WHERE coalesce(year(pickup_datetime) BETWEEN {LO} AND {HI}, true) GROUP BY 1, 2, 3",
)
def monthly_fares(spark, folder):
    trips = keep_years(fx.trips(spark, folder), "pickup_datetime", LO, HI)
    return rounded(profiling.monthly_fares(trips, "pickup_datetime"), total_fare=2, total_tips=2)


@check("a6_year_distribution", with_sql(fx.GAPS) + "SELECT CAST(year(pickup_datetime) AS INTEGER) AS year, count(*) AS rows FROM gaps GROUP BY 1")
def year_distribution(spark, folder):
    return profiling.year_distribution(fx.trips_with_gaps(spark, folder), "pickup_datetime")


NULL_COLUMNS = ["trip_key", "passenger_count", "fare_amount", "pickup_datetime", "payment_label"]


@check(
    "a7_null_profile",
    with_sql(fx.GAPS)
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS nulls, round(count(*) FILTER (WHERE {c} IS NULL) * 100.0::DOUBLE / count(*), 6) AS percent FROM gaps"
        for c in NULL_COLUMNS
    ),
)
def null_profile(spark, folder):
    return rounded(profiling.null_profile(fx.trips_with_gaps(spark, folder), NULL_COLUMNS))


PROBABILITIES = [0.01, 0.25, 0.33, 0.5, 0.66, 0.75, 0.99]


@check(
    "a8_exact_quantiles",
    with_sql(fx.TRIPS)
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {p}::DOUBLE AS p, round(quantile_cont({c}, {p}), 6) AS value FROM trips"
        for c in ("fare_amount", "trip_distance", "tip_amount")
        for p in PROBABILITIES
    ),
)
def exact_quantiles(spark, folder):
    wanted = {c: PROBABILITIES for c in ("fare_amount", "trip_distance", "tip_amount")}
    found = quantiles.quantiles(fx.trips(spark, folder), wanted)
    rows = [(c, p, v) for c, values in found.items() for p, v in zip(PROBABILITIES, values, strict=True)]
    return rounded(spark.createDataFrame(rows, "column string, p double, value double"))


@check("a9_median", with_sql(fx.GAPS) + "SELECT round(median(fare_amount), 6) AS median FROM gaps")
def median(spark, folder):
    value = quantiles.median(fx.trips_with_gaps(spark, folder), "fare_amount")
    return rounded(spark.createDataFrame([(value,)], "median double"))


@check(
    "a10_mode",
    with_sql(fx.GAPS) + "SELECT passenger_count AS mode FROM gaps WHERE passenger_count IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1",
)
def mode(spark, folder):
    value = quantiles.mode(fx.trips_with_gaps(spark, folder), "passenger_count")
    return spark.createDataFrame([(value,)], "mode int")


@check(
    "a11_cluster_statistics",
    with_sql(fx.TRIPS, CLUSTERED)
    + "SELECT cluster, "
    + ", ".join(
        f"round_even(avg({c}), 2) AS {c}_mean, round_even(stddev_samp({c}), 2) AS {c}_std, count({c}) AS {c}_count"
        for c in ("fare_amount", "trip_distance", "passenger_count")
    )
    + " FROM clustered GROUP BY 1",
)
def cluster_statistics(spark, folder):
    return profiling.cluster_statistics(_clustered(spark, folder), schema.CLUSTER_STATS)


@check("a12_cluster_sizes", with_sql(fx.TRIPS, CLUSTERED) + "SELECT cluster, count(*) AS cluster_size FROM clustered GROUP BY 1")
def cluster_sizes(spark, folder):
    return profiling.cluster_statistics(_clustered(spark, folder), ["fare_per_mile"])


PROFILE = ["trip_distance", "fare_amount", "passenger_count"]


@check(
    "a13_cluster_profile",
    with_sql(fx.TRIPS, CLUSTERED) + "SELECT cluster, " + ", ".join(f"round(avg({c}), 6) AS {c}" for c in PROFILE) + " FROM clustered GROUP BY 1",
)
def cluster_profile(spark, folder):
    return rounded(profiling.group_means(_clustered(spark, folder), ["cluster"], PROFILE))


@check(
    "a14_value_counts",
    with_sql(fx.GAPS) + "SELECT payment_label, count(*) AS n FROM gaps WHERE payment_label IS NOT NULL GROUP BY 1",
)
def value_counts(spark, folder):
    return profiling.value_counts(fx.trips_with_gaps(spark, folder), "payment_label")


@check(
    "a15_value_shares",
    with_sql(fx.TRIPS, CLUSTERED) + "SELECT cluster, count(*) AS n, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 6) AS percent FROM clustered GROUP BY 1",
)
def value_shares(spark, folder):
    return rounded(profiling.value_shares(_clustered(spark, folder), "cluster"))


CATEGORISED = f"categorised AS (SELECT *, {FARE} AS fare_category FROM clustered, cuts)"
LABELS = schema.FARE_LABELS


def _categorised(spark, folder):
    return features.add_fare_category(_clustered(spark, folder))


@check(
    "a16_crosstab_percent",
    with_sql(fx.TRIPS, CLUSTERED, CUTS.format(t="trips"), CATEGORISED)
    + "SELECT cluster, "
    + ", ".join(f"round(count(*) FILTER (WHERE fare_category = '{v}') * 100.0::DOUBLE / count(*), 6) AS {v}" for v in LABELS)
    + " FROM categorised GROUP BY 1",
)
def crosstab_percent(spark, folder):
    return rounded(profiling.crosstab_percent(_categorised(spark, folder), "cluster", "fare_category", LABELS))


@check(
    "a17_crosstab_counts",
    with_sql(fx.TRIPS, CLUSTERED, CUTS.format(t="trips"), CATEGORISED)
    + "SELECT payment_type, "
    + ", ".join(f"count(*) FILTER (WHERE fare_category = '{v}') AS {v}" for v in LABELS)
    + " FROM categorised GROUP BY 1",
)
def crosstab_counts(spark, folder):
    return profiling.crosstab_counts(_categorised(spark, folder), "payment_type", "fare_category", LABELS)


DISTINCT = ["VendorID", "passenger_count", "fare_amount", "trip_distance"]


@check(
    "a18_distinct_counts",
    with_sql(fx.TRIPS) + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS distinct_values FROM trips" for c in DISTINCT),
)
def distinct_counts(spark, folder):
    return profiling.distinct_counts(fx.trips(spark, folder), DISTINCT)


GUESS = "(2.5 + 2.5 * trip_distance)"


def _guessed(spark, folder):
    return _categorised(spark, folder).withColumn("predicted_fare", F.lit(2.5) + F.lit(2.5) * F.col("trip_distance"))


@check(
    "a19_error_by_group",
    with_sql(fx.TRIPS) + f"SELECT passenger_count, round(avg(abs({GUESS} - fare_amount)), 6) AS mean_abs_error FROM trips GROUP BY 1",
)
def error_by_group(spark, folder):
    return rounded(metrics.error_by_group(_guessed(spark, folder), "passenger_count", "fare_amount", "predicted_fare"))


@check(
    "a20_prediction_summary",
    with_sql(fx.TRIPS)
    + f"SELECT min({GUESS}) AS min_prediction, max({GUESS}) AS max_prediction, round(avg({GUESS}), 6) AS mean_prediction, count({GUESS}) AS predictions FROM trips",
)
def prediction_summary(spark, folder):
    return rounded(profiling.prediction_summary(_guessed(spark, folder)))


QUALITY = ["trip_key", "passenger_count", "pickup_datetime", "dropoff_datetime"]
QUALITY_TYPES = {"trip_key": "string", "passenger_count": "int", "pickup_datetime": "timestamp_ntz", "dropoff_datetime": "timestamp_ntz"}


def _quality_sql() -> str:
    none_text, none_value = "NULL::VARCHAR AS text", "NULL::DOUBLE AS value"
    parts = [
        f"SELECT 'trips' AS \"table\", '' AS \"column\", 'rows' AS metric, count(*)::DOUBLE AS value, {none_text} FROM gaps",
        f"SELECT 'trips', '', 'columns', {len(QUALITY)}::DOUBLE, NULL",
    ]
    for c in QUALITY:
        nulls = f"count(*) FILTER (WHERE {c} IS NULL)"
        parts += [
            f"SELECT 'trips', '{c}', 'type', {none_value}, '{QUALITY_TYPES[c]}'",
            f"SELECT 'trips', '{c}', 'nulls', {nulls}::DOUBLE, NULL FROM gaps",
            f"SELECT 'trips', '{c}', 'null_percent', round({nulls} * 100.0::DOUBLE / count(*), 6), NULL FROM gaps",
        ]
    for c in QUALITY[2:]:
        parts += [
            f"SELECT 'trips', '{c}', 'min_date', {none_value}, strftime(min({c}), '%Y-%m-%d %H:%M:%S') FROM gaps",
            f"SELECT 'trips', '{c}', 'max_date', {none_value}, strftime(max({c}), '%Y-%m-%d %H:%M:%S') FROM gaps",
            f"SELECT 'trips', '{c}', 'outliers', (count(*) FILTER (WHERE {OUTSIDE.format(c=c)}))::DOUBLE, NULL FROM gaps",
            f"SELECT 'trips', '{c}', 'rows_in_' || year({c}), count(*)::DOUBLE, NULL FROM gaps WHERE {c} IS NOT NULL GROUP BY year({c})",
        ]
    return with_sql(fx.GAPS) + " UNION ALL ".join(parts)


@check("a21_quality_report", _quality_sql())
def quality_report(spark, folder):
    trips = fx.trips_with_gaps(spark, folder).select(QUALITY)
    return rounded(profiling.quality_reports({"trips": trips}, LO, HI))


@check(
    "u4_melt",
    with_sql(fx.TRIPS, CLUSTERED, f"p AS (SELECT cluster, {', '.join(f'avg({c})::DOUBLE AS {c}' for c in PROFILE)} FROM clustered GROUP BY 1)")
    + " UNION ALL ".join(f"SELECT cluster, '{c}' AS feature, round({c}, 6) AS value FROM p" for c in PROFILE),
)
def melt(spark, folder):
    profile = profiling.group_means(_clustered(spark, folder), ["cluster"], PROFILE)
    return rounded(profiling.melt(profile, ["cluster"], PROFILE))


@check("t1_order_by_month", with_sql(fx.GAPS) + f"SELECT {MONTH}, count(*) AS trips FROM gaps GROUP BY 1, 2, 3 ORDER BY year, month_number")
def order_by_month(spark, folder):
    return profiling.monthly_counts(fx.trips_with_gaps(spark, folder), "pickup_datetime")


@check(
    "t3_arg_max",
    with_sql(fx.TRIPS, "g AS (SELECT passenger_count, avg(tip_amount) AS tip FROM trips GROUP BY 1)")
    + "SELECT arg_max(passenger_count, tip) AS passenger_count, round(max(tip), 6) AS tip FROM g",
)
def arg_max(spark, folder):
    groups = fx.trips(spark, folder).groupBy("passenger_count").agg(F.avg("tip_amount").alias("tip"))
    return rounded(metrics.best_row(groups, "passenger_count", "tip"))


@check(
    "t3_arg_min",
    with_sql(fx.TRIPS, "g AS (SELECT RatecodeID, avg(fare_amount) AS fare FROM trips GROUP BY 1)")
    + "SELECT arg_min(RatecodeID, fare) AS RatecodeID, round(min(fare), 6) AS fare FROM g",
)
def arg_min(spark, folder):
    groups = fx.trips(spark, folder).groupBy("RatecodeID").agg(F.avg("fare_amount").alias("fare"))
    return rounded(metrics.best_row(groups, "RatecodeID", "fare", smallest=True))


ORDER = fx.HASH48.format(key="trip_key")


@check("t4_sample_rows", with_sql(fx.TRIPS) + f"SELECT trip_key, fare_amount FROM trips ORDER BY {ORDER}, trip_key LIMIT 1000")
def sample_rows(spark, folder):
    return sampling.sample_rows(fx.trips(spark, folder), 1000, "trip_key").select("trip_key", "fare_amount")


@check("t5_sample_fraction", with_sql(fx.TRIPS) + f"SELECT trip_key, fare_amount FROM trips WHERE {fx.BUCKET.format(key='trip_key', n=100)} < 20")
def sample_fraction(spark, folder):
    return sampling.sample_fraction(fx.trips(spark, folder), 20, "trip_key").select("trip_key", "fare_amount")


@check("s16_sample_of_table", with_sql(fx.TRIPS) + "SELECT trip_key FROM trips")
def sample_of_table(spark, folder):
    """A sample of a stored table that is asked for more rows than there are: every row once."""
    fx.trips(spark, folder).createOrReplaceTempView("trips_to_sample")
    return get_sample(spark, "trips_to_sample", 2_000_000_000, seed=1).select("trip_key")


@check("s17_first_rows", with_sql(fx.TRIPS) + "SELECT trip_key, pickup_datetime FROM trips ORDER BY pickup_datetime, trip_key LIMIT 1000")
def first_rows(spark, folder):
    return sampling.first_rows(fx.trips(spark, folder), 1000, "pickup_datetime", "trip_key").select("trip_key", "pickup_datetime")
