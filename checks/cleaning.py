"""Filters, trims, fills and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixture as fx
from checks.registry import check, rounded, with_sql
from tripmill.functions.numeric import finite, safe_ratio
from tripmill.operators import cleaning, validation

LO, HI = fx.START_YEAR, fx.END_YEAR
IN_YEARS = f"(year({{c}}) BETWEEN {LO} AND {HI})"
KEYED = "trip_key, fare_amount, trip_distance"


@check(
    "p1_keep_positive",
    with_sql(fx.GAPS) + "SELECT trip_key, fare_amount, trip_distance FROM gaps WHERE fare_amount > 0 AND trip_distance > 0",
)
def keep_positive(spark, folder):
    return cleaning.keep_positive(fx.trips_with_gaps(spark, folder)).select("trip_key", "fare_amount", "trip_distance")


@check(
    "p2_trim_upper",
    with_sql(
        fx.TRIPS,
        "a AS (SELECT * FROM trips WHERE fare_amount > 0 AND trip_distance > 0)",
        "b AS (SELECT * FROM a WHERE fare_amount <= (SELECT round(quantile_cont(fare_amount, 0.99), 9) FROM a))",
    )
    + f"SELECT {KEYED} FROM b WHERE trip_distance <= (SELECT round(quantile_cont(trip_distance, 0.99), 9) FROM b)",
)
def trim_upper(spark, folder):
    return cleaning.clean_trips(fx.trips(spark, folder)).select("trip_key", "fare_amount", "trip_distance")


@check(
    "p3_trim_two_sided",
    with_sql(
        fx.GAPS,
        "a AS (SELECT * FROM gaps WHERE fare_amount > 0 AND trip_distance > 0)",
        "q AS (SELECT round(quantile_cont(fare_amount, 0.01), 9) AS lo, round(quantile_cont(fare_amount, 0.99), 9) AS hi FROM a)",
        "b AS (SELECT a.* FROM a, q WHERE fare_amount BETWEEN lo AND hi)",
        "r AS (SELECT round(quantile_cont(trip_distance, 0.01), 9) AS lo, round(quantile_cont(trip_distance, 0.99), 9) AS hi FROM b)",
        "c AS (SELECT b.* FROM b, r WHERE trip_distance BETWEEN lo AND hi)",
        "m AS (SELECT CAST(median(passenger_count) AS INTEGER) AS p FROM c)",
    )
    + f"SELECT {KEYED}, coalesce(passenger_count, p) AS passenger_count FROM c, m",
)
def trim_two_sided(spark, folder):
    cleaned = cleaning.clean_trips_two_sided(fx.trips_with_gaps(spark, folder))
    return cleaned.select("trip_key", "fare_amount", "trip_distance", "passenger_count")


@check(
    "p4_keep_years",
    with_sql(fx.GAPS) + f"SELECT trip_key, pickup_datetime FROM gaps WHERE coalesce({IN_YEARS.format(c='pickup_datetime')}, true)",
)
def keep_years(spark, folder):
    kept = cleaning.keep_years(fx.trips_with_gaps(spark, folder), "pickup_datetime", LO, HI)
    return kept.select("trip_key", "pickup_datetime")


@check(
    "p5_count_outside_years",
    with_sql(fx.GAPS)
    + f"SELECT count(*) FILTER (WHERE NOT {IN_YEARS.format(c='pickup_datetime')}) AS outliers FROM gaps",
)
def count_outside_years(spark, folder):
    return cleaning.count_outside_years(fx.trips_with_gaps(spark, folder), "pickup_datetime", LO, HI)


@check(
    "p6_keep_years_everywhere",
    with_sql(fx.GAPS)
    + "SELECT trip_key, pickup_datetime, dropoff_datetime FROM gaps "
    + f"WHERE coalesce({IN_YEARS.format(c='pickup_datetime')}, true) AND coalesce({IN_YEARS.format(c='dropoff_datetime')}, true)",
)
def keep_years_everywhere(spark, folder):
    kept = cleaning.keep_years_everywhere(fx.trips_with_gaps(spark, folder), LO, HI)
    return kept.select("trip_key", "pickup_datetime", "dropoff_datetime")


@check(
    "p9_validate_frame",
    "SELECT least(count(*), 1000)::BIGINT AS rows_seen, 'tips' AS missing_columns, false AS valid FROM lineitem",
)
def validate_frame(spark, folder):
    return validation.validation_report(fx.trips(spark, folder), ["fare_amount", "tips"], 1000)


@check(
    "p10_keep_large_categories",
    with_sql(fx.TRIPS, "s AS (SELECT RatecodeID, count(*) AS n FROM trips WHERE VendorID = 1 GROUP BY 1)",
             "v AS (SELECT RatecodeID FROM trips GROUP BY 1 HAVING count(*) >= 10000)")
    + "SELECT RatecodeID, count(*) AS trips FROM trips WHERE RatecodeID IN (FROM v) GROUP BY 1",
)
def keep_large_categories(spark, folder):
    kept = validation.keep_large_categories(fx.trips(spark, folder), "RatecodeID", 10000)
    return kept.groupBy("RatecodeID").agg(F.count(F.lit(1)).alias("trips"))


ROLE_COLUMNS = ["trip_key", "VendorID", "passenger_count", "trip_distance", "fare_amount", "payment_type", "RatecodeID", "trip_time_in_secs"]


@check(
    "p11_column_roles",
    with_sql(fx.TRIPS)
    + " UNION ALL ".join(
        [f"SELECT '{c}' AS \"column\", CASE WHEN count(DISTINCT {c}) < 10 THEN 'categorical' ELSE 'numeric' END AS role FROM trips" for c in ROLE_COLUMNS[1:]]
        + ["SELECT 'trip_key', 'categorical'"]
    ),
)
def column_roles(spark, folder):
    return validation.column_role_table(fx.trips(spark, folder).select(ROLE_COLUMNS))


@check(
    "p12_request_defaults",
    with_sql(fx.GAPS) + "SELECT trip_key, 5.0::DOUBLE AS trip_distance, 1.0::DOUBLE AS default_feature FROM gaps",
)
def request_defaults(spark, folder):
    bare = fx.trips_with_gaps(spark, folder).select("trip_key")
    filled, _ = validation.with_enough_features(validation.with_request_defaults(bare), ["trip_distance", "cost_per_mile"])
    return filled


@check(
    "f19_clip_iqr",
    with_sql(fx.TRIPS, "q AS (SELECT quantile_cont(fare_amount, 0.25) AS a, quantile_cont(fare_amount, 0.75) AS b FROM trips)",
             "f AS (SELECT a - 0.25 * (b - a) AS lo, b + 0.25 * (b - a) AS hi FROM q)")
    + "SELECT trip_key, round(greatest(least(fare_amount, hi), lo), 6) AS fare_amount FROM trips, f",
)
def clip_iqr(spark, folder):
    clipped = cleaning.clip_outliers(fx.trips(spark, folder), ["fare_amount", "trip_key"], "iqr", 0.25)
    return rounded(clipped.select("trip_key", "fare_amount"))


@check(
    "f20_clip_zscore",
    with_sql(fx.TRIPS, "f AS (SELECT avg(fare_amount) - stddev_samp(fare_amount) AS lo, avg(fare_amount) + stddev_samp(fare_amount) AS hi FROM trips)")
    + "SELECT trip_key, round(greatest(least(fare_amount, hi), lo), 6) AS fare_amount FROM trips, f",
)
def clip_zscore(spark, folder):
    clipped = cleaning.clip_outliers(fx.trips(spark, folder), ["fare_amount"], "zscore", 1.0)
    return rounded(clipped.select("trip_key", "fare_amount"))


def _filled(strategy_sql: str) -> str:
    return (
        with_sql(fx.GAPS, f"v AS (SELECT {strategy_sql} FROM gaps)")
        + "SELECT trip_key, round(coalesce(fare_amount, f), 6) AS fare_amount FROM gaps, v"
    )


def _fill(spark, folder, strategy):
    gaps = fx.trips_with_gaps(spark, folder).select("trip_key", "fare_amount")
    return rounded(cleaning.fill_missing(gaps, numeric_strategy=strategy, columns=["fare_amount"]))


@check("f21_fill_mean", _filled("avg(fare_amount) AS f"))
def fill_mean(spark, folder):
    return _fill(spark, folder, "mean")


@check("f21_fill_median", _filled("median(fare_amount) AS f"))
def fill_median(spark, folder):
    return _fill(spark, folder, "median")


@check("f21_fill_zero", _filled("max(0.0) AS f"))
def fill_zero(spark, folder):
    return _fill(spark, folder, "zero")


@check(
    "f22_fill_mode",
    with_sql(fx.GAPS, "c AS (SELECT payment_label, count(*) AS n FROM gaps WHERE payment_label IS NOT NULL GROUP BY 1)",
             "m AS (SELECT payment_label AS v FROM c ORDER BY n DESC, payment_label LIMIT 1)")
    + "SELECT trip_key, coalesce(payment_label, v) AS payment_label FROM gaps, m",
)
def fill_mode(spark, folder):
    gaps = fx.trips_with_gaps(spark, folder).select("trip_key", "payment_label")
    return cleaning.fill_missing(gaps, columns=["payment_label"])


@check("f22_fill_missing_label", with_sql(fx.GAPS) + "SELECT trip_key, coalesce(payment_label, 'missing') AS payment_label FROM gaps")
def fill_missing_label(spark, folder):
    gaps = fx.trips_with_gaps(spark, folder).select("trip_key", "payment_label")
    return cleaning.fill_missing(gaps, categorical_strategy="missing", columns=["payment_label"])


@check(
    "f23_null_if_not_finite",
    with_sql(fx.TRIPS)
    + "SELECT trip_key, CASE WHEN trip_time_in_secs % 7 = 0 THEN NULL ELSE fare_amount END AS fare_amount, "
    "fare_amount / nullif(trip_time_in_secs, 0) AS fare_per_second FROM trips",
)
def null_if_not_finite(spark, folder):
    trips = fx.trips(spark, folder)
    seconds = F.col("trip_time_in_secs")
    odd = F.when(seconds % 14 == 0, float("nan")).when(seconds % 7 == 0, float("inf")).otherwise(F.col("fare_amount"))
    return trips.select(
        "trip_key", finite(odd).alias("fare_amount"), safe_ratio(F.col("fare_amount"), seconds).alias("fare_per_second")
    )
