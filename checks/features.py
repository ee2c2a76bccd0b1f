"""Derived columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixture as fx
from checks.registry import NUDGE, check, rounded, with_sql
from tripmill.functions import bins, numeric, temporal
from tripmill.operators import features

HOUR = "hour(pickup_datetime)"


def _trips(spark, folder):
    return fx.trips(spark, folder)


def _pick(spark, folder, **columns):
    return _trips(spark, folder).select("trip_key", *[c.alias(n) for n, c in columns.items()])


@check(
    "f1_parse_timestamp",
    "SELECT event_id, date_trunc('second', ts) AS strict, CASE WHEN event_id % 5 <> 0 THEN date_trunc('second', ts) END AS lenient FROM events",
)
def parse_timestamp(spark, folder):
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    broken = F.when(F.col("event_id") % 5 == 0, F.lit("no time")).otherwise(text)
    return fx.table(spark, folder, "events").select(
        "event_id",
        temporal.parse_timestamp(text).alias("strict"),
        temporal.parse_timestamp(broken, strict=False).alias("lenient"),
    )


@check(
    "f2_pickup_parts",
    with_sql(fx.TRIPS)
    + f"SELECT trip_key, CAST({HOUR} AS INTEGER) AS pickup_hour, CAST(day(pickup_datetime) AS INTEGER) AS pickup_day, "
    "CAST(month(pickup_datetime) AS INTEGER) AS pickup_month, CAST(isodow(pickup_datetime) - 1 AS INTEGER) AS pickup_dayofweek FROM trips",
)
def pickup_parts(spark, folder):
    return _pick(spark, folder, **temporal.pickup_parts(F.col("pickup_datetime")))


@check(
    "f3_is_weekend",
    with_sql(fx.TRIPS)
    + "SELECT trip_key, isodow(pickup_datetime) >= 6 AS flag, CAST(isodow(pickup_datetime) >= 6 AS INTEGER) AS number FROM trips",
)
def weekend(spark, folder):
    flag = temporal.is_weekend(F.col("pickup_datetime"))
    return _pick(spark, folder, flag=flag, number=flag.cast("int"))


@check("f4_time_of_day", with_sql(fx.TRIPS) + f"SELECT trip_key, {fx.TIME_OF_DAY.format(h=HOUR)} AS time_of_day FROM trips")
def time_of_day(spark, folder):
    return _pick(spark, folder, time_of_day=temporal.time_of_day(F.hour("pickup_datetime")))


SPEED = "trip_distance / (nullif(trip_time_in_secs, 0) / 3600.0::DOUBLE)"


@check(
    "f5_speed",
    with_sql(fx.TRIPS, f"s AS (SELECT trip_key, {SPEED} AS speed FROM trips)", "m AS (SELECT median(speed) AS v FROM s)")
    + "SELECT trip_key, round(coalesce(speed, v), 6) AS speed FROM s, m",
)
def speed(spark, folder):
    return rounded(features.add_features(_trips(spark, folder), "pickup_datetime").select("trip_key", "speed"))


@check("f6_distance_category", with_sql(fx.TRIPS) + f"SELECT trip_key, {fx.DISTANCE.format(d='(trip_distance - 1)')} AS distance_category FROM trips")
def distance_category(spark, folder):
    return _pick(spark, folder, distance_category=bins.distance_category(F.col("trip_distance") - 1))


@check("f7_narrow_distance_category", with_sql(fx.TRIPS) + f"SELECT trip_key, {fx.NARROW_DISTANCE.format(d='(trip_distance * 5 - 5)')} AS distance_category FROM trips")
def narrow_distance_category(spark, folder):
    return _pick(spark, folder, distance_category=bins.narrow_distance_category(F.col("trip_distance") * 5 - 5))


@check(
    "f8_cost_per_mile",
    with_sql(
        fx.TRIPS,
        "d AS (SELECT trip_key, fare_amount, trip_distance - 0.5 AS trip_distance FROM trips)",
        "c AS (SELECT trip_key, fare_amount / nullif(trip_distance, 0) AS cost FROM d)",
        "m AS (SELECT median(cost) AS v FROM c)",
    )
    + "SELECT trip_key, round(coalesce(cost, v), 6) AS cost_per_mile FROM c, m",
)
def cost_per_mile(spark, folder):
    trips = _trips(spark, folder).withColumn("trip_distance", F.col("trip_distance") - 0.5)
    return rounded(features.add_features(trips, "none").select("trip_key", "cost_per_mile"))


@check(
    "f9_floored_cost_per_mile",
    with_sql(fx.TRIPS) + "SELECT trip_key, fare_amount / greatest(trip_distance - 0.5, 0.1::DOUBLE) AS cost_per_mile FROM trips",
)
def floored_cost_per_mile(spark, folder):
    cost = numeric.floored_cost_per_mile(F.col("fare_amount"), F.col("trip_distance") - 0.5)
    return _pick(spark, folder, cost_per_mile=cost)


@check("f10_passenger_group", with_sql(fx.GAPS) + f"SELECT trip_key, {fx.PASSENGERS.format(p='passenger_count')} AS passenger_group FROM gaps")
def passenger_group(spark, folder):
    return fx.trips_with_gaps(spark, folder).select("trip_key", bins.passenger_group(F.col("passenger_count")).alias("passenger_group"))


@check("f11_narrow_passenger_group", with_sql(fx.GAPS) + f"SELECT trip_key, {fx.NARROW_PASSENGERS.format(p='(passenger_count * 2 - 2)')} AS passenger_group FROM gaps")
def narrow_passenger_group(spark, folder):
    group = bins.narrow_passenger_group(F.col("passenger_count") * 2 - 2)
    return fx.trips_with_gaps(spark, folder).select("trip_key", group.alias("passenger_group"))


@check("f12_payment_category", with_sql(fx.TRIPS) + f"SELECT trip_key, {fx.PAYMENT.format(c='nullif(payment_type, 3)')} AS payment_category FROM trips")
def payment_category(spark, folder):
    return _pick(spark, folder, payment_category=bins.payment_category(F.nullif(F.col("payment_type"), F.lit(3))))


@check("f13_cash_or_not", with_sql(fx.TRIPS) + "SELECT trip_key, CASE WHEN nullif(payment_type, 3) = 2 THEN 'cash' ELSE 'non_cash' END AS payment_category FROM trips")
def cash_or_not(spark, folder):
    return _pick(spark, folder, payment_category=bins.cash_or_not(F.nullif(F.col("payment_type"), F.lit(3))))


CUTS = "cuts AS (SELECT round(quantile_cont(fare_amount, 0.33), 9) AS a, round(quantile_cont(fare_amount, 0.66), 9) AS b FROM {t})"
FARE = "CASE WHEN fare_amount <= a THEN 'low' WHEN fare_amount <= b THEN 'medium' WHEN fare_amount > b THEN 'high' END"


@check("f14_fare_category", with_sql(fx.GAPS, CUTS.format(t="gaps")) + f"SELECT trip_key, {FARE} AS fare_category FROM gaps, cuts")
def fare_category(spark, folder):
    return features.add_fare_category(fx.trips_with_gaps(spark, folder)).select("trip_key", "fare_category")


@check("f14_fare_category_without_fare", with_sql(fx.TRIPS) + "SELECT trip_key, 'medium' AS fare_category FROM trips")
def fare_category_without_fare(spark, folder):
    return features.add_fare_category(_trips(spark, folder).select("trip_key"))


@check("f15_same_location", with_sql(fx.ROUTES) + "SELECT trip_key, PULocationID = DOLocationID AS is_same_location FROM routes")
def same_location(spark, folder):
    return fx.routes(spark, folder).select("trip_key", (F.col("PULocationID") == F.col("DOLocationID")).alias("is_same_location"))


@check(
    "f16_month_parts",
    with_sql(fx.TRIPS)
    + "SELECT trip_key, CAST(date_trunc('month', pickup_datetime) AS TIMESTAMP) AS month_start, CAST(year(pickup_datetime) AS INTEGER) AS pickup_year, "
    "CAST(month(pickup_datetime) AS INTEGER) AS pickup_month FROM trips",
)
def month_parts(spark, folder):
    moment = F.col("pickup_datetime")
    return _pick(spark, folder, month_start=temporal.month_start(moment), pickup_year=F.year(moment), pickup_month=F.month(moment))


@check("f17_trip_seconds", with_sql(fx.TRIPS) + "SELECT trip_key, CAST(epoch(dropoff_datetime - pickup_datetime) AS BIGINT) AS seconds FROM trips")
def elapsed(spark, folder):
    return _pick(spark, folder, seconds=temporal.trip_seconds(F.col("pickup_datetime"), F.col("dropoff_datetime")))


@check(
    "f18_seconds_at_speed",
    with_sql(fx.TRIPS)
    + "SELECT trip_key, CAST(trunc(trip_distance / (10 + trip_time_in_secs % 21) * 3600) AS INTEGER) AS seconds FROM trips",
)
def seconds_at_speed(spark, folder):
    mph = (F.col("trip_time_in_secs") % 21 + 10).cast("double")
    return _pick(spark, folder, seconds=temporal.seconds_at_speed(F.col("trip_distance"), mph))


@check("f24_round_half_even", "SELECT l_orderkey, l_linenumber, l_partkey, round_even(l_quantity / 8.0, 2) AS rounded FROM lineitem")
def round_half_even(spark, folder):
    lines = fx.table(spark, folder, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", numeric.round_half_even(F.col("l_quantity") / 8.0).alias("rounded"))


@check(
    "f25_prediction_errors",
    with_sql(fx.TRIPS)
    + "SELECT trip_key, (2.5 + 2.5 * trip_distance) - fare_amount AS error, abs((2.5 + 2.5 * trip_distance) - fare_amount) AS abs_error, "
    "round(abs((fare_amount - (2.5 + 2.5 * trip_distance)) / fare_amount) * 100, 6) AS percent_error FROM trips",
)
def prediction_errors(spark, folder):
    guess, fare = F.lit(2.5) + F.lit(2.5) * F.col("trip_distance"), F.col("fare_amount")
    error = numeric.error(fare, guess)
    percent = F.round(numeric.absolute_percentage_error(fare, guess) + float(NUDGE), 6)
    return _pick(spark, folder, error=error, abs_error=F.abs(error), percent_error=percent)


@check("f26_distance_cluster", with_sql(fx.TRIPS) + f"SELECT trip_key, {fx.RULE_CLUSTER.format(d='trip_distance')} AS cluster FROM trips")
def distance_cluster(spark, folder):
    return _pick(spark, folder, cluster=bins.distance_cluster(F.col("trip_distance")))


COMPONENT = (
    with_sql(
        fx.GAPS,
        f"r AS (SELECT *, {SPEED} AS raw_speed, fare_amount / nullif(trip_distance, 0) AS raw_cost FROM gaps)",
        "m AS (SELECT median(raw_speed) AS ms, median(raw_cost) AS mc FROM r)",
    )
    + f"SELECT trip_key, CAST({HOUR} AS INTEGER) AS pickup_hour, CAST(day(pickup_datetime) AS INTEGER) AS pickup_day, "
    "CAST(month(pickup_datetime) AS INTEGER) AS pickup_month, CAST(isodow(pickup_datetime) - 1 AS INTEGER) AS pickup_dayofweek, "
    f"CAST(isodow(pickup_datetime) >= 6 AS INTEGER) AS is_weekend, {fx.TIME_OF_DAY.format(h=HOUR)} AS time_of_day, "
    "round(coalesce(raw_speed, ms), 6) AS speed, round(coalesce(raw_cost, mc), 6) AS cost_per_mile, "
    f"{fx.DISTANCE.format(d='trip_distance')} AS distance_category, {fx.PASSENGERS.format(p='passenger_count')} AS passenger_group, "
    f"{fx.PAYMENT.format(c='payment_type')} AS payment_category FROM r, m"
)
COMPONENT_COLUMNS = [
    "trip_key", "pickup_hour", "pickup_day", "pickup_month", "pickup_dayofweek", "is_weekend", "time_of_day",
    "speed", "cost_per_mile", "distance_category", "passenger_group", "payment_category",
]


@check("f27_training_features", COMPONENT)
def training_features(spark, folder):
    made = features.add_features(fx.trips_with_gaps(spark, folder), "pickup_datetime")
    return rounded(made.select(COMPONENT_COLUMNS))


@check(
    "f28_study_features",
    with_sql(fx.ROUTES, CUTS.format(t="routes"))
    + "SELECT trip_key, fare_amount / greatest(trip_distance, 0.1::DOUBLE) AS cost_per_mile, "
    f"{fx.NARROW_DISTANCE.format(d='trip_distance')} AS distance_category, {fx.NARROW_PASSENGERS.format(p='passenger_count')} AS passenger_group, "
    "CASE WHEN payment_type = 2 THEN 'cash' ELSE 'non_cash' END AS payment_category, "
    f"CAST({HOUR} AS INTEGER) AS pickup_hour, CAST(day(pickup_datetime) AS INTEGER) AS pickup_day, "
    "CAST(isodow(pickup_datetime) - 1 AS INTEGER) AS pickup_dayofweek, isodow(pickup_datetime) >= 6 AS is_weekend, "
    f"{fx.TIME_OF_DAY.format(h=HOUR)} AS time_of_day, PULocationID = DOLocationID AS is_same_location, {FARE} AS fare_category FROM routes, cuts",
)
def study_features(spark, folder):
    # Every trip has its route, so the cut points of the trips are those of the routes.
    cuts = features.fare_cuts(fx.trips(spark, folder))
    made = features.add_study_features(fx.routes(spark, folder), cuts=cuts)
    return made.select(
        "trip_key", "cost_per_mile", "distance_category", "passenger_group", "payment_category", "pickup_hour",
        "pickup_day", "pickup_dayofweek", "is_weekend", "time_of_day", "is_same_location", "fare_category",
    )
