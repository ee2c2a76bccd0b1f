"""Descriptive reports, joins and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixture as fx
from checks.features import COMPONENT
from checks.registry import check, rounded, with_sql
from tripmill.functions import bins
from tripmill.operators import features, joins, reports, setops
from tripmill.sources import trips as files

FEATURED = f"featured AS ({COMPONENT.replace('SELECT trip_key,', 'SELECT trip_key, fare_amount, tip_amount,', 1)})"


def _featured(spark, folder):
    return features.add_features(fx.trips_with_gaps(spark, folder), "pickup_datetime")


@check(
    "d1_cost_by_distance_band",
    with_sql(FEATURED) + "SELECT distance_category, round(avg(cost_per_mile), 5) AS avg_cost_per_mile, count(*) AS trips FROM featured GROUP BY 1",
)
def cost_by_distance_band(spark, folder):
    return rounded(reports.cost_by_distance_band(_featured(spark, folder)), 5)


@check(
    "d2_payment_shares",
    with_sql(FEATURED) + "SELECT payment_category, count(*) AS n, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 6) AS percent FROM featured GROUP BY 1",
)
def payment_shares(spark, folder):
    return rounded(reports.payment_shares(_featured(spark, folder)))


@check(
    "d3_tipping_by_payment",
    with_sql(FEATURED) + "SELECT payment_category, round(sum(tip_amount) / sum(fare_amount) * 100, 6) AS tip_percent, round(avg(fare_amount), 6) AS avg_fare FROM featured GROUP BY 1",
)
def tipping_by_payment(spark, folder):
    return rounded(reports.tipping_by_payment(_featured(spark, folder)))


@check(
    "d4_passenger_group_report",
    with_sql(FEATURED)
    + "SELECT passenger_group, count(*) AS trips, round(avg(fare_amount), 6) AS avg_fare, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 6) AS percent FROM featured GROUP BY 1",
)
def passenger_group_report(spark, folder):
    return rounded(reports.passenger_group_report(_featured(spark, folder)))


def _busiest(end: str, column: str) -> str:
    return f"(SELECT '{end}' AS \"end\", {column} AS zone, count(*) AS trips FROM routes GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 5)"


@check(
    "d5_top_zones",
    with_sql(fx.ROUTES) + "FROM " + _busiest("pickup", "PULocationID") + " UNION ALL FROM " + _busiest("dropoff", "DOLocationID"),
)
def top_zones(spark, folder):
    return reports.top_zones(fx.routes(spark, folder), 5)


ROUTE_TABLE = (
    "table_of_routes AS (SELECT PULocationID, DOLocationID, count(*) AS trips, avg(fare_amount) AS avg_fare, avg(trip_distance) AS avg_distance, "
    "sum(fare_amount) / sum(trip_distance) AS cost_per_mile FROM routes GROUP BY 1, 2)"
)


@check(
    "d6_route_table",
    with_sql(fx.ROUTES, ROUTE_TABLE)
    + "SELECT PULocationID, DOLocationID, trips, round(avg_fare, 6) AS avg_fare, round(avg_distance, 6) AS avg_distance, round(cost_per_mile, 6) AS cost_per_mile FROM table_of_routes",
)
def route_table(spark, folder):
    return rounded(reports.route_table(fx.routes(spark, folder)))


@check(
    "d7_route_inequality",
    with_sql(
        fx.ROUTES, ROUTE_TABLE,
        f"banded AS (SELECT *, {fx.DISTANCE.format(d='(avg_distance - 5)')} AS band FROM table_of_routes WHERE trips >= 10)",
        "compared AS (SELECT *, avg(cost_per_mile) OVER (PARTITION BY band) AS band_cost_per_mile FROM banded)",
    )
    + "SELECT PULocationID, DOLocationID, trips, round(avg_fare, 6) AS avg_fare, round(avg_distance, 6) AS avg_distance, round(cost_per_mile, 6) AS cost_per_mile, "
    "band, round(band_cost_per_mile, 6) AS band_cost_per_mile, round(cost_per_mile / band_cost_per_mile, 6) AS cost_ratio FROM compared "
    "ORDER BY cost_per_mile / band_cost_per_mile DESC, 1, 2 LIMIT 20",
)
def route_inequality(spark, folder):
    # Averages of this table lie between 10 and 15 miles; moving them spreads them over two bands.
    return rounded(reports.route_inequality(fx.routes(spark, folder), lambda d: bins.distance_category(d - 5), 10, 20))


@check(
    "d8_rate_code_report",
    with_sql(fx.TRIPS)
    + "SELECT RatecodeID, count(*) AS trips, round(avg(fare_amount), 6) AS avg_fare, round(sum(fare_amount) / sum(trip_distance), 6) AS cost_per_mile, "
    "round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 6) AS percent FROM trips GROUP BY 1",
)
def rate_code_report(spark, folder):
    return rounded(reports.rate_code_report(fx.trips(spark, folder)))


@check(
    "j1_label_payments",
    with_sql(fx.TRIPS) + f"SELECT trip_key, payment_type, {fx.PAYMENT.format(c='payment_type')} AS payment_label FROM trips",
)
def label_payments(spark, folder):
    return joins.label_payments(fx.trips(spark, folder).select("trip_key", "payment_type"))


@check("j2_above_threshold", with_sql(fx.TRIPS) + "SELECT trip_key, fare_amount FROM trips WHERE fare_amount > (SELECT round(avg(fare_amount), 6) FROM trips)")
def above_threshold(spark, folder):
    trips = fx.trips(spark, folder).select("trip_key", "fare_amount")
    return joins.above_threshold(trips, "fare_amount", rounded(trips.agg(F.avg("fare_amount").alias("mean"))))


@check(
    "j4_attach_zones",
    with_sql(fx.ROUTES, fx.ZONES)
    + "SELECT trip_key, PULocationID, DOLocationID, p.Borough AS pickup_borough, p.Zone AS pickup_zone, d.Borough AS dropoff_borough, d.Zone AS dropoff_zone "
    "FROM routes LEFT JOIN zones p ON PULocationID = p.LocationID LEFT JOIN zones d ON DOLocationID = d.LocationID",
)
def attach_zones(spark, folder):
    return joins.attach_zones(fx.routes(spark, folder).select("trip_key", "PULocationID", "DOLocationID"), fx.zones(spark, folder))


COMMON = "trip_key, VendorID, trip_time_in_secs, passenger_count, trip_distance, fare_amount, tip_amount, payment_type, RatecodeID"


@check("u1_union_taxi_trips", with_sql(fx.TRIPS) + f"SELECT {COMMON} FROM trips")
def union_taxi_trips(spark, folder):
    return setops.create_union_view(fx.yellow(spark, folder), fx.green(spark, folder), "all_taxi_trips")


@check(
    "u2_union_fhv_trips",
    "SELECT o_orderkey AS trip_id, o_orderdate AS pickup_datetime FROM orders UNION ALL SELECT event_id, ts FROM events",
)
def union_fhv_trips(spark, folder):
    return setops.create_union_view(fx.fhv(spark, folder), fx.hvfhv(spark, folder), "all_fhv_trips")


@check(
    "u5_union_with_times",
    with_sql(fx.TRIPS.replace("SELECT ", "SELECT CASE WHEN l_linestatus = 'F' THEN 'yellow' ELSE 'green' END AS trip_type, ", 1))
    + f"SELECT {COMMON}, pickup_datetime, dropoff_datetime, trip_type FROM trips",
)
def union_with_times(spark, folder):
    return setops.union_trips({"yellow": fx.yellow(spark, folder), "green": fx.green(spark, folder)})


@check("s1_scan_trip_files", "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem")
def scan_trip_files(spark, folder):
    return files.scan_trips(spark, folder, "LINEITEM").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@check(
    "s2_append_by_name",
    "SELECT c_custkey AS key, c_acctbal AS balance, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_acctbal, NULL FROM supplier",
)
def append_by_name(spark, folder):
    customer = fx.table(spark, folder, "customer").select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    supplier = fx.table(spark, folder, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("key"))
    return files.append_by_name([customer, supplier])


FILES = "filed AS (SELECT *, year(pickup_datetime) * 10 + RatecodeID % 2 AS file FROM gaps)"


@check(
    "s6_rows_of_overlapping_files",
    with_sql(
        fx.GAPS, FILES,
        "kept AS (SELECT file FROM filed GROUP BY 1 HAVING coalesce(NOT (year(max(pickup_datetime)) < 1996 OR year(min(pickup_datetime)) > 1998), true))",
    )
    + "SELECT trip_key, CAST(file AS INTEGER) AS file FROM filed WHERE file IN (SELECT file FROM kept WHERE file IS NOT NULL)",
)
def rows_of_overlapping_files(spark, folder):
    named = fx.trips_with_gaps(spark, folder).withColumn("file", F.year("pickup_datetime") * 10 + F.col("RatecodeID") % 2)
    return files.rows_of_overlapping_files(named, "pickup_datetime", "file", 1996, 1998).select("trip_key", "file")


@check(
    "s15_derive_zone_lookup",
    "SELECT n_nationkey::BIGINT AS LocationID, r_name AS Borough, n_name AS Zone FROM nation JOIN region ON n_regionkey = r_regionkey",
)
def derive_zone_lookup(spark, folder):
    from tripmill.sources.zones import derive_lookup

    named = fx.zones(spark, folder).select(F.col("Borough").alias("borough_name"), F.col("Zone").alias("zone_name"), F.col("LocationID").alias("objectid"))
    return derive_lookup(named)


@check(
    "s15_numbered_zone_lookup",
    "SELECT row_number() OVER (ORDER BY s_name) AS LocationID, 'Unknown' AS Borough, s_name AS Zone FROM supplier",
)
def numbered_zone_lookup(spark, folder):
    from tripmill.sources.zones import derive_lookup

    return derive_lookup(fx.table(spark, folder, "supplier").select(F.col("s_name").alias("zone")))


@check(
    "s19_ingest_table",
    with_sql(
        fx.TRIPS,
        "a AS (SELECT trip_key, fare_amount, trip_distance FROM trips WHERE fare_amount > 0 AND trip_distance > 0)",
        "b AS (SELECT * FROM a WHERE fare_amount <= (SELECT quantile_cont(fare_amount, 0.99) FROM a))",
    )
    + "SELECT trip_key, fare_amount, trip_distance FROM b WHERE trip_distance <= (SELECT quantile_cont(trip_distance, 0.99) FROM b)",
)
def ingest_table(spark, folder):
    """A stored table, ingested whole and cleaned."""
    from tripmill.plans.ingest import ingest

    fx.trips(spark, folder).createOrReplaceTempView("trips_to_ingest")
    return ingest(spark, "trips_to_ingest").select("trip_key", "fare_amount", "trip_distance")
