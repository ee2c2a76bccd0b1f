"""Files written from the driver's tables and read back."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from checks import fixture as fx
from checks.features import CUTS, FARE
from checks.registry import NUDGE, check, rounded, with_sql
from tripmill.functions import bins
from tripmill.models import coreset, regress
from tripmill.operators import features
from tripmill.operators.sampling import split
from tripmill.operators.setops import normalise_times
from tripmill.plans import dashboard
from tripmill.plans.ingest import write_by_month
from tripmill.session import checkpoint_folder, cut_lineage
from tripmill.sources import store, tables, trips, weather, zones


def _folder(spark, kind: str) -> str:
    """A new folder that all executors share."""
    return f"{checkpoint_folder(spark)}/{kind}-{uuid.uuid4().hex}"


@check("s3_read_csv", "SELECT event_id, user_id, event_type, value FROM events")
def read_csv(spark, folder):
    path = _folder(spark, "csv")
    rows = fx.table(spark, folder, "events").select("event_id", "user_id", "event_type", "value")
    rows.write.mode("overwrite").option("header", True).csv(path)
    return weather.read_csv(spark, path).select(
        F.col("event_id").cast("bigint"), F.col("user_id").cast("bigint"), "event_type", "value"
    )


@check("s13_zone_csv", with_sql(fx.ZONES) + "SELECT LocationID, Borough, Zone FROM zones")
def zone_csv(spark, folder):
    path = _folder(spark, "zones")
    zones.write_lookup(fx.zones(spark, folder), path)
    return zones.read_lookup(spark, path)


@check(
    "s6_scan_years",
    with_sql(fx.TRIPS) + "SELECT trip_key, pickup_datetime FROM trips WHERE year(pickup_datetime) BETWEEN 1996 AND 1998",
)
def scan_years(spark, folder):
    """Trip files laid out by year and month; only the files of the years are opened."""
    path = _folder(spark, "trips")
    write_by_month({"yellow": normalise_times(fx.yellow(spark, folder))}, path)
    green = _folder(spark, "trips")
    write_by_month({"green": normalise_times(fx.green(spark, folder))}, green)
    both = [trips.scan_years(spark, place, "part", 1996, 1998).select("trip_key", "pickup_datetime") for place in (path, green)]
    return both[0].unionByName(both[1])


NYC = "extract_day AS (SELECT o_orderkey, o_orderdate, o_totalprice, o_orderkey % 7 AS station FROM orders)"


@check(
    "s4_weather_load",
    with_sql(NYC) + "SELECT CAST(station AS INTEGER) AS station, count(*) AS readings, round(sum(o_totalprice), 2) AS total, "
    "CAST(min(o_orderdate) AS DATE) AS first_day, 'loaded' AS status, count(*) AS loaded FROM extract_day WHERE station <> 3 GROUP BY station "
    "UNION ALL SELECT 3, 0, NULL, NULL, 'skipped', 0",
)
def weather_load(spark, folder):
    """Readings in a file for each station, one of them with text for numbers: loaded in shared jobs, reported by file."""
    path = _folder(spark, "weather")
    rows = fx.table(spark, folder, "orders").select(
        (F.col("o_orderkey") % 7).alias("station"), F.col("o_orderdate").cast("date").cast("string").alias("obs_date"), F.col("o_totalprice").cast("string").alias("reading")
    )
    for station in range(7):
        one = rows.filter(F.col("station") == station).withColumn("reading", F.lit("warm") if station == 3 else F.col("reading"))
        one.coalesce(1).write.option("header", True).csv(f"{path}/raw{station}")
    files = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    names = spark._jvm.org.apache.hadoop.fs.Path
    for station in range(7):
        for found in files.globStatus(names(f"{path}/raw{station}/part-*")):
            files.rename(found.getPath(), names(f"{path}/ny_weather_{station}.csv"))
    table, report = weather.load_weather(spark, path)
    loaded = table.groupBy("station").agg(F.count(F.lit(1)).alias("readings"), F.round(F.sum("reading"), 2).alias("total"), F.min("obs_date").alias("first_day"))
    told = report.select(F.regexp_extract("file", r"(\d)", 1).cast("int").alias("station"), F.split("status", ":")[0].alias("status"), F.col("rows").alias("loaded"))
    return told.join(loaded, "station", "left").select("station", F.coalesce("readings", F.lit(0)).alias("readings"), "total", "first_day", "status", "loaded")


@check(
    "s8_trip_table",
    with_sql(fx.TRIPS) + "SELECT CAST(VendorID AS INTEGER) AS VendorID, count(*) AS trips, round(sum(fare_amount), 0) AS fares, count(*) AS without_flag FROM trips GROUP BY VendorID",
)
def trip_table(spark, folder):
    """The fixed-schema table, created anew and filled; columns that the rows lack are null."""
    name = f"trips_{uuid.uuid4().hex}"
    tables.create_trip_table(spark, name)
    tables.insert_trips(fx.trips(spark, folder), name)
    sums = spark.table(name).groupBy("VendorID").agg(
        F.count(F.lit(1)).alias("trips"), F.round(F.sum("fare_amount") + F.lit(float(NUDGE)), 0).alias("fares"), F.count_if(F.col("store_and_fwd_flag").isNull()).alias("without_flag")
    )
    made = cut_lineage(sums)
    spark.sql(f"DROP TABLE {name}")
    return made


@check(
    "s23_saved_model",
    with_sql(fx.TRIPS, f"f AS (SELECT regr_slope(fare_amount, trip_distance) AS slope, regr_intercept(fare_amount, trip_distance) AS base FROM trips WHERE {fx.BUCKET.format(key='trip_key', n=100)} < 80)")
    + "SELECT trip_key, round(base + slope * trip_distance, 5) AS predicted_fare FROM trips, f",
)
def saved_model(spark, folder):
    """Fares predicted by a model that was saved and loaded again."""
    trips_ = fx.trips(spark, folder)
    train, _ = split(trips_, "trip_key")
    path = _folder(spark, "model")
    store.save_model(regress.fit_regressor(train, [], ["trip_distance"], regress.linear_regressor()), path)
    return rounded(regress.predict(store.load_model(spark, path), trips_).select("trip_key", "predicted_fare"), 5)


@check(
    "j3_attach_predictions",
    with_sql(fx.TRIPS) + "SELECT trip_key, trip_distance, CAST(CASE WHEN trip_distance < 5 THEN 0 WHEN trip_distance < 10 THEN 1 ELSE 2 END AS INTEGER) AS cluster FROM trips",
)
def attach_predictions(spark, folder):
    """Clusters attached by a fitted model's own columns, not by position: centres that cut where the rule of clusters does."""
    rows = fx.trips(spark, folder).select("trip_key", "trip_distance")
    # A distance is nearer to the next centre from the middle between two on; grid distances are halves.
    centres = np.array([[2.25], [7.25], [12.25]])
    assembler = VectorAssembler(inputCols=["trip_distance"], outputCol="v")
    return coreset.as_model(spark, centres, "v").transform(assembler.transform(rows)).drop("v")


@check(
    "v3_dashboard",
    with_sql(fx.TRIPS, CUTS.format(t="trips"), f"c AS (SELECT {FARE} AS fare_category FROM trips, cuts)") + "SELECT fare_category, count(*) AS trips, CAST(8 AS BIGINT) AS tables FROM c GROUP BY fare_category",
)
def dashboard_tables(spark, folder):
    """The chart tables written under one folder; the fare distribution is read back, with the number of tables."""
    rows = features.add_fare_category(features.add_features(fx.trips(spark, folder), "pickup_datetime"))
    distance = F.col("trip_distance")
    scored = rows.withColumns({"cluster": bins.distance_cluster(distance), "predicted_fare": distance * 3, "predicted_fare_category": F.col("fare_category")})
    paths = dashboard.write_dashboard(scored, _folder(spark, "dashboard"), "trip_key", ["trip_distance", "fare_amount"])
    counts = spark.read.parquet(next(path for path in paths if path.endswith("fare_distribution")))
    return counts.select("fare_category", F.col(counts.columns[1]).cast("bigint").alias("trips"), F.lit(len(paths)).cast("bigint").alias("tables"))
