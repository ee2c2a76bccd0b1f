"""Descriptive trip reports: payment, passengers, zones, routes, rate codes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.operators.joins import lookup_map
from tripmill.operators.profiling import value_shares


def cost_by_distance_band(df: DataFrame, band: str = "distance_category") -> DataFrame:
    return df.groupBy(band).agg(F.avg("cost_per_mile").alias("avg_cost_per_mile"), F.count(F.lit(1)).alias("trips"))


def payment_shares(df: DataFrame) -> DataFrame:
    return value_shares(df, "payment_category")


def tipping_by_payment(df: DataFrame) -> DataFrame:
    return df.groupBy("payment_category").agg(
        (F.try_divide(F.sum("tip_amount"), F.sum("fare_amount")) * 100).alias("tip_percent"),
        F.avg("fare_amount").alias("avg_fare"),
    )


def _share_of_all(grouped: DataFrame) -> DataFrame:
    total = grouped.agg(F.sum("trips")).scalar()
    return grouped.withColumn("percent", F.col("trips") * 100.0 / total)


def passenger_group_report(df: DataFrame) -> DataFrame:
    grouped = df.groupBy("passenger_group").agg(
        F.count(F.lit(1)).alias("trips"), F.avg("fare_amount").alias("avg_fare")
    )
    return _share_of_all(grouped)


def top_zones(df: DataFrame, k: int = 10) -> DataFrame:
    """The k busiest pickup zones and the k busiest dropoff zones; each side reads one column."""
    sides = []
    for end, column in (("pickup", "PULocationID"), ("dropoff", "DOLocationID")):
        counted = df.groupBy(F.col(column).alias("zone")).agg(F.count(F.lit(1)).alias("trips"))
        top = counted.orderBy(F.desc("trips"), F.asc("zone")).limit(k)
        sides.append(top.select(F.lit(end).alias("end"), "zone", "trips"))
    return sides[0].unionByName(sides[1])


def route_table(df: DataFrame) -> DataFrame:
    """Trips, average fare, distance and cost per mile of every pickup-dropoff pair."""
    return df.groupBy("PULocationID", "DOLocationID").agg(
        F.count(F.lit(1)).alias("trips"),
        F.avg("fare_amount").alias("avg_fare"),
        F.avg("trip_distance").alias("avg_distance"),
        F.try_divide(F.sum("fare_amount"), F.sum("trip_distance")).alias("cost_per_mile"),
    )


def route_inequality(df: DataFrame, band, min_trips: int = 10, k: int = 20) -> DataFrame:
    """Routes that cost most per mile against routes of a similar distance.

    ``band`` maps the average distance column to a distance band. The band means are
    a handful of values that the routes look up by key.
    """
    routes = route_table(df).filter(F.col("trips") >= min_trips)
    routes = routes.withColumn("band", band(F.col("avg_distance")))
    means = routes.groupBy("band").agg(F.avg("cost_per_mile").alias("band_cost_per_mile"))
    lookup = lookup_map(means.filter(F.col("band").isNotNull()), "band", "band_cost_per_mile")
    compared = (
        routes.filter(F.col("band").isNotNull())
        .withColumn("band_cost_per_mile", lookup[F.col("band")])
        .withColumn("cost_ratio", F.try_divide(F.col("cost_per_mile"), F.col("band_cost_per_mile")))
    )
    return compared.orderBy(F.desc("cost_ratio"), "PULocationID", "DOLocationID").limit(k)


def rate_code_report(df: DataFrame) -> DataFrame:
    grouped = df.groupBy("RatecodeID").agg(
        F.count(F.lit(1)).alias("trips"),
        F.avg("fare_amount").alias("avg_fare"),
        F.try_divide(F.sum("fare_amount"), F.sum("trip_distance")).alias("cost_per_mile"),
    )
    return _share_of_all(grouped)
