"""Made-up trips. Every value comes from a hash of the row's id, so a trip is the
same on any cluster and the rows are generated where they are used."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.functions.bins import distance_cluster
from tripmill.functions.hashing import hash_choice, hash_normal, hash_range
from tripmill.functions.numeric import safe_ratio
from tripmill.functions.temporal import seconds_at_speed, trip_seconds

# Start of the hourly pickups.
FIRST_PICKUP = "2024-01-01 00:00:00"
# Mean and deviation of distance and fare of the three modes.
DISTANCE_MODES = [(3.0, 1.0), (8.0, 1.5), (15.0, 2.0)]
FARE_MODES = [(10.0, 2.0), (25.0, 5.0), (45.0, 7.0)]
# The fare formula.
BASE_FARE, PER_MILE, PER_MINUTE = 2.50, 2.50, 0.50
RUSH_FACTOR, NIGHT_FACTOR = 1.2, 1.3


def trip_ids(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(1, n + 1)


def _pick(key: Column, salt: str, names: list[str]) -> Column:
    return F.array(*[F.lit(n) for n in names])[hash_choice(key, salt, 0, len(names) - 1)]


def synthetic_trips(ids: DataFrame, by_speed: bool = False) -> DataFrame:
    """Trips with uniform fields and hourly pickups for a column of ids.

    Dropoff is an hour after pickup; ``by_speed`` instead takes 10 to 30 mph.
    """
    key = F.col("id")
    first = F.to_timestamp_ntz(F.lit(FIRST_PICKUP))
    pickup = F.timestamp_add("HOUR", (key - 1).cast("int"), first)
    drawn = ids.select(
        "id",
        hash_choice(key, "vendor", 1, 2).alias("VendorID"),
        pickup.alias("tpep_pickup_datetime"),
        hash_choice(key, "passengers", 1, 6).alias("passenger_count"),
        hash_range(key, "distance", 0.5, 20).alias("trip_distance"),
        hash_choice(key, "rate", 1, 6).alias("RatecodeID"),
        _pick(key, "flag", ["Y", "N"]).alias("store_and_fwd_flag"),
        hash_choice(key, "from", 1, 264).alias("PULocationID"),
        hash_choice(key, "to", 1, 264).alias("DOLocationID"),
        hash_choice(key, "payment", 1, 4).alias("payment_type"),
        hash_range(key, "fare", 2.5, 100).alias("fare_amount"),
        hash_range(key, "extra", 0, 5).alias("extra"),
        hash_range(key, "tax", 0, 1).alias("mta_tax"),
        hash_range(key, "tip", 0, 20).alias("tip_amount"),
        hash_range(key, "tolls", 0, 10).alias("tolls_amount"),
        hash_range(key, "surcharge", 0, 1).alias("improvement_surcharge"),
        hash_range(key, "total", 5, 150).alias("total_amount"),
    )
    pickup, distance = F.col("tpep_pickup_datetime"), F.col("trip_distance")
    if by_speed:
        seconds = seconds_at_speed(distance, hash_range(key, "mph", 10, 30))
        return drawn.withColumn("trip_time_in_secs", seconds).withColumn(
            "tpep_dropoff_datetime", F.timestamp_add("SECOND", "trip_time_in_secs", pickup)
        )
    dropoff = F.timestamp_add("HOUR", F.lit(1), pickup)
    return drawn.withColumn("tpep_dropoff_datetime", dropoff).withColumn(
        "trip_time_in_secs", trip_seconds(pickup, F.col("tpep_dropoff_datetime")).cast("int")
    )


def _calendar(key: Column) -> list[Column]:
    return [
        hash_choice(key, "hour", 0, 23).alias("pickup_hour"),
        hash_choice(key, "weekday", 0, 6).alias("pickup_dayofweek"),
        hash_choice(key, "day", 1, 28).alias("pickup_day"),
        hash_choice(key, "month", 1, 12).alias("pickup_month"),
    ]


def _categories(key: Column) -> list[Column]:
    return [
        _pick(key, "payment-name", ["credit_card", "cash", "dispute"]).alias("payment_category"),
        _pick(key, "distance-name", ["short", "medium", "long"]).alias("distance_category"),
        _pick(key, "group-name", ["solo", "couple", "group"]).alias("passenger_group"),
        _pick(key, "time-name", ["morning", "afternoon", "evening", "night"]).alias("time_of_day"),
        hash_choice(key, "weekend", 0, 1).alias("is_weekend"),
    ]


def _by_mode(key: Column, salt: str, modes: list[tuple[float, float]]) -> Column:
    draws = [hash_normal(key, salt, mean, deviation) for mean, deviation in modes]
    return F.when(key % 3 == 0, draws[0]).when(key % 3 == 1, draws[1]).otherwise(draws[2])


def synthetic_modes(ids: DataFrame) -> DataFrame:
    """Trips around three distances and fares; every third id belongs to one mode."""
    key = F.col("id")
    drawn = ids.select(
        "id",
        _by_mode(key, "mode-distance", DISTANCE_MODES).alias("trip_distance"),
        _by_mode(key, "mode-fare", FARE_MODES).alias("fare_amount"),
        hash_choice(key, "passengers", 1, 6).alias("passenger_count"),
        hash_choice(key, "payment", 1, 4).alias("payment_type"),
        hash_choice(key, "rate", 1, 6).alias("RatecodeID"),
        hash_choice(key, "cluster", 0, 2).alias("cluster"),
        *_calendar(key),
        *_categories(key),
    )
    timed = drawn.withColumn("trip_time_in_secs", F.col("trip_distance") * hash_normal(key, "pace", 180.0, 30.0))
    return timed.withColumns(
        {
            "speed": safe_ratio(F.col("trip_distance"), F.col("trip_time_in_secs") / 3600.0),
            "cost_per_mile": safe_ratio(F.col("fare_amount"), F.col("trip_distance")),
        }
    )


def time_factor(hour: Column) -> Column:
    """Night (23 to 5) before rush hours (7 to 9, 16 to 19) before the rest."""
    night = (hour >= 23) | (hour <= 5)
    rush = hour.between(7, 9) | hour.between(16, 19)
    return F.when(night, NIGHT_FACTOR).when(rush, RUSH_FACTOR).otherwise(1.0)


def formula_fare(distance: Column, seconds: Column, hour: Column) -> Column:
    parts = F.lit(BASE_FARE) + distance * F.lit(PER_MILE) + seconds / F.lit(60.0) * F.lit(PER_MINUTE)
    return parts * time_factor(hour)


def synthetic_fares(ids: DataFrame, noise: float = 0.1) -> DataFrame:
    """Trips whose fare follows the formula, times normal noise around one."""
    key = F.col("id")
    drawn = ids.select(
        "id",
        hash_range(key, "distance", 0.5, 20).alias("trip_distance"),
        hash_normal(key, "pace", 3.0, 0.5).alias("pace"),
        hash_choice(key, "passengers", 1, 6).alias("passenger_count"),
        hash_choice(key, "payment", 1, 2).alias("payment_type"),
        hash_choice(key, "rate", 1, 5).alias("RatecodeID"),
        *_calendar(key),
        *_categories(key),
    )
    distance, seconds = F.col("trip_distance"), F.col("trip_time_in_secs")
    timed = drawn.withColumn("trip_time_in_secs", distance * F.col("pace") * 60.0).drop("pace")
    fare = formula_fare(distance, seconds, F.col("pickup_hour"))
    if noise:
        fare = fare * hash_normal(key, "noise", 1.0, noise)
    return timed.withColumn("fare_amount", fare).withColumns(
        {
            "speed": safe_ratio(distance, seconds / 3600.0),
            "cost_per_mile": safe_ratio(F.col("fare_amount"), distance),
            "cluster": distance_cluster(distance),
        }
    )
