"""Column names, label orders and other fixed values of the trip model."""

from __future__ import annotations

from pyspark.sql import types as T

# The trip table.
TRIP_SCHEMA = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("VendorID", T.IntegerType()),
        T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
        T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
        T.StructField("passenger_count", T.IntegerType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("RatecodeID", T.IntegerType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("PULocationID", T.IntegerType()),
        T.StructField("DOLocationID", T.IntegerType()),
        T.StructField("payment_type", T.IntegerType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("extra", T.DoubleType()),
        T.StructField("mta_tax", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("improvement_surcharge", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("trip_time_in_secs", T.IntegerType()),
    ]
)

# File-name tokens and pickup columns by kind of trip.
FILE_TOKENS = {
    "yellow_taxi_trips": "yellow_tripdata",
    "green_taxi_trips": "green_tripdata",
    "fhv_trips": "fhv_tripdata",
    "hvfhv_trips": "fhvhv_tripdata",
}
DATE_COLUMNS = {
    "yellow_taxi_trips": ["tpep_pickup_datetime", "pickup_datetime"],
    "green_taxi_trips": ["lpep_pickup_datetime", "pickup_datetime"],
    "fhv_trips": ["pickup_datetime", "pickup_date"],
    "hvfhv_trips": ["pickup_datetime", "request_datetime"],
}
DATE_NAME_PARTS = ["datetime", "pickup", "date"]
DEFAULT_YEARS = (2022, 2024)

# Payment codes.
PAYMENT_LABELS = {
    1: "credit_card",
    2: "cash",
    3: "no_charge",
    4: "dispute",
    5: "unknown",
    6: "voided",
}
UNKNOWN_PAYMENT = "unknown"

# Bin edges and labels.
TIME_OF_DAY = ([0, 6, 12, 18, 24], ["night", "morning", "afternoon", "evening"])
DISTANCE_BANDS = ([0, 2, 5, 10, float("inf")], ["very_short", "short", "medium", "long"])
NARROW_DISTANCE_BANDS = ([0, 1, 3, 10, 100], ["very_short", "short", "medium", "long"])
PASSENGER_BANDS = ([0, 1, 2, 5, 10], ["solo", "couple", "small_group", "large_group"])
FARE_LABELS = ["low", "medium", "high"]
FARE_QUANTILES = (0.33, 0.66)

# Feature lists of the models.
CATEGORICAL_FEATURES = [
    "payment_type",
    "RatecodeID",
    "pickup_hour",
    "pickup_dayofweek",
    "payment_category",
    "distance_category",
    "passenger_group",
    "time_of_day",
    "is_weekend",
]
NUMERIC_FEATURES = [
    "passenger_count",
    "trip_distance",
    "trip_time_in_secs",
    "speed",
    "cost_per_mile",
    "pickup_day",
    "pickup_month",
]
CLUSTER_FEATURES = [
    "trip_distance",
    "fare_amount",
    "passenger_count",
    "speed",
    "fare_per_mile",
    "pickup_hour",
]
STUDY_CLUSTER_FEATURES = [
    "trip_distance",
    "fare_amount",
    "cost_per_mile",
    "pickup_hour",
    "passenger_count",
]
CLUSTER_STATS = ["fare_amount", "trip_distance", "speed", "passenger_count", "fare_per_mile"]

TARGET = "fare_amount"
# Columns from which the fare can be read back; left out of the models by default.
TARGET_LEAKS = ["fare_amount", "cost_per_mile", "total_amount", "fare_category", "tip_amount", "tolls_amount"]

# A request with nothing given.
DEFAULT_TRIP = {
    "trip_distance": 5.0,
    "passenger_count": 2,
    "pickup_hour": 12,
    "payment_type": 1,
    "trip_time_in_secs": 900,
}


def present(columns, wanted) -> list[str]:
    """The wanted names that exist, in the wanted order."""
    have = set(columns)
    return [name for name in wanted if name in have]
