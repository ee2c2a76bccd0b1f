"""The driver's tables seen as trips, once as DataFrames and once as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

START_YEAR, END_YEAR = 1996, 1998


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _trip_columns() -> dict:
    order, line, part, supplier = (F.col(f"l_{c}") for c in ("orderkey", "linenumber", "partkey", "suppkey"))
    fare = F.col("l_extendedprice") / 1000.0
    pickup = F.timestamp_add("SECOND", ((order * 7919 + line * 104729) % 86400).cast("int"), F.col("l_shipdate"))
    seconds = (part % 3600).cast("int")
    return {
        "trip_key": F.concat_ws("-", order, line, part),
        "VendorID": (supplier % 2 + 1).cast("int"),
        "pickup_datetime": pickup,
        "dropoff_datetime": F.timestamp_add("SECOND", seconds, pickup),
        "trip_time_in_secs": seconds,
        "passenger_count": line,
        "trip_distance": F.col("l_quantity") / 2.0,
        "fare_amount": fare,
        "tip_amount": fare * F.col("l_discount"),
        "tolls_amount": fare * F.col("l_tax"),
        "payment_type": (part % 7).cast("int"),
        "RatecodeID": (supplier % 6 + 1).cast("int"),
    }


def trips(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(*[c.alias(n) for n, c in _trip_columns().items()])


def trips_with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Trips with NULLs among passengers, fares and pickup times."""
    part = F.col("l_partkey")
    columns = _trip_columns()
    columns["passenger_count"] = F.nullif(columns["passenger_count"], F.lit(7))
    columns["fare_amount"] = F.when(part % 50 != 0, columns["fare_amount"])
    columns["pickup_datetime"] = F.when(part % 40 != 0, columns["pickup_datetime"])
    columns["payment_label"] = F.when(part % 30 != 0, F.concat(F.lit("p"), columns["payment_type"]))
    return table(spark, folder, "lineitem").select(*[c.alias(n) for n, c in columns.items()])


def routes(spark: SparkSession, folder: str) -> DataFrame:
    """Trips with pickup and dropoff zones: the supplier's and the customer's nation."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey", *[c.alias(n) for n, c in _trip_columns().items()])
    supplier = table(spark, folder, "supplier").select("s_suppkey", F.col("s_nationkey").alias("PULocationID"))
    order = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, folder, "customer").select("c_custkey", F.col("c_nationkey").alias("DOLocationID"))
    joined = (
        lines.join(supplier, lines.l_suppkey == supplier.s_suppkey)
        .join(order, lines.l_orderkey == order.o_orderkey)
        .join(customer, order.o_custkey == customer.c_custkey)
    )
    return joined.select(*_trip_columns(), "PULocationID", "DOLocationID")


def zones(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("LocationID"), F.col("r_name").alias("Borough"), F.col("n_name").alias("Zone")
    )


def yellow(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").filter("l_linestatus = 'F'")
    frame = lines.select(*[c.alias(n) for n, c in _trip_columns().items()])
    return frame.withColumnsRenamed(
        {"pickup_datetime": "tpep_pickup_datetime", "dropoff_datetime": "tpep_dropoff_datetime"}
    )


def green(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").filter("l_linestatus <> 'F'")
    frame = lines.select(*[c.alias(n) for n, c in _trip_columns().items()], F.lit(1).alias("trip_type_code"))
    return frame.drop("tolls_amount").withColumnsRenamed(
        {"pickup_datetime": "lpep_pickup_datetime", "dropoff_datetime": "lpep_dropoff_datetime"}
    )


def fhv(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("trip_id"),
        F.col("o_orderdate").alias("pickup_datetime"),
        F.col("o_custkey").alias("dispatch_id"),
    )


def hvfhv(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("event_id").alias("trip_id"),
        F.col("ts").alias("pickup_datetime"),
        F.col("user_id").alias("licence_id"),
    )


_SQL_COLUMNS = {
    "trip_key": "l_orderkey || '-' || l_linenumber || '-' || l_partkey",
    "VendorID": "CAST(l_suppkey % 2 + 1 AS INTEGER)",
    "pickup_datetime": "l_shipdate + to_seconds((l_orderkey * 7919 + l_linenumber * 104729) % 86400)",
    "dropoff_datetime": "l_shipdate + to_seconds((l_orderkey * 7919 + l_linenumber * 104729) % 86400) + to_seconds(l_partkey % 3600)",
    "trip_time_in_secs": "CAST(l_partkey % 3600 AS INTEGER)",
    "passenger_count": "l_linenumber",
    "trip_distance": "l_quantity / 2.0",
    "fare_amount": "l_extendedprice / 1000.0",
    "tip_amount": "l_extendedprice / 1000.0 * l_discount",
    "tolls_amount": "l_extendedprice / 1000.0 * l_tax",
    "payment_type": "CAST(l_partkey % 7 AS INTEGER)",
    "RatecodeID": "CAST(l_suppkey % 6 + 1 AS INTEGER)",
}


def _select(columns: dict[str, str]) -> str:
    return ", ".join(f"{expr} AS {name}" for name, expr in columns.items())


TRIPS = f"trips AS (SELECT {_select(_SQL_COLUMNS)} FROM lineitem)"
GAPS = "gaps AS (SELECT {} FROM lineitem)".format(
    _select(
        {
            **_SQL_COLUMNS,
            "passenger_count": "nullif(l_linenumber, 7)",
            "fare_amount": "CASE WHEN l_partkey % 50 <> 0 THEN l_extendedprice / 1000.0 END",
            "pickup_datetime": f"CASE WHEN l_partkey % 40 <> 0 THEN {_SQL_COLUMNS['pickup_datetime']} END",
            "payment_label": "CASE WHEN l_partkey % 30 <> 0 THEN 'p' || (l_partkey % 7) END",
        }
    )
)
ROUTES = (
    f"routes AS (SELECT {_select(_SQL_COLUMNS)}, s_nationkey AS PULocationID, c_nationkey AS DOLocationID "
    "FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey "
    "JOIN customer ON o_custkey = c_custkey)"
)
ZONES = (
    "zones AS (SELECT n_nationkey AS LocationID, r_name AS Borough, n_name AS Zone "
    "FROM nation JOIN region ON n_regionkey = r_regionkey)"
)

# Pieces of SQL that several checks share.
HASH48 = "('0x' || substr(md5({key}), 1, 12))::BIGINT"
BUCKET = "(('0x' || substr(md5({key}), 1, 8))::BIGINT % {n})"
TIME_OF_DAY = (
    "CASE WHEN {h} < 0 OR {h} > 24 THEN NULL WHEN {h} <= 6 THEN 'night' WHEN {h} <= 12 THEN 'morning' "
    "WHEN {h} <= 18 THEN 'afternoon' WHEN {h} <= 24 THEN 'evening' END"
)
DISTANCE = (
    "CASE WHEN {d} < 0 THEN NULL WHEN {d} <= 2 THEN 'very_short' WHEN {d} <= 5 THEN 'short' "
    "WHEN {d} <= 10 THEN 'medium' ELSE 'long' END"
)
NARROW_DISTANCE = (
    "CASE WHEN {d} <= 0 THEN NULL WHEN {d} <= 1 THEN 'very_short' WHEN {d} <= 3 THEN 'short' "
    "WHEN {d} <= 10 THEN 'medium' WHEN {d} <= 100 THEN 'long' END"
)
PASSENGERS = "CASE WHEN {p} = 2 THEN 'couple' WHEN {p} > 2 THEN 'group' ELSE 'solo' END"
NARROW_PASSENGERS = (
    "CASE WHEN {p} <= 0 THEN NULL WHEN {p} <= 1 THEN 'solo' WHEN {p} <= 2 THEN 'couple' "
    "WHEN {p} <= 5 THEN 'small_group' WHEN {p} <= 10 THEN 'large_group' END"
)
PAYMENT = (
    "CASE {c} WHEN 1 THEN 'credit_card' WHEN 2 THEN 'cash' WHEN 3 THEN 'no_charge' WHEN 4 THEN 'dispute' "
    "WHEN 6 THEN 'voided' ELSE 'unknown' END"
)
RULE_CLUSTER = "CASE WHEN {d} < 5 THEN 0 WHEN {d} < 10 THEN 1 ELSE 2 END"


def unit_sql(key: str, salt: str) -> str:
    """A number in [0, 1) from a key, as the hashed draws make it."""
    return "(" + HASH48.format(key=f"{key} || ':{salt}'") + " / 281474976710656.0::DOUBLE)"


def range_sql(key: str, salt: str, low: float, high: float) -> str:
    return f"({low}::DOUBLE + {unit_sql(key, salt)} * {high - low}::DOUBLE)"


def choice_sql(key: str, salt: str, low: int, high: int) -> str:
    return f"CAST({low} + floor({unit_sql(key, salt)} * {high - low + 1}) AS INTEGER)"


def normal_sql(key: str, salt: str, mean: float, deviation: float) -> str:
    radius = f"sqrt(-2.0::DOUBLE * ln(1.0::DOUBLE - {unit_sql(key, salt + '-r')}))"
    return f"({mean}::DOUBLE + {deviation}::DOUBLE * {radius} * cos(6.283185307179586::DOUBLE * {unit_sql(key, salt + '-a')}))"
