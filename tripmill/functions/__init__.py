"""Column expressions; every function takes and returns Spark columns."""

from tripmill.functions.bins import cut, fare_category
from tripmill.functions.hashing import hash48, hash_bucket, hash_unit
from tripmill.functions.numeric import finite, safe_ratio
from tripmill.functions.temporal import time_of_day, trip_seconds

__all__ = [
    "cut",
    "fare_category",
    "finite",
    "hash48",
    "hash_bucket",
    "hash_unit",
    "safe_ratio",
    "time_of_day",
    "trip_seconds",
]
