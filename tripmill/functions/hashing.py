"""Values drawn from a hash of a key: the same on every run and partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 48


def hash48(key: Column) -> Column:
    """48 bits of md5 as a bigint; exact as a double too."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def hash_bucket(key: Column, buckets: int = 100) -> Column:
    """Bucket number from the first 32 bits of md5."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint") % buckets


def hash_unit(key: Column, salt: str) -> Column:
    """Number in [0, 1) for a key and a named purpose."""
    return hash48(F.concat_ws(":", key.cast("string"), F.lit(salt))) / F.lit(float(2**HASH_BITS))


def hash_range(key: Column, salt: str, low: float, high: float) -> Column:
    return F.lit(low) + hash_unit(key, salt) * F.lit(high - low)


def hash_choice(key: Column, salt: str, low: int, high: int) -> Column:
    """Whole number from low to high, both included."""
    return (F.lit(low) + F.floor(hash_unit(key, salt) * F.lit(high - low + 1))).cast("int")


def hash_normal(key: Column, salt: str, mean: float, deviation: float) -> Column:
    """Normal draw by the Box-Muller transform of two hashed uniforms."""
    radius = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - hash_unit(key, salt + "-r")))
    return F.lit(mean) + F.lit(deviation) * radius * F.cos(F.lit(6.283185307179586) * hash_unit(key, salt + "-a"))
