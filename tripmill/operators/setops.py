"""Unions of trip tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def common_columns(left: DataFrame, right: DataFrame) -> list[str]:
    have = set(right.columns)
    return [name for name in left.columns if name in have]


def union_common(left: DataFrame | None, right: DataFrame | None) -> DataFrame | None:
    """All rows of both tables on the columns both have; None when that is nothing."""
    if left is None or right is None:
        return None
    columns = common_columns(left, right)
    if not columns:
        return None
    return left.select(columns).unionByName(right.select(columns))


def create_union_view(left: DataFrame | None, right: DataFrame | None, name: str) -> DataFrame | None:
    """The union under a view name; no view when there is nothing in common."""
    union = union_common(left, right)
    if union is not None:
        union.createOrReplaceTempView(name)
    return union


def normalise_times(df: DataFrame) -> DataFrame:
    """Pickup and dropoff time under one name for every kind of trip."""
    for prefix in ("tpep", "lpep"):
        for end in ("pickup", "dropoff"):
            df = df.withColumnRenamed(f"{prefix}_{end}_datetime", f"{end}_datetime")
    return df


def union_trips(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Trips of several kinds with common time names and the kind as a column."""
    frames = [
        normalise_times(df).withColumn("trip_type", F.lit(kind)) for kind, df in tables.items()
    ]
    union = frames[0]
    for frame in frames[1:]:
        union = union_common(union, frame)
    return union
