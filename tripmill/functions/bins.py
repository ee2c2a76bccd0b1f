"""Right-closed bins with labels."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmill import schema


def cut(value: Column, edges: Sequence[float], labels: Sequence[str], include_lowest: bool = False) -> Column:
    """Label of the interval (edge, next edge] that holds the value, NULL outside.

    ``include_lowest`` closes the first interval on the left as well.
    """
    value = value.cast("double")
    low = edges[0]
    inside = value.isNotNull() & ~F.isnan(value)
    if math.isfinite(low):
        inside = inside & ((value >= low) if include_lowest else (value > low))
    result = F.when(~inside, F.lit(None).cast("string"))
    for upper, label in zip(edges[1:], labels, strict=True):
        result = result.when(F.lit(True) if math.isinf(upper) else value <= upper, F.lit(label))
    return result


def distance_category(distance: Column) -> Column:
    edges, labels = schema.DISTANCE_BANDS
    return cut(distance, edges, labels, include_lowest=True)


def narrow_distance_category(distance: Column) -> Column:
    edges, labels = schema.NARROW_DISTANCE_BANDS
    return cut(distance, edges, labels)


def passenger_group(passengers: Column) -> Column:
    """Two passengers, more than two, or (unknown counts included) solo."""
    return F.when(passengers == 2, "couple").when(passengers > 2, "group").otherwise("solo")


def narrow_passenger_group(passengers: Column) -> Column:
    edges, labels = schema.PASSENGER_BANDS
    return cut(passengers, edges, labels)


def payment_category(code: Column) -> Column:
    """Payment label of a code; codes without a label and NULL are unknown."""
    pairs = [F.lit(part) for pair in schema.PAYMENT_LABELS.items() for part in pair]
    return F.coalesce(F.create_map(*pairs)[code.cast("int")], F.lit(schema.UNKNOWN_PAYMENT))


def cash_or_not(code: Column) -> Column:
    return F.when(code == 2, "cash").otherwise("non_cash")


def fare_category(fare: Column, low_cut: float, high_cut: float) -> Column:
    return cut(fare, [-math.inf, low_cut, high_cut, math.inf], schema.FARE_LABELS)


def distance_cluster(distance: Column, near: float = 5.0, far: float = 10.0) -> Column:
    """Cluster id by rule: short 0, middle 1, long 2."""
    return F.when(distance < near, 0).when(distance < far, 1).otherwise(2)
