"""Expressions over numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(value: Column) -> Column:
    """The value as double; NaN and infinities become NULL."""
    value = value.cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)


def safe_ratio(top: Column, bottom: Column) -> Column:
    """Quotient, NULL for a zero divisor or a result that is not finite."""
    return finite(F.try_divide(top.cast("double"), bottom.cast("double")))


def speed_mph(distance: Column, seconds: Column) -> Column:
    return safe_ratio(distance, seconds / F.lit(3600.0))


def cost_per_mile(fare: Column, distance: Column) -> Column:
    return safe_ratio(fare, distance)


def floored_cost_per_mile(fare: Column, distance: Column, floor: float = 0.1) -> Column:
    """Fare per mile with very short distances counted as the floor."""
    # greatest() skips NULL, so an unknown distance is kept apart.
    return F.when(distance.isNotNull(), F.try_divide(fare, F.greatest(distance, F.lit(floor))))


def clip(value: Column, low: float, high: float) -> Column:
    return F.when(value.isNotNull(), F.greatest(F.least(value, F.lit(high)), F.lit(low)))


def round_half_even(value: Column, digits: int = 2) -> Column:
    return F.bround(value, digits)


def error(actual: Column, predicted: Column) -> Column:
    return predicted - actual


def absolute_percentage_error(actual: Column, predicted: Column) -> Column:
    return F.abs(F.try_divide(actual - predicted, actual)) * 100
