"""Expressions over timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmill import schema
from tripmill.functions.bins import cut


def parse_timestamp(text: Column, strict: bool = True) -> Column:
    """Timestamp from text; the strict form fails on bad text, the other gives NULL."""
    parsed = F.to_timestamp(text) if strict else F.try_to_timestamp(text)
    return parsed.cast("timestamp_ntz")


def pickup_parts(moment: Column) -> dict[str, Column]:
    """Hour, day, month and weekday (Monday is 0) of a pickup."""
    return {
        "pickup_hour": F.hour(moment),
        "pickup_day": F.dayofmonth(moment),
        "pickup_month": F.month(moment),
        "pickup_dayofweek": F.weekday(moment),
    }


def is_weekend(moment: Column) -> Column:
    return F.weekday(moment).isin(5, 6)


def time_of_day(hour: Column) -> Column:
    edges, labels = schema.TIME_OF_DAY
    return cut(hour, edges, labels, include_lowest=True)


def month_start(moment: Column) -> Column:
    return F.date_trunc("month", moment).cast("timestamp_ntz")


def trip_seconds(pickup: Column, dropoff: Column) -> Column:
    return F.timestamp_diff("SECOND", pickup, dropoff)


def seconds_at_speed(distance: Column, mph: Column) -> Column:
    """Whole seconds needed for a distance in miles at a speed."""
    return (F.try_divide(distance, mph) * 3600).cast("int")


def year_bounds(start_year: int, end_year: int) -> tuple[str, str]:
    """First instant inside and first instant past a range of years."""
    return f"{start_year:04d}-01-01 00:00:00", f"{end_year + 1:04d}-01-01 00:00:00"


def within_years(moment: Column, start_year: int, end_year: int) -> Column:
    """Range test on the raw timestamp, so that it reaches the parquet scan."""
    low, high = (F.to_timestamp_ntz(F.lit(text)) for text in year_bounds(start_year, end_year))
    return (moment >= low) & (moment < high)
