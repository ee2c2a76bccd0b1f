"""Row filters, outlier limits and filling of missing values."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.functions.numeric import clip, finite
from tripmill.functions.temporal import within_years
from tripmill.operators.quantiles import cut_points, mode, quantiles


def keep_positive(df: DataFrame, columns: Sequence[str] = ("fare_amount", "trip_distance")) -> DataFrame:
    for column in columns:
        df = df.filter(F.col(column) > 0)
    return df


def trim(
    df: DataFrame,
    columns: Sequence[str] = ("fare_amount", "trip_distance"),
    low: float | None = None,
    high: float | None = 0.99,
) -> DataFrame:
    """Drop rows outside quantile bounds, one column after the other.

    Each column's bounds come from the rows left by the columns before it. The
    bounds enter the plan as literals, so later scans prune row groups by them.
    """
    for column in columns:
        probabilities = [p for p in (low, high) if p is not None]
        bounds = dict(zip(probabilities, cut_points(df, {column: probabilities})[column], strict=True))
        if low is not None:
            df = df.filter(F.col(column) >= F.lit(bounds[low]))
        if high is not None:
            df = df.filter(F.col(column) <= F.lit(bounds[high]))
    return df


def clean_trips(df: DataFrame) -> DataFrame:
    """Positive fares and distances, then the top one percent of each removed."""
    cleaned = trim(keep_positive(df), high=0.99)
    if cleaned.isEmpty():
        raise ValueError("no trips left after cleaning")
    return cleaned


def clean_trips_two_sided(
    df: DataFrame, fill: Sequence[str] = ("passenger_count", "payment_type", "RatecodeID")
) -> DataFrame:
    """As above with both tails removed and gaps in three columns filled."""
    trimmed = trim(keep_positive(df), low=0.01, high=0.99)
    return fill_missing(trimmed, columns=[c for c in fill if c in df.columns])


def keep_years(df: DataFrame, column: str, start_year: int, end_year: int) -> DataFrame:
    """Rows of a range of years; rows without a date stay."""
    moment = F.col(column)
    return df.filter(moment.isNull() | within_years(moment, start_year, end_year))


def outside_years(column: str, start_year: int, end_year: int) -> Column:
    return F.col(column).isNotNull() & ~within_years(F.col(column), start_year, end_year)


def count_outside_years(df: DataFrame, column: str, start_year: int, end_year: int) -> DataFrame:
    return df.agg(F.count_if(outside_years(column, start_year, end_year)).alias("outliers"))


def time_columns(df: DataFrame) -> list[str]:
    """Timestamp columns whose name speaks of a date or time."""
    kinds = (T.TimestampType, T.TimestampNTZType, T.DateType)
    return [
        field.name
        for field in df.schema.fields
        if isinstance(field.dataType, kinds) and any(part in field.name.lower() for part in ("date", "time"))
    ]


def keep_years_everywhere(df: DataFrame, start_year: int, end_year: int, columns: Iterable[str] | None = None) -> DataFrame:
    """The year filter on every time column in turn."""
    for column in time_columns(df) if columns is None else columns:
        df = keep_years(df, column, start_year, end_year)
    return df


def null_if_not_finite(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({column: finite(F.col(column)) for column in columns})


def _numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _text(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def fill_values(
    df: DataFrame,
    numeric_strategy: str = "median",
    categorical_strategy: str = "mode",
    columns: Sequence[str] | None = None,
) -> dict[str, object]:
    """Replacement of missing values per column that has any."""
    chosen = df.columns if columns is None else list(columns)
    gaps = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in chosen]).first() if chosen else {}
    numeric = [c for c in _numeric(df) if c in chosen and gaps[c]]
    text = [c for c in _text(df) if c in chosen and gaps[c]]
    values: dict[str, object] = {}
    if numeric and numeric_strategy == "mean":
        values.update(df.agg(*[F.avg(c).alias(c) for c in numeric]).first().asDict())
    elif numeric and numeric_strategy == "median":
        values.update({c: q[0] for c, q in quantiles(df, {c: [0.5] for c in numeric}).items()})
    elif numeric_strategy == "zero":
        values.update(dict.fromkeys(numeric, 0.0))
    for column in text:
        values[column] = mode(df, column) if categorical_strategy == "mode" else "missing"
    return {column: value for column, value in values.items() if value is not None}


def apply_fill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Fill gaps; whole-number columns widen to double only for a fractional value."""
    kinds = dict(df.dtypes)
    filled = {}
    for column, value in values.items():
        current = F.col(column)
        if isinstance(value, float) and kinds[column] not in ("double", "float"):
            if value.is_integer():
                value = int(value)
            else:
                current = current.cast("double")
        replacement = F.lit(value) if isinstance(value, float) else F.lit(value).cast(kinds[column])
        filled[column] = F.coalesce(current, replacement)
    return df.withColumns(filled) if filled else df


def fill_missing(
    df: DataFrame,
    numeric_strategy: str = "median",
    categorical_strategy: str = "mode",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    return apply_fill(df, fill_values(df, numeric_strategy, categorical_strategy, columns))


def outlier_limits(
    df: DataFrame, columns: Sequence[str], method: str = "iqr", threshold: float = 1.5
) -> dict[str, tuple[float, float]]:
    """Lower and upper limit per numeric column, by quartile range or by z-score."""
    numeric = [c for c in _numeric(df) if c in columns]
    limits: dict[str, tuple[float, float]] = {}
    if not numeric:
        return limits
    if method == "iqr":
        for column, (q1, q3) in quantiles(df, {c: [0.25, 0.75] for c in numeric}).items():
            if q1 is not None:
                limits[column] = (q1 - threshold * (q3 - q1), q3 + threshold * (q3 - q1))
        return limits
    if method != "zscore":
        raise ValueError(f"unknown method {method!r}")
    parts = [f for c in numeric for f in (F.avg(c).alias(f"{c}__m"), F.stddev_samp(c).alias(f"{c}__s"))]
    row = df.agg(*parts).first()
    for column in numeric:
        mean, deviation = row[f"{column}__m"], row[f"{column}__s"]
        if mean is not None and deviation is not None:
            limits[column] = (mean - threshold * deviation, mean + threshold * deviation)
    return limits


def clip_outliers(
    df: DataFrame, columns: Sequence[str], method: str = "iqr", threshold: float = 1.5
) -> DataFrame:
    limits = outlier_limits(df, columns, method, threshold)
    clipped = {c: clip(F.col(c).cast("double"), low, high) for c, (low, high) in limits.items()}
    return df.withColumns(clipped) if clipped else df
