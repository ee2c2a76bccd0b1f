"""Counts, ranges, shares and quality reports of a table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions.numeric import round_half_even
from tripmill.functions.temporal import month_start
from tripmill.operators.cleaning import outside_years, time_columns


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def date_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("min_date"), F.max(column).alias("max_date"))


def removal_report(df: DataFrame, column: str, start_year: int, end_year: int) -> DataFrame:
    """What the year filter takes away, in one pass."""
    removed = F.count_if(outside_years(column, start_year, end_year))
    counted = df.agg(F.count(F.lit(1)).alias("rows_before"), removed.alias("rows_removed"))
    return counted.select(
        "rows_before",
        (F.col("rows_before") - F.col("rows_removed")).alias("rows_after"),
        "rows_removed",
        F.try_divide(F.col("rows_removed") * 100.0, F.col("rows_before")).alias("percent_removed"),
    )


def _month_keys(column: str) -> list[Column]:
    moment = F.col(column)
    return [month_start(moment).alias("month"), F.year(moment).alias("year"), F.month(moment).alias("month_number")]


def monthly_counts(df: DataFrame, column: str) -> DataFrame:
    counted = df.groupBy(*_month_keys(column)).agg(F.count(F.lit(1)).alias("trips"))
    return counted.orderBy("year", "month_number")


def monthly_fares(df: DataFrame, column: str) -> DataFrame:
    """Trips, fares and tips by month."""
    grouped = df.groupBy(*_month_keys(column)).agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum("fare_amount").alias("total_fare"),
        F.avg("fare_amount").alias("avg_fare"),
        F.sum("tip_amount").alias("total_tips"),
        F.avg("tip_amount").alias("avg_tip"),
    )
    return grouped.orderBy("year", "month_number")


def year_distribution(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.year(column).alias("year")).agg(F.count(F.lit(1)).alias("rows")).orderBy("year")


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing values of every column from a single aggregate."""
    columns = df.columns if columns is None else list(columns)
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)],
    )
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("nulls")) for i, c in enumerate(columns)]
    return counts.select("__rows", F.inline(F.array(*cells))).select(
        "column", "nulls", F.try_divide(F.col("nulls") * 100.0, F.col("__rows")).alias("percent")
    )


def distinct_counts(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """Distinct values per column; the inexact form keeps one sketch per column."""
    count = F.count_distinct if exact else F.approx_count_distinct
    counts = df.agg(*[count(F.col(c)).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column", "distinct_values")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), F.asc(column))


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Count and percent of the rows with a value."""
    present = df.filter(F.col(column).isNotNull())
    counted = present.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counted.agg(F.sum("n")).scalar()
    return counted.withColumn("percent", F.col("n") * 100.0 / total)


def crosstab_counts(df: DataFrame, row: str, column: str, values: Sequence) -> DataFrame:
    """Rows per pair of values; the column values are given, so no job looks for them."""
    table = df.groupBy(row).pivot(column, list(values)).agg(F.count(F.lit(1)))
    return table.fillna(0, [str(v) for v in values])


def crosstab_percent(df: DataFrame, row: str, column: str, values: Sequence) -> DataFrame:
    table = crosstab_counts(df, row, column, values)
    names = [str(v) for v in values]
    total = reduce(lambda a, b: a + b, [F.col(n) for n in names])
    return table.select(row, *[F.try_divide(F.col(n) * 100.0, total).alias(n) for n in names])


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "feature", value: str = "value") -> DataFrame:
    return df.unpivot(list(ids), list(values), name, value)


def group_means(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in columns])


def cluster_statistics(df: DataFrame, columns: Sequence[str], cluster: str = "cluster", digits: int = 2) -> DataFrame:
    """Mean, deviation and count of the columns that exist; sizes when none does."""
    have = [c for c in columns if c in df.columns]
    if not have:
        return df.groupBy(cluster).agg(F.count(F.lit(1)).alias("cluster_size"))
    parts = []
    for c in have:
        parts += [
            round_half_even(F.avg(c), digits).alias(f"{c}_mean"),
            round_half_even(F.stddev_samp(c), digits).alias(f"{c}_std"),
            F.count(c).alias(f"{c}_count"),
        ]
    return df.groupBy(cluster).agg(*parts)


def prediction_summary(df: DataFrame, prediction: str = "predicted_fare") -> DataFrame:
    return df.agg(
        F.min(prediction).alias("min_prediction"),
        F.max(prediction).alias("max_prediction"),
        F.avg(prediction).alias("mean_prediction"),
        F.count(prediction).alias("predictions"),
    )


def column_types(df: DataFrame, table: str = "") -> DataFrame:
    rows = [(table, name, kind) for name, kind in df.dtypes]
    return df.sparkSession.createDataFrame(rows, "table string, column string, type string")


_CELL = "table string, column string, metric string, value double, text string"


def _cell(table: str, column: str, metric: str, value=None, text=None) -> Column:
    return F.struct(
        F.lit(table).alias("table"),
        F.lit(column).alias("column"),
        F.lit(metric).alias("metric"),
        (F.lit(None) if value is None else value).cast("double").alias("value"),
        (F.lit(None) if text is None else text).cast("string").alias("text"),
    )


def quality_report(
    df: DataFrame, table: str, start_year: int, end_year: int, columns: Sequence[str] | None = None
) -> DataFrame:
    """Long report of a table: rows, types, date ranges, rows by year, outliers, nulls.

    The scalar metrics come from one aggregate; years from one small grouping per
    date column.
    """
    dates = time_columns(df) if columns is None else list(columns)
    kinds = dict(df.dtypes)
    parts = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(df.columns):
        parts.append(F.count_if(F.col(c).isNull()).alias(f"null{i}"))
    for i, c in enumerate(dates):
        parts += [
            F.min(c).alias(f"min{i}"),
            F.max(c).alias(f"max{i}"),
            F.count_if(outside_years(c, start_year, end_year)).alias(f"out{i}"),
        ]
    cells = [_cell(table, "", "rows", F.col("rows")), _cell(table, "", "columns", F.lit(len(df.columns)))]
    for i, c in enumerate(df.columns):
        nulls = F.col(f"null{i}")
        cells += [
            _cell(table, c, "type", text=F.lit(kinds[c])),
            _cell(table, c, "nulls", nulls),
            _cell(table, c, "null_percent", F.try_divide(nulls * 100.0, F.col("rows"))),
        ]
    for i, c in enumerate(dates):
        cells += [
            _cell(table, c, "min_date", text=F.col(f"min{i}").cast("string")),
            _cell(table, c, "max_date", text=F.col(f"max{i}").cast("string")),
            _cell(table, c, "outliers", F.col(f"out{i}")),
        ]
    report = df.agg(*parts).select(F.inline(F.array(*cells)))
    for c in dates:
        years = df.filter(F.col(c).isNotNull()).groupBy(F.year(c).alias("y")).agg(F.count(F.lit(1)).alias("n"))
        cell = _cell(table, c, "", F.col("n")).withField("metric", F.concat(F.lit("rows_in_"), F.col("y")))
        report = report.unionByName(years.select(F.inline(F.array(cell))))
    return report


def quality_reports(tables: dict[str, DataFrame], start_year: int, end_year: int) -> DataFrame:
    reports = [quality_report(df, name, start_year, end_year) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, reports)
