"""From trip files to clean, year-bounded tables with reports."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill import schema
from tripmill.operators.cleaning import clean_trips
from tripmill.operators.profiling import monthly_counts, quality_reports, removal_report
from tripmill.operators.setops import create_union_view, union_trips
from tripmill.sources.synthetic import synthetic_trips, trip_ids
from tripmill.sources.tables import get_data
from tripmill.sources.trips import date_column, scan_years


def load_trips(
    spark: SparkSession,
    directory: str,
    start_year: int = schema.DEFAULT_YEARS[0],
    end_year: int = schema.DEFAULT_YEARS[1],
    tables: Mapping[str, str] = schema.FILE_TOKENS,
) -> dict[str, DataFrame]:
    """Trips of every kind that has readable files, bounded to the years; ``file_report`` tells what each file gave."""
    loaded = {}
    for table, token in tables.items():
        scanned = scan_years(spark, directory, table, start_year, end_year, token)
        if scanned is not None:
            loaded[table] = scanned
    return loaded


def create_views(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """A view per table and the two union views, where their tables exist."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    pairs = {
        "all_taxi_trips": ("yellow_taxi_trips", "green_taxi_trips"),
        "all_fhv_trips": ("fhv_trips", "hvfhv_trips"),
    }
    made = {name: create_union_view(tables.get(a), tables.get(b), name) for name, (a, b) in pairs.items()}
    return {name: df for name, df in made.items() if df is not None}


def load_report(tables: Mapping[str, DataFrame], start_year: int, end_year: int) -> DataFrame:
    """What the year filter removes from every table, before it is applied."""
    reports = []
    for name, df in tables.items():
        column = date_column(df.columns, name)
        if column is not None:
            reports.append(removal_report(df, column, start_year, end_year).withColumn("table", F.lit(name)))
    return reduce(DataFrame.unionByName, reports)


def verify(tables: Mapping[str, DataFrame], start_year: int, end_year: int) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Quality report over all tables and monthly counts of each."""
    months = {}
    for name, df in tables.items():
        column = date_column(df.columns, name)
        if column is not None:
            months[name] = monthly_counts(df, column)
    return quality_reports(dict(tables), start_year, end_year), months


def write_by_month(tables: Mapping[str, DataFrame], path: str) -> None:
    """All trips under common time names, laid out by year and month so that later reads skip whole folders.

    Rows spread over several writers per month: a busy month is not one task.
    """
    trips = union_trips(tables)
    dated = trips.withColumns({"year": F.year("pickup_datetime"), "month": F.month("pickup_datetime")})
    spread = dated.hint("rebalance", F.col("year"), F.col("month"))
    spread.write.mode("overwrite").partitionBy("year", "month").parquet(path)


def ingest(
    spark: SparkSession,
    table: str = "all_taxi_trips",
    sample_size: int | None = None,
    use_synthetic: bool = False,
    seed: int | None = None,
) -> DataFrame:
    """Stored trips, all or a sample of the size asked for, or made-up ones; cleaned."""
    if use_synthetic:
        trips = synthetic_trips(trip_ids(spark, 1000 if sample_size is None else sample_size))
    else:
        trips = get_data(spark, table, sample_size, seed)
    return clean_trips(trips)
