"""Catalog tables of trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill import schema
from tripmill.operators.sampling import random_rows


def _fit(df: DataFrame, target: T.StructType) -> DataFrame:
    """Columns cast to the table's types; columns the rows lack are NULL."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.fields
        ]
    )


def create_trip_table(spark: SparkSession, table: str) -> None:
    """Empty trip table, replacing one of that name."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.createDataFrame([], schema.TRIP_SCHEMA).write.format("parquet").saveAsTable(table)


def insert_trips(df: DataFrame, table: str, limit: int | None = None) -> None:
    """Append all rows in one write, or any ``limit`` of them when a limit is asked for."""
    rows = _fit(df, df.sparkSession.table(table).schema)
    (rows if limit is None else rows.limit(limit)).write.insertInto(table)


def replace_table(df: DataFrame, table: str, format: str = "parquet") -> None:
    df.write.format(format).mode("overwrite").saveAsTable(table)


def table_columns(spark: SparkSession, *tables: str) -> DataFrame:
    """Names and types of the columns of tables; missing tables have none."""
    rows = [
        (table, name, kind)
        for table in tables
        if spark.catalog.tableExists(table)
        for name, kind in spark.table(table).dtypes
    ]
    return spark.createDataFrame(rows, "table string, column string, type string")


def get_sample(spark: SparkSession, table: str, sample_size: int, seed: int | None = None) -> DataFrame:
    """Random rows of a table; an empty frame when there is no such table."""
    if not spark.catalog.tableExists(table):
        return spark.createDataFrame([], schema.TRIP_SCHEMA)
    return random_rows(spark.table(table), sample_size, seed)


def get_data(spark: SparkSession, table: str = "all_taxi_trips", sample_size: int | None = None, seed: int | None = None) -> DataFrame:
    """The whole table, or a sample when a size is asked for; an empty result is an error."""
    if sample_size is None and spark.catalog.tableExists(table):
        rows = spark.table(table)
    else:
        rows = get_sample(spark, table, sample_size or 0, seed)
    if rows.isEmpty():
        raise ValueError(f"no trips in {table}")
    return rows
