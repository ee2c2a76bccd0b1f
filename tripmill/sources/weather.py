"""Weather CSV files."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.operators.cleaning import keep_years
from tripmill.sources.trips import file_paths

# Parts of weather file names.
FILE_TOKENS = ["york", "weather", "ny"]
PARSED = "__parsed_date"
REPORT = "file string, status string, rows bigint"
FILE, ROWS = "__file", "__rows"
DAY = r"^\s*\d{4}-\d{1,2}-\d{1,2}\s*$"
TYPES = {
    "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "date": T.DateType(),
    "timestamp": T.TimestampType(), "boolean": T.BooleanType(), "string": T.StringType(),
}
#: Types that a column is tried as, the narrowest first.
LADDER = [
    ("int", lambda value: value.try_cast("int")),
    ("bigint", lambda value: value.try_cast("bigint")),
    ("double", lambda value: value.try_cast("double")),
    ("date", lambda value: F.when(value.rlike(DAY), value.try_cast("date"))),
    ("timestamp", lambda value: value.try_cast("timestamp")),
    ("boolean", lambda value: value.try_cast("boolean")),
]


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def headers(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """The first line of each file, all files in one job; a file without lines has none."""
    if not paths:
        return {}
    lines = spark.read.text(list(paths)).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    # Within a split lines come in order, and the header is the first line of a file's first split.
    first = lines.filter("block = 0").groupBy("file").agg(F.min_by("value", "at").alias("line"))
    return {_name(row["file"]): row["line"] for row in first.collect()}


def _name(path: str) -> str:
    return unquote(path.rsplit("/", 1)[-1])


def _as_text(spark: SparkSession, paths: Sequence[str], columns: Sequence[str]) -> DataFrame:
    kinds = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    return spark.read.option("header", True).schema(kinds).csv(list(paths))


def _kinds(spark: SparkSession, paths: Sequence[str], columns: Sequence[str]) -> dict[str, tuple[int, T.StructType]]:
    """Rows and column types of each file with these columns, told from all values in one job."""
    def typed(name: str) -> Column:
        value = F.col(f"`{name}`")
        passes = [F.count_if(value.isNotNull() & test(value).isNull()) == 0 for _, test in LADDER]
        kind = F.lit("string")
        for (name_of, _), good in reversed(list(zip(LADDER, passes, strict=True))):
            kind = F.when(good, name_of).otherwise(kind)
        return F.when(F.count(value) == 0, "string").otherwise(kind)

    rows = _as_text(spark, paths, columns).withColumn(FILE, F.col("_metadata.file_path")).groupBy(FILE)
    found = rows.agg(F.count(F.lit(1)).alias(ROWS), *[typed(name).alias(f"k{i}") for i, name in enumerate(columns)]).collect()
    return {
        _name(row[FILE]): (row[ROWS], T.StructType([T.StructField(name, TYPES[row[f"k{i}"]]) for i, name in enumerate(columns)]))
        for row in found
    }


def _fits(found: T.StructType, target: T.StructType) -> str | None:
    """Why a file does not fit the table, None when it does."""
    missing = [name for name in target.names if name not in found.names]
    extra = [name for name in found.names if name not in target.names]
    if missing or extra:
        return f"columns differ: missing {missing}, extra {extra}"
    for field in target.fields:
        kind = found[field.name].dataType
        numbers = isinstance(kind, T.NumericType) and isinstance(field.dataType, T.NumericType)
        if kind != field.dataType and not numbers and not isinstance(field.dataType, T.StringType):
            return f"column {field.name} is {kind.simpleString()}, not {field.dataType.simpleString()}"
    return None


def load_weather(spark: SparkSession, directory: str) -> tuple[DataFrame | None, DataFrame]:
    """Weather rows and a load report; the first file by name that has columns sets them.

    Files are read in groups of equal columns: a job for the headers of all files and one for each different header,
    however many files there are, then one scan for each header that fits. The report has a row for each file.
    """
    paths = {_name(path): path for path in file_paths(spark, directory, FILE_TOKENS, "csv")}
    if not paths:
        return None, spark.createDataFrame([], REPORT)
    lines = headers(spark, list(paths.values()))
    groups: dict[tuple[str, ...], list[str]] = {}
    report = {}
    for name in sorted(paths):
        columns = next(csv.reader([lines.get(name) or ""]), [])
        if not columns or len({column.lower() for column in columns}) < len(columns):
            report[name] = ("skipped: repeated columns" if columns else "skipped: no columns", 0)
            continue
        groups.setdefault(tuple(columns), []).append(name)
    known: dict[str, tuple[int, T.StructType]] = {}
    for columns, names in groups.items():
        made = _kinds(spark, [paths[name] for name in names], columns)
        nothing = (0, T.StructType([T.StructField(column, T.StringType()) for column in columns]))
        known.update({name: made.get(name, nothing) for name in names})
    target = known[min(known)][1] if known else None
    table = None
    for columns, names in groups.items():
        fitting = []
        for name in names:
            rows, kinds = known[name]
            problem = _fits(kinds, target)
            report[name] = (f"skipped: {problem}", 0) if problem else ("loaded", rows)
            if not problem:
                fitting.append(paths[name])
        if fitting:
            text = _as_text(spark, fitting, columns)
            part = text.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in target.fields])
            table = part if table is None else table.unionByName(part)
    return table, spark.createDataFrame([(name, *report[name]) for name in sorted(report)], REPORT)


def weather_date_column(df: DataFrame) -> str | None:
    for name in df.columns:
        if "date" in name.lower() or "time" in name.lower():
            return name
    return None


def weather_in_years(df: DataFrame, start_year: int, end_year: int) -> DataFrame:
    """Rows of the years. A date column read as text is parsed for the test; what is no date stays, as a missing one does."""
    column = weather_date_column(df)
    if column is None:
        return df
    kind = df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return keep_years(df, column, start_year, end_year)
    if not isinstance(kind, T.StringType):
        raise ValueError(f"{column} is {kind.simpleString()}, not a date: the table cannot be bounded to years")
    parsed = df.withColumn(PARSED, F.try_to_timestamp(F.col(column)))
    return keep_years(parsed, PARSED, start_year, end_year).drop(PARSED)
