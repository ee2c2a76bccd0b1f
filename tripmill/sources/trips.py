"""Trip files: discovery, scan, pruning by year."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill import schema
from tripmill.operators.cleaning import keep_years
from tripmill.operators.joins import broadcast_if_small


def any_case_glob(text: str) -> str:
    """Glob that matches the text in upper or lower case."""
    return "".join(f"[{ch.lower()}{ch.upper()}]" if ch.isalpha() else ch for ch in text)


def name_glob(tokens: Sequence[str], extension: str) -> str:
    """Glob for file names that hold any of the tokens and end with the extension."""
    choices = ",".join(any_case_glob(token) for token in tokens)
    inner = "{" + choices + "}" if len(tokens) > 1 else choices
    return f"*{inner}*.{extension}"


def list_files(spark: SparkSession, directory: str, tokens: Sequence[str], extension: str) -> DataFrame:
    """Paths, sizes and times of matching files; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", name_glob(tokens, extension)).load(directory)
    return files.select("path", "length", "modificationTime")


def file_paths(spark: SparkSession, directory: str, tokens: Sequence[str], extension: str) -> list[str]:
    return [row["path"] for row in list_files(spark, directory, tokens, extension).select("path").orderBy("path").collect()]


def _schema_of(spark: SparkSession, path: str) -> tuple[T.StructType | None, str]:
    """Columns of one file from its footer, and what is to be said of it."""
    try:
        return spark.read.parquet(path).schema, "loaded"
    except (PySparkException, Py4JError) as failure:
        condition = failure.getCondition() if isinstance(failure, PySparkException) else None
        return None, f"failed: {condition or type(failure).__name__}"


def file_report(spark: SparkSession, directory: str, table: str, token: str | None = None) -> DataFrame:
    """``file, status`` of every file of a kind of trip; footers are read, rows are not."""
    rows = [(path.rsplit("/", 1)[-1], _schema_of(spark, path)[1]) for path in _paths(spark, directory, table, token)]
    return spark.createDataFrame(rows, "file string, status string")


def _paths(spark: SparkSession, directory: str, table: str, token: str | None) -> list[str]:
    return file_paths(spark, directory, [token or schema.FILE_TOKENS.get(table, table)], "parquet")


def widened(kinds: Sequence[T.DataType]) -> T.DataType:
    """A type that holds all of some types: numbers meet in bigint or double, times in timestamps, others in text."""
    if all(kind == kinds[0] for kind in kinds):
        return kinds[0]
    if all(isinstance(kind, T.IntegralType) for kind in kinds):
        return T.LongType()
    if all(isinstance(kind, T.NumericType) for kind in kinds):
        return T.DoubleType()
    if all(isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)) for kind in kinds):
        return T.TimestampNTZType()
    return T.StringType()


def _scan_drifted(spark: SparkSession, directory: str, paths: Sequence[str]) -> DataFrame | None:
    """Files of different columns or types: those alike are read together, then cast and joined by name."""
    alike: dict[str, list[str]] = {}
    kinds: dict[str, list[T.DataType]] = {}
    for path in paths:
        found, _ = _schema_of(spark, path)
        if found is not None:
            alike.setdefault(found.json(), []).append(path)
            for field in found:
                kinds.setdefault(field.name, []).append(field.dataType)
    target = {name: widened(types) for name, types in kinds.items()}
    frames = []
    for same in alike.values():
        frame = spark.read.option("basePath", directory).parquet(*same)
        frames.append(frame.select(*[F.col(c).cast(target[c]).alias(c) if c in target else F.col(c) for c in frame.columns]))
    return append_by_name(frames) if frames else None


def scan_trips(spark: SparkSession, directory: str, table: str, merge: bool = True, token: str | None = None) -> DataFrame | None:
    """All parquet files of a kind of trip; columns of different files meet by name. None when no file can be read.

    Where the files' types differ or a file is no parquet, files are looked at one by one: types are widened, and what
    cannot be read is left out, as ``file_report`` tells.
    """
    glob = name_glob([token or schema.FILE_TOKENS.get(table, table)], "parquet")
    try:
        return spark.read.option("pathGlobFilter", glob).option("mergeSchema", merge).parquet(directory)
    except (PySparkException, Py4JError) as failure:
        if "UNABLE_TO_INFER_SCHEMA" in str(failure):
            return None
        return _scan_drifted(spark, directory, _paths(spark, directory, table, token))


def append_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def date_column(columns: Sequence[str], table: str | None = None) -> str | None:
    """Known date column of a kind of trip, else the first whose name speaks of one."""
    for name in schema.DATE_COLUMNS.get(table, []):
        if name in columns:
            return name
    for name in columns:
        if any(part in name.lower() for part in schema.DATE_NAME_PARTS):
            return name
    return None


def file_years(df: DataFrame, column: str, file: str) -> DataFrame:
    """First and last year of every file."""
    return df.groupBy(file).agg(F.year(F.min(column)).alias("first_year"), F.year(F.max(column)).alias("last_year"))


def overlapping_files(df: DataFrame, column: str, file: str, start_year: int, end_year: int) -> DataFrame:
    """Files whose dates meet the range; files without any date stay."""
    apart = (F.col("last_year") < start_year) | (F.col("first_year") > end_year)
    return file_years(df, column, file).filter(~F.coalesce(apart, F.lit(False)))


def rows_of_overlapping_files(df: DataFrame, column: str | None, file: str, start_year: int, end_year: int) -> DataFrame:
    """All rows of the files that meet the range; everything when no date column is known."""
    if column is None:
        return df
    files = overlapping_files(df, column, file, start_year, end_year).select(file)
    return df.join(broadcast_if_small(files), file, "left_semi")


def scan_years(
    spark: SparkSession, directory: str, table: str, start_year: int, end_year: int, token: str | None = None
) -> DataFrame | None:
    """The rows of the years, and those without a date; all rows when no date column is known.

    The bounds are compared with the stored column, so the scan skips row groups by the footers' statistics and no
    column is read to choose files. In a layout by year, whole folders are left out.
    """
    everything = scan_trips(spark, directory, table, token=token)
    if everything is None:
        return None
    column = date_column(everything.columns, table)
    if column is None:
        return everything
    kept = keep_years(everything, column, start_year, end_year)
    if any("/year=" in file for file in everything.inputFiles()[:1]):
        kept = kept.where(F.col("year").between(start_year, end_year) | F.col("year").isNull())
    return kept
