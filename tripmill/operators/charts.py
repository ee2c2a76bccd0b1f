"""The tables behind the charts; nothing is drawn."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.operators.profiling import melt
from tripmill.operators.sampling import sample_rows


def error_histogram(df: DataFrame, actual: str, predicted: str, category: str, bins: int = 50) -> DataFrame:
    """Prediction errors counted in equal bins between the smallest and largest, by category."""
    errors = df.select(category, (F.col(predicted) - F.col(actual)).alias("error")).filter("error is not null")
    edges = errors.agg(F.struct(F.min("error").alias("lo"), F.max("error").alias("hi"))).scalar()
    rows = errors.select(category, "error", edges["lo"].alias("lo"), edges["hi"].alias("hi"))
    share = F.try_divide(F.col("error") - F.col("lo"), F.col("hi") - F.col("lo"))
    place = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * bins), F.lit(bins - 1)).cast("int")
    return rows.groupBy(category, place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def fare_points(df: DataFrame, key: str, n: int = 1000, columns: Sequence[str] = ("trip_distance", "fare_amount", "fare_category")) -> DataFrame:
    return sample_rows(df, n, key).select(key, *columns)


def score_bars(scores: DataFrame, ids: Sequence[str], measures: Sequence[str]) -> DataFrame:
    return melt(scores, ids, measures, "measure", "score")
