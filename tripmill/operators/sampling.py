"""Samples and splits that depend on a key's hash, not on the partitioning."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions.hashing import hash48, hash_bucket
from tripmill.operators.quantiles import nth_smallest
from tripmill.session import cut_lineage

# Up to this many rows the top-n operator of the plan does the work.
TOP_ROWS = 100_000
DRAW = "__draw"


def random_rows(df: DataFrame, n: int, seed: int | None = None) -> DataFrame:
    """Any n rows, or all when there are fewer."""
    if n <= TOP_ROWS:
        return df.orderBy(F.rand(seed)).limit(n)
    if n >= df.count():
        return df
    # Drawn once and written, so that the cut and the rows know the same numbers.
    drawn = cut_lineage(df.withColumn(DRAW, F.rand(seed)))
    cut = F.lit(nth_smallest(drawn, F.lit("all"), F.col(DRAW), lambda _: n - 1)["all"])
    below = drawn.filter(F.col(DRAW) < cut)
    ties = drawn.filter(F.col(DRAW) == cut).limit(n - below.count())
    return below.unionByName(ties).drop(DRAW)


def sample_rows(df: DataFrame, n: int, key: str) -> DataFrame:
    """The n rows with the smallest key hash, or all when there are fewer."""
    if n <= TOP_ROWS:
        return df.orderBy(hash48(F.col(key)), F.col(key)).limit(n)
    rank = lambda rows: n - 1 if n <= rows else None
    cut = nth_smallest(df, F.lit("all"), hash48(F.col(key)), rank)
    if not cut:
        return df
    limit = F.lit(int(cut["all"]))
    below = df.filter(hash48(F.col(key)) < limit)
    ties = df.filter(hash48(F.col(key)) == limit).orderBy(F.col(key)).limit(n - below.count())
    return below.unionByName(ties)


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    return (df.orderBy(*order) if order else df).limit(n)


def sample_fraction(df: DataFrame, percent: int, key: str) -> DataFrame:
    return df.filter(hash_bucket(F.col(key)) < percent)


def split(df: DataFrame, key: str, train_percent: int = 80) -> tuple[DataFrame, DataFrame]:
    bucket = hash_bucket(F.col(key))
    return df.filter(bucket < train_percent), df.filter(bucket >= train_percent)


def fold_number(key: Column, folds: int) -> Column:
    return hash_bucket(F.concat_ws(":", F.lit("fold"), key.cast("string")), folds).cast("int")


def training_share(rows: int, share: float) -> int | None:
    """0-based rank of the last training row, None when no row trains."""
    kept = math.floor(rows * share + 1e-9)
    return kept - 1 if kept > 0 else None


def stratified_split(df: DataFrame, key: str, label: str, share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Split each label in the same proportion, by hash order inside the label.

    The cut inside a label is the exact order statistic of the hash, so no label's
    rows are ever gathered or sorted in one task. Rows without a label go to the test side.
    """
    position = hash48(F.col(key))
    cuts = nth_smallest(df, F.col(label), position, lambda rows: training_share(rows, share))
    # One comparison with the label's own cut: the hash is worked out once per row.
    cut_of_label = F.lit(None).cast("bigint")
    for name, cut in cuts.items():
        cut_of_label = F.when(F.col(label).cast("string") == name, F.lit(int(cut))).otherwise(cut_of_label)
    train = F.coalesce(position <= cut_of_label, F.lit(False))
    return df.filter(train), df.filter(~train)
