from __future__ import annotations

import math

from pyspark.sql import functions as F

from tripmill.operators import numbering, sampling


def test_split_is_disjoint_and_complete(spark):
    df = spark.range(2000).withColumnRenamed("id", "key")
    train, test = sampling.split(df, "key")
    assert train.intersect(test).count() == 0
    assert train.count() + test.count() == 2000
    again, _ = sampling.split(df.repartition(13), "key")
    assert again.exceptAll(train).count() == 0


def test_stratified_split_keeps_proportions(spark):
    df = spark.range(3000).select(F.col("id").alias("key"), F.when(F.col("id") % 10 < 7, "big").when(F.col("id") % 10 < 9, "small").alias("label"))
    train, test = sampling.stratified_split(df, "key", "label")
    sizes = {r.label: r["count"] for r in df.groupBy("label").count().collect()}
    taken = {r.label: r["count"] for r in train.groupBy("label").count().collect()}
    assert taken == {k: math.floor(n * 0.8) for k, n in sizes.items() if k}
    assert train.count() + test.count() == 3000


def test_sample_is_the_same_with_and_without_sort(spark, monkeypatch):
    df = spark.range(500).withColumnRenamed("id", "key").repartition(7)
    by_sort = {r.key for r in sampling.sample_rows(df, 120, "key").collect()}
    monkeypatch.setattr(sampling, "TOP_ROWS", 10)
    assert {r.key for r in sampling.sample_rows(df, 120, "key").collect()} == by_sort
    assert sampling.sample_rows(df, 900, "key").count() == 500


def test_ties_of_the_key_do_not_change_the_size(spark, monkeypatch):
    monkeypatch.setattr(sampling, "TOP_ROWS", 10)
    df = spark.range(300).select((F.col("id") % 4).alias("key"))
    assert sampling.sample_rows(df, 100, "key").count() == 100


def test_random_rows_of_large_samples_stay_spread(spark, monkeypatch):
    monkeypatch.setattr(sampling, "TOP_ROWS", 100)
    rows = spark.range(5_000).repartition(4)
    whole = sampling.random_rows(rows, 2_000_000_000, 1)
    part = sampling.random_rows(rows, 3_000, 1)
    for found, n in ((whole, 5_000), (part, 3_000)):
        assert found.distinct().count() == found.count() == n
    assert "Limit" not in whole._jdf.queryExecution().optimizedPlan().toString()
    held = part.rdd.mapPartitions(lambda some: [sum(1 for _ in some)]).collect()
    assert max(held) < 3_000
    assert part.columns == ["id"] and 2_300 < part.agg({"id": "avg"}).first()[0] < 2_700


def test_random_rows(spark):
    assert sampling.random_rows(spark.range(50), 20, 1).distinct().count() == 20
    assert sampling.random_rows(spark.range(50), 80).count() == 50


def test_running_numbers(spark):
    df = spark.range(1000).select((F.lit(999) - F.col("id")).alias("v")).repartition(9)
    rows = numbering.number_rows(df, "v").collect()
    assert all(r.number == r.v + 1 for r in rows) and len(rows) == 1000
