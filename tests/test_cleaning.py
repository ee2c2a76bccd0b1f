from __future__ import annotations

from datetime import datetime

import pytest

from tripmill.operators import cleaning, features, validation


def test_years_keep_rows_without_a_date(spark):
    days = [None, datetime(2021, 12, 31, 23, 59, 59), datetime(2022, 1, 1), datetime(2024, 12, 31, 23, 59, 59), datetime(2025, 1, 1)]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "i int, pickup_datetime timestamp_ntz")
    assert [r.i for r in cleaning.keep_years(df, "pickup_datetime", 2022, 2024).orderBy("i").collect()] == [0, 2, 3]
    assert cleaning.count_outside_years(df, "pickup_datetime", 2022, 2024).first()[0] == 2


def test_year_filter_reaches_the_scan(spark, tmp_path):
    spark.sql("SELECT 1 AS id, TIMESTAMP_NTZ '2023-05-01' AS t").write.parquet(str(tmp_path / "t"))
    plan = cleaning.keep_years(spark.read.parquet(str(tmp_path / "t")), "t", 2022, 2024)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(t,2022-01-01T00:00)" in plan


def test_trims_run_in_sequence(spark):
    rows = [(float(f), float(d)) for f, d in zip(range(1, 101), [1000] * 1 + list(range(1, 100)), strict=True)]
    df = spark.createDataFrame(rows, "fare_amount double, trip_distance double")
    kept = cleaning.clean_trips(df)
    assert kept.agg({"fare_amount": "max"}).first()[0] == 99.0
    assert kept.agg({"trip_distance": "max"}).first()[0] == 98.0
    with pytest.raises(ValueError):
        cleaning.clean_trips(df.filter("fare_amount < 0"))


def test_fill_values(spark):
    df = spark.createDataFrame([(1, 1.0, "a"), (None, None, "a"), (4, 2.0, "b"), (4, 9.0, None)], "n int, x double, s string")
    assert cleaning.fill_values(df) == {"n": 4.0, "x": 2.0, "s": "a"}
    assert cleaning.fill_missing(df).filter("n is null or x is null or s is null").count() == 0
    zeros = cleaning.fill_missing(df, "zero", "missing")
    assert zeros.filter("n = 0 and x = 0").count() == 1 and zeros.filter("s = 'missing'").count() == 1
    assert dict(cleaning.fill_missing(df).dtypes)["n"] == "int"


def test_fill_ties_take_the_smaller(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "s string")
    assert cleaning.fill_missing(df).filter("s = 'a'").count() == 2


@pytest.mark.parametrize("method", ["iqr", "zscore"])
def test_clip(spark, method):
    df = spark.createDataFrame([(float(v), 5.0, "t") for v in [*range(20), 1000]], "v double, c double, s string")
    clipped = cleaning.clip_outliers(df, ["v", "c", "s", "none"], method)
    assert clipped.agg({"v": "max"}).first()[0] < 500
    assert {r.c for r in clipped.collect()} == {5.0}


def test_features_fall_back_to_medians(spark):
    df = spark.createDataFrame([(10.0, 2.0, 360), (20.0, 0.0, 0), (9.0, 3.0, 1080)], "fare_amount double, trip_distance double, trip_time_in_secs int")
    rows = features.add_features(df).orderBy("fare_amount").collect()
    assert [r.speed for r in rows] == [10.0, 20.0, 15.0]
    assert [r.cost_per_mile for r in rows] == [3.0, 5.0, 4.0]
    assert features.add_features(df, medians={"speed": 1.0, "cost_per_mile": 2.0}).filter("speed = 1 and cost_per_mile = 2").count() == 1


def test_feature_steps_are_skipped_without_their_columns(spark):
    made = features.add_features(spark.createDataFrame([(3,)], "passenger_count int"))
    assert made.columns == ["passenger_count", "passenger_group"]
    text = spark.createDataFrame([("2024-01-06 13:30:00", 1.0, 1.0)], "tpep_pickup_datetime string, fare_amount double, trip_distance double")
    assert features.add_features(text).first().time_of_day == "afternoon"


def test_validation(spark):
    df = spark.range(5)
    assert validation.is_valid(df, ["id"], 5)
    assert not validation.is_valid(df, ["id"], 6)
    assert not validation.is_valid(df, ["fare"])
    assert not validation.is_valid(df.limit(0))


def test_column_roles(spark):
    df = spark.range(50).selectExpr(
        "id % 9 AS nine", "id % 10 AS ten", "id * 1.5D AS many", "'x' AS word", "true AS flag", "TIMESTAMP_NTZ '2024-01-01' AS t", "id AS fare_amount"
    )
    assert validation.column_roles(df, target="fare_amount") == {"nine": "categorical", "ten": "numeric", "many": "numeric", "word": "categorical"}


def test_small_categories_go(spark):
    df = spark.createDataFrame([("a",)] * 9 + [("b",)] * 10, "c string")
    assert {r.c for r in validation.keep_large_categories(df, "c", 10).collect()} == {"b"}
