from __future__ import annotations

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tripmill.functions import bins, numeric, temporal
from tripmill.sources import synthetic

NAN, INF = math.nan, math.inf


@pytest.mark.parametrize(
    "function, inputs, wanted",
    [
        (temporal.time_of_day, [0, 6, 7, 12, 13, 18, 19, 23, None],
         ["night", "night", "morning", "morning", "afternoon", "afternoon", "evening", "evening", None]),
        (bins.distance_category, [0, 2, 2.01, 5, 10, 10.01, 1e9, -1, None, NAN],
         ["very_short", "very_short", "short", "short", "medium", "long", "long", None, None, None]),
        (bins.narrow_distance_category, [0, 1, 3, 10, 100, 100.1], [None, "very_short", "short", "medium", "long", None]),
        (bins.passenger_group, [None, 0, 1, 2, 3], ["solo", "solo", "solo", "couple", "group"]),
        (bins.narrow_passenger_group, [0, 1, 2, 5, 6, 10, 11], [None, "solo", "couple", "small_group", "large_group", "large_group", None]),
        (bins.payment_category, [0, 1, 2, 3, 4, 5, 6, 7, None],
         ["unknown", "credit_card", "cash", "no_charge", "dispute", "unknown", "voided", "unknown", "unknown"]),
        (bins.cash_or_not, [1, 2, None], ["non_cash", "cash", "non_cash"]),
        (lambda c: bins.fare_category(c, 10.0, 20.0), [-5, 10, 10.01, 20, 20.01, None], ["low", "low", "medium", "medium", "high", None]),
        (bins.distance_cluster, [4.9, 5, 9.9, 10], [0, 1, 1, 2]),
        (numeric.finite, [1.0, NAN, INF, -INF, None], [1.0, None, None, None, None]),
        (numeric.round_half_even, [0.125, 0.375, -0.125], [0.12, 0.38, -0.12]),
        (lambda c: numeric.clip(c, 1.0, 2.0), [0.0, 1.5, 3.0, None], [1.0, 1.5, 2.0, None]),
        (synthetic.time_factor, [5, 6, 7, 9, 10, 16, 19, 20, 23], [1.3, 1.0, 1.2, 1.2, 1.0, 1.2, 1.2, 1.0, 1.3]),
    ],
)
def test_edges(values, function, inputs, wanted):
    assert values(function, [None if v is None else float(v) for v in inputs]) == wanted


def test_ratios_without_a_value(spark):
    df = spark.createDataFrame([(5.0, 0), (5.0, 3600), (None, 60), (NAN, 60)], "d double, s int")
    assert [r[0] for r in df.select(numeric.speed_mph(df.d, df.s)).collect()] == [None, 5.0, None, None]


def test_floored_cost(spark):
    df = spark.createDataFrame([(5.0, 0.0), (5.0, 2.0), (5.0, None), (None, 1.0)], "f double, d double")
    assert [r[0] for r in df.select(numeric.floored_cost_per_mile(df.f, df.d)).collect()] == [50.0, 2.5, None, None]


def test_parse_timestamp(spark):
    df = spark.createDataFrame([("2024-01-06 13:30:00",), ("soon",)], "t string")
    lenient = [r[0] for r in df.select(temporal.parse_timestamp(df.t, strict=False)).collect()]
    assert lenient == [datetime(2024, 1, 6, 13, 30), None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CANNOT_PARSE"):
        df.select(temporal.parse_timestamp(df.t)).collect()


def test_pickup_parts(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-06 13:30:00' AS t")
    row = df.select(*[c.alias(n) for n, c in temporal.pickup_parts(F.col("t")).items()], temporal.is_weekend(F.col("t"))).first()
    assert tuple(row) == (13, 6, 1, 5, True)
