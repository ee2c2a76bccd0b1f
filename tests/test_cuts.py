"""Limits that fall on a value whose last bit is not that of its digits, as in large tables of prices."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from checks import load
from checks.compare import compare, connect
from tripmill.operators.cleaning import trim
from tripmill.operators.features import fare_cuts

FOLDER = Path("/root/testdata/sf0.001")
NAMES = [
    "p3_trim_two_sided", "a17_crosstab_counts", "e2_classification_report", "e4_confusion_matrix", "f28_study_features",
    "m6_stratified_split", "m7_label_encoding", "m16_classification_rows", "v3_dashboard",
]
# Cents whose thousandth part is a bit above the number of the same digits.
AWKWARD = [p / 100 for p in range(1_000_000, 9_000_000, 1_234) if round(p / 100 / 1000.0, 9) < p / 100 / 1000.0][:5]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    if not FOLDER.exists():
        pytest.skip("test tables are not here")
    made = tmp_path_factory.mktemp("cuts")
    price = f"list_extract({AWKWARD}, 1 + CAST(l_orderkey % 5 AS INTEGER))"
    lines = f"SELECT * REPLACE ({price} AS l_extendedprice) FROM '{FOLDER}/lineitem.parquet'"
    duckdb.connect().execute(f"COPY ({lines}) TO '{made}/lineitem.parquet' (FORMAT parquet)")
    for path in FOLDER.glob("*.parquet"):
        if path.name != "lineitem.parquet":
            (made / path.name).symlink_to(path)
    return str(made)


@pytest.mark.parametrize("name", NAMES)
def test_limit_on_a_value(spark, folder, name):
    verdict, _ = compare(connect(folder), spark, folder, load()[name])
    assert verdict == "same"


def test_limits_have_no_stray_bits(spark):
    fares = [(price / 1000.0,) for price in AWKWARD for _ in range(20)]
    df = spark.createDataFrame(fares, "fare_amount double")
    assert fare_cuts(df) == (round(AWKWARD[1] / 1000.0, 9), round(AWKWARD[3] / 1000.0, 9))
    assert trim(df, ["fare_amount"]).count() == 80
