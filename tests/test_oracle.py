"""Every query with SQL must give the SQL's rows."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry
from checks import load
from checks.compare import compare, connect

FOLDER = "/root/testdata/sf0.001"
EXACT = [one for one in load().values() if one.sql is not None]
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("one", EXACT, ids=lambda one: one.name)
def test_equals_sql(spark, con, one):
    verdict, _ = compare(con, spark, FOLDER, one)
    assert verdict == "same"


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
