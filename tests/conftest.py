from __future__ import annotations

import pytest

from tripmill.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__checkpoint__dir=str(folder / "checkpoint"),
        spark__sql__warehouse__dir=str(folder / "warehouse"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Results of a column function over a list of inputs."""

    def run(function, inputs, kind="double"):
        rows = [(i, value) for i, value in enumerate(inputs)]
        df = spark.createDataFrame(rows, f"i int, v {kind}")
        return [row[0] for row in df.orderBy("i").select(function(df.v)).collect()]

    return run
