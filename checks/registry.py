"""Names, queries and their SQL."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Check:
    name: str
    run: Run
    sql: str | None


CHECKS: dict[str, Check] = {}


def check(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query, with SQL where the result is fixed."""

    def register(run: Run) -> Run:
        if name in CHECKS:
            raise ValueError(f"{name} is registered twice")
        CHECKS[name] = Check(name, run, None if sql is None else _nudged(sql))
        return run

    return register


def with_sql(*views: str) -> str:
    return "WITH " + ", ".join(views) + " "


# Added before rounding, so that values in the middle of two roundings go the same way everywhere.
NUDGE = "3.7e-10"


def _nudged(sql: str) -> str:
    """The SQL with the nudge inside every ``round``, but for those of cut points (9 digits)."""
    out, at = "", 0
    for found in re.finditer(r"\bround\(", sql):
        start, depth, comma, i = found.end(), 1, -1, found.end()
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[i], 0)
            if sql[i] == "," and depth == 1:
                comma = i
            i += 1
        if sql[comma + 1 : i - 1].strip() == "9":
            continue
        out += sql[at:comma] + f" + {NUDGE}"
        at = comma
    return out + sql[at:]


def rounded(df: DataFrame, digits: int = 6, **other: int) -> DataFrame:
    """Doubles rounded, so that the order of additions does not show."""
    kinds = dict(df.dtypes)
    return df.select(
        *[F.round(F.col(c) + F.lit(float(NUDGE)), other.get(c, digits)).alias(c) if kinds[c] == "double" else F.col(c) for c in df.columns]
    )
