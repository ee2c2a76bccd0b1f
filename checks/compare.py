"""Runs every query and its SQL side by side: ``python -m checks.compare [folder] [names ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

from checks import load
from tripmill.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
KINDS = {
    "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz", "DATE": "date",
}


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(con, spark, folder: str, one) -> tuple[str, int]:
    """Verdict and number of rows of one check."""
    df = one.run(spark, folder)
    found = [tuple(row) for row in df.collect()]
    if one.sql is None:
        return "rows only", len(found)
    cursor = con.execute(one.sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: KINDS.get(str(d[1]), str(d[1])) for d in cursor.description}
    wanted = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {df.columns} / {names}", len(found)
    differ = {c: (k, kinds[c]) for c, k in df.dtypes if kinds[c] != k}
    if differ:
        return f"types {differ}", len(found)
    if len(found) != len(wanted):
        return f"rows {len(found)} / {len(wanted)}", len(found)
    columns, left = _rows(df.columns, found)
    _, right = _rows(names, wanted)
    if left != right:
        bad = [(a, b) for a, b in zip(left, right, strict=True) if a != b]
        return f"values {columns} {len(bad)} of {len(left)}: {bad[:2]}", len(found)
    return "same", len(found)


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name, one in load().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            verdict, rows = compare(con, spark, folder, one)
        except Exception as failure:
            verdict, rows = f"{type(failure).__name__}: {str(failure)[:600]}", -1
        good = verdict in ("same", "rows only")
        bad += not good
        print(f"{'ok ' if good else 'BAD'} {name:45s} {rows:8d} {time.time() - start:6.1f}s {verdict}", flush=True)
        spark.catalog.clearCache()
    print(f"{bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
