from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tripmill.llm import ann


def test_recall_scores_and_order(spark):
    draw = np.random.default_rng(1)
    vectors = draw.normal(size=(3000, 16)) + 2 * draw.normal(size=(12, 16))[draw.integers(12, size=3000)]
    vectors[100:400] = vectors[40]
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = ann.search(table, F.col("vec_id") % 20 == 0, count=10).collect()
    found, hits = {}, 0
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((-r["score"], r["vec_id"]))
        assert abs(r["score"] - vectors[r["query_id"]] @ vectors[r["vec_id"]]) < 1e-9
    assert len(found) == 150
    for query, best in found.items():
        score = (vectors[query] * vectors).sum(axis=1)
        score[query] = -np.inf
        hits += len({i for _, i in best} & set(np.lexsort((np.arange(3000), -score))[:10]))
        assert best == sorted(best) and len(best) == 10 and query not in [i for _, i in best]
    assert hits >= 0.9 * 1500


def test_balanced_parts():
    vectors = np.random.default_rng(2).normal(size=(1000, 8))
    part = ann.balanced(ann.nearest(vectors, vectors, 10, own=True), ann.halves(vectors, 7), 7)
    assert np.bincount(part, minlength=7).max() <= np.ceil(1000 / 7 * 1.05)


def test_odd_rows(spark):
    rows = [
        (1, [1.0, 0.0]), (2, [1.0, 0.0]), (20, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [1.0, None]), (7, [1.0, 1.0, 1.0]),
        (8, [float("inf"), 1.0]), (9, []), (None, [1.0, 1.0]), (40, [2.0, 3.0]), (20, [1.0, 0.0]), (60, None),
    ]
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, rank int, part string")
    got = [tuple(r) for r in ann.search(table, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(20, 1, 40, 2.0), (20, 2, 1, 1.0), (20, 3, 2, 1.0), (40, 1, 1, 2.0), (40, 2, 2, 2.0), (40, 3, 20, 2.0)]
    assert ann.search(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0
