from __future__ import annotations

import random

import numpy as np

from tripmill.llm import toxicity


def test_cumulative_link_recovers_weights_and_thresholds():
    draw = np.random.default_rng(0)
    names, true, cuts = ["a", "b", "c"], np.array([3.0, 1.5, 0.0]), np.array([1.0, 2.5])
    rows = [{n: int(k) for n, k in zip(names, draw.poisson(1.0, 3), strict=True) if k} for _ in range(6000)]
    noise = draw.logistic(size=len(rows))
    scores = np.array([sum(true[names.index(n)] * np.log1p(k) for n, k in r.items()) for r in rows])
    grades = [int((s + e > cuts).sum()) for s, e in zip(scores, noise, strict=True)]
    model = toxicity.fit_rows(rows, grades, names)
    assert np.allclose([model.weights[n] for n in names], true, atol=0.3)
    assert np.allclose(model.thresholds, cuts, atol=0.25)
    over = model.probabilities({"a": 2})
    assert over == sorted(over, reverse=True)


def test_held_out_rows(documents, spark):
    draw, rows, labels = random.Random(4), [], []
    for i in range(900):
        words = [f"w{draw.randrange(400)}" for _ in range(draw.randrange(20, 80))]
        toxic = i % 5 == 0
        for _ in range(draw.randrange(2, 6) if toxic else 0):
            words.insert(draw.randrange(len(words)), draw.choice(["vile", "idiot"]) + draw.choice(["", "s", "en", "ic"]))
        rows.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, int(toxic)))
    docs = documents(rows)
    known = spark.createDataFrame(labels[:600] + [(None, 1), (5000, 1), (3, None)], "doc_id long, toxic int")
    found = {r["doc_id"]: r for r in toxicity.severity_of_labelled(docs, known, ["doc_id"]).collect()}
    wrong = [i for i, toxic in labels if (found[i]["toxic_chance"] >= toxicity.REJECT) != bool(toxic)]
    assert len(wrong) <= 4
    assert all(0 <= r["severity"] <= 3 for r in found.values())


def test_odd_rows_and_constant_models(odd, spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    found = toxicity.severity_of_labelled(odd, none, ["doc_id"]).collect()
    assert len(found) == odd.count() and {r["severity"] for r in found} == {0.0}
    one = spark.createDataFrame([(1, 0), (6, 0)], "doc_id long, toxic int")
    assert {r["toxic_chance"] for r in toxicity.severity_of_labelled(odd, one, ["doc_id"]).collect()} == {0.0}
    assert toxicity.severity_of_labelled(odd.limit(0), one, ["doc_id"]).count() == 0
