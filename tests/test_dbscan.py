from __future__ import annotations

import numpy as np
import pytest

from tripmill.operators import dbscan as module
from tripmill.operators.components import connected_components


def brute(x, eps, least):
    near = ((x[:, None] - x[None]) ** 2).sum(-1) <= eps * eps
    core = near.sum(1) >= least
    labels = np.full(len(x), -1)
    for start in range(len(x)):
        if core[start] and labels[start] < 0:
            labels[start], stack = start, [start]
            while stack:
                for other in np.nonzero(near[stack.pop()] & core)[0]:
                    if labels[other] < 0:
                        labels[other] = start
                        stack.append(other)
    touched = [set(labels[np.nonzero(near[i] & core)[0]]) for i in range(len(x))]
    return core, labels, touched


@pytest.mark.parametrize("dimensions, eps, budget", [(2, 0.25, 1_000_000), (3, 0.5, 0)])
def test_equals_brute_force(spark, monkeypatch, dimensions, eps, budget):
    monkeypatch.setattr(module, "PAIR_BUDGET", budget)
    rng = np.random.default_rng(dimensions)
    x = np.concatenate([
        rng.normal(0, 0.4, (200, dimensions)), rng.normal(2, 0.2, (100, dimensions)), rng.uniform(-3, 4, (100, dimensions)),
        np.full((60, dimensions), 3.5),
    ])
    names = [f"f{i}" for i in range(dimensions)]
    rows = [(i, *map(float, p)) for i, p in enumerate(x)] + [(len(x), *[None] * dimensions)]
    df = spark.createDataFrame(rows, "id int, " + ", ".join(f"{n} double" for n in names))
    found = {r.id: r for r in module.dbscan(df, names, eps, 10).collect()}
    assert len(found) == len(rows) and found[len(x)].cluster is None
    core, labels, touched = brute(x, eps, 10)
    named = {}
    for i in range(len(x)):
        assert found[i].is_core == core[i]
        if core[i]:
            assert named.setdefault(labels[i], found[i].cluster) == found[i].cluster
    assert sorted(named.values()) == list(range(len(named)))
    for i in range(len(x)):
        if not core[i]:
            assert found[i].cluster == min((named[k] for k in touched[i]), default=-1)


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(60)]
    star = [(100, i) for i in range(101, 160)]
    edges = spark.createDataFrame(path + star, "a int, b int")
    nodes = spark.range(0, 200).selectExpr("cast(id as int) AS node")
    found = {r.node: r.component for r in connected_components(nodes, edges).collect()}
    assert {found[i] for i in range(61)} == {0}
    assert {found[i] for i in range(100, 160)} == {100}
    assert found[180] == 180
