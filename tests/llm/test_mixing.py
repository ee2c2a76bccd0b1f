from __future__ import annotations

import random
from collections import defaultdict

from tripmill.llm import mixing


def filled(sizes):
    """Targets by the rule itself: cap, share out again, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    left, open_, target = float(sum(sizes.values())), set(order), {}
    while True:
        total = sum(weight[s] for s in open_)
        above = [s for s in open_ if left * weight[s] / total > 3 * sizes[s]]
        if not above:
            return target | {s: left * weight[s] / total for s in open_}
        for s in above:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
            open_.remove(s)


def test_targets_words_and_reruns(documents):
    draw, rows = random.Random(2), []
    for i in range(3000):
        source = draw.choice(["hot"] * 6 + ["ä", "b", "c", "tiny", None]) if i > 3 else "tiny"
        rows.append((i, " ".join(["w"] * int(draw.lognormvariate(4, 1.2))), "en", source, 0))
    docs = documents(rows)
    found = mixing.taken(docs)
    got, size, words = found.collect(), defaultdict(int), defaultdict(int)
    source_of = {r[0]: r[3] for r in rows}
    for r in got:
        source = source_of[r["doc_id"]]
        size[source] += r["size"]
        words[source] += r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] % max(r["size"], 1) == 0
    wanted = filled(size)
    for r in got:
        assert r["source_size"] == size[source_of[r["doc_id"]]]
        assert abs(r["target"] - wanted[source_of[r["doc_id"]]]) < 1e-6 * r["target"]
    for source, target in wanted.items():
        assert abs(words[source] - target) <= 0.01 * target + 2
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.taken(docs.repartition(5)).collect()))
    mix = mixing.mix(docs)
    assert mix.columns == docs.columns
    assert sum(len(r["text"].split()) for r in mix.collect()) == sum(words.values())


def test_odd_rows(odd):
    got = mixing.taken(odd).collect()
    assert len(got) == odd.count() and all(r["size"] == 0 or r["taken"] <= 3 * r["size"] for r in got)
    assert mixing.mix(odd).columns == odd.columns
    assert mixing.taken(odd.limit(0)).count() == 0 and mixing.mix(odd.limit(0)).count() == 0


def test_no_python_on_the_main_path(odd):
    plan = mixing.taken(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
