from __future__ import annotations

import random

import pytest
import xxhash

from tripmill.llm import simhash
from tripmill.llm.components import components


def fingerprint(text, words=3):
    """Bit by bit, from the definition."""
    found = (text or "").translate({c: c + 32 for c in range(65, 91)}).split(" ") if text else []
    found = [w for part in found for w in part.replace("\t", "\n").replace("\v", "\n").replace("\f", "\n").replace("\r", "\n").split("\n") if w]
    shingles = [" ".join(found[i : i + words]) for i in range(len(found) - words + 1)] or ([" ".join(found)] if found else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    value = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return value - (1 << 64) if value >> 63 else value


def roots_of(values, budget=2):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= budget and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {v: find(v) for v in values}


def near_values(n, seed):
    draw = random.Random(seed)
    centres = [draw.getrandbits(64) for _ in range(max(1, n // 30))]
    out = set()
    while len(out) < n:
        value = draw.choice(centres)
        for _ in range(draw.randrange(5)):
            value ^= 1 << draw.randrange(64)
        out.add(value - (1 << 64) if value >> 63 else value)
    return sorted(out)


@pytest.mark.parametrize("crowd", [1, 64])
@pytest.mark.parametrize("segments", [5, 7, 9])
def test_links_reach_all_within_budget(spark, crowd, segments):
    values = near_values(250, segments)
    found = components(simhash.links(spark.createDataFrame([(v,) for v in values], "print long"), segments=segments, crowd=crowd))
    got = {v: v for v in values} | {r["node"]: r["root"] for r in found.collect()}
    assert got == roots_of(values)


def test_pairs_are_exactly_those_within_budget(spark):
    values = near_values(200, 3)
    found = simhash.links(spark.createDataFrame([(v,) for v in values], "print long"), crowd=10_000).collect()
    wanted = {(a, b) for a in values for b in values if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2}
    assert sorted((r["a"], r["b"]) for r in found) == sorted(wanted)


def test_groups_against_brute_force(odd):
    rows = odd.select("doc_id", "text").collect()
    prints = [fingerprint(r["text"]) for r in rows]
    roots = roots_of(sorted(set(prints)))
    least = {}
    for r, p in zip(rows, prints, strict=True):
        if r["doc_id"] is not None:
            least[roots[p]] = min(r["doc_id"], least.get(roots[p], r["doc_id"]))
    wanted = [(r["doc_id"], p, least.get(roots[p])) for r, p in zip(rows, prints, strict=True)]
    assert sorted(map(tuple, simhash.group_documents(odd).collect()), key=repr) == sorted(wanted, key=repr)
    assert simhash.group_documents(odd.limit(0)).count() == 0


def test_components_of_a_long_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1400)] + [(7, 7), (None, 3)]
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in found} == {**{i: 0 for i in range(1, 201)}, **{i: 1000 for i in range(1001, 1400)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
