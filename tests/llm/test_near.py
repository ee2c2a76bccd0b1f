from __future__ import annotations

import random

from pyspark.sql import functions as F

from tripmill.llm import near, simhash


def edited(words, n, draw):
    words = list(words)
    for _ in range(n):
        words[draw.randrange(len(words))] = f"new{draw.randrange(10**6)}"
    return words


def test_groups_against_brute_force(documents, monkeypatch):
    monkeypatch.setattr(near, "CROWD", 6)
    draw, texts = random.Random(1), []
    for _ in range(4):
        base = [f"w{draw.randrange(5000)}" for _ in range(200)]
        texts += [" ".join(edited(base, draw.randrange(9), draw)) for _ in range(30)]
    texts += [" ".join(f"u{draw.randrange(5000)}" for _ in range(50)) for _ in range(20)] + ["", None, "two words", "two words"]
    sets = [frozenset(simhash.shingles_of(t, 5)[0]) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both >= 0.8 * (len(a) + len(sets[j]) - both):
                root[max(find(i), find(j))] = min(find(i), find(j))
    docs = documents([(i, t, "en", "s", 0) for i, t in enumerate(texts)])
    kept = near.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({find(i) for i in range(len(texts))})


def test_odd_rows(odd):
    kept = [r["doc_id"] for r in near.deduplicate(odd).collect()]
    # Rows without words are one group; of the equal texts the smallest key stays.
    assert sorted(kept, key=str) == sorted([1, None, 4, 5, 6, 8, 9], key=str)
    assert near.deduplicate(odd.limit(0)).count() == 0


def test_crowded_block_joins_texts_with_a_repeated_word(documents, monkeypatch):
    sketches = near._sketches
    monkeypatch.setattr(near, "_sketches", lambda *a: sketches(*a).withColumn("blocks", F.array(F.lit(1).cast("long"))))
    monkeypatch.setattr(near, "CROWD", 4)
    monkeypatch.setattr(near, "LEADERS", 1)
    draw = random.Random(3)
    base = [f"w{draw.randrange(5000)}" for _ in range(200)]
    rows = [(i, " ".join(edited(base, 2, draw)), "en", "s", 0) for i in range(10)]
    for i in range(10, 18, 2):
        text = " ".join(f"v{draw.randrange(5000)}" for _ in range(84))
        rows += [(i, text, "en", "s", 0), (i + 1, text + " same" * 24, "en", "s", 0)]
    assert sorted(r["doc_id"] for r in near.deduplicate(documents(rows)).collect()) == [0, 10, 12, 14, 16]


def test_texts_are_shuffled_compressed(documents):
    words = " ".join(f"word{i % 97}" for i in range(3_000))
    texts = [words, "", None, "naïve 東京 \U0001f600", "\x00"]
    packed = near._packed(documents([(i, t, "en", "s", 0) for i, t in enumerate(texts)]).select("doc_id", F.col("text").alias("text__")))
    found = {r["doc_id"]: r["text__"] for r in packed.collect()}
    assert [near.unpacked(found[i]) for i in range(len(texts))] == texts
    assert len(found[0]) < len(words) / 10
