from __future__ import annotations

import random
from itertools import permutations

import pytest

from checks.compare import connect
from tripmill.llm import interaction
from tripmill.llm.common import read

NAMES = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def brute(docs, labels):
    """By applying the filters one after the other to lists of rows."""
    failing, part_of = [], []
    for key, text, part in docs:
        words = [w for w in text.translate({c: " " for c in (*range(9, 14), 32)}).split(" ") if w]
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": key is not None and any(k is not None and k < key and t == text for k, t, _ in docs),
        }
        failing.append({letter for letter, bad in fails.items() if bad})
        part_of.append(part)
    good = [any(k == key and k is not None and q == 1 for k, q, _ in labels) for key, _, _ in docs]
    toxic = [any(k == key and k is not None and t == 1 for k, _, t in labels) for key, _, _ in docs]
    rows, shapley = [], {}
    for part in set(part_of):
        of = [i for i in range(len(docs)) if part_of[i] == part]
        for order in permutations("ABCDE"):
            left = list(of)
            for step, letter in enumerate(order, 1):
                out = [i for i in left if letter in failing[i]]
                earlier = [i for i in of if i not in left and letter in failing[i]]
                left = [i for i in left if i not in out]
                shapley[part, letter] = shapley.get((part, letter), 0) + len(out)
                rows.append((part, "".join(order), step, len(left), len(out), len(earlier), sum(failing[i] == {letter} for i in of), sum(good[i] for i in out), sum(toxic[i] for i in out)))
    return sorted((*row, shapley[row[0], row[1][row[2] - 1]]) for row in rows)


def found(docs, labels):
    return sorted(tuple(r[n] for n in NAMES) for r in interaction.audit(interaction.cells(docs, labels)).collect())


def test_like_brute_force(spark, odd, documents):
    draw = random.Random(3)
    pool = [" ".join(draw.choice(["A", "b", "c#", "Dd", "é", "word%d" % draw.randrange(900)]) for _ in range(draw.randrange(150, 400))) for _ in range(12)]
    rows = [(draw.choice([None, *range(50)]), draw.choice(pool), draw.choice([None, "", "en", "fr"]), "s", 1) for _ in range(70)]
    rows += [(100 + i, pool[0], "en", "s", 1) for i in range(40)]
    labels = [(i, draw.choice([0, 1, None]), draw.choice([0, 1, None])) for i in [*range(60), *range(100, 130), 3, 4, None]]
    marks = spark.createDataFrame([(*row, "x") for row in labels], "doc_id long, quality int, toxic int, digest string")
    docs = documents(rows).unionByName(odd.where("doc_id IS NULL OR doc_id <> 4")).withColumnsRenamed({"size": "mask", "rank": "part", "shard": "digest", "row": "key"})
    plain = [(r["doc_id"], r["text"] or "", r["lang"] or "") for r in docs.collect()]
    assert found(docs, marks) == brute(plain, labels)


def test_one_part_has_every_step(odd, spark):
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = interaction.audit(interaction.cells(odd, marks)).where("part = 'en'").collect()
    assert len(rows) == 600 and len({(r.filter_order, r.step) for r in rows}) == 600
    assert {r.good_lost + r.toxic_lost for r in rows} == {0}
    for r in rows:
        assert r.step > 1 or r.redundant == 0


def test_no_documents_no_rows(odd, spark):
    marks = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert found(odd.limit(0), marks) == []


def test_filters_must_be_few_and_different(spark):
    masks = spark.createDataFrame([(1,)], "mask int")
    assert interaction.steps(masks, "AB").count() == 4
    for letters in ("AA", "ABCDEFG"):
        with pytest.raises(ValueError):
            interaction.steps(masks, letters)


def test_sql(spark):
    folder = "/root/testdata/sf0.001"
    cursor = connect(folder).execute(interaction.AUDIT_SQL)
    names = [d[0] for d in cursor.description]
    wanted = sorted(tuple(dict(zip(names, row, strict=True))[n] for n in NAMES) for row in cursor.fetchall())
    assert found(read(spark, folder, "documents"), read(spark, folder, "labels")) == wanted
