from __future__ import annotations

import random
import zlib
from collections import defaultdict

from tripmill.llm import sharding


def test_law_groups_and_slots(documents):
    draw = random.Random(3)
    texts = [" ".join(f"w{draw.randrange(99)}" for _ in range(draw.randrange(1, 60))) for _ in range(1500)] + ["the same copy"] * 900
    docs = documents([(i, t, "en", "s", 0) for i, t in enumerate(texts)])
    got = sharding.assign(docs, shards=8).collect()
    size, slots, shards = defaultdict(int), defaultdict(list), defaultdict(set)
    for r in got:
        text = texts[r["doc_id"]]
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(text) + 1, zlib.crc32(text.encode()), "bytes", None)
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        shards[text].add(r["shard"])
    assert sorted(size) == list(range(8)) and max(size.values()) < 1.03 * min(size.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for text, s in shards.items() if text != "the same copy") and len(shards["the same copy"]) > 1
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, sharding.assign(docs.repartition(5), shards=8).collect()), key=repr)


def test_odd_rows_and_files(odd, tmp_path):
    got = sharding.assign(odd, shards=4).collect()
    assert len(got) == odd.count()
    assert {(r["size"], r["text_crc32"]) for r in got if r["doc_id"] in (1, 2)} == {(1, 0)}
    assert sharding.assign(odd.limit(0)).count() == 0
    sharding.write_shards(odd.drop("shard"), str(tmp_path / "shards"), shards=4)
    assert odd.sparkSession.read.parquet(str(tmp_path / "shards")).count() == odd.count()
