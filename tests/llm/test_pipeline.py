from __future__ import annotations

import random

import corpus_pipeline
import __spark_entry__ as entry
from tripmill.llm import queries


def test_stages_keep_columns_and_clean_rows(odd, documents, spark, tmp_path):
    draw = random.Random(7)
    texts = [" ".join(f"w{draw.randrange(3000)}" for _ in range(draw.randrange(40, 90))) for _ in range(200)]
    texts += texts[:20] + [t + " end" for t in texts[20:40]] + [t + " idiotic idiots idiot" for t in texts[40:60]]
    docs = documents([(i, t, "en", f"s{i % 3}", 0) for i, t in enumerate(texts)]).unionByName(odd.where("doc_id IS NULL OR doc_id <> 4"))
    spark.createDataFrame([(i, int(i >= 240)) for i in range(260)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != "bpe_encoding":
            assert out.columns == docs.columns
        docs = corpus_pipeline.written(out)
        seen.append({r["doc_id"] for r in docs.select("doc_id").collect()})
    assert set(range(240)) <= seen[0] and seen[0] <= set(range(260))
    assert seen[1] == set(range(240))
    assert seen[2] == set(range(200))
    empty = odd.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


def test_registered():
    names = set(entry.queries())
    assert set(queries.QUERIES) | {"pipeline"} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
