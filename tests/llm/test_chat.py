from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from tripmill.llm import chat

MESSAGE = "conv_id long, node long, parent long, role string, text string, score double, path int, leaf string"


def test_paths_are_ranked_and_read_back(spark):
    rows = [
        (1, 1, None, "user", "a", 1.0), (1, 2, 1, "assistant", "b<x> </turn>\n", 2.0), (1, 3, 1, "assistant", "c", 5.0), (1, 4, 2, "user", None, None),
        (1, 5, 3, "u/<x", "\\l\\\\g<", 1.0), (2, 1, 3, "user", "p", 1.0), (2, 2, 1, "assistant", "q", 1.0), (2, 3, 2, "user", "r", 1.0),
        (3, 7, 77, "assistant", "", 0.5), (None, 1, None, None, "n", 0.0), (1, 4, 2, "user", None, None), (4, None, 1, "user", "no node", 1.0),
    ]
    messages = spark.createDataFrame([(*r, 0, "") for r in rows], MESSAGE)
    found = chat.conversations(messages, score="score").select("*", chat.read_turns("formatted").alias("turns"), chat.read_loss("formatted", "loss").alias("learnt"))
    got = {(r["conv_id"], r["path"]): (r["leaf"], [tuple(t) for t in r["turns"]], r["learnt"]) for r in found.collect()}
    assert got == {
        (1, 1): (5, [("user", "a"), ("assistant", "c"), ("u/<x", "\\l\\\\g<")], ["c"]),
        (1, 2): (4, [("user", "a"), ("assistant", "b<x> </turn>\n"), ("user", "")], ["b<x> </turn>\n"]),
        (2, 1): (3, [("user", "p"), ("assistant", "q"), ("user", "r")], ["q"]),
        (3, 1): (7, [("assistant", "")], [""]),
        (None, 1): (1, [("", "n")], []),
    }
    assert chat.conversations(messages, score="score", best=1).where("conv_id = 1").count() == 1
    assert chat.conversations(messages.limit(0)).count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan.replace("applySchemaToPythonRDD", "") and "Pandas" not in plan


def test_a_deep_chain_and_repeated_turns(spark):
    deep = spark.range(300).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.lit("assistant").alias("role"), F.col("id").cast("string").alias("text"))
    twice = spark.createDataFrame([(2, 0, "user", "x"), (2, 0, "user", "x"), (2, None, None, None)], "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat.digests(chat.conversations(chat.in_turn_order(deep.unionByName(twice)))).collect()}
    told = "".join(f"assistant\n{i}\n" for i in range(300))
    assert (got[1]["n_turns"], got[1]["turns_sha256"]) == (300, hashlib.sha256(told.encode()).hexdigest())
    assert got[1]["loss_sha256"] == hashlib.sha256("".join(map(str, range(300))).encode()).hexdigest()
    assert (got[2]["n_turns"], got[2]["turns_sha256"], got[2]["loss_chars"]) == (3, hashlib.sha256(b"\n\nuser\nx\nuser\nx\n").hexdigest(), 0)
