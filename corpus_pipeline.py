"""The corpus pipeline: stages over the documents table, each written and read again by the next.

Each stage takes all that the one before kept, with its own columns, whatever else they are called. Empty tables go
through all stages; null keys, sources, languages and texts are values as the operators define them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm import bpe, fertility, mixing, near, toxicity
from tripmill.llm.common import read, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality rules keep. Rows equal in all columns share a verdict, so they are matched by content."""
    named = docs.select("*", F.struct(*near.row_hashes(docs)).alias("row__"))
    judged = fertility.judged(named, key="row__")
    kept = written(judged.where("kept").select("row__.*").distinct())
    return docs.select("*", *near.row_hashes(docs)).join(kept, ["row1__", "row2__"], "left_semi").select(*docs.columns)


def clean(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that are more probably clean than toxic."""
    columns = {name: f"own{i}__" for i, name in enumerate(docs.columns)}
    named = docs.select("doc_id", "text", *[F.col(name).alias(own) for name, own in columns.items()])
    scored = toxicity.severity_of_labelled(named, read(spark, folder, "labels"), list(columns.values()))
    return scored.where(F.col("toxic_chance") < toxicity.REJECT).select(*[F.col(own).alias(name) for name, own in columns.items()])


def different(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near.deduplicate(docs)


def mixed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of every text, in place of the text."""
    kept = [name for name in docs.columns if name not in ("text", "ids", "n_tokens")]
    return bpe.encode(docs, kept).withColumn("n_tokens", F.size("ids"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("toxicity", clean),
    ("near_duplicates", different),
    ("mixing", mixed),
    ("bpe_encoding", encoded),
]
# Neither tokenizers nor fitted models can be told in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, folder))
    return STAGES[-1][1](spark, docs, folder)
