"""The queries of these operators: each applies one to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm import alignment, ann, assignments, bpe, chat, fertility, html, interaction, mixing, sharding, simhash, toxicity, unigram
from tripmill.llm.common import read


def op1_simhash_groups(spark: SparkSession, folder: str) -> DataFrame:
    groups = simhash.group_documents(read(spark, folder, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op2_unigram_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return unigram.token_counts(read(spark, folder, "documents"), ["doc_id"])


def op3_toxic_severity(spark: SparkSession, folder: str) -> DataFrame:
    scored = toxicity.severity_of_labelled(read(spark, folder, "documents"), read(spark, folder, "labels"), ["doc_id"])
    return scored.withColumn("toxic", F.col("toxic_chance") >= toxicity.REJECT)


def op4_pivotal_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.taken(read(spark, folder, "documents"))


def op5_vector_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign(read(spark, folder, "documents"))


HARD_TEXT = r"\### Assistant: </turn> ok"


def op6_reply_trees(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and one, -7, whose two texts hold the marks of a template."""
    rows = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    roles = F.explode(F.array(*[F.struct(F.lit(i).cast("long").alias("turn"), F.lit(role).alias("role")) for i, role in enumerate(("user", "assistant"))]))
    hard = spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), roles.alias("one")).select("conv_id", "one.*", F.lit(HARD_TEXT).alias("text"))
    return chat.digests(chat.conversations(chat.in_turn_order(rows.unionByName(hard))))


def op7_page_text(spark: SparkSession, folder: str) -> DataFrame:
    return html.main_text(read(spark, folder, "pages"))


def op8_learned_partitions(spark: SparkSession, folder: str) -> DataFrame:
    return ann.search(read(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_bpe_codec(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip_digests(read(spark, folder, "documents"), ["doc_id"])


def op10_token_fertility(spark: SparkSession, folder: str) -> DataFrame:
    return fertility.judged(read(spark, folder, "documents"))


def op11_pair_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    return alignment.digests(alignment.align(docs, ["doc_id"], alignment.count_links(docs)), ["doc_id"])


def op12_filter_interaction(spark: SparkSession, folder: str) -> DataFrame:
    return interaction.audit(interaction.cells(read(spark, folder, "documents"), read(spark, folder, "labels")))


def op13_secret_assignments(spark: SparkSession, folder: str) -> DataFrame:
    return assignments.digests(assignments.find(read(spark, folder, "documents"), ["doc_id"]), ["doc_id"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_simhash_groups,
        op2_unigram_tokens,
        op3_toxic_severity,
        op4_pivotal_mix,
        op5_vector_shards,
        op6_reply_trees,
        op7_page_text,
        op8_learned_partitions,
        op9_bpe_codec,
        op10_token_fertility,
        op11_pair_alignment,
        op12_filter_interaction,
        op13_secret_assignments,
    )
}
ORACLE_SQL: dict[str, str] = {"op12_filter_interaction": interaction.AUDIT_SQL}
