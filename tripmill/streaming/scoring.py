"""Batch scoring starts no job of its own, so the same plan runs on a stream."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tripmill import schema
from tripmill.plans.scoring import FareScorer


def score_arrivals(
    spark: SparkSession,
    scorer: FareScorer,
    source: str,
    target: str,
    checkpoint: str,
    columns: StructType = schema.TRIP_SCHEMA,
) -> StreamingQuery:
    """Score every trip file once as it arrives; stops when the files at hand are done."""
    trips = spark.readStream.schema(columns).parquet(source)
    return (
        scorer.predict(trips)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )
