"""Session settings and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app: str = "tripmill", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC timestamps and adaptive execution (skew joins included)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names; a local one only when the session runs on one machine."""
    folder = spark.conf.get(CHECKPOINT_KEY, None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a shared folder")
        folder = tempfile.mkdtemp(prefix="tripmill-checkpoint-")
        spark.conf.set(CHECKPOINT_KEY, folder)
    return folder


def spread(df: DataFrame) -> DataFrame:
    """The rows in even partitions for all cores; files of few row groups are read by as few tasks."""
    return df.hint("rebalance")


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows written to the checkpoint folder and read back.

    Iterative jobs call this once a round: the rows are computed once, survive lost
    executors, and come back with known sizes, so the planner picks joins by size.
    They are deleted when the session's JVM ends.
    """
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/tripmill-{uuid.uuid4().hex}"
    df.write.parquet(path)
    written = spark._jvm.org.apache.hadoop.fs.Path(path)
    written.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(written)
    return spark.read.schema(df.schema).parquet(path)
