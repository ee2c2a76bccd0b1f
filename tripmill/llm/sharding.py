"""Sharding by vector bin packing: bytes, tokens and rows of the shards are balanced together.

Rows of equal texts form a group. Groups that are large against a shard are placed one by one, in parts if they are
too large for one shard; the others are packed in packages by a hash. The bounded list of these items is placed,
largest first, each on the shard whose residual capacity has the highest dot product with the item.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.common import PART_ROWS, WORD, written

SHARDS = 16
#: Groups over 1/64 of a shard in some measure are placed one by one; there are at most 64 such for each shard and measure.
ITEMS = 64
#: A group over this part of a shard is spread in as many parts as there are shards.
MOST_IN_A_SHARD = 0.5
#: The other groups come in so many packages for each shard.
PACKAGES = 256
MEASURES = ("size", "tokens", "rows")
NO_GROUP = "small"


def place(items: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each item, from their measures in columns.

    Capacities are equal shares of the totals. Largest item first, by its largest measure; ties to the first item
    and the first shard.
    """
    capacity = items.sum(axis=0) / shards
    scaled = items / np.where(capacity > 0, capacity, 1.0)
    left = np.tile((capacity > 0).astype(float), (shards, 1))
    shard = np.zeros(len(items), dtype=np.int64)
    for at in np.argsort(-scaled.max(axis=1, initial=0.0), kind="stable"):
        shard[at] = np.argmax(left @ scaled[at])
        left[shard[at]] -= scaled[at]
    return shard


def assign(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """A row for each row of ``docs``: key, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``.

    Size is the UTF-8 bytes of the text plus 1; a null text counts as empty. The law is ``bytes``: sizes of the
    shards are near equal, tokens and rows are balanced with them. Rows of equal texts share a shard unless their
    group is over half a shard in some measure; such a group is spread over all shards by a hash of the key, so that a
    hot group needs no one task. Slots count from 0 in each shard without gaps, in the order of a hash, then of the key.
    ``grown_shard`` is null, as this law does not keep rows in place when shards are added.
    The driver gets the measures of ``shards`` times some hundred items, whatever the number of rows.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = written(
        docs.select(
            F.col(key).alias("id"),
            (F.octet_length(whole) + 1).cast("long").alias("size"),
            F.coalesce(F.regexp_count(whole, F.lit(WORD)), F.lit(0)).cast("long").alias("tokens"),
            F.crc32(F.encode(whole, "UTF-8")).alias("text_crc32"),
            F.xxhash64(whole).alias("text_hash"),
        )
    )
    group = ["text_hash", "text_crc32", "size"]
    measured = [F.sum("size").alias("sum_size"), F.sum("tokens").alias("sum_tokens"), F.count("*").alias("sum_rows")]
    groups = written(rows.groupBy(*group).agg(*measured))
    totals = groups.agg(*[F.coalesce(F.sum(f"sum_{m}"), F.lit(0)) for m in MEASURES]).first()
    least = [max(total / (shards * ITEMS), 1e-9) for total in totals]
    share = F.greatest(*[F.col(f"sum_{m}") / limit for m, limit in zip(MEASURES, least, strict=True)])
    large = groups.where(share > 1).select(*group, F.when(share > ITEMS * MOST_IN_A_SHARD, shards).otherwise(1).alias("parts"))
    item = F.struct(
        F.coalesce(F.hex("text_hash"), F.lit(NO_GROUP)).alias("group"),
        F.when(F.col("parts").isNull(), F.pmod(F.col("text_hash"), F.lit(shards * PACKAGES)))
        .otherwise(F.pmod(F.xxhash64("id", "text_hash"), "parts"))
        .alias("part"),
    )
    item = F.when(F.col("parts").isNull(), item.withField("group", F.lit(NO_GROUP))).otherwise(item)
    # At most 3 * shards * ITEMS groups hold over 1 / (shards * ITEMS) of a measure.
    spread = rows.join(F.broadcast(large), group, "left").withColumn("item", item)
    items = written(spread.groupBy("item").agg(*measured))
    listed = items.orderBy("item").collect()
    placed = place(np.array([[r[f"sum_{m}"] for m in MEASURES] for r in listed], dtype=float).reshape(-1, len(MEASURES)), shards)
    spark = docs.sparkSession
    where = spark.createDataFrame(
        [(r["item"]["group"], r["item"]["part"], int(s)) for r, s in zip(listed, placed, strict=True)], "item_group string, item_part long, shard int"
    )
    same = (F.col("item.group") == F.col("item_group")) & (F.col("item.part") == F.col("item_part"))
    cells = max(1, -(-int(totals[2]) // (shards * PART_ROWS)))
    order = F.xxhash64("id", "text_hash")
    sharded = written(
        spread.join(F.broadcast(where), same).select("id", "size", "text_crc32", "text_hash", "shard", F.pmod(order, F.lit(cells)).alias("cell"))
    )
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = sharded.groupBy("shard", "cell").count().select("shard", "cell", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy("shard", "cell").orderBy(order, "id", "text_hash"))
    numbered = sharded.withColumn("within", within).join(written(starts), ["shard", "cell"])
    return numbered.select(
        F.col("id").alias(key),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("start") + F.col("within") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """Writes ``docs`` as Parquet in a folder for each shard and returns the assignment.

    Rows are matched by key, size and checksum of the text; rows equal in all three go where the first of them goes.
    """
    assigned = written(assign(docs, key, text, shards))
    whole = F.coalesce(F.col(text), F.lit(""))
    first = assigned.groupBy(F.col(key).alias("key__"), F.col("size").alias("size__"), F.col("text_crc32").alias("crc__")).agg(F.min("shard").alias("shard__"))
    same = F.col(key).eqNullSafe(F.col("key__")) & ((F.octet_length(whole) + 1) == F.col("size__")) & (F.crc32(F.encode(whole, "UTF-8")) == F.col("crc__"))
    docs.join(first, same).select(*docs.columns, "shard__").withColumnRenamed("shard__", "shard").write.partitionBy("shard").parquet(path)
    return assigned
