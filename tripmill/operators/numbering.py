"""Running numbers over a table of any size."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_ROW_BITS = 33


def number_rows(df: DataFrame, *order: str, name: str = "number", start: int = 1) -> DataFrame:
    """Numbers start, start + 1, ... in sort order.

    The rows are range-sorted once; each partition numbers its own rows from the
    count of rows in the partitions before it. Only those counts, one row per
    partition, pass through a single window.
    """
    tagged = df.orderBy(*order).withColumn("__at", F.monotonically_increasing_id())
    tagged = tagged.persist(StorageLevel.MEMORY_AND_DISK)
    part = F.shiftright("__at", _ROW_BITS)
    counts = tagged.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("__part", F.coalesce(before, F.lit(0)).alias("__before"))
    place = F.col("__at").bitwiseAND((1 << _ROW_BITS) - 1)
    numbered = tagged.withColumn("__part", part).join(F.broadcast(offsets), "__part")
    return numbered.withColumn(name, F.col("__before") + place + start).drop("__part", "__at", "__before")
