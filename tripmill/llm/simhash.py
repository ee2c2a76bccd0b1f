"""SimHash fingerprints, and links between them found by pigeonring filtering.

A fingerprint is cut into segments that form a ring. If two fingerprints differ in at most ``budget`` bits, some
segment starts a chain around the ring whose first l segments differ in at most ``l * budget / segments`` bits, for
every l. As long as that is below one, the segments must be equal: this start of the chain is the key two
fingerprints meet by. The longer chain is tested on each meeting, and only at its end are all bits compared.
"""

from __future__ import annotations

from itertools import islice, repeat

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import per_text, written
from tripmill.llm.components import components

BITS = 64
SEED = 42
SEGMENTS = 7
#: Keys with more fingerprints are linked through shared one-bit neighbours, which needs no pairs.
CROWD = 64
#: Shingles hashed at a time.
BLOCK = 50_000


def shingles_of(text: str | None, words: int):
    """Shingles of a text, repeats included, and how many; A-Z are lower-cased.

    A text of fewer words is one shingle; a text without words has none.
    """
    found = (text or "").encode().lower().split()
    if not found:
        return iter(()), 0
    if len(found) < words:
        return iter((b" ".join(found),)), 1
    return map(b" ".join, zip(*[islice(found, i, None) for i in range(words)])), len(found) - words + 1


def hashes_of(text: str | None, words: int) -> np.ndarray:
    shingles, n = shingles_of(text, words)
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), dtype=np.uint64, count=n)


def majority(hashes: np.ndarray) -> int:
    """Bits that are set in over half the hashes; no hashes: zero."""
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, dtype=np.int64)
    for start in range(0, len(hashes), BLOCK):
        block = hashes[start : start + BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text", words: int = 3) -> DataFrame:
    """The columns ``keep`` and ``fingerprint long`` of every whole text, one row for each row.

    A null, empty or blank text has fingerprint 0.
    """

    def make():
        return lambda text: (majority(hashes_of(text, words)),)

    return per_text(docs, text, keep, "fingerprint bigint", make)


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _chain_mask(start: int, length: int, segments: int) -> int:
    """The bits of ``length`` segments from ``start`` on around the ring."""
    bounds = [i * BITS // segments for i in range(segments + 1)]
    mask = 0
    for i in range(start, start + length):
        low, high = bounds[i % segments], bounds[i % segments + 1]
        mask |= (1 << high) - (1 << low)
    return _signed(mask)


def _free_length(budget: int, segments: int) -> int:
    """The longest chain that must not differ at all."""
    length = -(-segments // budget) - 1 if budget else segments
    if length < 1:
        raise ValueError("use more segments than bits may differ")
    return length


def _keys(prints: DataFrame, budget: int, segments: int) -> DataFrame:
    length = _free_length(budget, segments)
    keys = [F.struct(F.lit(i).alias("start"), F.col("print").bitwiseAND(F.lit(_chain_mask(i, length, segments))).alias("part")) for i in range(segments)]
    return prints.select("print", F.explode(F.array(*keys)).alias("key")).select("print", "key.*")


def first_chain(differ: Column, budget: int, segments: int) -> Column:
    """The first segment that starts a chain within all its budgets, null if none does.

    A chain is tested from its shortest piece on; the last piece is the whole ring, which compares all bits.
    """
    free = _free_length(budget, segments)
    found = None
    for start in range(segments):
        within = F.bit_count(differ.bitwiseAND(F.lit(_chain_mask(start, free, segments)))) == 0
        for length in range(free + 1, segments + 1):
            within = within & (F.bit_count(differ.bitwiseAND(F.lit(_chain_mask(start, length, segments)))) <= length * budget // segments)
        found = F.when(within, start) if found is None else found.when(within, start)
    return found


def links(prints: DataFrame, budget: int = 2, segments: int = SEGMENTS, crowd: int = CROWD) -> DataFrame:
    """Links ``a, b`` between distinct values of ``print`` so that all within ``budget`` bits are connected.

    Fingerprints that share no crowded key are linked pair by pair. Those of a crowded key are linked through their
    one-bit neighbours if the budget is 2: two fingerprints are within two bits exactly if some value is within one bit
    of both, and no value has more than 65 such fingerprints. For other budgets nothing counts as crowded.
    """
    keys = _keys(prints, budget, segments)
    if budget == 2:
        crowded = written(keys.groupBy("start", "part").count().where(F.col("count") > crowd).select("start", "part"))
        sparse, dense = keys.join(crowded, ["start", "part"], "left_anti"), keys.join(crowded, ["start", "part"], "left_semi")
    else:
        sparse, dense = keys, None
    left, right = sparse.alias("l"), sparse.alias("r")
    meet = (F.col("l.start") == F.col("r.start")) & (F.col("l.part") == F.col("r.part")) & (F.col("l.print") < F.col("r.print"))
    chain = first_chain(F.col("l.print").bitwiseXOR(F.col("r.print")), budget, segments) == F.col("l.start")
    found = left.join(right, meet & chain).select(F.col("l.print").alias("a"), F.col("r.print").alias("b"))
    if dense is None:
        return found
    flips = F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << i)).cast("long") for i in range(BITS)])
    near = dense.select("print").distinct().select("print", F.explode(flips).alias("flip"))
    stars = near.groupBy(F.col("print").bitwiseXOR(F.col("flip")).alias("middle")).agg(F.sort_array(F.collect_list("print")).alias("around"))
    star = stars.where(F.size("around") > 1).select(F.col("around")[0].alias("a"), F.explode(F.slice("around", 2, BITS)).alias("b"))
    return found.unionByName(star.distinct())


def group_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, budget: int = 2) -> DataFrame:
    """``key, fingerprint long, component_id``: one row for each row of ``docs``.

    ``component_id`` is the smallest key reachable over links between fingerprints that differ in at most ``budget``
    bits. Rows with equal fingerprints, repeated rows and texts without words included, are one node: they are never
    compared with each other. Null keys are never the smallest; a component of only null keys has a null id.
    Other columns are ignored.
    """
    rows = written(fingerprints(docs.select(F.col(key).alias("id"), F.col(text).alias("text")), ["id"], words=words))
    prints = written(rows.groupBy(F.col("fingerprint").alias("print")).agg(F.min("id").alias("least")))
    roots = components(links(prints.select("print"), budget))
    placed = prints.join(roots.withColumnRenamed("node", "print"), "print", "left").withColumn("root", F.coalesce("root", "print"))
    placed = written(placed)
    ids = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = written(placed.join(written(ids), "root").select("print", "component_id"))
    return rows.join(named, F.col("fingerprint") == F.col("print"), "left").select(
        F.col("id").alias(key), "fingerprint", "component_id"
    )
