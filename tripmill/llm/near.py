"""Near-duplicate documents: SimHash links and min-wise blocks give candidates, exact similarity decides.

Texts count as near-duplicates if the sets of their word shingles have a Jaccard similarity of at least 0.8. At that
similarity two 64-bit SimHashes differ in about ten bits, which no filter on a few bits can find; so the pigeonring
links of ``simhash`` are joined by blocks of equal min-wise samples, and SimHash only rules out where a block is
crowded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, MapType, StructField, StructType

from tripmill.llm import simhash
from tripmill.llm.common import Table, hold_nothing, per_text, ship, written
from tripmill.llm.components import components

WORDS = 5
SIMILARITY = 0.8
#: Blocks of 5 samples: a pair of similarity 0.8 misses one with probability 0.67, all 16 with 0.0017.
BLOCKS, SAMPLES = 16, 5
#: In blocks of up to this many different texts, all pairs are compared.
CROWD = 24
#: In larger ones, all are first compared with this many of them.
LEADERS = 4
#: Texts of similarity 0.8 differ in more bits with a probability of about 0.0002, if their SimHashes are of sets of shingles.
MOST_BITS = 20
#: One bit of each of so many min-wise samples; texts of similarity 0.8 differ in a tenth of them, and in over 136 of
#: 1,024 with a probability of about 0.0002.
SKETCH_BITS, MOST_DIFFERENT = 1_024, 136
CHUNK = 4_096


def _factors(n: int) -> np.ndarray:
    draw = np.random.default_rng(5)
    return draw.integers(1, 1 << 63, size=n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def min_wise(hashes: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The least of differently multiplied shingle hashes, for each factor."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, dtype=np.uint64)
    chunk = max(1, CHUNK * BLOCKS * SAMPLES // len(factors))
    for start in range(0, len(hashes), chunk):
        mixed = hashes[start : start + chunk, None] * factors[None, :]
        mixed ^= mixed >> np.uint64(29)
        np.minimum(least, mixed.min(axis=0), out=least)
    return least


def block_keys(hashes: np.ndarray, factors: np.ndarray) -> list[int]:
    """A key for each block of min-wise samples."""
    parts = min_wise(hashes, factors).astype("<u8").reshape(BLOCKS, SAMPLES)
    return [xxhash.xxh64_intdigest(parts[i].tobytes(), i) - (1 << 63) for i in range(BLOCKS)]


def row_hashes(docs: DataFrame) -> list[Column]:
    """128 bits of a row's content; columns of maps are left out, as they have no order to hash in."""
    columns = [field.name for field in docs.schema if not isinstance(field.dataType, MapType)]
    return [F.xxhash64(F.lit(i), *[F.col(c) for c in columns]).alias(f"row{i}__") for i in (1, 2)]


def _packed(rows: DataFrame) -> DataFrame:
    """The rows with ``text__`` compressed: texts are shuffled several times, and a shuffle's own compression leaves half as much again."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_nothing()
        codec = pa.Codec("zstd")
        for batch in batches:
            at = batch.schema.get_field_index("text__")
            texts = [text.as_buffer() for text in batch.column(at)]
            made = [None if t is None else t.size.to_bytes(8, "little") + codec.compress(t, asbytes=True) for t in texts]
            yield batch.set_column(at, "text__", pa.array(made, pa.binary()))

    ship(rows.sparkSession)
    kinds = [StructField(f.name, BinaryType() if f.name == "text__" else f.dataType) for f in rows.schema]
    return rows.mapInArrow(packed, StructType(kinds))


def unpacked(packed: bytes | None) -> str | None:
    """The text that ``_packed`` compressed."""
    if packed is None:
        return None
    return pa.Codec("zstd").decompress(packed[8:], int.from_bytes(packed[:8], "little"), asbytes=True).decode()


def _sketches(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    def make():
        hold_nothing()
        factors = _factors(BLOCKS * SAMPLES)

        def one(text):
            hashes = simhash.hashes_of(text, words)
            different = np.unique(hashes)
            return xxhash.xxh3_128_hexdigest(different.tobytes()), simhash.majority(different), block_keys(different, factors)

        return one

    rows = docs.select(*row_hashes(docs), F.col(key).alias("id__"), F.col(text).alias("text__"))
    return per_text(rows, "text__", ["row1__", "row2__", "id__"], "shingles string, print bigint, blocks array<bigint>", make)


def _bits(texts: DataFrame, words: int) -> DataFrame:
    """``shingles, bits array<bigint>``: a bit of each min-wise sample of a class."""

    def make():
        factors = _factors(SKETCH_BITS)

        def one(text):
            least = min_wise(np.unique(simhash.hashes_of(unpacked(text), words)), factors)
            return (np.packbits((least >> np.uint64(32) & np.uint64(1)).astype(np.uint8)).view("<i8").tolist(),)

        return one

    return per_text(texts, "text__", ["shingles"], "bits array<bigint>", make)


def _similar(pairs: DataFrame, texts: DataFrame, words: int, similarity: float) -> DataFrame:
    """The candidate pairs ``a, b`` whose texts are similar enough."""
    ship(pairs.sparkSession)

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_nothing()
        last, shingles = None, set()
        for batch in batches:
            keep = []
            for b, left, right in zip(batch.column("b").to_pylist(), batch.column("left"), batch.column("right"), strict=True):
                if b != last:
                    last, shingles = b, set(simhash.shingles_of(unpacked(right.as_py()), words)[0])
                other = set(simhash.shingles_of(unpacked(left.as_py()), words)[0])
                both = len(shingles & other)
                keep.append(both >= similarity * (len(shingles) + len(other) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = texts.select(F.col("shingles").alias("a"), F.col("text__").alias("left"))
    right = texts.select(F.col("shingles").alias("b"), F.col("text__").alias("right"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(verified, "a string, b string")


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose ends are not in one group yet."""
    for end in ("a", "b"):
        pairs = pairs.join(roots.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}")), end, "left")
    return pairs.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b").distinct()


def _grouped(docs: DataFrame, key: str, text: str, words: int, similarity: float) -> tuple[DataFrame, list[Table]]:
    """The rows of ``groups`` and the tables that they are read from; all others are dropped when they have been read."""
    kept: list[Table] = []

    def keep(df: DataFrame) -> DataFrame:
        kept.append(Table(df))
        return kept[-1].rows

    rows = keep(_sketches(docs, key, text, words))
    rank = F.struct(F.col("id__").isNull().alias("none"), F.col("id__").alias("id"), F.col("row1__").alias("row1"), F.col("row2__").alias("row2"))
    classes = Table(rows.groupBy("shingles").agg(F.min(F.struct(rank.alias("rank"), "print", "blocks")).alias("best")).select("shingles", "best.*"))
    named = _packed(docs.select(*row_hashes(docs), F.col(text).alias("text__")))

    def texts_for(used: DataFrame) -> Table:
        used = used.distinct().join(classes.rows, "shingles").select("shingles", F.col("rank.row1").alias("row1__"), F.col("rank.row2").alias("row2__"))
        wanted = Table(used)
        found = Table(named.join(wanted.rows, ["row1__", "row2__"]).select("shingles", "text__").dropDuplicates(["shingles"]))
        wanted.drop()
        return found

    def similar(pairs: Table) -> Table:
        texts = texts_for(pairs.rows.select(F.explode(F.array("a", "b")).alias("shingles")))
        found = Table(_similar(pairs.rows, texts.rows, words, similarity))
        texts.drop()
        return found

    members = Table(classes.rows.select("shingles", F.explode("blocks").alias("value")))
    sizes = Table(members.rows.groupBy("value").agg(F.count("*").alias("count"), F.min("shingles").alias("least")).where(F.col("count") > 1))
    shared = Table(members.rows.join(sizes.rows, "value"))
    members.drop()
    # The least members of a class's blocks mostly agree, so the first round compares each class with one other only.
    nearest = shared.rows.groupBy("shingles").agg(F.min("least").alias("least")).where("least < shingles")
    first = Table(nearest.select(F.col("least").alias("a"), F.col("shingles").alias("b")))
    edges = [similar(first)]
    roots = Table(components(edges[0].rows))

    # The second round: what shares a block, a leader or a fingerprint and is not in one group yet.
    grouped = shared.rows.join(roots.rows.withColumnRenamed("node", "shingles"), "shingles", "left").withColumn("root", F.coalesce("root", "shingles"))
    sparse = grouped.where(F.col("count") <= CROWD).select("shingles", "value", "root")
    several = Table(sparse.groupBy("value").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("value"))
    sparse = Table(sparse.join(several.rows, "value"))
    several.drop()
    meet = sparse.rows.select(F.col("shingles").alias("a"), F.col("root").alias("root_a"), "value")
    meet = meet.join(sparse.rows.select(F.col("shingles").alias("b"), F.col("root").alias("root_b"), "value"), "value")
    by_block = meet.where("a < b AND root_a <> root_b").select("a", "b")

    dense = Table(shared.rows.where(F.col("count") > CROWD).select("shingles", "value", "count"))
    shared.drop()
    # What shares its blocks with most others is nearest to the middle of its group.
    middle = Table(dense.rows.groupBy("shingles").agg(F.sum("count").alias("shared")))
    ranked = dense.rows.join(middle.rows, "shingles")
    salt = F.pmod(F.xxhash64("shingles"), F.lit(LEADERS))
    leaders = Table(ranked.groupBy("value", salt.alias("salt")).agg(F.max_by("shingles", F.struct("shared", "shingles")).alias("leader")))
    middle.drop()
    by_leader = dense.rows.join(leaders.rows, "value").where("shingles <> leader").select(*_pair("shingles", "leader"))

    prints = Table(classes.rows.groupBy("print").agg(F.min("shingles").alias("first")))
    linked = simhash.links(prints.rows.select("print"))
    ends = [prints.rows.select(F.col("print").alias(end), F.col("first").alias(f"first_{end}")) for end in ("a", "b")]
    by_print = linked.join(ends[0], "a").join(ends[1], "b").select(*_pair("first_a", "first_b"))
    equal = classes.rows.join(prints.rows, "print").where("shingles <> first").select(*_pair("shingles", "first"))

    others = _apart(by_print.unionByName(equal).unionByName(by_leader), roots.rows)
    pairs = Table(by_block.unionByName(others).distinct().join(first.rows, ["a", "b"], "left_anti"))
    for table in (sparse, leaders, prints, roots):
        table.drop()
    edges.append(similar(pairs))
    roots = Table(components(edges[0].rows.unionByName(edges[1].rows)))

    if dense.rows.limit(1).count():
        crowded = dense.rows.join(classes.rows.select("shingles", "print", "blocks"), "shingles")
        crowded = crowded.join(roots.rows.withColumnRenamed("node", "shingles"), "shingles", "left").withColumn("root", F.coalesce("root", "shingles"))
        texts = texts_for(dense.rows.select("shingles"))
        placed = Table(crowded.join(_bits(texts.rows, words), "shingles"))
        texts.drop()
        main = Table(placed.rows.groupBy("value", "root").count().groupBy("value").agg(F.max_by("root", F.struct("count", "root")).alias("main")))
        apart = Table(
            placed.rows.join(main.rows, "value").where("root <> main").select(
                F.col("shingles").alias("a"), F.col("print").alias("print_a"), F.col("root").alias("root_a"), F.col("bits").alias("bits_a"), F.col("blocks").alias("blocks_a"), "value"
            )
        )
        main.drop()
        near = F.bit_count(F.col("print").bitwiseXOR(F.col("print_a"))) <= MOST_BITS
        different = sum((F.bit_count(F.col("bits")[i].bitwiseXOR(F.col("bits_a")[i])) for i in range(1, SKETCH_BITS // 64)), F.bit_count(F.col("bits")[0].bitwiseXOR(F.col("bits_a")[0])))
        # A pair meets in the least block that both share only; if that is no crowded one, the second round compared it.
        once = F.array_min(F.array_intersect("blocks", "blocks_a")) == placed.rows["value"]
        met = placed.rows.join(apart.rows, [placed.rows["value"] == apart.rows["value"], F.col("root") != F.col("root_a"), near, different <= MOST_DIFFERENT, once])
        more = met.select(*_pair("a", "shingles")).distinct()
        for tested in (first, pairs):
            more = more.join(tested.rows, ["a", "b"], "left_anti")
        more = Table(more)
        for table in (placed, apart, roots):
            table.drop()
        edges.append(similar(more))
        more.drop()
        roots = Table(components(edges[0].rows.unionByName(edges[1].rows).unionByName(edges[2].rows)))
    for table in (first, pairs, dense, *edges):
        table.drop()
    placed = classes.rows.join(roots.rows.withColumnRenamed("node", "shingles"), "shingles", "left").select("shingles", "rank", F.coalesce("root", "shingles").alias("root"))
    placed = Table(placed)
    best = Table(placed.rows.groupBy("root").agg(F.min("rank").alias("best")))
    told = keep(placed.rows.join(best.rows, "root").select("shingles", F.col("root").alias("group__"), "best"))
    for table in (classes, roots, placed, best):
        table.drop()
    stays = (F.col("row1__") == F.col("best.row1")) & (F.col("row2__") == F.col("best.row2"))
    return rows.select("row1__", "row2__", "id__", "shingles").join(told, "shingles").select("row1__", "row2__", "id__", "group__", stays.alias("first__")), kept


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """``row1__, row2__, id__, group__, first__``: for each row its group, and whether it is what stays of it.

    Rows are in one group if a chain of texts leads from one to the other whose neighbours are near-duplicates. Of a
    group, the smallest key stays, null last, then the smallest content hash; rows equal in all columns are one. Texts with
    the same shingles, and all texts without words, are near-duplicates; an empty table has no groups. Of a pair at exactly
    the least similarity, 0.2 % are missed, of closer ones far fewer.

    Texts with the same shingles are one class, compared once. In the first round a class is compared with one other of
    its blocks; later rounds compare only what is not in one group by then, so few texts are joined twice. In a crowded
    block, every class is compared with a few leaders; what then does not belong to the block's main group is compared
    with all of the block outside its own, as far as SimHash and a sketch of 1,024 bits let it pass (all but 0.04 % of
    pairs at the least similarity).
    """
    return _grouped(docs, key, text, words, similarity)[0]


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that stay: one of each group, with its own columns only."""
    found, read_from = _grouped(docs, key, text, words, similarity)
    stays = written(found.where("first__").select("row1__", "row2__").distinct())
    for table in read_from:
        table.drop()
    hashed = docs.select("*", *row_hashes(docs))
    return hashed.join(stays, ["row1__", "row2__"]).dropDuplicates(["row1__", "row2__"]).select(*docs.columns)
