"""Nearest neighbours by learned partitions.

A neighbour graph of a bounded sample is cut into balanced parts; a softmax classifier learns in which parts the
neighbours of a vector lie. Every row belongs to its most probable part. A query is routed to several most probable
parts, as many as held-out rows of the sample needed, and all their rows are ranked by the exact measure.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.common import ship, written

#: Rows the partitions are learnt on at most, chosen by a hash of their id; one in eight is held out.
SAMPLE_ROWS = 8_192
PARTS = 64
#: A part is learnt from so many sampled rows at least, so a small sample makes fewer parts.
LEAST_IN_PART = 32
NEIGHBOURS = 10
#: Share of the held-out rows' neighbours that the routed parts must hold.
REACH = 0.965
#: Rows of a part, and queries routed to it, are dealt in blocks of about this many.
BLOCK = 4_096


@dataclass
class Router:
    """``weights`` (dimension + 1 by parts) of the classifier; a query goes to ``probes`` parts."""

    weights: np.ndarray
    probes: int

    @property
    def dimension(self) -> int:
        return len(self.weights) - 1

    def order(self, vectors: np.ndarray) -> np.ndarray:
        """Parts by falling probability for each vector."""
        return np.argsort(-_scores(vectors, self.weights), axis=1, kind="stable")


def _scores(vectors: np.ndarray, weights: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(length > 0, length, 1.0) @ weights[:-1] + weights[-1]


def nearest(queries: np.ndarray, rows: np.ndarray, count: int, own: bool = False) -> np.ndarray:
    """Indices of the ``count`` rows with the largest inner product for each query; ``own``: query i is row i."""
    found = []
    for start in range(0, len(queries), 512):
        product = queries[start : start + 512] @ rows.T
        if own:
            product[np.arange(len(product)), np.arange(start, start + len(product))] = -np.inf
        found.append(np.argpartition(-product, min(count, len(rows)) - 1, axis=1)[:, :count])
    return np.concatenate(found) if found else np.zeros((0, count), dtype=np.int64)


def halves(vectors: np.ndarray, parts: int) -> np.ndarray:
    """A first cut into parts of equal size: halves at the median along the direction of largest spread, again and again."""
    part = np.zeros(len(vectors), dtype=np.int64)
    todo = [(np.arange(len(vectors)), 0, parts)]
    while todo:
        rows, first, n = todo.pop()
        part[rows] = first
        if n == 1:
            continue
        centred = vectors[rows] - vectors[rows].mean(axis=0)
        direction = np.linalg.eigh(centred.T @ centred)[1][:, -1]
        cut = len(rows) * (n // 2) // n
        order = rows[np.argsort(centred @ direction, kind="stable")]
        todo += [(order[:cut], first, n // 2), (order[cut:], first + n // 2, n - n // 2)]
    return part


def balanced(graph: np.ndarray, part: np.ndarray, parts: int, rounds: int = 20, slack: float = 1.05) -> np.ndarray:
    """Moves vertices to the part of most of their neighbours, best gains first, while no part outgrows its share."""
    n, most = len(part), int(np.ceil(len(part) / parts * slack))
    part = part.copy()
    for _ in range(rounds):
        votes = np.zeros((n, parts))
        np.add.at(votes, (np.repeat(np.arange(n), graph.shape[1]), part[graph].ravel()), 1)
        np.add.at(votes, (graph.ravel(), np.repeat(part, graph.shape[1])), 1)
        to = votes.argmax(axis=1)
        gain = votes[np.arange(n), to] - votes[np.arange(n), part]
        sizes, moved = np.bincount(part, minlength=parts), 0
        for vertex in np.argsort(-gain, kind="stable"):
            if gain[vertex] <= 0:
                break
            if sizes[to[vertex]] < most:
                sizes[part[vertex]] -= 1
                sizes[to[vertex]] += 1
                part[vertex] = to[vertex]
                moved += 1
        if moved < n / 200:
            break
    return part


def train(vectors: np.ndarray, wanted: np.ndarray, rounds: int = 150, rate: float = 0.5) -> np.ndarray:
    """Softmax regression on shares ``wanted``, by Adam on all rows."""
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    inputs = np.hstack([vectors / np.where(length > 0, length, 1.0), np.ones((len(vectors), 1))])
    weights = np.zeros((inputs.shape[1], wanted.shape[1]))
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, rounds + 1):
        score = inputs @ weights
        chance = np.exp(score - score.max(axis=1, keepdims=True))
        chance /= chance.sum(axis=1, keepdims=True)
        slope = inputs.T @ (chance - wanted) / len(inputs) + 1e-6 * weights
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        weights -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return weights


def learn(vectors: np.ndarray, parts: int = PARTS, count: int = 20, reach: float = REACH) -> Router:
    """The router learnt from sampled vectors, in their order; every eighth is held out to set the number of probes."""
    if not len(vectors):
        return Router(np.zeros((1, 1)), 1)
    held = np.arange(len(vectors)) % 8 == 7
    fitted = vectors[~held]
    parts = max(1, min(parts, len(fitted) // LEAST_IN_PART))
    if parts == 1:
        return Router(np.zeros((vectors.shape[1] + 1, 1)), 1)
    graph = nearest(fitted, fitted, min(NEIGHBOURS, len(fitted) - 1), own=True)
    part = balanced(graph, halves(fitted, parts), parts)
    wanted = np.zeros((len(fitted), parts))
    wanted[np.arange(len(fitted)), part] += graph.shape[1]
    np.add.at(wanted, (np.repeat(np.arange(len(fitted)), graph.shape[1]), part[graph].ravel()), 1)
    router = Router(train(fitted, wanted / wanted.sum(axis=1, keepdims=True)), parts)
    order = router.order(vectors[held])
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(parts)[None, :].repeat(len(order), axis=0), axis=1)
    mine = router.order(fitted)[:, 0]
    near = nearest(vectors[held], fitted, min(count, len(fitted)))
    needed = np.sort(np.take_along_axis(place, mine[near], axis=1).ravel())
    router.probes = int(needed[min(len(needed) - 1, int(np.ceil(reach * len(needed))))]) + 1
    return router


def best_of(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """query, row and score of the best ``count`` rows of each query but its own, ties to the smaller row id.

    Equal rows tie always, so the smallest ``count + 1`` ids of each different row are enough. The matrix product only
    chooses; scores are summed again pair by pair, so that equal rows get equal scores wherever they lie.
    """
    order = np.argsort(row_ids, kind="stable")
    rows, row_ids = np.ascontiguousarray(rows[order]), row_ids[order]
    same = np.unique(rows, axis=0, return_inverse=True)[1].reshape(-1)
    by = np.argsort(same, kind="stable")
    starts = np.concatenate([[0], np.flatnonzero(np.diff(same[by])) + 1])
    nth = np.arange(len(by)) - np.repeat(starts, np.diff(np.concatenate([starts, [len(by)]])))
    keep = np.sort(by[nth <= count])
    rows, row_ids = rows[keep], row_ids[keep]
    out_q, out_r, out_s = [], [], []
    for start in range(0, len(queries), 256):
        block, ids = queries[start : start + 256], query_ids[start : start + 256]
        product = block @ rows.T
        product[ids[:, None] == row_ids[None, :]] = -np.inf
        take = min(count, product.shape[1])
        least = np.partition(product, product.shape[1] - take, axis=1)[:, product.shape[1] - take]
        near = (product >= (least - 1e-9 * (1 + np.abs(least)))[:, None]) & np.isfinite(product)
        at_q, at_r = np.nonzero(near)
        score = (block[at_q] * rows[at_r]).sum(axis=1)
        order = np.lexsort((row_ids[at_r], -score, at_q))
        at_q, at_r, score = at_q[order], at_r[order], score[order]
        first = np.searchsorted(at_q, at_q)
        top = np.arange(len(at_q)) - first < count
        out_q.append(ids[at_q[top]])
        out_r.append(row_ids[at_r[top]])
        out_s.append(score[top])
    return np.concatenate(out_q), np.concatenate(out_r), np.concatenate(out_s)


def _usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def search(
    vectors: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", count: int = 20, parts: int = PARTS, sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest ``count`` rows found for each query, by inner product in doubles.

    Every usable row but the query's own is a candidate. Rows take no part if their id or vector is null, or if the
    vector is zero, holds a null or a number that is not finite, or has another length than most of the sample. Of rows
    with one id the smallest vector stands. Ties go to the smaller id. Without usable rows the result is empty.
    Rows of a part are dealt in blocks by a hash, and queries too, so neither a hot part nor equal vectors gather.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = rows.where(F.col("id").isNotNull() & _usable(F.col("vector")))
    rows = written(rows.groupBy("id").agg(F.min("vector").alias("vector"), F.max("asks").alias("asks")))
    sample = [np.asarray(r["vector"], dtype=np.float64) for r in rows.orderBy(F.xxhash64("id"), "id").limit(sample_rows).collect()]
    lengths = [len(v) for v in sample]
    usual = max(sorted(set(lengths)), key=lengths.count, default=0)
    router = learn(np.array([v for v in sample if len(v) == usual], dtype=np.float64).reshape(-1, max(usual, 1)), parts, count)
    ship(spark)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                order = router.order(flat.reshape(batch.num_rows, -1)).astype(np.int32)
                wide = pa.array([order[i, : router.probes] if asks else [] for i, asks in enumerate(batch.column("asks").to_pylist())], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("vector"), pa.array(order[:, 0]), wide], ["id", "vector", "part", "routes"])

    kind = rows.schema["vector"].dataType.simpleString()
    known = rows.where(F.size("vector") == usual).mapInArrow(placed, f"id long, vector {kind}, part int, routes array<int>")
    known = written(known)
    routed = known.select(F.col("id").alias("query_id"), F.col("vector").alias("query"), F.explode("routes").alias("part"))
    blocks = known.groupBy("part").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    chunks = routed.groupBy("part").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("chunks"))
    # One row for each part.
    dealt = F.broadcast(written(blocks.join(chunks, "part")))
    held = known.join(dealt, "part").select(
        "id", "vector", "part", F.pmod(F.xxhash64("id"), "blocks").cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk")
    )
    asked = routed.join(dealt, "part").select(
        "query_id",
        "query",
        "part",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.pmod(F.xxhash64("query_id"), "chunks").cast("int").alias("chunk"),
    )

    def ranked(there: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        if not len(there) or not len(asking):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        query, row, score = best_of(_matrix(asking["query"]), asking["query_id"].to_numpy(), _matrix(there["vector"]), there["id"].to_numpy(), count)
        return pd.DataFrame({"query_id": query, "vec_id": row, "score": score})

    keys = ("part", "block", "chunk")
    found = held.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(ranked, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= count).select("query_id", "rank", "vec_id", "score")
