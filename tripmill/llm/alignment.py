"""Cross-tokenizer alignment: which tokens of two vocabularies end at the same bytes, and how often.

A first pass aligns every text and counts, within a task, how often it links each pair of ids. The distinct pairs get a
minimal perfect hash, so that counts are dense vectors indexed by it; these are summed up a tree. Keys are kept beside
the counts and verified, as a perfect hash takes any key. A second pass aligns the documents again and looks counts up.

Of two tokens that end together, the shorter one's bytes end the longer one. So the number of pairs is bounded by the
two vocabularies, however many texts there are: ``pair_bound`` counts them. That is why the hash may be broadcast.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from array import array
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType
from tokenizers import Tokenizer

from tripmill.llm.bpe import byte_letters
from tripmill.llm.common import OUT_ROWS, held, ship, tokenizer_file, written

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Both vocabularies start a token at a single space with a word behind it, so texts are cut there and pieces remembered.
CUT = re.compile(r"(?<=[^ ]) (?=\S)")
MORE_SPACE = re.compile(r" (?!\S)")
LONGEST_REMEMBERED = 64
#: Two generations of so many pieces are remembered in a Python worker.
REMEMBERED = 200_000
#: The faster encoder takes pieces up to this long; its time grows with the square of a word.
LONG_PIECE = 500
#: So many pieces are encoded together.
TOGETHER = 2_000
#: Links that a task gathers before it adds them up.
GATHERED = 2_000_000
#: Keys of one group of the hash, and of one bucket of it, on average.
GROUP_KEYS, BUCKET_KEYS = 1_000, 4
TRIES = 64
#: So many vectors are added at each node of the tree.
FAN_IN = 16
U = np.uint64


class Piece(NamedTuple):
    """What the alignment of a piece adds to its document."""

    n_a: int
    n_b: int
    n_links: int
    groups: str
    links: bytes
    n_best: int = 0
    count_sum: int = 0


def ranked(path: str, tokens: list[bytes]) -> tiktoken.Encoding | None:
    """The faster library's encoder of the same vocabulary, where ids are the ranks of merges and words split by the usual pattern."""
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    model, split = described["model"], described["pre_tokenizer"]
    special = {token["id"] for token in described["added_tokens"]}
    first = len(set(model["vocab"].values()) - special) - len(model["merges"])
    pairs = (pair if isinstance(pair, list) else pair.split(" ") for pair in model["merges"])
    in_order = all(model["vocab"].get("".join(pair)) == first + rank for rank, pair in enumerate(pairs))
    if not in_order or described["normalizer"] or split["type"] != "ByteLevel" or split["add_prefix_space"] or not split.get("use_regex", True):
        return None
    ranks = {token: number for number, token in enumerate(tokens) if number not in special}
    return tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class TokenizerPair:
    """Ids and byte lengths of the tokens of both vocabularies; special tokens' strings are plain text."""

    def __init__(self, path_a: str, path_b: str):
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte_of = {letter: value for value, letter in enumerate(byte_letters())}
        tokens = sorted((number, token) for token, number in self.a.get_vocab().items())
        self.bytes_a = [bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode() for _, token in tokens]
        if [number for number, _ in tokens] != list(range(len(tokens))):
            raise ValueError(f"{path_a}: ids are not gapless")
        self.ranked = ranked(path_a, self.bytes_a)
        n = self.b.get_piece_size()
        self.names = [*map(str, range(max(n, len(tokens))))]
        self.bytes_b = [bytes([int(self.b.id_to_piece(i)[1:-1], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode() for i in range(n)]
        self.size_a, self.size_b = (np.array([len(one) for one in of], dtype=np.int64) for of in (self.bytes_a, self.bytes_b))

    def ids(self, pieces: list[str]) -> list[np.ndarray]:
        """Ids of both vocabularies for pieces that stand one behind the other; the second encoder puts the first space itself."""
        text = " ".join(pieces)
        if self.ranked is None or max(map(len, pieces)) > LONG_PIECE:
            first = self.a.encode(" " + text, add_special_tokens=False).ids
        else:
            first = self.ranked.encode_ordinary(" " + text)
        return [np.array(one, dtype=np.int64) for one in (first, self.b.encode(text))]

    def align(self, pieces: list[str], told: bool) -> list[Piece | None]:
        """What each piece adds; None for one that the tokens of either vocabulary do not spell.

        Pieces are encoded together, as both vocabularies cut between them, and if that does not spell them, by halves.
        """
        raw = [piece.encode() for piece in pieces]
        spelled = b" " + b" ".join(raw)
        ids = self.ids(pieces)
        ends = [np.cumsum(size[one]) for size, one in zip((self.size_a, self.size_b), ids, strict=True)]
        stops = np.cumsum([len(one) + 1 for one in raw])
        tokens = [np.searchsorted(end, stops, "right") for end in ends]
        whole = all(
            b"".join(map(size.__getitem__, one.tolist())) == spelled and (end[np.maximum(at, 1) - 1] == stops).all()
            for size, one, end, at in zip((self.bytes_a, self.bytes_b), ids, ends, tokens, strict=True)
        )
        if not whole:
            half = len(pieces) // 2
            return [*self.align(pieces[:half], told), *self.align(pieces[half:], told)] if half else [None]
        _, at_a, at_b = np.intersect1d(*ends, assume_unique=True, return_indices=True)
        links = (ids[0][at_a] << 32 | ids[1][at_b]).tobytes()
        last = np.searchsorted(ends[0][at_a], stops, "right").tolist()
        sizes = [np.diff(at, prepend=0).tolist() for at in tokens]
        lows = [0, *last[:-1]]
        groups = []
        if told:
            names = [[*map(self.names.__getitem__, one.tolist())] for one in ids]
            cuts = [[0, *(at + 1).tolist()] for at in (at_a, at_b)]
            ranges = zip(cuts[0], cuts[0][1:], cuts[1], cuts[1][1:])
            groups = [",".join(names[0][i:j]) + "|" + ",".join(names[1][k:m]) for i, j, k, m in ranges]
        return [Piece(*n, high - low, ";".join(groups[low:high]), links[8 * low : 8 * high]) for *n, low, high in zip(*sizes, lows, last, strict=True)]

    def pair_bound(self) -> int:
        """How many pairs of ids there are of which one's bytes end the other: no more can ever be linked."""
        there = [Counter(self.bytes_a), Counter(self.bytes_b)]
        ends = lambda tokens, of: sum(of[one[i:]] for one in tokens for i in range(len(one)))
        equal = sum(n * there[1][one] for one, n in there[0].items())
        return ends(self.bytes_a, there[1]) + ends(self.bytes_b, there[0]) - equal


def pieces_of(text: str | None) -> list[str]:
    """A text cut where both vocabularies always start a token; a text of nothing has no pieces."""
    if not text:
        return []
    return CUT.split(text) if text[0] == " " or MORE_SPACE.search(text) else text.split(" ")


def _pieces(column: pa.Array) -> Iterator[list[list[str]]]:
    """Texts of a batch as pieces, in parts that are held at once."""
    for start in range(0, len(column), OUT_ROWS):
        yield [pieces_of(value.as_py()) for value in column.slice(start, OUT_ROWS)]


def mixed(keys: np.ndarray, seed: int | np.ndarray) -> np.ndarray:
    """Well spread 64 bits of each key."""
    with np.errstate(over="ignore"):
        x = keys.astype(U) + np.asarray(seed, dtype=U) * U(0x9E3779B97F4A7C15)
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


GROUP_SEED, BUCKET_SEED, FIRST_SEED = 1, 2, 3


def perfect_hash(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seeds of the buckets of one group and its keys in the places they get: no place is empty, none taken twice.

    Buckets are placed from the largest on, each under the least seed that puts all its keys on free places.
    """
    n = len(keys)
    n_buckets = -(-n // BUCKET_KEYS)
    bucket = mixed(keys, BUCKET_SEED) % U(n_buckets)
    seeds, placed, free = np.zeros(n_buckets, dtype=np.int32), np.zeros(n, dtype=np.int64), np.ones(n, dtype=bool)
    by_bucket = [keys[bucket == U(i)] for i in range(n_buckets)]
    for i in sorted(range(n_buckets), key=lambda i: -len(by_bucket[i])):
        own, seed = by_bucket[i], 0
        while len(own):
            tried = np.arange(seed, seed + TRIES)
            places = (mixed(own[None, :], tried[:, None] + FIRST_SEED) % U(n)).astype(np.int64)
            fits = free[places].all(axis=1)
            if len(own) > 1:
                fits &= (np.diff(np.sort(places, axis=1), axis=1) > 0).all(axis=1)
            if fits.any():
                at = int(fits.argmax())
                seeds[i] = seed + at
                placed[places[at]], free[places[at]] = own, False
                break
            seed += TRIES
    return seeds, placed


class PairHash:
    """The places of known keys, by group and bucket; unknown keys are told by the keys kept."""

    def __init__(self, groups: int, rows: list[tuple[int, np.ndarray, np.ndarray]]):
        self.groups = groups
        size, buckets = np.zeros(groups, dtype=np.int64), np.zeros(groups, dtype=np.int64)
        rows = sorted(rows, key=lambda row: row[0])
        for group, seeds, keys in rows:
            size[group], buckets[group] = len(keys), len(seeds)
        self.size, self.buckets = size, buckets
        self.first, self.first_bucket = np.cumsum(size) - size, np.cumsum(buckets) - buckets
        join = lambda parts, kind: np.concatenate([np.asarray(p, dtype=kind) for p in parts]) if parts else np.zeros(0, dtype=kind)
        self.seeds, self.keys = join([row[1] for row in rows], np.int64), join([row[2] for row in rows], np.int64)

    def places(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 for one the hash was not made for."""
        if not len(self.keys):
            return np.full(len(keys), -1, dtype=np.int64)
        group = group_of(keys, self.groups)
        size, buckets = np.maximum(self.size[group], 1), np.maximum(self.buckets[group], 1)
        bucket = (mixed(keys, BUCKET_SEED) % buckets.astype(U)).astype(np.int64)
        seed = self.seeds[np.minimum(self.first_bucket[group] + bucket, len(self.seeds) - 1)]
        place = self.first[group] + (mixed(keys, seed + FIRST_SEED) % size.astype(U)).astype(np.int64)
        place = np.minimum(place, len(self.keys) - 1)
        return np.where(self.keys[place] == keys, place, -1)


def group_of(keys: np.ndarray, groups: int) -> np.ndarray:
    return (mixed(keys, GROUP_SEED) % U(groups)).astype(np.int64)


class LinkCounts:
    """How often each pair is linked, and whether that is the most of its second id: arrays in the places of the hash."""

    def __init__(self, pairs: PairHash, counts: np.ndarray):
        self.pairs, self.counts = pairs, counts
        second = pairs.keys & 0xFFFFFFFF
        most = np.zeros(int(second.max(initial=0)) + 1, dtype=np.int64)
        np.maximum.at(most, second, counts)
        self.best = counts == most[second]

    def looked_up(self, made: list[Piece | None]) -> list[Piece | None]:
        """The pieces with the counts of their links; pairs that were never counted have none."""
        links = np.frombuffer(b"".join([one.links for one in made if one]), dtype=np.int64)
        if not len(links):
            return made
        place = self.pairs.places(links)
        count = np.where(place >= 0, self.counts[place], 0)
        best = (place >= 0) & self.best[place]
        ends = np.cumsum([one.n_links for one in made if one])
        sums = [np.add.reduceat(of, np.concatenate([[0], ends[:-1]])).tolist() for of in (count, best.astype(np.int64))]
        told = iter(zip(*sums, strict=True))
        return [one and one._replace(links=b"", count_sum=(sums := next(told))[0], n_best=sums[1]) for one in made]


class Remembered:
    """Aligned pieces in two generations: what is used moves to the young one, the old one goes when that is full."""

    def __init__(self, paths: tuple[str, str], counts: LinkCounts | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are what runs side by side
        self.pair, self.counts, self.young, self.old = TokenizerPair(*paths), counts, {}, {}

    def _made(self, pieces: list[str]) -> list[Piece | None]:
        # White space at the end of a piece would run on into the next one's, so such a piece stands alone.
        alone = [i for i, piece in enumerate(pieces) if not piece or piece[-1].isspace() or piece[0].isspace()]
        made: list[Piece | None] = [None] * len(pieces)
        together = sorted(set(range(len(pieces))).difference(alone)) if alone else range(len(pieces))
        for start in range(0, len(together), TOGETHER):
            part = together[start : start + TOGETHER]
            for i, one in zip(part, self.pair.align([pieces[i] for i in part], self.counts is not None), strict=True):
                made[i] = one
        for i in alone:
            (made[i],) = self.pair.align([pieces[i]], self.counts is not None)
        return made if self.counts is None else self.counts.looked_up(made)

    def of(self, texts: list[list[str]]) -> list[list[Piece | None]]:
        young, old, long = self.young, self.old, {}
        missing = []
        for piece in set().union(*texts).difference(young):
            if piece in old:
                young[piece] = old[piece]
            else:
                missing.append(piece)
        for start in range(0, len(missing), 10_000):
            part = missing[start : start + 10_000]
            for piece, one in zip(part, self._made(part), strict=True):
                (young if len(piece) <= LONGEST_REMEMBERED else long)[piece] = one
        rows = [[young[piece] if piece in young else long[piece] for piece in text] if long else [*map(young.__getitem__, text)] for text in texts]
        if len(young) > REMEMBERED:
            self.young, self.old = {}, young
        return rows


def _partial_counts(docs: DataFrame, text: str, paths: tuple[str, str], groups: int) -> DataFrame:
    """``grp, pair, links``: what each task links, added up in the task."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held(("aligned", paths), lambda: Remembered(paths))
        keys, counts, gathered, n = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), [], 0

        def added() -> tuple[np.ndarray, np.ndarray]:
            new, times = np.unique(np.frombuffer(b"".join(gathered), dtype=np.int64), return_counts=True)
            both, where = np.unique(np.concatenate([keys, new]), return_inverse=True)
            sums = np.zeros(len(both), dtype=np.int64)
            np.add.at(sums, where, np.concatenate([counts, times]))
            return both, sums

        for batch in batches:
            for texts in _pieces(batch.column(0)):
                for pieces in known.of(texts):
                    if pieces and None not in pieces:
                        gathered.append(b"".join([one.links for one in pieces]))
                        n += len(gathered[-1]) // 8
                if n > GATHERED:
                    keys, counts = added()
                    gathered, n = [], 0
        keys, counts = added()
        group = group_of(keys, groups).astype(np.int32)
        for start in range(0, len(keys), 10_000):
            part = slice(start, start + 10_000)
            yield pa.RecordBatch.from_arrays([pa.array(group[part]), pa.array(keys[part]), pa.array(counts[part])], ["grp", "pair", "links"])

    ship(docs.sparkSession)
    return docs.select(F.col(text).alias("text__")).mapInArrow(counted, "grp int, pair bigint, links bigint")


def _hashed(partial: DataFrame) -> DataFrame:
    """``grp, seeds, keys``: the perfect hash of the distinct pairs, each group of it built by itself."""

    def build(table: pa.Table) -> pa.Table:
        seeds, keys = perfect_hash(np.sort(table.column("pair").to_numpy()))
        return pa.table({"grp": table.column("grp")[:1], "seeds": pa.array([seeds]), "keys": pa.array([keys])})

    return partial.select("grp", "pair").distinct().groupBy("grp").applyInArrow(build, "grp int, seeds array<int>, keys array<bigint>")


def _summed(partial: DataFrame, pairs: PairHash) -> DataFrame:
    """``grp, counts``: a dense vector for each task, cut at the groups of the hash, and their sums up a tree."""
    shared = partial.sparkSession.sparkContext.broadcast(pairs)

    def vector(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = shared.value
        total = np.zeros(len(pairs.keys), dtype=np.int64)
        for batch in batches:
            place = pairs.places(batch.column("pair").to_numpy())
            if (place < 0).any():
                raise ValueError("a pair that the hash was not made for")
            np.add.at(total, place, batch.column("links").to_numpy())
        node = TaskContext.get().partitionId()
        for group in np.flatnonzero(pairs.size).tolist():
            part = total[pairs.first[group] : pairs.first[group] + pairs.size[group]]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([group], pa.int32()), pa.array([node], pa.int32()), pa.array([part])], ["grp", "node", "counts"])

    def add(table: pa.Table) -> pa.Table:
        rows = table.column("counts").combine_chunks()
        total = rows.flatten().to_numpy().reshape(len(rows), -1).sum(axis=0)
        return pa.table({"grp": table.column("grp")[:1], "node": table.column("node")[:1], "counts": pa.array([total])})

    kind = "grp int, node int, counts array<bigint>"
    vectors = written(partial.mapInArrow(vector, kind))
    left = vectors.agg(F.max("node")).first()[0] or 0
    while left:
        vectors = vectors.withColumn("node", F.floor(F.col("node") / FAN_IN).cast("int")).groupBy("grp", "node").applyInArrow(add, kind)
        left //= FAN_IN
    return vectors.select("grp", "counts")


def count_links(docs: DataFrame, text: str = "text", path_a: str | None = None, path_b: str | None = None) -> LinkCounts:
    """The first pass: how often all texts together link each pair of ids.

    What comes to the driver, and goes out to the tasks, is bounded by the vocabularies (``pair_bound``).
    """
    paths = path_a or tokenizer_file(VOCABULARY_A), path_b or tokenizer_file(VOCABULARY_B)
    groups = max(1, -(-TokenizerPair(*paths).pair_bound() // GROUP_KEYS))
    partial = written(_partial_counts(docs, text, paths, groups))
    pairs = PairHash(groups, [(r["grp"], r["seeds"], r["keys"]) for r in _hashed(partial).collect()])
    counts = np.zeros(len(pairs.keys), dtype=np.int64)
    for row in _summed(partial, pairs).collect():
        counts[pairs.first[row["grp"]] : pairs.first[row["grp"]] + pairs.size[row["grp"]]] = row["counts"]
    return LinkCounts(pairs, counts)


ALIGNED = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups string"


def align(docs: DataFrame, keep: list[str], counts: LinkCounts, text: str = "text", path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """The second pass: the columns ``keep``, the alignment of each whole text and what its links count in all.

    ``groups`` tells the groups between common ends as ``a1,a2|b1;a3|b2``. Each group ends in the one link that its
    last two tokens make. Null and empty texts, and those that the tokens of a vocabulary do not spell, have no tokens:
    zeros and an empty string. Rows come out as often as they went in; nothing is shuffled.
    """
    paths = path_a or tokenizer_file(VOCABULARY_A), path_b or tokenizer_file(VOCABULARY_B)
    kinds = [to_arrow_type(field.dataType) for field in StructType.fromDDL(ALIGNED)]
    names = [*keep, *StructType.fromDDL(ALIGNED).names]
    shared = docs.sparkSession.sparkContext.broadcast(counts)
    own = uuid.uuid4().hex

    def told(pieces: list[Piece | None]) -> tuple:
        if not pieces or None in pieces:
            return 0, 0, 0, 0, 0, 0, ""
        n_a, n_b, n_links, groups, _, n_best, count_sum = zip(*pieces, strict=True)
        return sum(n_a), sum(n_b), sum(n_links), sum(n_links), sum(n_best), sum(count_sum), ";".join(groups)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held(("looked up", paths, own), lambda: Remembered(paths, shared.value))
        for batch in batches:
            start = 0
            for texts in _pieces(batch.column("text__")):
                made = list(zip(*[told(pieces) for pieces in known.of(texts)], strict=True))
                kept = [batch.column(f"keep{i}__").slice(start, len(texts)) for i in range(len(keep))]
                start += len(texts)
                yield pa.RecordBatch.from_arrays([*kept, *[pa.array(column, kind) for column, kind in zip(made, kinds, strict=True)]], names)

    ship(docs.sparkSession)
    narrow = docs.select(*[F.col(name).alias(f"keep{i}__") for i, name in enumerate(keep)], F.col(text).alias("text__"))
    return narrow.mapInArrow(rows, StructType([*docs.select(*keep).schema.fields, *StructType.fromDDL(ALIGNED).fields]))


def digests(aligned: DataFrame, keep: list[str]) -> DataFrame:
    """The counts, and a digest in place of the groups; none without tokens."""
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return aligned.select(*keep, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256"))
