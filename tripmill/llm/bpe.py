"""Byte-level BPE: encoding with a contiguous rank array for each word, and decoding."""

from __future__ import annotations

import hashlib
import json
import sys
from array import array
from collections.abc import Iterable
from heapq import heapify, heappop, heappush

import numpy as np
import regex
from pyspark.sql import DataFrame

from tripmill.llm.common import held, per_text, tokenizer_file

VOCABULARY = "byte_bpe_50k.json"
#: A word up to this many bytes is merged in a rank array; scanning costs the square of its length, so longer ones use a heap.
SHORT_WORD = 64
#: Encodings of two generations of so many pieces between spaces are remembered in a Python worker.
REMEMBERED = 200_000
NO_RANK, NO_PAIR = 1 << 30, (1 << 63) - 1

# The split pattern of byte-level BPE, with white space spelled out as Unicode's White_Space.
SPACE = r"\t-\r \x85\xa0  -     　"
PATTERN = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in a vocabulary file.

    Printable Latin-1 bytes stand for themselves; the others take the characters from 256 on, in order.
    """
    own = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)}
    others = iter(range(256, 512))
    return [chr(b if b in own else next(others)) for b in range(256)]


class BytePairCoder:
    """Encodes and decodes as the file's own library does, special tokens in the text included."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model, split = described["model"], described["pre_tokenizer"]
        plain = not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        if model["type"] != "BPE" or described["normalizer"] or split["type"] != "ByteLevel" or split["add_prefix_space"] or not plain:
            raise ValueError(f"{path}: only plain byte-level BPE is supported")
        letters = byte_letters()
        byte_of = {letter: value for value, letter in enumerate(letters)}
        ids = model["vocab"]
        self.bytes_of = {number: bytes(byte_of[c] for c in token) for token, number in ids.items()}
        self.first = [ids[letter] for letter in letters]
        self.ranks: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[ids[left] << 32 | ids[right]] = rank
            self.merged.append(ids[left + right])
        self.special = {token["content"]: token["id"] for token in described["added_tokens"]}
        for content, number in self.special.items():
            self.bytes_of[number] = content.encode()
        longest_first = sorted(self.special, key=len, reverse=True)
        self.special_at = regex.compile("|".join(map(regex.escape, longest_first))) if longest_first else None
        self.pattern = regex.compile(PATTERN)
        #: What is used moves to the young ones; the old ones go when those are full.
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        pairs = sorted(self.ranks)
        self.pairs = np.array([*pairs, NO_PAIR], dtype=np.int64)
        self.rank_of = np.array([*map(self.ranks.__getitem__, pairs), NO_RANK], dtype=np.int64)
        self.made = np.array(self.merged, dtype=np.int64)
        self.first_of = np.array(self.first, dtype=np.int64)

    def merge_short(self, parts: list[int]) -> list[int]:
        """``ranks[i]`` belongs to the boundary between parts i and i + 1; the least one, leftmost first, goes."""
        rank, merged = self.ranks.get, self.merged
        ranks = [rank(left << 32 | right, NO_RANK) for left, right in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == NO_RANK:
                break
            at = ranks.index(least)
            parts[at] = made = merged[least]
            del parts[at + 1], ranks[at]
            if at < len(ranks):
                ranks[at] = rank(made << 32 | parts[at + 1], NO_RANK)
            if at:
                ranks[at - 1] = rank(parts[at - 1] << 32 | made, NO_RANK)
        return parts

    def merge_long(self, parts: list[int]) -> list[int]:
        """The same merges in the same order, from a heap over a linked list."""
        n, ranks, merged = len(parts), self.ranks, self.merged
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := ranks.get(parts[i] << 32 | parts[i + 1])) is not None]
        heapify(heap)

        def offer(left: int, right: int) -> None:
            found = ranks.get(parts[left] << 32 | parts[right])
            if found is not None:
                heappush(heap, (found, left, parts[left], parts[right]))

        while heap:
            rank, at, left, right = heappop(heap)
            beside = after[at]
            if parts[at] != left or beside >= n or parts[beside] != right:
                continue  # one of the two has been merged since
            parts[at], parts[beside] = merged[rank], -1
            after[at] = after[beside]
            if after[at] < n:
                before[after[at]] = at
                offer(at, after[at])
            if before[at] >= 0:
                offer(before[at], at)
        return [part for part in parts if part >= 0]

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pair = left << 32 | right
        at = np.searchsorted(self.pairs, pair)
        return np.where(self.pairs[at] == pair, self.rank_of[at], NO_RANK)

    def merge_many(self, words: list[bytes]) -> list[bytes]:
        """Ids of short words, all those of one length in the same rank arrays: a row for each word.

        Of each row the least rank goes, leftmost first, with the boundary that it belongs to; its neighbours' ranks are
        looked up anew. A row is done when it has no rank left.
        """
        made: list[bytes] = [b""] * len(words)
        by_length: dict[int, list[int]] = {}
        for number, word in enumerate(words):
            by_length.setdefault(len(word), []).append(number)
        for width, numbers in by_length.items():
            parts = self.first_of[np.frombuffer(b"".join([words[i] for i in numbers]), dtype=np.uint8)].reshape(-1, width)
            row, ranks = np.arange(len(parts)), self._ranks(parts[:, :-1], parts[:, 1:])
            out, sizes, whole = np.zeros(parts.shape, dtype=np.uint32), np.zeros(len(parts), dtype=np.int64), width
            while True:
                least = ranks.min(axis=1, initial=NO_RANK)
                done = least == NO_RANK
                if done.any():
                    out[row[done], :width], sizes[row[done]] = parts[done], width
                    parts, row, ranks, least = parts[~done], row[~done], ranks[~done], least[~done]
                if not len(row):
                    break
                each, at = np.arange(len(row)), ranks.argmin(axis=1)
                parts[each, at] = self.made[least]
                kept = np.ones(parts.shape, dtype=bool)
                kept[each, at + 1] = False
                parts = parts[kept].reshape(len(row), width - 1)
                kept = np.ones(ranks.shape, dtype=bool)
                kept[each, at] = False
                ranks = ranks[kept].reshape(len(row), width - 2)
                width -= 1
                for beside in (at, at - 1):
                    here = (beside >= 0) & (beside < width - 1)
                    i, j = each[here], beside[here]
                    ranks[i, j] = self._ranks(parts[i, j], parts[i, j + 1])
            raw, length = out.tobytes(), 4 * whole
            for i, (number, size) in enumerate(zip(numbers, sizes.tolist(), strict=True)):
                made[number] = raw[i * length : i * length + 4 * size]
        return made

    def _word(self, word: str) -> list[int]:
        parts = [*map(self.first.__getitem__, word.encode("utf-8"))]
        return self.merge_long(parts) if len(parts) > SHORT_WORD else self.merge_short(parts)

    def _split(self, text: str) -> bytes:
        ids = array("I")
        for word in self.pattern.findall(text):
            ids.extend(self._word(word))
        return ids.tobytes()

    def prepare(self, texts: Iterable[str | None]) -> None:
        """Remember the pieces of the texts that are not known yet; their words are merged together."""
        young, old, missing = self.young, self.old, set()
        for text in texts:
            missing.update(set((text or "").split(" ")).difference(young))
        for piece in missing.intersection(old):
            young[piece] = old[piece]
        short = [piece for piece in missing.difference(young) if piece and len(piece) <= SHORT_WORD // 4 and not piece[0].isspace()]
        if not short:
            return
        words = self.pattern.findall(" " + " ".join(short))
        different = [*set(words)]
        ids = dict(zip(different, self.merge_many([word.encode() for word in different]), strict=True))
        starts = [i for i, word in enumerate(words) if word[0] == " "]
        for piece, start, end in zip(short, starts, [*starts[1:], len(words)], strict=True):
            young[piece] = b"".join([ids[word] for word in words[start:end]])

    def _plain(self, text: str) -> bytes:
        """Ids of a text without special tokens.

        The split pattern always cuts before a space that has something else than white space behind it,
        so texts are cut there first and the pieces are remembered.
        """
        first, *pieces = text.split(" ")
        young, old = self.young, self.old
        found = list(map(young.get, pieces))
        if None in found:
            for at, ids in enumerate(found):
                if ids is None:
                    piece = pieces[at]
                    if not piece or piece[0].isspace():
                        return self._split(text)
                    ids = young.get(piece) or old.get(piece)
                    if ids is None:
                        ids = self._split(" " + piece)
                    found[at] = ids
                    if len(piece) <= SHORT_WORD:
                        young[piece] = ids
        if len(young) >= REMEMBERED:
            self.young, self.old = {}, young
        return self._split(first) + b"".join(found)

    def encode(self, text: str) -> array:
        ids, start = array("I"), 0
        for found in self.special_at.finditer(text) if self.special_at else ():
            ids.frombytes(self._plain(text[start : found.start()]))
            ids.append(self.special[found[0]])
            start = found.end()
        ids.frombytes(self._plain(text[start:] if start else text))
        return ids

    def decode(self, ids: array) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", errors="replace")


def coder_of(path: str) -> BytePairCoder:
    """One coder for all tasks of a Python worker."""
    return held(("coder_of", path), lambda: BytePairCoder(path))


def encode(docs: DataFrame, keep: list[str], text: str = "text", path: str | None = None) -> DataFrame:
    """The columns ``keep`` and ``ids array<int>`` of every whole text, one row for each row.

    A null or empty text has no ids. Repeated rows come out as often as they went in. Nothing is shuffled.
    """
    path = path or tokenizer_file(VOCABULARY)

    def make():
        coder = coder_of(path)

        def one(text: str | None) -> tuple:
            return (np.asarray(coder.encode(text or "")).astype(np.int32),)

        one.prepare = coder.prepare
        return one

    return per_text(docs, text, keep, "ids array<int>", make)


def decode(encoded: DataFrame, keep: list[str], ids: str = "ids", path: str | None = None) -> DataFrame:
    """The columns ``keep`` and ``text`` decoded from an array of ids; null or empty ids give an empty text."""
    path = path or tokenizer_file(VOCABULARY)

    def make():
        coder = coder_of(path)
        return lambda ids: (coder.decode(ids if ids is not None else []),)

    return per_text(encoded, ids, keep, "text string", make)


def round_trip_digests(docs: DataFrame, keep: list[str], text: str = "text", path: str | None = None) -> DataFrame:
    """Encodes and decodes every whole text in one pass and returns counts and digests instead of the long columns.

    ``n_tokens long``, ``ids_sha256`` (ids as little-endian unsigned 32-bit integers), ``decoded_sha256`` (UTF-8). A null
    text is an empty one; rows come out as often as they went in.
    """
    path = path or tokenizer_file(VOCABULARY)

    def make():
        coder = coder_of(path)

        def one(text: str | None) -> tuple:
            ids = coder.encode(text or "")
            decoded = coder.decode(ids)
            if sys.byteorder == "big":
                ids.byteswap()
            return len(ids), hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()

        one.prepare = coder.prepare
        return one

    return per_text(docs, text, keep, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", make)
