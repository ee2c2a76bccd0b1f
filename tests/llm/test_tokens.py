from __future__ import annotations

import hashlib
import random
import struct

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer, models

from tripmill.llm import bpe, unigram

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def texts(n, seed):
    draw = random.Random(seed)
    parts = ["<|endoftext|>", "a", "the", " ", "  ", "\n", "\t ", "é", "'re", "12", "!!", "日本", "☃", "😀", "ing", "\x85", "　", "x" * 90, "▁", "<s>"]
    return ["".join(draw.choice(parts) for _ in range(draw.randrange(60))) for _ in range(n)]


@pytest.fixture(scope="module")
def coder():
    return bpe.BytePairCoder(BYTES)


def test_same_ids_and_texts_as_the_library(coder):
    library = Tokenizer.from_file(BYTES)
    for text in texts(1500, 1):
        ids = library.encode(text, add_special_tokens=False).ids
        assert list(coder.encode(text)) == ids
        assert coder.decode(ids) == library.decode(ids, skip_special_tokens=False) == text


def test_every_character_splits_as_in_the_library(coder):
    library = Tokenizer.from_file(BYTES)
    points = [*range(0x3100), *range(0xA000, 0xA100), *range(0xFE00, 0x10400), *range(0x1F000, 0x1F700), 0xE0001, 0x10FFFF]
    for start in range(0, len(points), 50):
        text = "".join(f"a{chr(p)}b {chr(p)}  {chr(p)}{chr(p)}1" for p in points[start : start + 50])
        assert list(coder.encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_rank_array_and_heap_merge_alike(coder):
    for text in texts(200, 2):
        parts = [coder.first[b] for b in text.encode()]
        assert coder.merge_short(list(parts)) == coder.merge_long(list(parts))


def test_many_words_in_the_same_rank_arrays(coder):
    words = [w.encode() for text in texts(400, 4) for w in coder.pattern.findall(text)]
    words = [w for w in words if len(w) <= bpe.SHORT_WORD] + [b"a", b"\xff", b"aa" * 32]
    found = coder.merge_many(words)
    for word, ids in zip(words, found, strict=True):
        assert list(memoryview(ids).cast("I")) == coder.merge_short([coder.first[b] for b in word])
    assert coder.merge_many([]) == []


def test_prepared_pieces_and_generations(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 40)
    prepared, library = bpe.BytePairCoder(BYTES), Tokenizer.from_file(BYTES)
    some = texts(600, 6)
    for start in range(0, len(some), 50):
        prepared.prepare([*some[start : start + 50], None, ""])
        for text in some[start : start + 50]:
            assert list(prepared.encode(text)) == library.encode(text, add_special_tokens=False).ids
    assert len(prepared.old) and len(prepared.young) <= 40 + 50 * 60


def test_codec_of_odd_rows(odd):
    library = Tokenizer.from_file(BYTES)
    wanted = []
    for r in odd.select("doc_id", "text").collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        sha = hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        wanted.append((r["doc_id"], len(ids), sha, hashlib.sha256((r["text"] or "").encode()).hexdigest()))
    assert sorted(map(tuple, bpe.round_trip_digests(odd, ["doc_id"]).collect()), key=repr) == sorted(wanted, key=repr)
    back = bpe.decode(bpe.encode(odd, ["doc_id"]), ["doc_id"]).collect()
    assert sorted((r["text"] for r in back)) == sorted(r["text"] or "" for r in odd.collect())
    assert bpe.round_trip_digests(odd.limit(0), ["doc_id"]).count() == 0


@pytest.fixture(scope="module")
def viterbi():
    """The library's unigram model over the same pieces; control pieces are renamed, as they never match text."""
    pieces = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    vocabulary = []
    for i in range(pieces.get_piece_size()):
        plain = not (pieces.is_control(i) or pieces.is_unknown(i))
        vocabulary.append((pieces.id_to_piece(i), pieces.get_score(i)) if plain else (f"\U000f0000{i}", 0.0))
    return Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=True))


def library_count(viterbi, text):
    return len(viterbi.encode("▁" + text.replace(" ", "▁"), add_special_tokens=False).ids) if text else 0


def test_same_counts_as_the_library(viterbi):
    counter = unigram.UnigramCounter.load(PIECES)
    for text in texts(1500, 3):
        assert counter.count(text) == library_count(viterbi, text)


def test_ties_go_to_the_piece_that_starts_first():
    scores = {"a": -1.0, "b": -1.0, "c": -1.0, "ab": -2.0, "bc": -2.0, "abc": -3.0, "▁": -1.0}
    library = Tokenizer(models.Unigram([("<unk>", -9.0), *scores.items()], unk_id=0))
    for text in ("abc", "▁abcab", "cabcbca", "abzbc"):
        assert unigram.UnigramCounter({**scores, "<unk>": -9.0}).viterbi(text)[1] == len(library.encode(text).ids)


def test_counts_of_odd_rows(odd, viterbi):
    wanted = [(r["doc_id"], library_count(viterbi, r["text"] or "")) for r in odd.collect()]
    assert sorted(map(tuple, unigram.token_counts(odd, ["doc_id"]).collect()), key=repr) == sorted(wanted, key=repr)
    assert unigram.token_counts(odd.limit(0), ["doc_id"]).count() == 0
