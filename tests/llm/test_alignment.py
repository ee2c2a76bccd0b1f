from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tripmill.llm import alignment
from tripmill.llm.bpe import byte_letters

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def brute(rows):
    """Whole texts through both libraries, ends compared as sets, counts over all rows."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    byte_of = {letter: bytes([value]) for value, letter in enumerate(byte_letters())}
    aligned, count = [], Counter()
    for key, text in rows:
        ids = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        spelled = (
            [b"".join(byte_of[c] for c in a.id_to_token(i)) for i in ids[0]],
            [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids[1]],
        )
        if not text or any(b"".join(one) != (" " + text).encode() for one in spelled):
            aligned.append((key, [], [], [], []))
            continue
        ends = [np.cumsum([len(t) for t in one]).tolist() for one in spelled]
        links = [(x, y) for i, x in enumerate(ids[0]) for y in [ids[1][j] for j in [k for k, e in enumerate(ends[1]) if e == ends[0][i]]]] if len(text) < 400 else None
        if links is None:
            at = {e: y for e, y in zip(ends[1], ids[1], strict=True)}
            links = [(x, at[e]) for e, x in zip(ends[0], ids[0], strict=True) if e in at]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        inside = lambda which: [[i for i, e in zip(ids[which], ends[which], strict=True) if low < e <= high] for low, high in zip([0, *cuts], cuts)]
        groups = list(zip(inside(0), inside(1), strict=True)) if len(text) < 4000 else None
        count.update(links)
        aligned.append((key, *ids, groups, links))
    most = Counter()
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    done = []
    for key, one, other, groups, links in aligned:
        told = None if groups is None else ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        digest = told and hashlib.sha256(told.encode()).hexdigest()
        done.append((key, len(one), len(other), len(links), len(links), sum(count[l] == most[l[1]] for l in links), sum(count[l] for l in links), digest))
    return done, count


def texts(n, seed):
    draw = random.Random(seed)
    parts = ["<|endoftext|>", "a", "the", " ", " ", "  ", "\n", "\t ", "é", "'re", "12", "!!", "日本", "☃", "😀", "ing", "\x85", "　", "x" * 90, "▁", "<s>", "</s>", "<unk>", "\x1c", "\r\n", "ﬁ", "Wort", "\x00", "<0x41>"]
    weights = [1 if p in ("▁", "\x00") else 6 for p in parts]
    return ["".join(draw.choices(parts, weights)[0] for _ in range(draw.randrange(60))) for _ in range(n)]


def same(found, wanted):
    assert len(found) == len(wanted)
    for one, other in zip(sorted(found, key=lambda r: (r[0] is None, r)), sorted(wanted, key=lambda r: (r[0] is None, r)), strict=True):
        assert one[:7] == other[:7]
        assert other[7] is None or one[7] == other[7]


def test_like_brute_force(spark, odd, documents):
    many = [(100 + i, text, "en", "s", 1) for i, text in enumerate([*texts(400, 3), *["same words again and again"] * 200])]
    docs = odd.unionByName(documents(many)).withColumnsRenamed({"ids": "groups", "row": "links", "value": "pair"}).repartition(20)
    counts = alignment.count_links(docs)
    found = [tuple(r) for r in alignment.digests(alignment.align(docs, ["doc_id"], counts), ["doc_id"]).collect()]
    wanted, count = brute([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    same(found, wanted)
    keys = np.array([x << 32 | y for x, y in count], dtype=np.int64)
    place = counts.pairs.places(keys)
    assert sorted(place.tolist()) == list(range(len(counts.counts)))
    assert counts.counts[place].tolist() == list(count.values())
    assert sum(1 for r in found if r[7] == "") > 3


def test_empty_table_and_texts_without_tokens(odd):
    for docs in (odd.limit(0), odd.where("text IS NULL OR text = ''")):
        counts = alignment.count_links(docs)
        assert len(counts.counts) == 0
        assert all(tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "") for r in alignment.align(docs, ["doc_id"], counts).collect())


def test_pieces_are_remembered_in_generations(monkeypatch):
    split = [pieces for text in texts(60, 8) if (pieces := alignment.pieces_of(text))]
    told = lambda known, pieces: [one and (one.n_a, one.n_b, one.n_links) for one in known.of([pieces])[0]]
    wanted = [told(known, pieces) for known in [alignment.Remembered((A, B))] for pieces in split]
    monkeypatch.setattr(alignment, "REMEMBERED", 30)
    known = alignment.Remembered((A, B))
    for _ in range(2):
        for pieces, one in zip(split, wanted, strict=True):
            assert told(known, pieces) == one
            assert len(known.young) <= 30 and len(known.old) <= 30 + max(map(len, split))


@pytest.mark.parametrize("n", [0, 1, 2, 5, 1000, 3000])
def test_perfect_hash(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 47, n))
    seeds, placed = alignment.perfect_hash(keys)
    assert sorted(placed.tolist()) == keys.tolist()
    pairs = alignment.PairHash(1, [(0, seeds, placed)] if n else [])
    assert sorted(pairs.places(keys).tolist()) == list(range(n))
    assert pairs.keys[pairs.places(keys)].tolist() == keys.tolist() if n else True
    strange = np.setdiff1d(np.random.default_rng(7).integers(0, 1 << 47, 500), keys)
    assert (pairs.places(strange) == -1).all()


def test_faster_encoder_gives_the_same_ids():
    pair = alignment.TokenizerPair(A, B)
    assert pair.ranked is not None
    points = [p for p in range(0x110000) if not 0xD800 <= p < 0xE000]
    for start in range(0, len(points), 1000):
        text = "".join(f"a{chr(p)}b {chr(p)}  {chr(p)}{chr(p)}1\n{chr(p)} '{chr(p)}s" for p in points[start : start + 1000])
        assert pair.ranked.encode_ordinary(text) == pair.a.encode(text, add_special_tokens=False).ids


def test_bound_holds_all_linked_pairs():
    pair = alignment.TokenizerPair(A, B)
    assert pair.pair_bound() == 324_302  # fixed by the two files
