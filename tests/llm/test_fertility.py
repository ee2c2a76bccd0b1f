from __future__ import annotations

import random
import re
from collections import Counter

from tripmill.llm import fertility

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(inside)


def test_base_counts_against_brute_force(odd, documents):
    draw = random.Random(5)
    texts = ["".join(draw.choice(["a ", "b ", "c# ", "\n", "\t", "é ", "x\n", "\x85"]) for _ in range(draw.randrange(120))) for _ in range(150)]
    docs = odd.unionByName(documents([(100 + i, t, None, "s", 0) for i, t in enumerate(texts)]))
    text_of = {}
    for r in docs.collect():
        text_of.setdefault(r["doc_id"], []).append(r["text"])
    got = fertility.judged(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        options = [base(t) for t in text_of[r["doc_id"]]]
        counts = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        assert counts in options
        assert r["base_failed"] == (counts[0] < 10 or 100 * counts[4] > 20 * counts[0])
        assert not (r["base_failed"] and r["kept"]) and r["kept"] is not None
    assert fertility.judged(odd.limit(0)).count() == 0


def test_figures_and_bands(documents):
    draw, common = random.Random(6), ["the", "time", "people", "water", "house", "small", "great", "under", "light", "world", "school", "never"]
    clean = [" ".join(draw.choice(common) for _ in range(draw.randrange(60, 100))) for _ in range(400)]
    junk = [" ".join(chr(draw.randrange(0x1E00, 0x1EFF)) * 3 for _ in range(80)) for _ in range(8)]
    got = fertility.judged(documents([(i, t, "en", "s", 0) for i, t in enumerate(clean + junk)])).collect()
    assert sum(not r["kept"] for r in got if r["doc_id"] < 400) <= 1
    assert not any(r["kept"] for r in got if r["doc_id"] >= 400)
    one = fertility.Fertility(fertility.tokenizer_file(fertility.VOCABULARY))(["the", "☃☃"], 5)
    pieces = ["▁the", "▁", "☃", "☃"]
    assert one[0] == len(pieces) and one[1] == 5 / 4


def test_copies_of_one_text_leave_the_bands_alone(documents):
    draw, common = random.Random(7), [f"{a}{b}" for a in ("water", "people", "house", "school", "light", "world") for b in ("", "s", " one", " two", " time")]
    clean = [" ".join(draw.choice(common[: draw.randrange(15, 31)]) for _ in range(draw.randrange(90, 150))) for _ in range(300)]
    junk = [" ".join(draw.choice(common[:7]) for _ in range(draw.randrange(90, 150))) for _ in range(4)]
    measure = fertility.Fertility(fertility.tokenizer_file(fertility.VOCABULARY))
    entropy = {t: measure(t.split(), len(t))[3] for t in clean}

    def kept(copied):
        rows = clean + junk + [copied] * 150
        return {r["doc_id"]: r["kept"] for r in fertility.judged(documents([(i, t, "en", "s", 0) for i, t in enumerate(rows)])).collect()}

    in_order = sorted(clean, key=entropy.get)
    alone = kept(in_order[150])
    for hot in (in_order[75], in_order[225], junk[0]):
        got = kept(hot)
        assert all(got[i] == alone[i] for i in range(304))


def test_long_or_rare_junk_is_held_against_other_classes(documents):
    draw, stems = random.Random(8), "water people house school light world small great under never time long hand year work play".split()
    common = [stem + end for stem in stems for end in ("", "s", "er", "ing", "ed")]

    def of(words, n):
        return " ".join(draw.choice(words) for _ in range(n))

    rows = [(i, of(common, draw.randrange(90, 120)), "en") for i in range(80)]
    rows += [(100, of(common, 6000), "en"), (101, of(common[:30], 6000), "en"), (102, of(common[:30], 6000), "en"), (103, of(common, 12), "en")]
    rows += [(104, of(common, 6000), "xx"), (105, of(common[:30], 6000), "xx")]
    got = {r["doc_id"]: r for r in fertility.judged(documents([(*row, "s", 0) for row in rows])).collect()}
    assert not any(r["base_failed"] for r in got.values())
    assert {i for i, r in got.items() if not r["kept"]} == {101, 102, 105}
