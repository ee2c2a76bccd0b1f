"""Token counts under a unigram vocabulary, by a Viterbi pass that keeps no path.

Aho-Corasick gives the vocabulary's pieces that end at each character; each position keeps the best score to there
and how many pieces it takes. Ties go to the piece that starts first, as the tokenizer's forward pass decides them:
a later candidate must be strictly better.
"""

from __future__ import annotations

import re

import ahocorasick
import sentencepiece
from pyspark.sql import DataFrame

from tripmill.llm.common import held, per_text, tokenizer_file

VOCABULARY = "piece_bpe_32k.model"
#: Counts of so many pieces of text are remembered in a Python worker.
REMEMBERED = 400_000
LONGEST_REMEMBERED = 64
# Fixed values of the tokenizer: the mark of a space, and how far an unknown character lies under the worst piece.
SPACE_MARK = "▁"
UNKNOWN_PENALTY = 10.0


class UnigramCounter:
    """Counts pieces; an unknown character counts as its UTF-8 bytes, which is how byte fallback spells it."""

    def __init__(self, scores: dict[str, float]):
        self.trie = ahocorasick.Automaton()
        for piece, score in scores.items():
            self.trie.add_word(piece, (len(piece), score))
        self.trie.make_automaton()
        self.unknown = min(scores.values()) - UNKNOWN_PENALTY
        self.cut = None if any(SPACE_MARK in piece.lstrip(SPACE_MARK) for piece in scores) else re.compile(f"{SPACE_MARK}+[^{SPACE_MARK}]*")
        self.known: dict[str, int] = {}

    @classmethod
    def load(cls, path: str) -> UnigramCounter:
        """Pieces and scores of a file; control, unknown, unused and byte pieces never match text."""
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i))]
        return cls({model.id_to_piece(i): model.get_score(i) for i in plain})

    def viterbi(self, text: str) -> tuple[float, int]:
        """Best score of a marked text and its number of pieces."""
        best, pieces, unknown = [0.0], [0], self.unknown
        ends = self.trie.iter(text)
        end, found = next(ends, (None, None))
        for at, letter in enumerate(text):
            score, count, single = None, 0, False
            while end == at:  # the longest piece, which starts first, comes first
                length, own = found
                there = best[at + 1 - length] + own
                single = single or length == 1
                if score is None or there > score:
                    score, count = there, pieces[at + 1 - length] + 1
                end, found = next(ends, (None, None))
            if not single and (score is None or best[at] + unknown > score):
                score, count = best[at] + unknown, pieces[at] + len(letter.encode())
            best.append(score)
            pieces.append(count)
        return best[-1], pieces[-1]

    def count(self, text: str) -> int:
        """No piece crosses from a word into the next space mark, so texts are cut there and counts remembered."""
        if not text:
            return 0
        marked = SPACE_MARK + text.replace(" ", SPACE_MARK)
        if self.cut is None:
            return self.viterbi(marked)[1]
        total, known = 0, self.known
        for part in self.cut.findall(marked):
            found = known.get(part)
            if found is None:
                found = self.viterbi(part)[1]
                if len(part) <= LONGEST_REMEMBERED:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[part] = found
            total += found
        return total


def counter_of(path: str) -> UnigramCounter:
    """One counter for all tasks of a Python worker."""
    return held(("counter_of", path), lambda: UnigramCounter.load(path))


def token_counts(docs: DataFrame, keep: list[str], text: str = "text", path: str | None = None) -> DataFrame:
    """The columns ``keep`` and ``n_tokens long`` of every whole text, one row for each row.

    A null or empty text has no tokens. Nothing is shuffled; a text needs a few numbers for each of its characters.
    """
    path = path or tokenizer_file(VOCABULARY)

    def make():
        counter = counter_of(path)
        return lambda text: (counter.count(text or ""),)

    return per_text(docs, text, keep, "n_tokens bigint", make)
