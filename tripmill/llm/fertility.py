"""Quality rules on tokeniser fertility: how a public vocabulary cuts a text, against bands of its language."""

from __future__ import annotations

import unicodedata
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import sentencepiece
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.common import held, per_text, tokenizer_file, written

VOCABULARY = "piece_bpe_32k.model"
REMEMBERED = 250_000
LONGEST_REMEMBERED = 64
#: A class of length with fewer different texts has no band of its own.
LEAST_TEXTS = 20
#: The band of all texts; names of other bands are longer.
ALL = "all"
#: Relative accuracy of the quartiles.
ACCURACY = 10_000


@dataclass(frozen=True)
class Width:
    """How far a band reaches: so many times from the median to the quartile below and above it.

    A band reaches at least ``least`` times the median (``least_above`` on the upper side, if given) and ``floor``, so it
    does not collapse where many texts have nearly one figure. With ``scatter``, it widens for texts of few
    tokens, as by chance their figures scatter more; with ``least_scatter``, only its least width does. ``None`` leaves a
    side open. With ``by_length``, a text is only held against texts of its length, in classes of powers of two.
    """

    below: float | None
    above: float | None
    least: float
    floor: float = 0.0
    scatter: int = 0
    by_length: bool = False
    least_above: float | None = None
    least_scatter: int = 0


WIDTHS = {
    "chars_per_token": Width(12.0, 12.0, 0.15, scatter=100),
    "fallback_share": Width(None, 12.0, 0.0, floor=0.05, scatter=100),
    "token_entropy": Width(4.75, 25.0, 0.05, by_length=True, least_above=0.3, least_scatter=200),
}
METRICS = tuple(WIDTHS)

BASE = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"
FERTILITY = "n_tokens bigint, chars_per_token double, fallback_share double, token_entropy double, script string"
# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS, REPEAT_WINDOW, REPEAT_PERCENT = 10, 5, 20


def repeated_words(words: list[str], window: int = REPEAT_WINDOW) -> int:
    """Words in windows of ``window`` words that the text holds twice or more, the first time included.

    Windows get exact numbers by doubling: two equal neighbours in number make an equal longer window.
    """
    if len(words) <= window:
        return 0
    number: dict[str, int] = {}
    single = np.fromiter((number.setdefault(word, len(number)) for word in words), dtype=np.int64, count=len(words))
    now, length = single, 1
    while length < window:
        step = min(length, window - length)
        pair = now[: len(now) - step] * (int(now.max()) + 1) + now[step:]
        _, now = np.unique(pair, return_inverse=True)
        length += step
    again = np.bincount(now)[now] > 1
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    starts = np.flatnonzero(again)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + window, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def base_counts(text: str) -> tuple[list[str], tuple[int, int, int, int, int]]:
    words = [word.decode() for word in text.encode().split()]
    lines = [line for line in text.split("\n") if line.encode().split()]
    symbols = sum(text.count(symbol) for symbol in SYMBOLS)
    return words, (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), repeated_words(words))


@lru_cache(maxsize=4096)
def script_of(letter: str) -> str:
    """Script by the first word of the character's name, which is how Unicode names letters."""
    return unicodedata.name(letter, "OTHER").split(" ")[0] if letter.isalpha() else ""


class Fertility:
    """Tokens of a text's words, each taken as it stands after a space; what is known of a word is remembered."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.byte = np.array([self.model.is_byte(i) for i in range(self.model.get_piece_size())])
        self.known: dict[str, bytes] = {}

    def _ids(self, word: str) -> bytes:
        ids = np.asarray(self.model.encode(word), dtype=np.int32).tobytes()
        if len(word) <= LONGEST_REMEMBERED:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[word] = ids
        return ids

    def __call__(self, words: list[str], chars: int) -> tuple[int, float | None, float | None, float | None, str | None]:
        if not words:
            return 0, None, None, None, None
        known, miss = self.known, self._ids
        ids = np.frombuffer(b"".join([known.get(word) or miss(word) for word in words]), dtype=np.int32)
        _, counts = np.unique(ids, return_counts=True)
        share = counts / len(ids)
        entropy = float(-(share * np.log2(share)).sum()) + 0.0
        initials = Counter(word[0] for word in words)
        scripts: Counter = Counter()
        for letter, n in initials.items():
            scripts[script_of(letter)] += n
        scripts.pop("", None)
        script = min(scripts, key=lambda s: (-scripts[s], s)) if scripts else None
        return len(ids), chars / len(ids), float(self.byte[ids].mean()), entropy, script


def fertility_of(path: str) -> Fertility:
    """One measurer for all tasks of a Python worker."""
    return held(("fertility_of", path), lambda: Fertility(path))


def measured(docs: DataFrame, keep: list[str], text: str = "text", path: str | None = None) -> DataFrame:
    """The columns ``keep``, the base counts and the fertility figures of every whole text; a null text is empty."""
    path = path or tokenizer_file(VOCABULARY)

    def make():
        fertility = fertility_of(path)

        def one(text: str | None) -> tuple:
            words, base = base_counts(text or "")
            return (*base, *fertility(words, base[1]))

        return one

    return per_text(docs, text, keep, f"{BASE}, {FERTILITY}", make)


def bands(figures: DataFrame, by_length: bool) -> DataFrame:
    """For each language, or language and class of length: the quartiles of its figures over ``figures``."""
    quartiles = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    chosen = [F.percentile_approx(m, quartiles, ACCURACY).alias(f"{m}_quartiles") for m, w in WIDTHS.items() if w.by_length == by_length]
    return figures.groupBy("band", *["length_class"] * by_length).agg(*chosen, F.count("*").alias("n"))


def different_texts(figures: DataFrame) -> DataFrame:
    """The figures of texts that pass the base rules, one row for each different text of a language."""
    return figures.where(~F.col("base_failed")).select("band", "length_class", "text1__", "text2__", *METRICS).dropDuplicates(["band", "text1__", "text2__"])


def length_bands(texts: DataFrame) -> DataFrame:
    """For each language and class of length: the quartiles its texts are held against, and ``eased``.

    A class of fewer than ``LEAST_TEXTS`` different texts takes the band of the nearest shorter class of its language
    that has them, else of the nearest longer one, else of the whole language; a language without so many texts takes
    that of all texts, found the same way, and in a table of few texts that of the whole table. Shorter texts have a
    lower entropy: if the band is of longer texts, its lower side is lowered by ``eased`` bits, one for each halving,
    which is the most that a text can have less than its halves on average.
    """
    names = [f"{m}_quartiles" for m, w in WIDTHS.items() if w.by_length]
    once = texts.dropDuplicates(["text1__", "text2__"]).withColumn("band", F.lit(ALL))
    both = texts.unionByName(once)
    classes, whole = bands(both, True), bands_of_all(both)
    used = F.struct(*names, F.col("length_class").alias("used"))
    enough = F.when(F.col("n") >= LEAST_TEXTS, used)
    order = Window.partitionBy("band").orderBy("length_class")
    shorter = F.last(enough, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    longer = F.first(enough, ignorenulls=True).over(order.rowsBetween(0, Window.unboundedFollowing))
    found = classes.select("band", "length_class", F.coalesce(shorter, longer).alias("near")).join(whole, "band")
    fits = (F.col("band") == ALL) | (F.col("n_whole") >= LEAST_TEXTS)
    found = written(found.select("band", "length_class", F.coalesce("near", F.when(fits, F.col("whole"))).alias("found")))
    any_ = found.where(F.col("band") == ALL).select("length_class", F.col("found").alias("any"))
    chosen = found.where(F.col("band") != ALL).join(any_, "length_class").select("band", "length_class", F.coalesce("found", "any").alias("chosen"))
    eased = F.greatest(F.col("chosen.used") - F.col("length_class"), F.lit(0)).alias("eased")
    return chosen.select("band", "length_class", *[F.col("chosen")[name].alias(name) for name in names], eased)


def bands_of_all(texts: DataFrame) -> DataFrame:
    """For each language: the band by length of its texts of all lengths, at their median class, and how many these are."""
    quartiles = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    chosen = [F.percentile_approx(m, quartiles, ACCURACY).alias(f"{m}_quartiles") for m, w in WIDTHS.items() if w.by_length]
    used = F.percentile_approx("length_class", 0.5).alias("used")
    return texts.groupBy("band").agg(F.struct(*chosen, used).alias("whole"), F.count("*").alias("n_whole"))


def _inside(metric: str) -> Column:
    """Whether a figure is within its band; true where there is no figure or no band."""
    width, figure = WIDTHS[metric], F.col(metric)
    low, middle, high = [F.col(f"{metric}_quartiles")[i] for i in range(3)]
    slack = F.sqrt(F.lit(1.0) + F.lit(width.scatter) / F.greatest(F.col("n_tokens"), F.lit(1)))
    inside = F.lit(True)
    short = F.sqrt(F.lit(1.0) + F.lit(width.least_scatter) / F.greatest(F.col("n_tokens"), F.lit(1)))
    least_above = width.least if width.least_above is None else width.least_above
    for times, part, side, least in ((width.below, middle - low, -1, width.least), (width.above, high - middle, 1, least_above)):
        if times is not None:
            reach = F.greatest(F.lit(times) * part, F.lit(least) * middle * short, F.lit(width.floor)) * slack
            eased = F.col("eased") if width.by_length and side < 0 else F.lit(0)
            inside = inside & ((figure - middle) * side - eased <= reach)
    return F.coalesce(inside, F.lit(True))


def judged(docs: DataFrame, key: str = "doc_id", text: str = "text", language: str = "lang", path: str | None = None) -> DataFrame:
    """A row for each row of ``docs``: key, base counts, fertility figures, ``base_failed`` and ``kept``.

    ``base_failed``: under 10 words, or over 20 % of the words in repeated windows of five words. Other texts are kept
    if characters per token and the share of byte-fallback tokens lie within the bands of their language, and the
    tokens' entropy within the band of their language and length; a text without a language is held against the texts in its script. A null, empty or blank text has no
    figures and fails the base rules. Repeated rows are judged alike. Quartiles are those of different texts, however many copies a text has.
    """
    hashes = [F.xxhash64(F.lit(i), F.col(text)).alias(f"text{i}__") for i in (1, 2)]
    rows = docs.select(F.col(key).alias("key__"), F.col(language).alias("language__"), F.col(text).alias("text__"), *hashes)
    figures = measured(rows, ["key__", "language__", "text1__", "text2__"], "text__", path)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    band = F.coalesce(F.concat(F.lit("language "), "language__"), F.concat(F.lit("script "), "script"), F.lit("none"))
    length = F.floor(F.log2(F.greatest(F.col("n_tokens"), F.lit(1))))
    figures = written(figures.select("*", failed.alias("base_failed"), band.alias("band"), length.alias("length_class")))
    texts = written(different_texts(figures))
    by_language, by_length = written(bands(texts, False).drop("n")), written(length_bands(texts))
    inside = [_inside(metric) for metric in METRICS]
    verdict = ~F.col("base_failed") & inside[0] & inside[1] & inside[2]
    return figures.join(by_language, "band", "left").join(by_length, ["band", "length_class"], "left").select(
        F.col("key__").alias(key), *[c.strip().split(" ")[0] for c in f"{BASE}, {FERTILITY}".split(",")], "base_failed", verdict.alias("kept")
    )
