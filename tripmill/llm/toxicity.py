"""Severity of toxic language: cumulative-link ordinal regression on sparse text features.

One weight for each feature is shared by all thresholds: P(grade > k) = logistic(weights · features - threshold k),
with thresholds in ascending order. The expected severity is the sum of these probabilities.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import hold_nothing, per_text, written

#: Labelled rows the model is fitted on at most, chosen by a hash of their key.
SAMPLE_ROWS = 10_000
#: Features kept at most: those that set grades above zero apart best.
FEATURES = 4_096
#: A feature must be in so many fitted rows of a grade above zero, and so many times as common there.
LEAST_ROWS = 3
LEAST_LIFT = 8.0
#: A document is toxic from this probability of a grade above zero on.
REJECT = 0.5
PREFIXES = (4, 5, 6)
PENALTY = 0.05
WORD = re.compile(r"[^\W\d_]+")
REMEMBERED = 200_000


def features_of(word: str) -> list[str]:
    """A word and its beginnings, so that other endings of a known word count as well."""
    return ["=" + word, *[word[:n] for n in PREFIXES if len(word) >= n]]


@dataclass
class OrdinalModel:
    """Weights by feature and ascending thresholds; ``grades`` is the highest grade."""

    weights: dict[str, float] = field(default_factory=dict)
    thresholds: list[float] = field(default_factory=list)
    lowest: int = 0

    @property
    def grades(self) -> int:
        return len(self.thresholds)

    def probabilities(self, counts: dict[str, int]) -> list[float]:
        """P(grade > k) for each threshold."""
        score = sum(self.weights[name] * float(np.log1p(n)) for name, n in counts.items())
        return [float(1 / (1 + np.exp(np.clip(t - score, -500, 500)))) for t in self.thresholds]


class Counted:
    """Counts the known features of whole texts; what is known of a word is remembered."""

    def __init__(self, names):
        self.names, self.memory = set(names), {}

    def __call__(self, text: str | None) -> dict[str, int]:
        counts: Counter = Counter()
        memory = self.memory
        for word in WORD.findall((text or "").lower()):
            found = memory.get(word)
            if found is None:
                found = [name for name in features_of(word) if name in self.names]
                if len(memory) >= REMEMBERED:
                    memory.clear()
                if len(word) <= 64:
                    memory[word] = found
            if found:
                counts.update(found)
        return counts


def _telling(sample: DataFrame) -> list[str]:
    """The features that set grades above zero apart: likelihood ratio over presence in a row."""

    def make():
        def one(text):
            return (list({name for word in set(WORD.findall((text or "").lower())) for name in features_of(word)}),)

        return one

    totals = {bool(r[0]): r[1] for r in sample.groupBy(F.col("grade") > 0).count().collect()}
    bad, good = totals.get(True, 0), totals.get(False, 0)
    if not bad or not good:
        return []
    found = per_text(sample, "text", ["grade"], "names array<string>", make)
    seen = found.select("grade", F.explode("names").alias("name")).groupBy("name").agg(
        F.sum(F.when(F.col("grade") > 0, 1).otherwise(0)).alias("bad"), F.sum(F.when(F.col("grade") > 0, 0).otherwise(1)).alias("good")
    )
    lift = (F.col("bad") / bad) / ((F.col("good") + 0.5) / good)
    both = F.col("bad") + F.col("good")
    part = lambda n, share: F.when(n > 0, n * F.log(n / (both * share))).otherwise(0.0)
    ratio = part(F.col("bad"), bad / (bad + good)) + part(F.col("good"), good / (bad + good))
    best = seen.where((F.col("bad") >= LEAST_ROWS) & (lift >= LEAST_LIFT)).orderBy(ratio.desc(), "name").limit(FEATURES)
    return sorted(r["name"] for r in best.select("name").collect())


def fit_rows(rows: list[dict[str, int]], grades: list[int], names: list[str], penalty: float = PENALTY, rounds: int = 300) -> OrdinalModel:
    """Maximum likelihood with a ridge on the weights, by L-BFGS; rows hold the counts of their features."""
    grade = np.asarray(grades, dtype=np.int64)
    lowest, top = int(grade.min(initial=0)), int(grade.max(initial=0))
    levels = top - lowest
    if not len(grade) or levels == 0:
        return OrdinalModel({}, [], lowest)
    place = {name: i for i, name in enumerate(names)}
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col = np.fromiter((place[name] for r in rows for name in r), dtype=np.int64, count=len(row))
    val = np.log1p(np.fromiter((n for r in rows for n in r.values()), dtype=np.float64, count=len(row)))
    above = (grade[:, None] - lowest > np.arange(levels)).astype(float)
    share = np.clip(above.mean(axis=0), 1e-4, 1 - 1e-4)
    start = np.sort(np.log((1 - share) / share)) + np.arange(levels) * 1e-3
    x = np.concatenate([np.zeros(len(names)), start[:1], np.log(np.diff(start))])
    width = len(names)

    def loss(x):
        steps = np.exp(np.clip(x[width + 1 :], -30, 30))
        cuts = x[width] + np.concatenate([[0.0], np.cumsum(steps)])
        score = np.bincount(row, weights=x[:width][col] * val, minlength=len(rows))
        over = 1 / (1 + np.exp(np.clip(cuts - score[:, None], -500, 500)))
        ends = np.hstack([np.ones((len(rows), 1)), over, np.zeros((len(rows), 1))])
        at = np.arange(len(rows)), grade - lowest
        chance = np.maximum(ends[at] - ends[at[0], at[1] + 1], 1e-12)
        slope = ends * (1 - ends)
        d_score = -(slope[at] - slope[at[0], at[1] + 1]) / chance
        d_cut = np.zeros(levels)
        np.add.at(d_cut, at[1][at[1] > 0] - 1, (slope[at] / chance)[at[1] > 0])
        np.add.at(d_cut, at[1][at[1] < levels], -(slope[at[0], at[1] + 1] / chance)[at[1] < levels])
        gradient = np.empty_like(x)
        gradient[:width] = np.bincount(col, weights=d_score[row] * val, minlength=width) + penalty * x[:width]
        later = np.cumsum(d_cut[::-1])[::-1]
        gradient[width] = later[0]
        gradient[width + 1 :] = later[1:] * steps
        return -np.log(chance).sum() + penalty / 2 * (x[:width] ** 2).sum(), gradient

    x = _lbfgs(loss, x, rounds)
    cuts = x[width] + np.concatenate([[0.0], np.cumsum(np.exp(np.clip(x[width + 1 :], -30, 30)))])
    return OrdinalModel(dict(zip(names, x[:width].tolist(), strict=True)), cuts.tolist(), lowest)


def _lbfgs(loss, x: np.ndarray, rounds: int, memory: int = 8) -> np.ndarray:
    value, gradient = loss(x)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        if np.abs(gradient).max() < 1e-5 * max(1.0, len(x) ** 0.5):
            break
        step, kept = gradient.copy(), []
        for s, y in reversed(past):
            a = (s @ step) / (s @ y)
            kept.append(a)
            step -= a * y
        if past:
            s, y = past[-1]
            step *= (s @ y) / (y @ y)
        else:
            step /= max(1.0, np.abs(gradient).sum())
        for (s, y), a in zip(past, reversed(kept), strict=True):
            step += (a - (y @ step) / (s @ y)) * s
        size = 1.0
        while size > 1e-10:
            there, slope = loss(x - size * step)
            if there <= value - 1e-4 * size * (gradient @ step):
                break
            size /= 2
        else:
            break
        moved, turned = -size * step, slope - gradient
        x, value, gradient = x + moved, there, slope
        if moved @ turned > 1e-12:
            past = [*past[1 - memory :], (moved, turned)]
    return x


def fit(docs: DataFrame, labels: DataFrame, grade: str, key: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS) -> OrdinalModel:
    """The model of an integer grade from 0 on, fitted on at most ``sample_rows`` labelled documents.

    Labels without a key, grade or document are left out; of several labels of a key the highest counts, and of
    several documents of a key one is used for each distinct text. Without two grades the model is constant.
    """
    chosen = labels.select(F.col(key).alias("id"), F.col(grade).cast("int").alias("grade")).where("id IS NOT NULL AND grade IS NOT NULL")
    chosen = chosen.groupBy("id").agg(F.max("grade").alias("grade")).orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    sample = written(rows.join(chosen, "id").select("grade", "text").distinct())
    names = _telling(sample)

    def make():
        counted = Counted(names)
        return lambda text: (dict(counted(text)),)

    found = per_text(sample, "text", ["grade"], "counts map<string,int>", make).collect()
    found.sort(key=lambda r: (r["grade"], sorted(r["counts"].items())))
    return fit_rows([dict(r["counts"]) for r in found], [r["grade"] for r in found], names)


def graded(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", toxic: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, grade`` of the sampled labels: 0 if not toxic, else 1 to 3 by how many telling words a text holds.

    The labels only say whether a text is toxic. Toxic texts are cut in three at the thirds of their counts of
    telling features, so that a text with one insult ranks below one that is full of them.
    """
    chosen = labels.select(F.col(key).alias("id"), F.col(toxic).cast("int").alias("grade")).where("id IS NOT NULL AND grade IS NOT NULL")
    chosen = chosen.groupBy("id").agg(F.max("grade").alias("grade")).orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    sample = written(rows.join(chosen, "id").select("id", "grade", "text").distinct())
    names = _telling(sample)

    def make():
        counted = Counted(names)
        return lambda text: (sum(counted(text).values()),)

    counts = written(per_text(sample, "text", ["id", "grade"], "n bigint", make))
    cuts = counts.where("grade > 0").agg(F.percentile("n", F.array(F.lit(1 / 3), F.lit(2 / 3))).alias("cuts")).first()["cuts"] or [0.0, 0.0]
    level = F.when(F.col("grade") <= 0, 0).when(F.col("n") <= cuts[0], 1).when(F.col("n") <= cuts[1], 2).otherwise(3)
    return counts.select(F.col("id").alias(key), level.alias("grade"))


def severity(docs: DataFrame, model: OrdinalModel, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` and, for each row's whole text, ``severity`` (the expected grade) and ``toxic_chance``.

    ``toxic_chance`` is the probability of a grade above the lowest. A text without known features, a null or
    empty one included, has the severity that the thresholds alone give. A constant model gives its one grade.
    """

    def make():
        hold_nothing()
        counted = Counted(model.weights)

        def one(text):
            over = model.probabilities(counted(text))
            return model.lowest + sum(over), over[0] if over else float(model.lowest > 0)

        return one

    return per_text(docs, text, keep, "severity double, toxic_chance double", make)


def severity_of_labelled(docs: DataFrame, labels: DataFrame, keep: list[str], sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Severity of every row of ``docs`` by a model fitted on the labels (columns doc_id and toxic)."""
    grades = graded(docs, labels, sample_rows=sample_rows)
    return severity(docs, fit(docs, grades, "grade", sample_rows=sample_rows), keep)
