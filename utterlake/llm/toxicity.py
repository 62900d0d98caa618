"""Toxicity: a logistic model on sentences, regularised with counterfactual sentences.

A document's score is that of its worst sentence, so that length doesn't dilute it. Features are the
presence of words and word beginnings that the training texts tie to the label. For the counterfactual
penalty each training sentence is rewritten with its identity terms swapped for other groups' terms
(a sentence without one gets a neutral mention), and squared changes of the score are penalised, so that
naming a group does not move the score.

Defined cases: a null text counts as empty and gets the score of an empty sentence; very long texts are scored whole, sentence by
sentence; of equally bad sentences the first trains; every input row gives one output row, repeated rows and null ids included; an
empty table gives no rows; extra columns are ignored; without both labels in the sample every score is 0.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from utterlake.llm.common import crc_bucket, labelled_sample, small_batches, table

SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"\w+")

#: Terms for groups of people that a neutral sentence may name.
IDENTITY = (
    "women", "men", "woman", "man", "girls", "boys", "muslims", "christians", "jews", "hindus", "atheists",
    "muslim", "christian", "jewish", "hindu", "gay", "lesbian", "straight", "transgender", "black", "white",
    "asian", "african", "latino", "immigrants", "refugees", "disabled", "blind", "deaf", "elderly", "young",
)


def features(word: str) -> list[str]:
    """The word, and its beginnings of 3 to 8 letters (marked by a *)."""
    return [word, *(word[:k] + "*" for k in range(3, min(8, len(word)) + 1))]


def swap_identity(words: list[str], turn: int) -> list[str]:
    """The sentence with every identity term replaced by another; without one, with a term put in front."""
    other = IDENTITY[turn % len(IDENTITY)]
    found = [i for i, w in enumerate(words) if w in IDENTITY]
    if not found:
        return [other, *words]
    return [(other if w != other else IDENTITY[(turn + 1) % len(IDENTITY)]) if i in found else w for i, w in enumerate(words)]


@dataclass
class Toxicity:
    weights: dict[str, float]
    bias: float

    def word_weights(self) -> "_Words":
        return _Words(self.weights)

    def score(self, text: str | None, known: "_Words") -> float:
        text = (text or "").lower()
        most = self.bias
        if any(known[w] for w in set(WORD.findall(text))):
            for s in SENTENCE.findall(text):
                got = {f for w in WORD.findall(s) for f in known[w]}
                if got:
                    most = max(most, self.bias + sum(self.weights[f] for f in got))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, most))))


class _Words(dict):
    """Word to its features that have a weight; bounded, so that a worker's memory stays flat."""

    def __init__(self, weights: dict[str, float] | dict[str, int], most: int = 200_000):
        super().__init__()
        self.weights, self.most = weights, most

    def __missing__(self, word: str) -> tuple[str, ...]:
        if len(self) >= self.most:
            self.clear()
        self[word] = got = tuple(f for f in features(word) if f in self.weights)
        return got


def _sentences(text: str) -> Iterator[list[str]]:
    return (WORD.findall(m[0]) for m in SENTENCE.finditer(text.lower()))


def fit_texts(
    rows: list[tuple[str, int]], n_features: int = 1500, least_docs: int = 4, ridge: float = 3e-4,
    counterfactual: float = 0.3, toxic_share: float = 0.35, rounds: int = 3, steps: int = 150,
) -> Toxicity:
    """Pick features by their log odds over documents, then fit weights on each document's worst sentence.

    Each round reads the texts again, one at a time, and keeps a worst sentence's features only, so that memory doesn't depend on
    how many sentences a text has.
    """
    n = Counter(y for _, y in rows)
    if len(n) < 2:
        return Toxicity({}, -30.0)
    y = np.array([r[1] for r in rows], float)
    share = np.where(y == 1, toxic_share / n[1], (1 - toxic_share) / n[0])
    seen = {0: Counter(), 1: Counter()}
    for text, label in rows:
        words = {w for s in _sentences(text) for w in s}
        seen[label].update({f for w in words for f in features(w)})
    strength = {}
    for f, a in seen[1].items():
        b = seen[0][f]
        if a >= least_docs and f not in IDENTITY:
            odds = math.log((a + 0.5) / (n[1] - a + 0.5)) - math.log((b + 0.5) / (n[0] - b + 0.5))
            z = odds / math.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
            if odds > 2 and z > 3.5:
                strength[f] = z
    seen.clear()
    names = sorted(strength, key=lambda f: (-strength[f], f))[:n_features] + list(IDENTITY)
    at = {f: i for i, f in enumerate(names)}
    known = _Words(at)

    def places(words: list[str]) -> list[int]:
        return sorted({at[f] for w in words for f in known[w]})

    def dense(found: list[list[int]]) -> np.ndarray:
        x = np.zeros((len(found), len(names)), np.float32)
        for row, i in zip(x, found, strict=True):
            row[i] = 1
        return x

    w, bias = np.array([1.0 if f in strength else 0.0 for f in names], np.float32), -2.0
    for _ in range(rounds):
        worst, swapped = [], []
        for i, (text, _) in enumerate(rows):
            best: tuple[float, list[int], list[str]] | None = None
            for words in _sentences(text):
                if (found := places(words)) and (best is None or w[found].sum() > best[0]):
                    best = (w[found].sum(), found, words)
            _, found, words = best or (0.0, [], [])
            worst.append(found)
            swapped.append(places(swap_identity(words, i)))
        x = dense(worst)
        change = dense(swapped) - x
        first, second = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
        for step in range(1, steps + 1):
            p = 1 / (1 + np.exp(-np.clip(x @ w + bias, -30, 30)))
            moved = change @ w
            grad = x.T @ (share * (p - y)) + ridge * w + 2 * counterfactual * change.T @ moved / len(y)
            full = np.append(grad, (share * (p - y)).sum())
            first, second = 0.9 * first + 0.1 * full, 0.99 * second + 0.01 * full**2
            by = 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
            w, bias = (w - by[:-1]).astype(np.float32), bias - float(by[-1])
    return Toxicity({f: float(v) for f, v in zip(names, w, strict=True) if abs(v) > 1e-3}, bias)


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 4000, max_chars: int = 32768) -> Toxicity:
    """Learn from at most max_rows labelled texts; rows with crc32(doc_id as text) mod 5 = 0 are held out."""
    train = crc_bucket(F.col("doc_id"), 5) != 0
    return fit_texts(labelled_sample(docs, labels, "toxic", train, max_rows, max_chars))


def score(text: Column, model: Toxicity) -> Column:
    """The probability of label 1, from 0 to 1."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = model.word_weights()
        for texts in batches:
            yield pd.Series([model.score(t, known) for t in texts], dtype="float64")

    return scored(text)


def toxicity(docs: DataFrame, model: Toxicity) -> DataFrame:
    """One row per row of docs: doc_id, held_out, score, predicted."""
    small_batches(docs.sparkSession)
    return docs.select("doc_id", score(F.col("text"), model).alias("score")).select(
        "doc_id",
        (crc_bucket(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity(docs, fit(docs, table(spark, sf_dir, "labels")))
