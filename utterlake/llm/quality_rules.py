"""Quality rules: base rules and gradient-boosted trees over document statistics.

The trees are fitted with numpy on a bounded labelled sample, by histograms, with monotonic
constraints on the junk features (more symbols, repeats or capitals can never raise a score), and
flattened into node arrays, which score a batch of documents level by level.

Defined cases: a null text counts as empty; a text without words has base_failed true (n_words < 10)
and is not kept; very long texts are counted whole; a score equal to the least one is kept; every input row gives one
output row, repeated rows and null ids included; an empty table gives no rows; extra columns are ignored. With no labelled rows the verdict is the base rule alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from utterlake.llm.common import labelled_sample, small_batches, table
from utterlake.llm.text_stats import MONOTONE, document_stats

SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, score double"
)


@dataclass
class FlatTrees:
    """All trees' nodes in arrays. A leaf has feature -1 and points to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    bias: float
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            f = self.feature[at]
            go_left = x[rows, np.maximum(f, 0)] <= self.threshold[at]
            at = np.where(f < 0, at, np.where(go_left, self.left[at], self.right[at]))
        return 1 / (1 + np.exp(-np.clip(self.value[at].sum(1) + self.bias, -30, 30)))


def fit_trees(
    x: np.ndarray, y: np.ndarray, monotone=MONOTONE, n_trees: int = 50, depth: int = 3, rate: float = 0.2,
    bins: int = 48, reg: float = 1.0, min_weight: float = 2.0,
) -> FlatTrees:
    """Second-order boosting of the logistic loss over quantile bins."""
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, j]) for j, c in enumerate(cuts)], 1)
    prior = min(max(y.mean(), 1e-3), 1 - 1e-3)
    bias = float(np.log(prior / (1 - prior)))
    margin = np.full(len(y), bias)
    nodes: list[list[float]] = []  # feature, threshold, left, right, value
    roots = []

    def grow(rows: np.ndarray, grad: np.ndarray, hess: np.ndarray, low: float, high: float, left_depth: int) -> int:
        g, h = grad[rows].sum(), hess[rows].sum()
        value = float(np.clip(-g / (h + reg), low, high))
        me = len(nodes)
        nodes.append([-1, 0.0, me, me, rate * value])
        best = (1e-6, None)
        if left_depth and len(rows) > 1:
            for j, c in enumerate(cuts):
                if not len(c):
                    continue
                gl = np.cumsum(np.bincount(binned[rows, j], grad[rows], len(c) + 1))[:-1]
                hl = np.cumsum(np.bincount(binned[rows, j], hess[rows], len(c) + 1))[:-1]
                gr, hr = g - gl, h - hl
                vl, vr = np.clip(-gl / (hl + reg), low, high), np.clip(-gr / (hr + reg), low, high)
                fits = (hl >= min_weight) & (hr >= min_weight) & (monotone[j] * (vr - vl) >= 0)
                gain = np.where(fits, -(gl * vl + (hl + reg) * vl**2 / 2) - (gr * vr + (hr + reg) * vr**2 / 2), -np.inf)
                gain += g * value + (h + reg) * value**2 / 2
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (gain[k], (j, k, float(vl[k]), float(vr[k])))
        if best[1] is None:
            margin[rows] += rate * value
            return me
        j, k, vl, vr = best[1]
        mid = (vl + vr) / 2
        goes = binned[rows, j] <= k
        l_low, l_high, r_low, r_high = low, high, low, high
        if monotone[j] < 0:
            l_low, r_high = max(low, mid), min(high, mid)
        elif monotone[j] > 0:
            l_high, r_low = min(high, mid), max(low, mid)
        a = grow(rows[goes], grad, hess, l_low, l_high, left_depth - 1)
        b = grow(rows[~goes], grad, hess, r_low, r_high, left_depth - 1)
        nodes[me] = [j, float(cuts[j][k]), a, b, 0.0]
        return me

    everything = np.arange(len(y))
    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-margin))
        roots.append(grow(everything, p - y, np.maximum(p * (1 - p), 1e-6), -np.inf, np.inf, depth))
    a = np.array(nodes)
    return FlatTrees(a[:, 0].astype(int), a[:, 1], a[:, 2].astype(int), a[:, 3].astype(int), a[:, 4], np.array(roots), bias, depth)


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 4000, max_chars: int = 32768) -> FlatTrees | None:
    """Trees for P(quality = 1), from at most max_rows labelled texts; None without both labels."""
    rows = labelled_sample(docs, labels, "quality", F.lit(True), max_rows, max_chars)
    y = np.array([r[1] for r in rows], float)
    if len(set(y)) < 2:
        return None
    return fit_trees(np.array([document_stats(t)[1] for t, _ in rows]), y)


def verdict(text: Column, trees: FlatTrees | None, least: float = 0.5) -> Column:
    """A struct column with SCHEMA's fields: statistics, base rule, and kept = base rule and score >= least."""

    @F.pandas_udf(SCHEMA)
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            both = [document_stats(t) for t in texts]
            counts = np.array([b[0] for b in both], np.int64).reshape(-1, 5)
            score = trees.score(np.array([b[1] for b in both])) if trees and both else np.ones(len(both))
            failed = (counts[:, 0] < 10) | (100 * counts[:, 4] > 20 * counts[:, 0])
            out = pd.DataFrame(counts, columns=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"])
            yield out.assign(base_failed=failed, kept=~failed & (score >= least), score=score)

    return judged(text)


def quality_rules(docs: DataFrame, trees: FlatTrees | None) -> DataFrame:
    """One row per row of docs: doc_id and verdict()'s fields."""
    small_batches(docs.sparkSession)
    return docs.select("doc_id", verdict(F.col("text"), trees).alias("v")).select("doc_id", "v.*")


def op9_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules(docs, fit(docs, table(spark, sf_dir, "labels")))
