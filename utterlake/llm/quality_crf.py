"""Quality: a linear-chain conditional random field labels every line of a text good or bad.

A line's features are its own statistics and those of the lines before and after it. Training is weakly
supervised: each line of a labelled text carries the text's label. Scoring takes each line's marginal from
forward-backward, averages them weighted by the lines' lengths, and calibrates the average (a logistic map
fitted on the same sample).

Defined cases: a null text counts as empty; a text without a line that has a word gets the score of the
calibrated prior; very long texts are scored whole, as one chain; every input row gives one output row, repeated rows and null ids
included; an empty table gives no rows; extra columns are ignored; with one label only in the sample all scores are 0.5.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from utterlake.llm.common import crc_bucket, labelled_sample, small_batches, table
from utterlake.llm.text_stats import DIGIT, STOP, SYMBOL, UPPER, count

OWN = 10
N_FEATURES = 3 * OWN + 3


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Features of each line with a word (own, the line before, the line after, edges, bias), and the lines' bytes."""
    seen: set[bytes] = set()
    own, sizes = [], []
    for line in (text or "").encode("utf-8", "surrogatepass").split(b"\n"):
        words = line.split()
        if not words:
            continue
        n, size = len(words), len(line)
        own.append((
            min(count(line, SYMBOL) / n, 4.0),
            min(line.count(b"!") / n, 4.0),
            min(line.count(b"|") / n, 2.0),
            count(line, UPPER) / size,
            count(line, DIGIT) / size,
            min(count(line, STOP) / n, 2.0),
            len(set(words)) / n,
            float(line in seen),
            math.log1p(n) / 4,
            min(size / n, 30.0) / 10,
        ))
        seen.add(line)
        sizes.append(size)
    if not own:
        return np.zeros((0, N_FEATURES)), np.zeros(0)
    a = np.array(own)
    none = np.zeros((1, OWN))
    edges = np.zeros((len(a), 3))
    edges[0, 0] = edges[-1, 1] = 1
    edges[:, 2] = 1
    return np.hstack([a, np.vstack([none, a[:-1]]), np.vstack([a[1:], none]), edges]), np.array(sizes, float)


def marginals(d: list[float], move: np.ndarray) -> list[float]:
    """P(line is good) for each line; d: the good state's potential less the bad one's. move[a, b]: from a to b."""
    (bb, bg), (gb, gg) = np.exp(move).tolist()
    e = [math.exp(max(-30.0, min(30.0, v))) for v in d]
    ahead, f = [], 0.5
    for i, v in enumerate(e):
        if i:
            good, bad = v * (f * gg + (1 - f) * bg), f * gb + (1 - f) * bb
        else:
            good, bad = v, 1.0
        f = good / (good + bad)
        ahead.append(f)
    out, b = [0.0] * len(e), 0.5  # b: the good state's share of the backward message
    for i in range(len(e) - 1, -1, -1):
        good, bad = ahead[i] * b, (1 - ahead[i]) * (1 - b)
        out[i] = good / (good + bad)
        good, bad = gg * e[i] * b + gb * (1 - b), bg * e[i] * b + bb * (1 - b)
        b = good / (good + bad)
    return out


@dataclass
class LineCrf:
    weights: np.ndarray
    move: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def raw(self, text: str | None) -> float | None:
        x, sizes = line_features(text)
        if not len(x):
            return None
        return float(np.dot(marginals((x @ self.weights).tolist(), self.move), sizes) / sizes.sum())

    def score(self, text: str | None) -> float:
        good = self.raw(text)
        odds = self.shift + (0.0 if good is None else self.slope * _logit(good))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))


def _logit(p: float) -> float:
    p = min(max(p, 1e-3), 1 - 1e-3)
    return math.log(p / (1 - p))


def chains(made: list[np.ndarray], longest: int = 200, most: int = 100_000) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Texts' lines as padded blocks of chains of about one length: (which text, features [chain, line], which lines there are).

    A text of more than `longest` lines is several chains, for training only; all of its lines train. A block holds at most `most`
    lines with its padding, and chains are padded to less than twice their length.
    """
    parts = [(i, at, min(longest, len(x) - at)) for i, x in enumerate(made) for at in range(0, len(x), longest)]
    parts.sort(key=lambda p: p[2])
    start = 0
    while start < len(parts):
        end, least = start + 1, parts[start][2]
        while end < len(parts) and parts[end][2] < 2 * least and parts[end][2] * (end + 1 - start) <= most:
            end += 1
        group = parts[start:end]
        x = np.zeros((len(group), group[-1][2], N_FEATURES), np.float32)
        mask = np.zeros(x.shape[:2], bool)
        for k, (i, at, n) in enumerate(group):
            x[k, :n], mask[k, :n] = made[i][at : at + n], True
        yield np.array([p[0] for p in group]), x, mask
        start = end


def fit_texts(rows: list[tuple[str, int]], ridge: float = 1e-3, steps: int = 80, rate: float = 0.1) -> LineCrf:
    """Maximise the chains' conditional likelihood, then calibrate."""
    y = np.array([r[1] for r in rows], float)
    if len(set(y)) < 2:
        return LineCrf(np.zeros(N_FEATURES), np.zeros((2, 2)), 0.0, 0.0)
    made = [line_features(t)[0].astype(np.float32) for t, _ in rows]
    per = np.array([0.5 / (y == label).sum() / max(len(x), 1) for label, x in zip(y, made, strict=True)])  # a text's weight, for each line
    blocks = list(chains(made))
    w, move = np.zeros(N_FEATURES), np.zeros((2, 2))
    first, second = np.zeros(N_FEATURES + 4), np.zeros(N_FEATURES + 4)
    for step in range(1, steps + 1):
        g_w, g_move = ridge * w, ridge * move
        for text, x, mask in blocks:
            gold, weight = y[text].astype(int), per[text]
            node, pair = _expect(np.where(mask, x @ w, 0.0), mask, move)
            g_w = g_w + np.einsum("kt,ktf->f", np.where(mask, node - gold[:, None], 0.0) * weight[:, None], x)
            told = np.zeros((len(text), 2, 2))
            told[np.arange(len(text)), gold, gold] = mask.sum(1) - 1
            g_move = g_move + ((pair - told) * weight[:, None, None]).sum(0)
        full = np.append(g_w, g_move)
        first, second = 0.9 * first + 0.1 * full, 0.99 * second + 0.01 * full**2
        by = rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        w, move = w - by[:-4], move - by[-4:].reshape(2, 2)
    model = LineCrf(w, move)
    raw = [model.raw(t) for t, _ in rows]
    z = np.array([0.0 if r is None else _logit(r) for r in raw])
    weight = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum())
    a, b = 1.0, 0.0
    for _ in range(400):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        a, b = a - 0.5 * float((weight * (p - y) * z).sum() + 1e-3 * (a - 1)), b - 0.5 * float((weight * (p - y)).sum())
    return LineCrf(w, move, a, b)


def _expect(d: np.ndarray, mask: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(good) of each line, and the expected number of each move in each chain."""
    n, long = d.shape
    m = np.exp(move)
    e = np.stack([np.ones_like(d), np.exp(np.clip(d, -30, 30))], 2)
    ahead, back = np.full((n, long, 2), 0.5), np.full((n, long, 2), 0.5)
    for t in range(long):
        f = e[:, t] * (ahead[:, t - 1] @ m) if t else e[:, t]
        ahead[:, t] = f / f.sum(1, keepdims=True)
    for t in range(long - 2, -1, -1):
        b = (e[:, t + 1] * back[:, t + 1]) @ m.T
        b /= b.sum(1, keepdims=True)
        back[:, t] = np.where(mask[:, t + 1, None], b, 0.5)
    both = ahead * back
    node = both[:, :, 1] / both.sum(2)
    pair = np.zeros((n, 2, 2))
    for t in range(long - 1):
        q = ahead[:, t, :, None] * m[None] * (e[:, t + 1] * back[:, t + 1])[:, None, :]
        pair += np.where(mask[:, t + 1, None, None], q / q.sum((1, 2), keepdims=True), 0)
    return node, pair


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 2000, max_chars: int = 32768) -> LineCrf:
    """Learn from at most max_rows labelled texts; rows with crc32(doc_id as text) mod 4 = 2 are held out."""
    train = crc_bucket(F.col("doc_id"), 4) != 2
    return fit_texts(labelled_sample(docs, labels, "quality", train, max_rows, max_chars))


def score(text: Column, model: LineCrf) -> Column:
    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([model.score(t) for t in texts], dtype="float64")

    return scored(text)


def quality(docs: DataFrame, model: LineCrf) -> DataFrame:
    """One row per row of docs: doc_id, held_out, score, predicted (score >= 0.7)."""
    small_batches(docs.sparkSession)
    return docs.select("doc_id", score(F.col("text"), model).alias("score")).select(
        "doc_id",
        (crc_bucket(F.col("doc_id"), 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op6_quality_crf(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality(docs, fit(docs, table(spark, sf_dir, "labels")))
