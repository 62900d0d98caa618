"""Statistics of one text, by bytes operations that run at C speed."""

from __future__ import annotations

import numpy as np

UPPER = bytes(range(65, 91))
DIGIT = bytes(range(48, 58))
SYMBOL = b"#*$%&|<>"
STOP = b".,;:?"


def count(data: bytes, of: bytes) -> int:
    return len(data) - len(data.translate(None, of))


def repeat_words(words: list[bytes]) -> int:
    """How many words lie in a 5-word window that the text has twice or more."""
    n = len(words) - 4
    if n < 2:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.uint64, len(words))
    if len(known) == len(words):
        return 0
    mixed = np.zeros(n, np.uint64)
    for j in range(5):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + ids[j : j + n]
    if np.unique(mixed).size == n:  # equal windows have equal sums, so there are none
        return 0
    pair = _rank(ids[:-1], ids[1:])
    four = _rank(pair[:-2], pair[2:])
    five = _rank(four[:n], ids[4:])
    _, back, times = np.unique(five, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(times[back] > 1)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + 5, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def _rank(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number the pairs (a, b): equal pairs get equal numbers. Both are below 2**32."""
    return np.unique((a << np.uint64(32)) | b, return_inverse=True)[1].astype(np.uint64)


def document_stats(text: str | None) -> tuple[list[int], list[float]]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words), and the features of the boosted trees."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    n, chars = len(words), len(text) - sum(map(text.count, " \t\n\x0b\x0c\r"))
    symbols = count(data, SYMBOL)
    lines = [x for x in data.split(b"\n") if x.strip()]
    dup = len(lines) - len(set(lines))
    repeat = repeat_words(words)
    w = max(n, 1)
    size = max(len(data), 1)
    features = [
        symbols / w,
        dup / max(len(lines), 1),
        repeat / w,
        count(data, UPPER) / size,
        data.count(b"!") / w,
        data.count(b"|") / w,
        count(data, DIGIT) / size,
        np.log1p(n),
        chars / w,
        len(set(words)) / w,
        count(data, STOP) / w,
        n / max(len(lines), 1),
    ]
    return [n, chars, symbols, dup, repeat], features


#: Of document_stats' features: the score may only fall as the feature grows (-1), or is free (0).
MONOTONE = (-1, -1, -1, -1, -1, -1, 0, 0, 0, 0, 0, 0)
