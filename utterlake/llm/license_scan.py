"""License scans: MinHash bands over overlapping text windows retrieve templates, shingle containment verifies.

Templates are license notices and whole license texts (LICENSES, or any small table of texts). A text's 5-word shingles are cut into
windows that overlap by half. Each template has windows of its own size: a half holds 1.25 times its shingles, rounded up by at most
a half, so that the template lies in one window wherever it begins, and makes up a fair part of it. Each of BANDS seeds gives a window's
least hash, which is looked up among the templates'. A window that holds the needed 75 % of a template's shingles shares a hash with
it but for a probability of missed(n), which is below 3 in a million for every n. A retrieved template is then searched for
exactly: it is reported if the whole text holds at least 75 % of its distinct shingles.

What the bands are not made for: a template whose shingles are strewn over a text, so that no window holds 75 % of them.

Templates of fewer than five words are one shingle: their whole sequence.

Defined cases: a text without words matches nothing; every row of docs that holds a template gives one row for each such template
(repeated rows too, null ids as well); very long texts are scanned whole, in slabs of bounded memory; of equal places the first is
reported; extra columns are ignored; template repeats are scanned once; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from utterlake.llm.common import small_batches, table
from utterlake.llm.near_dup import WORDS, WordHashes, mix, shingle_set, words_of

#: Names and texts of the notices that are looked for by default.
LICENSES = {
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "mit": "Released under the MIT License.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
}
# Whole texts and headers of common licenses.
LICENSES |= {
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
    '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
    "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
    "following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
    'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
    "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
    "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "bsd-3-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
    "in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its "
    "contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS "
    'PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED '
    "WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
    'the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL '
    "WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    "apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
    "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
    'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either '
    "express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "gpl-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
    "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed "
    "in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
    "PURPOSE. See the GNU General Public License for more details.",
}
BANDS = 64
PERCENT = 75
#: Shingles of a text that are looked at together, at least.
SLAB = 3 << 14
MATCH = "doc_id long, license string, n_found long, n_template long, first_word long"

_SEEDS = (mix(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def ordered_shingles(words: list[bytes], known: WordHashes, width: int) -> np.ndarray:
    """The hash of each window of `width` words, in order (as shingle_set() hashes them)."""
    n = len(words) - width + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    out = np.zeros(n, np.uint64) if width == WORDS else np.full(n, width, np.uint64)
    for j in range(width):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[j : j + n]
    return mix(out)


def half_window(n: int) -> int:
    """Shingles in half a window for a template of n shingles: the least of 2, 3, 4, 6, 8, 12, ... that holds 1.25 n."""
    size = 2
    while 4 * size < 5 * n:
        size = size * 3 // 2 if size & (size - 1) == 0 else size * 4 // 3
    return size


def needed(n: int) -> int:
    return -(-PERCENT * n // 100)


def missed(n: int) -> float:
    """The most with which the bands miss a template of n shingles in a window that holds as many of them as needed."""
    return (1 - needed(n) / (2 * half_window(n) + n - needed(n))) ** BANDS


def banded(hashes: np.ndarray) -> np.ndarray:
    """The shingles' values under each band [shingle, band]: 32 bits suffice, as what is retrieved is verified."""
    return (hashes >> np.uint64(32)).astype(np.uint32)[:, None] * _SEEDS


def _least(rows: np.ndarray, k: int) -> np.ndarray:
    """The least of each k rows on end (the last ones may be fewer)."""
    whole = len(rows) // k * k
    out = rows[0:whole:k]
    for j in range(1, k):
        out = np.minimum(out, rows[j:whole:k])
    return np.vstack([out, rows[whole:].min(0)]) if whole < len(rows) else out


def band_minima(hashes: np.ndarray, sizes: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """(size, least value of each half window under each band [half, band]) for each size, ascending; longer ones come from shorter ones."""
    first = sorted({3 if s % 3 == 0 else 2 for s in sizes})
    parts: dict[int, list[np.ndarray]] = {k: [] for k in first}
    for at in range(0, len(hashes), 6144):  # stretches that stay in the cache
        rows = banded(hashes[at : at + 6144])
        for k in first:
            parts[k].append(_least(rows, k))
    made = {k: np.vstack(p) for k, p in parts.items()}
    for size in sorted(sizes):
        near = max(s for s in made if size % s == 0 and (size // s) & (size // s - 1) == 0)
        while near < size:
            made[2 * near] = _least(made[near], 2)
            near *= 2
        yield size, made[size]


class Lookup:
    """Values of templates; a small table of some of their bits answers for most values that aren't there."""

    def __init__(self, owners: dict[int, list[int]]):
        self.owners, self.values = owners, np.array(sorted(owners), np.uint32)
        self.some = np.zeros(1 << 16, bool)
        self.some[self._bits(self.values)] = True

    @staticmethod
    def _bits(values: np.ndarray) -> np.ndarray:
        return values.astype(np.uint16)

    def find(self, values: np.ndarray) -> set[int]:
        likely = values[self.some[self._bits(values)]]
        return {t for v in np.intersect1d(likely, self.values).tolist() for t in self.owners[v]}


class Index:
    """Templates' shingle sets and, for each width of shingles and size of half windows, which templates have which least hashes.

    Each band multiplies with a seed of its own, so that one table serves all bands.
    """

    def __init__(self, templates: dict[str, str]):
        known = WordHashes()
        owners: dict[int, dict[int, dict[int, list[int]]]] = {}
        self.templates: list[tuple[str, np.ndarray, int]] = []
        for name, text in sorted(templates.items()):
            words = words_of(text)
            s = shingle_set(words, known)
            if not len(s):
                continue
            width = min(WORDS, len(words))
            values = owners.setdefault(width, {}).setdefault(half_window(len(s)), {})
            for v in set(banded(s).min(0).tolist()):
                values.setdefault(v, []).append(len(self.templates))
            self.templates.append((name, s, width))
        self.lookups = {width: {size: Lookup(v) for size, v in sizes.items()} for width, sizes in owners.items()}

    def retrieved(self, hashes: np.ndarray, width: int) -> set[int]:
        """The templates that some window of a text's shingles (of one width, in order) shares a band's least hash with."""
        found: set[int] = set()
        sizes = list(self.lookups[width])
        slab = -(-SLAB // (3 * (most := 1 << max(sizes).bit_length()))) * 3 * most  # whole half windows of every size
        for at in range(0, len(hashes), slab):
            for size, least in band_minima(hashes[at : at + slab + max(sizes)], sizes):
                windows = np.minimum(least[:-1], least[1:]) if len(least) > 1 else least
                found |= self.lookups[width][size].find(windows.ravel())
        return found

    def scan(self, words: list[bytes], known: WordHashes) -> list[tuple[str, int, int, int]]:
        """(name, shingles found, shingles of the template, first word of the first one found) of each match."""
        shingles = {width: ordered_shingles(words, known, width) for width in self.lookups}
        found = {t for width, hashes in shingles.items() if len(hashes) for t in self.retrieved(hashes, width)}
        out = []
        for t in sorted(found):
            name, s, width = self.templates[t]
            hits = np.flatnonzero(np.isin(shingles[width], s))
            n = len(np.unique(shingles[width][hits]))
            if n >= needed(len(s)):
                out.append((name, n, len(s), int(hits[0])))
        return out


#: Characters of all templates together that may go out with the tasks.
MOST_TEMPLATE_CHARS = 20_000_000


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """MATCH's columns. templates: a small table of names and texts, shipped with the tasks (at most MOST_TEMPLATE_CHARS)."""
    small_batches(docs.sparkSession)
    templates = LICENSES if templates is None else templates
    if sum(map(len, templates.values())) > MOST_TEMPLATE_CHARS:
        raise ValueError(f"templates of more than {MOST_TEMPLATE_CHARS} characters; scan for them in parts")
    index = Index(templates)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        for batch in batches:
            rows = [
                (doc_id, *match)
                for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True)
                for match in index.scan(words_of(text), known)
            ]
            out = pd.DataFrame(rows, columns=["doc_id", "license", "n_found", "n_template", "first_word"])
            yield out.astype({"doc_id": "Int64", "n_found": "int64", "n_template": "int64", "first_word": "int64", "license": object})

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInPandas(scan, MATCH)


def op4_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _oracle() -> str:
    """DuckDB: words and shingles of every text and template, counted where they meet."""
    rows = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in sorted(LICENSES.items()))
    words = r"list_filter(regexp_split_to_array(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
    return f"""
WITH t AS (SELECT license, {words.format("text")} AS w FROM (VALUES {rows}) v(license, text)),
ts AS (SELECT DISTINCT license, least(5, len(w)) AS k, array_to_string(list_slice(w, i, i + least(5, len(w)) - 1), ' ') AS s
       FROM (SELECT license, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM t)),
n AS (SELECT license, count(*) AS n_template FROM ts GROUP BY license),
d AS (SELECT row_number() OVER () AS r, doc_id, {words.format("text")} AS w FROM documents WHERE text IS NOT NULL),
ds AS (SELECT r, doc_id, i - 1 AS pos, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS s
       FROM (SELECT r, doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM ts)))
SELECT doc_id, license, count(DISTINCT s) AS n_found, any_value(n_template) AS n_template, min(pos) AS first_word
FROM ds JOIN ts USING (k, s) JOIN n USING (license)
GROUP BY r, doc_id, license HAVING 100 * count(DISTINCT s) >= 75 * any_value(n_template)
"""


ORACLE_SQL = _oracle()
