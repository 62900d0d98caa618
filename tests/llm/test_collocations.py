"""Collocations against a plain count of all phrases."""

import re
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest

from utterlake.llm import collocations as C
from utterlake.llm import common


def plain(rows, least, longest, share, top):
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    counts, total = {}, Counter()
    for lang, text in rows:
        seen = counts.setdefault(lang or "und", Counter())
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(low)):
            words = [w for w in re.split("[ \t]", piece) if w]
            total[lang or "und"] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    seen[tuple(words[i : i + k])] += 1
    out = []
    for lang, seen in counts.items():
        often = {p: n for p, n in seen.items() if n >= least}
        found = []
        for p, a in often.items():
            if len(p) < 2:
                continue
            score, _, l, r = min((10**6 * a * a // (seen[p[:k]] * seen[p[k:]]), k, seen[p[:k]], seen[p[k:]]) for k in range(1, len(p)))
            around = [n for q, n in often.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if not any(100 * n >= share * a for n in around):
                found.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def got(df, **options):
    return sorted(tuple(r) for r in C.collocations(df, **options).collect())


def rows_of(seed, n=60):
    rng = np.random.default_rng(seed)
    words = ["a", "B", "b", "ün", "漢字", "x-y", "#", "c\x1c", "İ"]
    join = [" ", "  ", "\t", " ", " ", ". ", ",", "\n", "\r", "!", ":\x0b"]
    text = lambda: "".join(words[rng.integers(len(words))] + join[rng.integers(len(join))] for _ in range(int(rng.integers(0, 80))))
    return [((None, "en", "de")[i % 3], None if i % 11 == 0 else text()) for i in range(n)]


@pytest.mark.parametrize("seed,least,longest,share,top", [(1, 10, 3, 50, 2000), (2, 3, 3, 50, 7), (3, 2, 4, 80, 50), (4, 1, 2, 1, 2000)])
def test_like_a_plain_count(spark, seed, least, longest, share, top):
    rows = rows_of(seed)
    df = spark.createDataFrame([(*r, 1, "n") for r in rows], "lang string, text string, n int, phrase string").repartition(3)
    assert got(df, least=least, longest=longest, share=share, top=top) == plain(rows, least, longest, share, top)


def test_the_bit_table_changes_no_result(spark):
    df = spark.createDataFrame(rows_of(5), "lang string, text string")
    assert got(df, least=3, bits=64) == got(df, least=3)


def test_shards_of_any_size_count_alike(spark):
    rows = rows_of(6)
    df = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    filled = [np.full(1, ~np.uint64(0))] * 2
    count = lambda most: sorted(tuple(r) for r in C.phrase_counts(C.shards(df, most), 3, filled, rows=10).groupBy("lang", "phrase").sum("n").collect())
    assert count(1) == count(100) == count(10**6) and count(1)


def test_a_task_holds_a_few_shards(spark, monkeypatch):
    """However many it writes or reads: a row group, which both hold whole, ends with the shard that fills it."""
    whole, stored, seen = C.shards, C.stored, []
    monkeypatch.setattr(C, "shards", lambda docs: whole(docs, 2_000))
    monkeypatch.setattr(C, "stored", lambda *a, **options: seen.append(stored(*a, **options)) or seen[-1])
    monkeypatch.setattr(common, "GROUP_BYTES", 50_000, raising=False)
    rng = np.random.default_rng(7)
    rows = [("en", " ".join(f"w{n}" for n in rng.integers(0, 1_000, 1_000))) for _ in range(40)]
    C.frequent_phrases(spark.createDataFrame(rows, "lang string, text string").coalesce(1))
    (path,) = seen[0].inputFiles()
    meta = pq.ParquetFile(path.removeprefix("file://")).metadata
    sizes = [meta.row_group(i).total_byte_size for i in range(meta.num_row_groups)]
    assert meta.num_rows == 20 and sum(sizes) > 300_000 and max(sizes) < 100_000


def test_phrases_cross_blocks_but_not_pieces(spark):
    text = "p q " * 40 + ". p. q p\nq"
    rows = [("en", text)]
    assert got(spark.createDataFrame(rows, "lang string, text string"), least=2) == plain(rows, 2, 3, 50, 2000)


def test_counts_beyond_64_bit_products(spark):
    n = 4 * 10**12
    often = spark.createDataFrame([("en", "a", n + 1, 1), ("en", "b", n + 7, 1), ("en", "a b", n, 2)], "lang string, phrase string, n long, words int")
    r = C.scored(often).first()
    assert r.score == 10**6 * n * n // ((n + 1) * (n + 7)) and (r.l, r.r) == (n + 1, n + 7)


def test_edges(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert got(empty) == [] and got(spark.createDataFrame([("en", None), (None, ""), ("en", ".,;\t ")], "lang string, text string")) == []
    long = [("en", "one two three " * 60_000)]
    assert got(spark.createDataFrame(long, "lang string, text string")) == plain(long, 10, 3, 50, 2000)
