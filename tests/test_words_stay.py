"""What the work on words costs: the queries don't write them, and the helpers take all rows of a batch at once."""

import random

import numpy as np
import pyarrow as pa
import pytest

from utterlake.functions import text as T
from utterlake.jobs import queries
from utterlake.operators import intervals, speakers

LINES = ["one two three four five", "six seven? eight", "nine", "один два три да четыре пять", "", "ten eleven twelve thirteen fourteen"]
WORDY = ("assign_word_speakers", "split_by_speaker", "words_hit_by_ranges", "merge_placeholders", "reunite_placeholders")


@pytest.mark.parametrize("name", WORDY)
def test_words_are_not_written(spark, tmp_path, monkeypatch, name):
    spark.createDataFrame([(i, "\n".join(LINES[i % 3 :])) for i in (8, 9)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    kept, store = {}, queries.written

    def watched(df, table):
        kept[table] = df.columns
        return store(df, table)

    for module in (queries, queries.clean, queries.intervals, queries.speakers):
        monkeypatch.setattr(module, "written", watched)
    queries.QUERIES[name](spark, str(tmp_path))
    assert kept and not [t for t, columns in kept.items() if "words" in columns]


def test_texts_without_cyrillic_letters_are_not_searched_for_them(spark):
    need = [p for p in T.HALLUCINATIONS if T.needs_cyrillic(p)]
    assert len(need) == 28 and not any(map(T.needs_cyrillic, ["DimaTorzok", "а|b", "а?b", "(а)?b", "[аb]c", r"^\.+$", "♪"]))
    texts = ["Спасибо за просмотр", "ᲃпасибо за просмотр", "СПАСИБО ЗА ВНИМАНИЕ!", "gracias por ver — señor", "dimatorzok", "DIMATORZOK", "...", " ♪ la", "Музыка", "ok", "", None, "урок"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    stripped = T.strip(queries.F.coalesce("t", queries.F.lit("")))
    rows = df.select(T.is_hallucination(df.t).alias("a"), ((stripped == "") | stripped.rlike(T.any_of(T.HALLUCINATIONS))).alias("b")).collect()
    assert [r.a for r in rows] == [r.b for r in rows] and 6 < sum(r.a for r in rows) < 12


def test_answers_like_the_column_expression(spark):
    said = ["да", "Да!", " угу ", "стол", "это?", "нет.,", None, "ДА", "это? ", "три", "", " ну "]
    w = [random.Random(3).choice(said) for _ in range(300)]
    df = spark.createDataFrame([(i, x, w[i - 1] if i % 7 else None) for i, x in enumerate(w)], "i int, w string, b string")
    want = [r.a for r in df.select("i", T.is_response_word(df.w, df.b).alias("a")).orderBy("i").collect()]
    first = np.arange(300) % 7 == 0
    assert speakers.response_words(pa.array(w), first).tolist() == want


def test_rows_at_once_like_rows_alone():
    rng = np.random.default_rng(5)
    n, m = rng.integers(0, 9, 60), rng.integers(0, 6, 60)
    row, of = np.repeat(np.arange(60), n), np.repeat(np.arange(60), m)
    a, c = rng.integers(0, 40, len(row)), rng.integers(0, 40, len(of))
    b, d, code = a + rng.integers(0, 9, len(a)), c + rng.integers(1, 9, len(c)), rng.integers(0, 4, len(c))
    got, hit = intervals.best_codes(a, b, row, c, d, code, of), intervals.hits(a / 1.0, b / 1.0, row, c / 1.0, d / 1.0, of)
    far = intervals.best_codes(a * 10**16, b * 10**16, row, c * 10**16, d * 10**16, code, of)  # centuries: by halves
    for i, r in enumerate(row):
        own = of == r
        sums = [np.maximum(0, np.minimum(b[i], d[own]) - np.maximum(a[i], c[own]))[code[own] == k].sum() for k in range(4)]
        assert got[i] == far[i] == (int(np.argmax(sums)) if max(sums) else -1)
        assert hit[i] == bool(((a[i] < d[own]) & (b[i] > c[own])).any())


def test_smoothing_many_rows_like_each_alone():
    rng = np.random.default_rng(8)
    rows = []
    for n in rng.integers(2, 12, 80):
        rows.append((rng.choice([0.1, 0.3, 0.5], n - 1), rng.integers(0, 3, n), rng.random(n) < 0.1))
    who, answers = np.concatenate([r[1] for r in rows]), np.concatenate([r[2] for r in rows])
    gap = np.concatenate([np.append(r[0], 0.0) for r in rows])[:-1]
    first = np.concatenate([np.arange(len(r[1])) == 0 for r in rows])
    last = np.append(first[1:], True)
    smooth = speakers.smoothed(gap, who, answers, first, last)
    begins, names = speakers.runs_of(gap, smooth, answers, first)
    at = 0
    for g, w, ans in rows:
        f = np.arange(len(w)) == 0
        alone = speakers.smoothed(g, w, ans, f, f[::-1])
        assert smooth[at : at + len(w)].tolist() == alone.tolist()
        b, s = speakers.runs_of(g, alone, ans, f)
        own = (begins >= at) & (begins < at + len(w))
        assert (begins[own] - at).tolist() == b.tolist() and names[own].tolist() == s.tolist() and b[0] == 0
        at += len(w)
