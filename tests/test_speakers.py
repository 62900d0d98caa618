"""Speakers: golden rows, and the helpers against a whole-recording model of our own."""

import random

import pytest

from utterlake.functions import text as T
from utterlake.operators import report, speakers
from utterlake.sources.derived import WORD

SEGMENT = f"recording_id long, seq long, start double, end double, text string, speaker string, is_placeholder boolean, words array<{WORD}>"


def words(*items):
    """(word, speaker, gap before) of half a second each."""
    at, out = 0.0, []
    for text, who, gap in items:
        at = round(at + gap, 2)
        out.append((text, at, round(at + 0.5, 2), 0.9, who))
        at = round(at + 0.5, 2)
    return out


def frame(spark, rows):
    return spark.createDataFrame([(1, i, *r) for i, r in enumerate(rows)], SEGMENT)


def one(spark, items):
    w = words(*items)
    return frame(spark, [(w[0][1], w[-1][2], " ".join(x[0] for x in w), "A", False, w)])


@pytest.mark.parametrize(
    ("middle", "before", "want"), [("стол", "это", "AAAAA"), ("да", "это", "AABAA"), ("стол", "это?", "AABAA")]
)
def test_middle_word(spark, middle, before, want):
    got = speakers.smooth_word_speakers(one(spark, [("вот", "A", 0), (before, "A", 0.1), (middle, "B", 0.1), ("тут", "A", 0.1), ("же", "A", 0.1)])).first()
    assert "".join(w.speaker for w in got.words) == want


def test_chain_of_flips(spark):
    items = [(f"слово{i}", s, 0.1) for i, s in enumerate("ABABA")]
    assert "".join(w.speaker for w in speakers.smooth_word_speakers(one(spark, items)).first().words) == "AAAAA"


def test_one_word_run_at_the_start(spark):
    got = speakers.split_by_speaker(one(spark, [("слово", "B", 0), ("вот", "A", 0.5), ("оно", "A", 0.1)])).orderBy("seq").collect()
    assert [(r.speaker, r.text, r.seq) for r in got] == [("B", "слово", 0), ("A", "вот оно", 1)]


def test_words_are_conserved(spark):
    r = random.Random(5)
    rows = [tuple((f"w{i}", r.choice(["A", "B", "C", None]), r.choice([0.1, 0.3, 0.5])) for i in range(r.randint(1, 12))) for _ in range(60)]
    w = [words(*x) for x in rows]
    df = frame(spark, [(x[0][1], x[-1][2], " ".join(y[0] for y in x), "A", False, x) for x in w])
    got = speakers.split_by_speaker(df).orderBy("seq").collect()
    assert [y.word for x in got for y in x.words] == [y[0] for x in w for y in x]
    assert [x.seq for x in got] == list(range(len(got)))


def test_short_segment(spark):
    rows = [(0.0, 2.0, "a b c d", "A", False, []), (2.4, 2.7, "слово", "B", False, []), (3.7, 6.0, "e f g h", "A", False, [])]
    got = speakers.merge_short_segments(frame(spark, rows)).orderBy("seq").collect()
    assert [x.speaker for x in got] == ["A", "A", "A"]


def answers(text):
    return text.lower().rstrip(".,!?") in T.RESPONSES


def whole(rows, min_dur=0.7, max_gap=0.45):
    """All passes over a whole recording."""
    who = [r[3] for r in rows]
    for _ in range(5):
        changed = False
        for i, (a, b, text, *_rest) in enumerate(rows):
            n = len(text.split())
            if b - a >= min_dur and n > 2 or n <= 2 and answers(text.split()[0] if n else ""):
                continue
            if 0 < i < len(rows) - 1 and who[i - 1] and who[i - 1] == who[i + 1] != who[i]:
                if a - rows[i - 1][1] <= max_gap or rows[i + 1][0] - b <= max_gap:
                    who[i], changed = who[i - 1], True
                    continue
            if n <= 1:
                if i and a - rows[i - 1][1] < 0.35:
                    who[i], changed = who[i - 1], True
                elif i < len(rows) - 1 and rows[i + 1][0] - b < 0.35:
                    who[i], changed = who[i + 1], True
        if not changed:
            break
    return who


def test_short_segments_like_the_whole_recording(spark):
    r = random.Random(7)
    for _ in range(6):
        at, rows = 0.0, []
        for _i in range(80):
            at = round(at + r.choice([0.1, 0.3, 0.4, 0.6]), 2)
            n, long = r.choice([0, 1, 1, 2, 3, 5]), r.choice([0.3, 0.5, 1.0])
            text = " ".join(r.choice(["да", "слово", "ну", "дом", "там"]) for _ in range(n))
            rows.append((at, round(at + long, 2), text, r.choice(["A", "B", None]), False, []))
            at = round(at + long, 2)
        got = [x.speaker for x in speakers.merge_short_segments(frame(spark, rows)).orderBy("seq").collect()]
        assert got == whole(rows)


def test_labels(spark):
    rows = [(0.0, 1.0, "a", "SPEAKER_01", False, []), (1.0, 2.0, "b", None, False, []), (2.0, 3.0, "c", "SPEAKER_00", False, [])]
    got = report.speaker_labels(frame(spark, rows)).orderBy("seq").collect()
    assert [x.label for x in got] == ["Спикер 1", "Спикер ?", "Спикер 2"]


@pytest.mark.parametrize(
    ("second", "n"),
    [((4.5, 5.0, "b"), 1), ((4.6, 5.0, "b"), 2), ((2.0, 45.0, "b"), 1), ((2.0, 45.1, "b"), 2), ((2.0, 3.0, "b" * 449), 1), ((2.0, 3.0, "b" * 450), 2)],
)
def test_paragraph_limits(spark, second, n):
    rows = [(0.0, 2.0, "a", "S", False, []), (*second, "S", False, [])]
    assert report.paragraphs(frame(spark, rows)).count() == n


def test_overlap_ties_take_the_smaller_name(spark):
    w = [("w", 0.0, 2.0, 0.9, None)]
    turns = spark.createDataFrame([(1, 0.0, 1.0, "B"), (1, 1.0, 2.0, "A")], "recording_id long, start double, end double, speaker string")
    got = speakers.assign_speakers(frame(spark, [(0.0, 2.0, "w", None, False, w)]), turns).first()
    assert got.speaker == "A" and got.words[0].speaker == "A"


def test_placeholders_keep_their_place(spark):
    w = words(("вот", "A", 0), ("оно", "A", 0.1))
    rows = [(0.0, 1.2, "вот оно что тут", None, False, w), (1.2, 3.0, "[неразборчиво — 1.8с]", "UNKNOWN", True, []), (3.0, 3.2, "дом", None, False, [("дом", 3.0, 3.2, 0.9, None)])]
    turns = spark.createDataFrame([(1, 0.0, 2.0, "A"), (1, 2.5, 4.0, "B")], "recording_id long, start double, end double, speaker string")
    got = speakers.speaker_pipeline(frame(spark, rows), turns).orderBy("seq").collect()
    assert [(r.seq, r.speaker, bool(r.is_placeholder)) for r in got] == [(0, "A", False), (1, "UNKNOWN", True), (2, "B", False)]
    assert speakers.speaker_count(spark.createDataFrame(got, SEGMENT)).first().n_speakers == 2
