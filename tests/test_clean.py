"""Golden rows for clean-up, zones and the merge of both passes."""

import pytest

from utterlake.functions import text as T
from utterlake.operators import audio, clean, intervals, validate
from utterlake.sources.derived import WORD

SEGMENT = f"recording_id long, seq long, start double, end double, text string, avg_logprob double, no_speech_prob double, speaker string, is_placeholder boolean, words array<{WORD}>"


def segments(spark, rows):
    """rows: (start, end, text[, words])"""
    out = [(1, i, float(r[0]), float(r[1]), r[2], 0.0, 0.0, None, False, r[3] if len(r) > 3 else []) for i, r in enumerate(rows)]
    return spark.createDataFrame(out, SEGMENT)


def kept(spark, rows):
    got = clean.suppress_repeats(segments(spark, rows)).filter("not is_repeat").orderBy("seq").collect()
    return [r.start for r in got]


def test_loop_of_a_short_text(spark):
    assert kept(spark, [(0, 1, "угу"), (5, 6, "Угу"), (10, 11, "угу")]) == [0, 10]
    assert kept(spark, [(0, 1, "угу"), (6, 7, "угу")]) == [0]


def test_long_repeat(spark):
    t = "a" * 20
    assert kept(spark, [(0, 1, t), (60, 61, t), (95, 96, t)]) == [0, 95]


def repeats(rows):
    """Brute force: every row looks at all kept ones that no row in between lay too far behind."""
    kept, out = [], []
    reach = lambda i: 6 if len(rows[i][2]) <= 15 else 90
    for i, (start, _, text) in enumerate(rows):
        live = [k for k in kept if all(rows[j][0] - rows[k][0] <= reach(k) for j in range(k + 1, i + 1)) and start - rows[k][0] <= reach(i)]
        hit = any(rows[k][2] == text or (min(len(text), len(rows[k][2])) > 15 and (text in rows[k][2] or rows[k][2] in text)
                  and min(len(text), len(rows[k][2])) > 0.8 * max(len(text), len(rows[k][2]))) for k in live)
        if not hit:
            kept.append(i)
            out.append(start)
    return out


def test_starts_that_go_back(spark):
    long = "a rather long sentence"
    rows = [(0, 1, long), (10, 11, "да"), (100, 101, "нет"), (5, 6, long), (12, 13, "да"), (4, 5, "да"), (6, 7, long + " ok")]
    assert kept(spark, rows) == repeats(rows) == [0, 10, 100, 5, 12]
    random = __import__("random").Random(5)
    for _ in range(3):
        rows = [(random.randrange(0, 200), 0, random.choice(["да", "нет", long, long + " ok", "another sentence of words"])) for _ in range(60)]
        assert kept(spark, rows) == repeats(rows)


def test_violations(spark):
    rows = [(1, 0, 0.0, 1.0), (1, 1, 5.0, 4.0), (1, 2, None, 6.0), (1, 3, 2.0, 3.0), (1, 3, 2.5, 3.0), (2, 0, 0.0, 0.0)]
    got = validate.violations(spark.createDataFrame(rows, "recording_id long, seq long, start double, end double"))
    assert sorted((r.seq, r.rule) for r in got.collect()) == [(1, "ends_early"), (2, "no_time"), (3, "goes_back"), (3, "repeated_seq")]
    assert validate.violations(spark.createDataFrame([], "recording_id long, seq long, start double, end double")).isEmpty()


@pytest.mark.parametrize(("a", "b", "n"), [(20, 24, 1), (16, 20, 2)])
def test_near_duplicate(spark, a, b, n):
    assert len(kept(spark, [(0, 1, "x" * a), (2, 3, "x" * a + "y" * (b - a))])) == n


def test_short_text_between_long_ones_does_not_matter(spark):
    t = "the same long sentence"
    assert kept(spark, [(0, 1, t), (1, 2, "да"), (2, 3, t), (2.5, 2.6, "да")]) == [0, 1]


@pytest.mark.parametrize(
    ("text", "hit"),
    [("УЧИТЕЛЬ и ученики обсуждают", True), ("[музыка]", True), ("Музыка", True), ("...", True), ("музыка играет", False), (None, True), ("  ", True)],
)
def test_patterns(spark, text, hit):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(T.is_hallucination(df.t)).first()[0] is hit


def word(at, score, text="w", end=None, speaker=None):
    return (text, at, end if end is not None else at + 0.1, score, speaker)


def test_low_confidence_words(spark):
    s = segments(spark, [(0, 1, "a b c", [word(0.0, 0.4)] * 3), (2, 3, "a b", [word(0.0, 0.4)] * 2)])
    got = s.select("seq", T.low_confidence_flag(s.avg_logprob, s.words).alias("f")).orderBy("seq").collect()
    assert [r.f for r in got] == ["low_confidence", None]


@pytest.mark.parametrize(("gap", "reason"), [(0.5, None), (0.6, "chunk_boundary"), (3.0, None), (3.1, "large_gap_with_speech"), (60.0, None)])
def test_gap_limits(spark, gap, reason):
    s = segments(spark, [(0.0, 0.0, "a"), (gap, gap + 1, "b", [word(gap, 0.4)])])
    got = clean.segment_gaps(s).collect()
    assert [r.reason for r in got] == ([reason] if reason else [])


def test_zone_merge(spark):
    z = spark.createDataFrame([(1, 0, 0.0, 5.0, "a"), (1, 1, 6.0, 7.0, "b"), (1, 2, 8.1, 9.0, "c")], "recording_id long, ord int, start double, end double, reason string")
    got = intervals.merge_zones(z).orderBy("start").collect()
    assert [(r.start, r.end, r.reason) for r in got] == [(0, 7, "a+b"), (8.1, 9, "c")]


@pytest.mark.parametrize(("a", "b", "texts"), [(1.3, 1.5, ["new", "three"]), (1.45, 1.55, ["one", "new", "three"])])
def test_pass2_merge(spark, a, b, texts):
    words = [word(0.0, 0.9, "one", 1.0), word(1.0, 0.9, "two", 2.0), word(2.0, 0.9, "three", 3.0)]
    s = segments(spark, [(0, 3, "one two three", words)])
    r = spark.createDataFrame([(1, a, b, "new")], "recording_id long, start double, end double, text string")
    got = clean.merge_pass2(s, r).orderBy("seq").collect()
    assert [x.text for x in got] == texts and [x.seq for x in got] == list(range(len(texts)))


def test_pass2_merge_keeps_other_recordings(spark):
    s = segments(spark, [(0, 3, "one")])
    r = spark.createDataFrame([(2, 0.0, 1.0, "new")], "recording_id long, start double, end double, text string")
    assert sorted((x.recording_id, x.text) for x in clean.merge_pass2(s, r).collect()) == [(1, "one"), (2, "new")]


def test_detect_on_empty_table(spark):
    parts = clean.detect_problem_zones(segments(spark, []))
    assert [p.count() for p in parts] == [0, 0, 0]


def test_pass2_log_and_counts(spark):
    zones = spark.createDataFrame([(1, i, 10.0 * i, 10.0 * i + 1) for i in range(4)] + [(2, 0, 0.0, 0.1)], "recording_id long, zone_id long, start double, end double")
    recordings = spark.createDataFrame([(1, 60.0), (2, 0.2)], "recording_id long, duration double")
    error = "out of memory " + "x" * 60
    rows = [(1, 0, "hello there", None), (1, 1, "good words", None), (1, 1, None, error), (1, 2, "...", None)]
    candidates = spark.createDataFrame([(r, z, 0.0, 1.0, t, -0.1, 0.1, e) for r, z, t, e in rows], "recording_id long, zone_id long, rel_start double, rel_end double, text string, avg_logprob double, no_speech_prob double, error string")
    windows = clean.plan_pass2_windows(zones, recordings)
    good = clean.recover(candidates, windows)
    log = clean.pass2_log(zones, good, candidates, windows)
    got = {(r.recording_id, r.zone_id): (r.status, r.n) for r in log.collect()}
    silence = ("unrecognized_silence", 0)
    assert got == {(1, 0): ("recovered", 1), (1, 1): ("error: " + error[:50], 0), (1, 2): silence, (1, 3): silence}
    merged = spark.createDataFrame([(1, True), (1, None), (1, False), (3, True)], "recording_id long, is_placeholder boolean")
    counts = clean.pass2_counts(log, merged, merged.union(merged))
    assert sorted(map(tuple, counts.collect())) == [(1, 1, 3, 1, 1, 3, 6), (3, 0, 0, 0, 1, 1, 2)]


def test_gaps_with_and_without_speech(spark):
    c = segments(spark, [(10, 12, "a"), (20, 22, "b"), (40, 42, "c")])
    recordings = spark.createDataFrame([(1, 60.0)], "recording_id long, duration double")
    ranges = clean.gap_ranges(c, recordings)
    found = [(0.0, 10.0), (12.0, 20.0), (22.0, 40.0), (42.0, 60.0)]
    assert sorted((r.start, r.end) for r in ranges.collect()) == found
    x = [0.5 if 14 <= t / 16 < 18 or t / 16 >= 50 else 0.0 for t in range(960)]
    chunks = spark.createDataFrame([(1, k, 64 * k, x[64 * k : 64 * k + 64]) for k in range(15)], "recording_id long, chunk_idx long, sample_offset long, samples array<double>")
    speech = audio.speech_in_range(ranges, chunks, sr=16)
    assert [(r.start, r.end) for r in clean.segment_gaps(c, speech).collect()] == found[1:2]
    assert [(r.start, r.end, r.reason) for r in clean.edge_gaps(c, recordings, speech).collect()] == [(*found[3], "missing_end")]


def test_chunks_of_any_size(spark):
    """A second of sound in a minute of silence, in chunks of 16,000 samples and in uneven ones."""
    ranges = spark.createDataFrame([(1, 0.0, 5.0), (1, 9.5, 20.0), (1, 30.0, 60.0), (2, 0.0, 5.0)], "recording_id long, start double, end double")
    x = [0.4 if 10 <= t / 1000 < 11 else 0.0 for t in range(60000)]
    for sizes in ([16000] * 4, [1, 15000, 7000, 38000]):
        at = [sum(sizes[:i]) for i in range(len(sizes))]
        rows = [(1, i, a, x[a : a + n]) for i, (a, n) in enumerate(zip(at, sizes, strict=True))]
        chunks = spark.createDataFrame(rows, "recording_id long, chunk_idx long, sample_offset long, samples array<double>")
        for block in (None, 7000):
            got = audio.speech_in_range(ranges, chunks, sr=1000, block=block).collect()
            assert sorted((r.recording_id, r.start, r.has_speech) for r in got) == [(1, 0.0, False), (1, 9.5, True), (1, 30.0, False), (2, 0.0, False)]


def test_guarded_alternation_finds_what_the_patterns_find(spark):
    texts = ["Спасибо за внимание!", "и СПАСИБО ЗА ПРОСМОТР", "dimatorzok", "они решают", "[Смех]", "смех", "♪ la", "a ♪", "- - -", "урок идёт", "Онлайн урок с репетитором", "x" * 50]
    plain = "(?iuUd)" + "|".join(f"(?:{p})" for p in T.HALLUCINATIONS)
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert all(r.a == r.b for r in df.selectExpr("t").select(df.t.rlike(plain).alias("a"), df.t.rlike(T.any_of(T.HALLUCINATIONS)).alias("b")).collect())
    odd = ("x?abc", "a|zz", "[^a]q", "(b|c)d", r"\d+e")
    plain = "(?iuUd)" + "|".join(f"(?:{p})" for p in odd)
    df = spark.createDataFrame([(t,) for t in ("bc abc", "zz", "1e", "BD", "q", "aq", "")], "t string")
    assert all(r.a == r.b for r in df.select(df.t.rlike(plain).alias("a"), df.t.rlike(T.any_of(odd)).alias("b")).collect())


def test_pass2_log_has_no_negative_zero(spark):
    zones = spark.createDataFrame([(1, 0, -0.04, 3.25), (1, 1, -0.06, 0.04)], "recording_id long, zone_id long, start double, end double")
    log = clean.pass2_log(zones, zones.limit(0))
    assert [r.zone for r in log.sort("zone_id").collect()] == ["0.0-3.3", "-0.1-0.0"]


def test_pass2_results_have_no_negative_zero(spark):
    """The log of a second pass with candidates and windows."""
    zones = spark.createDataFrame([(1, 0, -0.04, 3.25)], "recording_id long, zone_id long, start double, end double")
    tried = spark.createDataFrame([(1, 0, "out of memory")], "recording_id long, zone_id long, error string")
    log = clean.pass2_log(zones, zones.limit(0), tried, zones)
    assert [(r.zone, r.status) for r in log.collect()] == [("0.0-3.3", "error: out of memory")]


def test_verdicts_without_texts(spark):
    """What only zones and kept rows are taken from has no texts, and else the same rows."""
    s = segments(spark, [(0, 3, "one long enough to be kept"), (3, 6, "..."), (6, 9, "One long enough to be kept"), (20, 22, "two")])
    told, bare = clean.verdicts(s), clean.verdicts(s, texts=False)
    assert bare.columns == [c for c in told.columns if c != "text"]
    assert sorted(bare.collect()) == sorted(told.drop("text").collect())
    assert {r.removed for r in bare.collect()} == {None, "hallucination", "duplicate"}
