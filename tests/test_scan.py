"""Prefix scans over bins: the same as one window over each recording, on a thousand random tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from utterlake.functions import scan
from utterlake.operators import clean, intervals, report


def whole():
    return W.partitionBy("recording_id").orderBy("seq")


@pytest.fixture(scope="module")
def table(spark):
    """A thousand recordings (one without an id) of 0 to 25 rows: ties and gaps in seq, equal starts, null labels."""
    rng = np.random.default_rng(11)
    rows = []
    for i in range(1000):
        n, start = int(rng.integers(0, 26)), 0.0
        for seq in np.cumsum(rng.integers(1, 4, n)).tolist():
            start += float(rng.integers(0, 30)) / 10
            rows.append((None if i == 3 else i, seq, start, start + float(rng.integers(0, 40)) / 10, (None, "a", "b", "b", "b")[rng.integers(5)], bool(rng.integers(3) > 0), float(rng.integers(0, 10)) / 10))
    df = spark.createDataFrame(rows, "recording_id long, seq long, start double, end double, label string, kept boolean, score double")
    return df.repartition(3).cache()


@pytest.fixture(params=[3, 4096])
def size(request, monkeypatch):
    monkeypatch.setattr(scan, "SEQ_BIN", request.param)
    monkeypatch.setattr(scan, "SEC_BIN", float(request.param))
    return request.param


def same(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    rows = lambda df: sorted(map(repr, df.select(*columns).collect()))
    assert rows(a) == rows(b)


def test_running_sum_and_greatest(table, size):
    same(scan.running_sum(table, F.col("seq"), ["seq"], "x"), table.withColumn("x", F.sum("seq").over(whole().rowsBetween(W.unboundedPreceding, 0))))
    same(scan.greatest_before(table, F.col("end"), ["seq"], "x"), table.withColumn("x", F.max("end").over(whole().rowsBetween(W.unboundedPreceding, -1))))


def test_numbered_runs(table, size):
    new = F.when((F.lag("label").over(whole()) == F.col("label")) & (F.col("start") - F.lag("end").over(whole()) <= 1), 0).otherwise(1)
    plain = table.withColumn("new", new).withColumn("x", F.sum("new").over(whole().rowsBetween(W.unboundedPreceding, 0)).cast("long") - 1).drop("new")
    same(scan.numbered_runs(table, ["label", "start", "end"], lambda a, b: ~((a["label"] == b["label"]) & (b["start"] - a["end"] <= 1)), ["seq"], "x"), plain)


def test_renumber(table, size):
    t = table.withColumn("source", F.col("seq") % 2)
    plain = t.withColumn("seq", (F.row_number().over(W.partitionBy("recording_id").orderBy("start", "source", "end", "label", "kept", "score")) - 1).cast("long"))
    same(intervals.renumber(t, "start", "source", "end", "label", "kept", "score").drop("source"), plain.drop("source"))


def test_speaker_blocks(table, size):
    plain = table.withColumn("n", F.when(F.lag("label").over(whole()) == F.col("label"), 0).otherwise(1))
    same(report.speaker_blocks(table), plain.withColumn("block_id", F.sum("n").over(whole().rowsBetween(W.unboundedPreceding, 0)) - 1).drop("n"))


def test_merge_zones(table, size):
    z = table.select("recording_id", F.struct(F.lit(0).alias("k"), "seq").alias("ord"), "start", "end", F.coalesce("label", F.lit("x")).alias("reason"))
    w = W.partitionBy("recording_id").orderBy("start", "ord")
    p = z.withColumn("new", F.when(F.col("start") <= F.max("end").over(w.rowsBetween(W.unboundedPreceding, -1)) + 1.0, 0).otherwise(1))
    p = p.withColumn("zone_id", F.sum("new").over(w.rowsBetween(W.unboundedPreceding, 0)) - 1)
    told = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "ord", "reason"))), lambda x: x["reason"]), "+")
    same(intervals.merge_zones(z), p.groupBy("recording_id", "zone_id").agg(F.min("start").alias("start"), F.max("end").alias("end"), told.alias("reason")))


def test_all_zones_like_a_loop(table, size):
    rows = table.withColumns({"first_score": F.col("score"), "last_score": 1 - F.col("score"), "zone_reason": F.when(F.col("label") == "a", "low")})
    durations = table.groupBy("recording_id").agg((F.max("end") + 4).alias("duration")).filter("recording_id is not null")
    length = {r.recording_id: r.duration for r in durations.collect()}
    want, by = [], {}
    for r in rows.collect():
        by.setdefault(r.recording_id, []).append(r)
    for i, own in by.items():
        own.sort(key=lambda r: r.seq)
        kept = [r for r in own if r.kept]
        want += [(i, 0, r.seq, r.start, r.end, "low", False) for r in own if r.zone_reason]
        for a, b in zip(kept, kept[1:]):
            gap = b.start - a.end
            if 0.5 < gap < 3.0 and (a.last_score < 0.5 or b.first_score < 0.5):
                want.append((i, 1, a.seq, a.end - 1.0, b.start + 1.0, "chunk_boundary", False))
            if 3.0 < gap < 60.0:
                want.append((i, 1, a.seq, a.end, b.start, "large_gap_with_speech", True))
        if kept and 3.0 < kept[0].start < 120.0:
            want.append((i, 2, 0, 0.0, kept[0].start, "missing_start", True))
        if kept and i in length and 3.0 < length[i] - kept[-1].end < 120.0:
            want.append((i, 3, 0, kept[-1].end, length[i], "missing_end", True))
    got = [(r.recording_id, r.ord.k, r.ord.seq, r.start, r.end, r.reason, r.ask) for r in clean.all_zones(rows, durations).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_paragraphs_like_a_loop(spark, table, size):
    segments = table.select("recording_id", "seq", "start", "end", F.col("label").alias("speaker"), F.lit(False).alias("is_placeholder"), F.when(F.col("score") > 0.1, F.repeat(F.lit("ab "), (F.col("score") * 20).cast("int"))).otherwise(" ").alias("text"))
    want, by = [], {}
    for r in segments.collect():
        if r.text.strip() and r.recording_id is not None:
            by.setdefault(r.recording_id, []).append(r)
    for i, own in by.items():
        names, block, par, last = {}, -1, -1, None
        for r in sorted(own, key=lambda r: r.seq):
            label = f"Спикер {names.setdefault(r.speaker, len(names) + 1)}" if r.speaker else "Спикер ?"
            text, end = r.text.strip(), r.end or r.start
            if last is None or last[0] != label:
                block += 1
            if last is None or last[0] != label or r.start - last[1] > 0.8 or end - begin > 6.0 or len(said) + len(text) > 60:
                par, begin, said = par + 1, r.start, text
                want.append([i, block, par, label, begin, said])
            else:
                said += " " + text
                want[-1][5] = said
                # a joining space counts from the second text on
            last = (label, end)
    got = [list(r) for r in report.paragraphs(segments, 0.8, 6.0, 60).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_one_endless_recording_uses_all_tasks(spark):
    rows = spark.range(400_000).select(F.lit(1).cast("long").alias("recording_id"), F.col("id").alias("seq"), (F.col("id") * 1.5).alias("start"), (F.col("id") * 1.5 + 1).alias("end"), F.floor(F.col("id") / 7).cast("string").alias("label"))
    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for out, name, last in ((report.speaker_blocks(rows), "block_id", 399_999 // 7), (intervals.renumber(rows.drop("seq"), "start"), "seq", 399_999)):
            parts = out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.max(name).alias("m")).collect()
            assert len(parts) == 4 and max(r.n for r in parts) < 200_000 and max(r.m for r in parts) == last
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)


@pytest.mark.parametrize("margin", [0.0, 0.4])
def test_meeting_pairs_like_a_loop(spark, margin):
    rng = np.random.default_rng(5)

    def some(n, longest):
        rows = []
        for i in range(n):
            a = round(float(rng.uniform(-50, 400)), 1)
            rows.append((int(rng.integers(2)), i, a, round(a + float(rng.choice([0, 0.5, -0.3, rng.uniform(0, longest)])), 1)))
        return rows

    left, right = some(150, 300), some(150, 2000)
    frame = lambda rows, name: spark.createDataFrame(rows, f"recording_id int, {name} int, start double, end double")
    got = intervals.meeting_pairs(frame(left, "x"), frame(right, "y"), 10.0, margin).select("recording_id", "x", "o_y").collect()
    touch = lambda a, b, c, d: max(min(a, b), min(c, d)) <= min(max(a, b), max(c, d))
    want = [(r, x, y) for r, x, a, b in left for q, y, c, d in right if r == q and touch(a, b, c - margin, d + margin)]
    assert sorted(map(tuple, got)) == sorted(want) and len(want) > 1000


def test_rows_of_a_cover(spark):
    """At most two nodes of a level, apart from each other, together the bins: 360,000 bins are some thirty rows."""
    rng = np.random.default_rng(6)
    spans = [(int(a), int(a + n)) for a in rng.integers(-1000, 1000, 40) for n in rng.integers(0, 70, 3)] + [(7, 360_006), (0, 2**40)]
    for r in spark.createDataFrame(spans, "a long, b long").select("a", "b", intervals.cover(F.col("a"), F.col("b")).alias("c")).collect():
        parts = sorted((n["at"] << n["level"], (n["at"] + 1) << n["level"]) for n in r.c)
        assert parts[0][0] == r.a and parts[-1][1] == r.b + 1 and all(p[1] == q[0] for p, q in zip(parts, parts[1:]))
        assert len(parts) <= max(2, 2 * np.log2(r.b - r.a + 1))


def test_words_against_ranges_of_one_row_are_fast():
    import time

    rng = np.random.default_rng(7)
    start = np.sort(rng.uniform(0, 20_000, 50_000))
    end, r_start = start + 0.3, rng.uniform(0, 20_000, 5000)
    r_end = r_start + rng.uniform(0, 3, 5000)
    began = time.time()
    hits = set(intervals.hit_by(start, end, r_start, r_end).tolist())
    who = np.array(["a", "b", "c"], object)[rng.integers(3, size=5000)]
    whole = intervals.whole_micros
    best = intervals.best_speakers(whole(start), whole(end), whole(r_start), whole(r_end), who)
    assert time.time() - began < 1
    for i in rng.integers(0, 50_000, 300):
        assert (i in hits) == bool(((start[i] < r_end) & (end[i] > r_start)).any())
        shared = np.maximum(0, np.minimum(whole(end[i]), whole(r_end)) - np.maximum(whole(start[i]), whole(r_start)))
        sums = {name: shared[who == name].sum() for name in "abc"}
        most = max(sums.values())
        assert best[i] == (min(n for n, v in sums.items() if v == most) if most else None)
