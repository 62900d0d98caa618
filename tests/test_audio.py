import numpy as np
import pytest

from utterlake.functions.store import written
from utterlake.operators import audio

CHUNK = "recording_id long, chunk_idx long, sample_offset long, samples array<float>"


def loud(x, there, lo, hi, sr):
    """has_speech of samples lo to hi, straight from the samples that are there."""
    v = np.abs(x[max(lo, 0) : hi][there[max(lo, 0) : hi]].astype(float))
    return bool(len(v) >= sr // 4 and np.sqrt((v * v).mean()) >= 0.003 and (v > 0.01).mean() > 0.05)


@pytest.fixture(scope="module")
def recordings(spark):
    """Three recordings in uneven chunks, the second with holes, the third with gaps that start in the middle of a block."""
    rng, rows, whole = np.random.default_rng(5), [], {}
    for rec, n in ((1, 9000), (2, 20011), (3, 700)):
        x = (rng.normal(size=n) * np.repeat(rng.choice([0.0, 0.002, 0.3], n // 50 + 1), 50)[:n]).astype(np.float32)
        there, at, k = np.ones(n, bool), 0, 0
        while at < n:
            size = int(rng.integers(1, 900))
            if rec > 1 and rng.random() < 0.2:
                there[at : at + size] = False
            else:
                rows.append((rec, k, at, x[at : at + size].tolist()))
            at, k = at + size, k + 1
        whole[rec] = (x, there)
    rows.append((3, 99, 0, []))
    return spark.createDataFrame(rows, CHUNK).repartition(5), whole


@pytest.mark.parametrize("block", [1, 7, 64, 100_000])
def test_ranges_like_brute_force(spark, recordings, block):
    chunks, whole = recordings
    sr, rng = 100, np.random.default_rng(block)
    ranges = [(int(r), float(a), float(a + d)) for r, a, d in zip(rng.integers(1, 5, 150), rng.uniform(0, 205, 150), rng.choice([0.0, 0.1, 0.5, 3.0, 60.0, 300.0], 150), strict=True)]
    ranges += [(2, 0.0, 1e4), (1, -3.0, 2.0), (1, 5.0, 4.0), (1, 0.0, 90.0)]
    df = spark.createDataFrame(ranges + ranges[:3], "recording_id long, start double, end double")
    got = audio.speech_in_range(df, chunks, sr=sr, block=block).collect()
    assert len(got) == len(ranges) + 3
    for r in got:
        x, there = whole.get(r.recording_id, (np.zeros(0), np.zeros(0, bool)))
        assert r.has_speech == loud(x, there, int(np.floor(r.start * sr)), int(np.floor(r.end * sr)), sr), r
    assert {r.has_speech for r in got} == {True, False}


def test_one_index_for_ranges_and_levels(spark, recordings):
    chunks, _ = recordings
    index = audio.energy_index(chunks, block=64)
    index = index._replace(nodes=written(index.nodes, "energy"))
    plain, told = (sorted(map(tuple, audio.signal_stats(chunks, 100, i).collect())) for i in (None, index))
    assert [r[0] for r in plain] == [r[0] for r in told] == [1, 2, 3] and np.allclose(plain, told, rtol=1e-12)
    assert "samples" not in audio.signal_stats(chunks, 100, index)._jdf.queryExecution().optimizedPlan().toString()
    ranges = spark.createDataFrame([(1, 0.0, 90.0), (2, 3.0, 3.1), (9, 0.0, 5.0)], "recording_id long, start double, end double")
    given, own = (sorted(map(tuple, audio.speech_in_range(ranges, chunks, sr=100, index=i).collect())) for i in (index, None))
    assert given == own


def test_ranges_above_the_highest_level(spark, recordings, monkeypatch):
    chunks, _ = recordings
    ranges = spark.createDataFrame([(1, 0.05, 89.0), (2, 3.0, 190.0), (3, 0.0, 7.0)], "recording_id long, start double, end double")
    told = lambda: sorted(map(tuple, audio.speech_in_range(ranges, chunks, sr=100, block=16).collect()))
    before = told()
    monkeypatch.setattr(audio, "TOP", 2)
    assert told() == before


def test_no_audio_and_no_ranges(spark):
    none = spark.createDataFrame([], CHUNK)
    ranges = spark.createDataFrame([(1, 0.0, 5.0), (None, 0.0, 5.0), (1, None, 5.0)], "recording_id long, start double, end double")
    assert [r.has_speech for r in audio.speech_in_range(ranges, none).collect()] == [False] * 3
    assert audio.speech_in_range(ranges.limit(0), none).isEmpty() and audio.signal_stats(none, index=audio.energy_index(none)).isEmpty()
