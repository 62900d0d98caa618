"""Stage files, the ledger, the queue and the stream."""

import collections
import json
import random

import pytest

from utterlake.jobs import batch, clean_up, queries, second_pass, validate
from utterlake.operators import worklist
from utterlake.sources import derived, files
from utterlake.streaming.ingest import Intake, incremental_ingest, read_quarantine


def stage_file(path, texts):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps({"segments": [{"start": float(i), "end": i + 1.0, "text": t} for i, t in enumerate(texts)], "n_raw": 2, "version": "6"}))


def test_stage_json(spark, tmp_path):
    stage_file(tmp_path / "_a_ckpt" / "s2.json", ["x", "y"])
    (tmp_path / "_b_ckpt").mkdir()
    (tmp_path / "_b_ckpt" / "s2.json").write_text("{not json")
    got = files.read_stage_json(spark, f"{tmp_path}/_*_ckpt/s2.json", 2).orderBy("seq").collect()
    assert [(r.seq, r.text, r.avg_logprob, r.version) for r in got] == [(0, "x", 0.0, "6"), (1, "y", 0.0, "6")]


def test_write_stage_keeps_other_stages(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "recording_id long")
    for stage in (2, 3, 3):
        files.write_stage(df, f"{tmp_path}/out", stage, "1")
    assert sorted(r.stage for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [2, 3]


def test_ledger(spark, tmp_path):
    path = f"{tmp_path}/ledger"
    assert files.read_ledger(spark, path).count() == 0
    files.append_ledger(spark.createDataFrame([("/a", "/z.zip"), ("/b", None)], "path string, from_zip string"), path)
    assert sorted(r.key for r in files.read_ledger(spark, path).collect()) == ["/a", "/b", "/z.zip"]


def test_listing(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.mp4").write_bytes(b"123")
    got = files.list_media_files(spark, str(tmp_path)).first()
    assert (got.path, got.name, got["size"]) == (f"{tmp_path}/d/a.mp4", "a.mp4", 3)


def ingest(spark, tmp_path, checkpoint="ckpt", out=True):
    job = lambda s: s.filter("text <> 'noise'").select("recording_id", "seq", "text")
    incremental_ingest(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/ledger", f"{tmp_path}/{checkpoint}", job).awaitTermination()
    return out and sorted(r.text for r in spark.read.parquet(f"{tmp_path}/out").collect())


def test_ingest_takes_each_file_once(spark, tmp_path):
    stage_file(tmp_path / "in" / "a.json", ["x"])
    assert ingest(spark, tmp_path) == ["x"]
    assert ingest(spark, tmp_path) == ["x"]
    stage_file(tmp_path / "in" / "b.json", ["y"])
    assert ingest(spark, tmp_path) == ["x", "y"]


def test_replayed_batch_writes_the_same_rows(spark, tmp_path):
    stage_file(tmp_path / "in" / "a.json", ["x"])
    assert ingest(spark, tmp_path) == ["x"]
    for f in (tmp_path / "ckpt" / "commits").iterdir():  # as if the run had been lost after the ledger, before the commit
        if f.name.strip(".").split(".")[0] == "0":
            f.unlink()
    assert ingest(spark, tmp_path) == ["x"]
    assert ingest(spark, tmp_path) == ["x"]
    assert files.read_ledger(spark, f"{tmp_path}/ledger").count() == 1


def test_new_checkpoint_keeps_what_is_done(spark, tmp_path):
    stage_file(tmp_path / "in" / "a.json", ["x"])
    assert ingest(spark, tmp_path) == ["x"]
    stage_file(tmp_path / "in" / "b.json", ["y"])
    assert ingest(spark, tmp_path, "other") == ["x", "y"]


def test_files_without_rows_enter_the_ledger(spark, tmp_path):
    stage_file(tmp_path / "in" / "a.json", ["x"])
    stage_file(tmp_path / "in" / "empty.json", [])
    stage_file(tmp_path / "in" / "noise.json", ["noise"])
    (tmp_path / "in" / "bad.json").write_text("{not json")
    assert ingest(spark, tmp_path) == ["x"]
    names = sorted(r.key.rsplit("/", 1)[1] for r in files.read_ledger(spark, f"{tmp_path}/ledger").collect())
    assert names == ["a.json", "empty.json", "noise.json"]


def test_transcripts_and_audio(spark, tmp_path):
    lines = spark.createDataFrame([(1, 1, "A:"), (1, 0, "rec1.mp4"), (1, 2, "00:00:01 - x"), (2, 0, "rec2.mp4")], "recording_id long, line_no long, line string")
    files.write_transcript(lines, f"{tmp_path}/t", 4)
    got = {r.recording_id: r.text for r in spark.read.parquet(f"{tmp_path}/t").collect()}
    assert got == {1: "rec1.mp4\nA:\n00:00:01 - x", 2: "rec2.mp4"}
    chunks = [(1, 0, 0, [0.5] * 16000), (1, 1, 16000, [0.5] * 8000), (2, 0, 0, [0.1])]
    spark.createDataFrame(chunks, "recording_id long, chunk_idx long, sample_offset long, samples array<float>").write.parquet(f"{tmp_path}/a")
    long = {r.recording_id: r.duration for r in files.audio_durations(files.read_audio_chunks(spark, f"{tmp_path}/a")).collect()}
    assert long == {1: 1.5, 2: 1 / 16000}


def test_unique_names(spark):
    rows = [("a.mp4", "/1/a.mp4"), ("a.mp4", "/2/a.mp4"), ("a.mp4", "/3/a.mp4"), ("a_1.mp4", "/4/a_1.mp4"), ("b", "/5/b")]
    got = worklist.unique_names(spark.createDataFrame(rows, "name string, path string")).orderBy("path").collect()
    assert [r.unique_name for r in got] == ["a.mp4", "a_2.mp4", "a_3.mp4", "a_1.mp4", "b"]


def test_unique_names_like_brute_force(spark):
    """Hot names, used numbers with gaps, leading zeros and numbers beyond any count."""
    rng = random.Random(4)
    names = ["a.mp4"] * 9000 + ["b.c.mp4"] * 40 + ["plain"] * 30 + ["once.mov"] + ["a_7.mp4"] * 3 + [None]
    names += [f"a_{i}.mp4" for i in rng.sample(range(1, 12000), 5000)] + ["a_007.mp4", "a_0.mp4", "a_99999999999999999999.mp4", "a_123456789012345678.mp4", "plain_2", "plain_1.x"]
    rows = [(n, f"/{i:05d}/{n}", i) for i, n in enumerate(names)]
    rng.shuffle(rows)
    got = worklist.unique_names(spark.createDataFrame(rows, "name string, path string, more long")).collect()
    real, seen, want = set(names), collections.Counter(), {}
    number = collections.Counter()
    for n, path, _ in sorted(rows, key=lambda r: r[1]):
        want[path] = n
        if n is not None and seen[n]:
            stem, dot, ext = n.rpartition(".")
            base, dotted = (stem, dot + ext) if dot else (n, "")
            number[n] += 1
            while f"{base}_{number[n]}{dotted}" in real:
                number[n] += 1
            want[path] = f"{base}_{number[n]}{dotted}"
        seen[n] += 1
    assert len(got) == len(rows) and {r.path: r.unique_name for r in got} == want
    assert worklist.unique_names(spark.createDataFrame([], "name string, path string")).isEmpty()


def test_stage_plan(spark):
    rows = [(1, s, v) for s, v in ((2, "5"), (3, "11"), (4, None), (5, None))] + [(2, s, v) for s, v in ((2, "6"), (3, "10"), (4, None), (5, None))]
    rows += [(3, s, v) for s, v in ((3, "11"), (4, None), (5, None))]
    m = spark.createDataFrame([(a, b, c, 1) for a, b, c in rows], "recording_id long, stage int, version string, ts long")
    got = {r.recording_id: r.stages for r in worklist.plan_stages(m).collect()}
    assert got == {1: [2, 3, 4, 5], 2: [3, 4, 5], 3: [2]}


def test_every_word_of_a_line(spark, tmp_path):
    text = " ".join(f"w{i}" for i in range(150))
    spark.createDataFrame([(8, text)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert derived.segments(spark, str(tmp_path)).selectExpr("size(words) n").first().n == 150
    for name in ("response_words", "assign_word_speakers", "words_hit_by_ranges", "smooth_word_speakers"):
        assert queries.QUERIES[name](spark, str(tmp_path)).count() == 150
    for name in ("split_by_speaker", "speaker_pipeline"):
        said = [r.text for r in queries.QUERIES[name](spark, str(tmp_path)).orderBy("seq").collect()]
        assert " ".join(said).split() == text.split()


def test_jobs_from_stage_files_to_the_merge(spark, tmp_path):
    said = [(0.0, 5.0, "a clear sentence to begin with"), (5.2, 6.0, "[музыка]"), (40.0, 45.0, "and another one that ends it")]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps({"segments": [{"start": a, "end": b, "text": t} for a, b, t in said]}))
    source, cleaned = f"{tmp_path}/in/*.json", f"{tmp_path}/cleaned"
    validate.run(spark, source, f"{tmp_path}/checked")
    assert spark.read.parquet(f"{tmp_path}/checked/counts").isEmpty()
    clean_up.run(spark, source, cleaned)
    zone = spark.read.parquet(f"{cleaned}/zones").collect()
    assert [(z.zone_id, z.start, z.end) for z in zone] == [(0, 5.0, 40.0)]
    rec = zone[0].recording_id
    second_pass.run(spark, cleaned, f"{tmp_path}/plain")
    rows = spark.read.parquet(f"{tmp_path}/plain/segments").orderBy("seq").collect()
    assert [(r.text, bool(r.is_placeholder)) for r in rows] == [(said[0][2], False), ("[неразборчиво — 35.0с]", True), (said[2][2], False)]
    heard = [(rec, 0, 14.0, 16.0, "heard at last", -0.2, 0.1, None)]
    spark.createDataFrame(
        heard, "recording_id string, zone_id long, rel_start double, rel_end double, text string, avg_logprob double, no_speech_prob double, error string"
    ).write.parquet(f"{tmp_path}/candidates")
    spark.createDataFrame([(rec, 60.0)], "recording_id string, duration double").write.parquet(f"{tmp_path}/recordings")
    second_pass.run(spark, cleaned, f"{tmp_path}/out", f"{tmp_path}/candidates", f"{tmp_path}/recordings")
    rows = spark.read.parquet(f"{tmp_path}/out/segments").orderBy("seq").collect()
    assert [(r.text, r.start) for r in rows] == [(said[0][2], 0.0), ("heard at last", 15.0), (said[2][2], 40.0)]
    counts = spark.read.parquet(f"{tmp_path}/out/counts").first()
    assert (counts.recovered, counts.not_recovered, counts.n_placeholders, counts.n_segments) == (1, 0, 0, 3)


def test_batch_does_what_is_left(spark, tmp_path):
    def arrive(name, version="6"):
        stage_file(tmp_path / "in" / name, [f"{name} says a sentence", "and then another of them"])
        path = tmp_path / "in" / name
        path.write_text(path.read_text().replace('"version": "6"', f'"version": "{version}"'))

    def run(name):
        if not batch.run(spark, f"{tmp_path}/in/*.json", f"{tmp_path}/turns", f"{tmp_path}/rec", f"{tmp_path}/manifest", f"{tmp_path}/ledger", f"{tmp_path}/out", name):
            return {}
        rows = spark.read.parquet(f"{tmp_path}/out/run={name}/transcripts").collect()
        return {r.recording_id.rsplit("/", 1)[1]: r.text for r in rows}

    arrive("a.json")
    arrive("old.json", "5")
    ids = [f"file://{tmp_path}/in/{n}.json" for n in ("a", "b", "old")]
    spark.createDataFrame([(i, 0.0, 9.0, "SPEAKER_00") for i in ids], "recording_id string, start double, end double, speaker string").write.parquet(f"{tmp_path}/turns")
    spark.createDataFrame([(i, i, 9.0) for i in ids], "recording_id string, path string, duration double").write.parquet(f"{tmp_path}/rec")
    first = run("one")
    assert list(first) == ["a.json"]
    assert first["a.json"].split("\n")[:2] == ["a.json", "Спикер 1:"] and "a.json says a sentence and then another of them" in first["a.json"]
    assert run("one") == first  # as after a crash: the same work again
    arrive("b.json")
    assert list(run("two")) == ["b.json"]
    assert run("three") == {}
    assert sorted(r.key.rsplit("/", 1)[1] for r in files.read_ledger(spark, f"{tmp_path}/ledger").collect()) == ["a.json", "b.json"]


def test_new_versions_start_from_stored_stages(spark, tmp_path, monkeypatch):
    """A new version of stage 3 is made of kept stage-2 rows, a lost stage 4 of kept stage-3 rows, a new stage 2 of its file."""
    for n in ("a.json", "b.json"):
        stage_file(tmp_path / "in" / n, [f"{n} says a sentence", "and then another of them"])
    ids = [f"file://{tmp_path}/in/{n}.json" for n in "ab"]
    spark.createDataFrame([(i, 0.0, 9.0, "SPEAKER_00") for i in ids], "recording_id string, start double, end double, speaker string").write.parquet(f"{tmp_path}/turns")
    spark.createDataFrame([(i, i, 9.0) for i in ids], "recording_id string, path string, duration double").write.parquet(f"{tmp_path}/rec")

    def run(name, manifest="manifest", ledger="ledger", **versions):
        where = [f"{tmp_path}/{x}" for x in ("in/*.json", "turns", "rec", manifest, ledger, "out")]
        if not batch.run(spark, *where, name, versions={2: "6", 3: "11"} | {int(k[1:]): v for k, v in versions.items()}):
            return None
        entered = spark.read.parquet(f"{tmp_path}/{manifest}").filter(f"batch = '{name}'").collect()
        texts = {r.text for r in spark.read.parquet(f"{tmp_path}/out/run={name}/transcripts").collect()}
        return sorted((r.recording_id[-6], r.stage, r.version) for r in entered), texts

    entered, texts = run("one")
    assert entered == [(r, k, v) for r in "ab" for k, v in ((2, "6"), (3, "11"), (4, None), (5, None))] and len(texts) == 2
    assert run("two") is None
    read = batch.read_stage_json
    monkeypatch.setattr(batch, "read_stage_json", None)  # the files' rows are not needed
    want = [(r, k, v) for r in "ab" for k, v in ((3, "12"), (4, None), (5, None))]
    assert run("three", s3="12") == (want, texts)
    entered, again = run("three", s3="12")  # as after a crash: the same once more
    assert (sorted(set(entered), key=entered.index), again) == (want, texts)
    assert run("four", s3="12") is None
    spark.read.parquet(f"{tmp_path}/manifest").filter("stage < 4").write.parquet(f"{tmp_path}/part")
    assert run("five", "part", s3="12") == ([(r, k, None) for r in "ab" for k in (4, 5)], texts)
    monkeypatch.setattr(batch, "read_stage_json", read)
    path = tmp_path / "in" / "b.json"
    path.write_text(path.read_text().replace('"version": "6"', '"version": "7"').replace("another", "one more"))
    entered, now = run("six", s2="7", s3="12")  # a.json waits for the recogniser
    assert entered == [("b", 2, "7"), ("b", 3, "12"), ("b", 4, None), ("b", 5, None)] and "one more of them" in now.pop()
    assert run("seven", s2="7", s3="12") is None
    keys = [r.key for r in spark.read.parquet(f"{tmp_path}/ledger").collect()]
    assert sorted(keys) == ids


def test_recordings_without_a_clean_segment(spark, tmp_path):
    stage_file(tmp_path / "in" / "a.json", ["...", "♪"])
    source = f"{tmp_path}/in/*.json"
    clean_up.run(spark, source, f"{tmp_path}/cleaned")
    second_pass.run(spark, f"{tmp_path}/cleaned", f"{tmp_path}/merged")
    assert spark.read.parquet(f"{tmp_path}/cleaned/segments").isEmpty()


def test_repaired_files_are_read_once(spark, tmp_path):
    there = tmp_path / "in"
    stage_file(there / "a.json", ["x"])
    (there / "b.json").write_text('{"segments": [{"start": 0.0, "end"')
    (there / "c.json").write_text("nothing")
    (there / "d e.json").write_text('{"n_raw": 3}')
    assert ingest(spark, tmp_path) == ["x"] and ingest(spark, tmp_path) == ["x"]
    held = read_quarantine(spark, f"{tmp_path}/ledger-quarantine")
    assert sorted(r.path.rsplit("/", 1)[1] for r in held.collect()) == ["b.json", "c.json", "d%20e.json"]
    stage_file(there / "b.json", ["y"])
    (there / "c.json").write_text("{still not")
    stage_file(there / "n.json", ["new"])
    assert ingest(spark, tmp_path) == ["new", "x", "y"] and read_quarantine(spark, f"{tmp_path}/ledger-quarantine").count() == 4
    stage_file(there / "c.json", ["z"])
    stage_file(there / "d e.json", ["w"])
    for _ in range(2):
        assert ingest(spark, tmp_path) == ["new", "w", "x", "y", "z"]
    ids = {r.recording_id for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert len(ids) == 5 and len(set(r.key for r in files.read_ledger(spark, f"{tmp_path}/ledger").collect())) == 5


def test_lost_retry_is_taken_again_as_a_whole(spark, tmp_path):
    there = tmp_path / "in"
    for name in "ab":
        there.mkdir(exist_ok=True)
        (there / f"{name}.json").write_text("{")
    assert not ingest(spark, tmp_path, out=False)
    for name in "ab":
        stage_file(there / f"{name}.json", [name])
    intake = lambda job: Intake(f"{tmp_path}/out", f"{tmp_path}/ledger", f"{tmp_path}/ledger-quarantine", job, 2)

    def lost(rows):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        intake(lost).retry(spark, str(there))
    stage_file(there / "c.json", ["c"])
    assert ingest(spark, tmp_path) == ["a", "b", "c"]
    assert intake(lost).retry(spark, str(there)) == 0


def test_json_ledgers(spark, tmp_path):
    (tmp_path / "good.json").write_text('{"transcribed": ["/v/a.mp4", "b.mp4", "b.mp4", null]}')
    for name, text in (("broken", '{"transcribed": ["a'), ("other", '{"done": 1}'), ("list", "[1, 2]"), ("empty", "")):
        (tmp_path / f"{name}.json").write_text(text)
    keys = lambda name: sorted(r.key for r in files.read_ledger(spark, f"{tmp_path}/{name}.json").collect())
    assert keys("good") == ["/v/a.mp4", "b.mp4"]
    assert all(keys(name) == [] for name in ("broken", "other", "list", "empty", "missing"))
    queue = spark.createDataFrame([("/v/a.mp4", "a.mp4"), ("/w/b.mp4", "b.mp4"), ("/w/c.mp4", "c.mp4")], "path string, name string")
    assert [r.name for r in worklist.pending_files(queue, files.read_ledger(spark, f"{tmp_path}/good.json"), by="name_or_path").collect()] == ["c.mp4"]


def test_audio_chunks_keep_their_ids(spark, tmp_path):
    for kind, value in (("string", "file:///a.json"), ("bigint", 7)):
        spark.createDataFrame([(value, 0, 0, [0.5])], f"recording_id {kind}, chunk_idx long, sample_offset long, samples array<float>").write.parquet(f"{tmp_path}/{kind}")
        assert files.read_audio_chunks(spark, f"{tmp_path}/{kind}").first().recording_id == value


def test_transcripts_as_text_files(spark, tmp_path):
    lines = [("r1", i, f"line {i}") for i in (2, 0, 1)] + [("r/2", 0, "ü")]
    files.write_transcript(spark.createDataFrame(lines, "recording_id string, line_no long, line string").repartition(3), f"{tmp_path}/t", form="text")
    got = {p.parent.name: p.read_text() for p in (tmp_path / "t").rglob("*.txt")}
    assert got == {"name=r1": "line 0\nline 1\nline 2\n", "name=r%2F2": "ü\n"}


def test_batch_with_audio_and_candidates(spark, tmp_path):
    there = tmp_path / "in"
    stage_file(there / "a.json", ["the first sentence of it", "and then the second one"])
    (there / "bad.json").write_text("{")
    (there / "mute.json").write_text('{"segments": [], "n_raw": 0, "version": "6"}')
    stage_file(there / "short.json", ["too short to keep"])
    rid = {n: f"file://{there}/{n}.json" for n in ("a", "bad", "mute", "short")}
    lengths = {"a": 40.0, "mute": 50.0, "short": 9.0}
    spark.createDataFrame([(rid[n], n, d) for n, d in lengths.items()], "recording_id string, path string, duration double").write.parquet(f"{tmp_path}/rec")
    spark.createDataFrame([(rid["a"], 0.0, 40.0, "SPEAKER_00")], "recording_id string, start double, end double, speaker string").write.parquet(f"{tmp_path}/turns")
    chunks = [(rid["a"], k, k * 160, [0.5 if k > 1 else 0.0] * 160) for k in range(4)]  # 16 samples a second: speech from 20 s on
    spark.createDataFrame(chunks, "recording_id string, chunk_idx long, sample_offset long, samples array<float>").write.parquet(f"{tmp_path}/audio")
    found = [(rid["a"], 0, 20.0, 25.0, "what the second pass has heard", -0.2, 0.1, None)]
    schema = "recording_id string, zone_id long, rel_start double, rel_end double, text string, avg_logprob double, no_speech_prob double, error string"
    spark.createDataFrame(found, schema).write.parquet(f"{tmp_path}/candidates")

    def run(name):
        return batch.run(spark, f"{there}/*.json", f"{tmp_path}/turns", f"{tmp_path}/rec", f"{tmp_path}/manifest", f"{tmp_path}/ledger", f"{tmp_path}/out", name,
                         f"{tmp_path}/candidates", f"{tmp_path}/audio", min_duration=30.0, sr=16)

    assert run("one") and not run("two")
    zone = spark.read.parquet(f"{tmp_path}/out/run=one/cleaned/zones").collect()
    assert [(z.reason, z.start, z.end) for z in zone] == [("missing_end", 2.0, 40.0)]
    assert spark.read.parquet(f"{tmp_path}/out/run=one/merged/log").first().status == "recovered"
    text = spark.read.parquet(f"{tmp_path}/out/run=one/transcripts").first().text
    assert "what the second pass has heard" in text
    rows = spark.read.parquet(f"{tmp_path}/manifest").collect()
    told = sorted((r.recording_id.rsplit("/", 1)[1], r.stage, r.status, r.error) for r in rows if r.status != "done")
    assert told == [("bad.json", 2, "failed", "unreadable stage file"), ("mute.json", 3, "skipped", "no_speech"), ("short.json", 3, "skipped", "too_short")]
    assert sorted(r.stage for r in rows if r.status == "done") == [2, 3, 4, 5] and all(r.seconds > 0 for r in rows if r.status == "done" and r.stage > 2)


def test_media_filter_goes_by_whole_names(spark):
    paths = ["/T/a.mp4", "/TOld/b.mp4", "/T/_x/c.mp4", "/T/1/2/3/4/5/6/d.MP4", "/T/work/e.mp4", "/T/workshop/f.mp4", "/T/" + "y" * 2000 + "/_z/g.mp4", "/T/h.txt"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    names = lambda **options: sorted(r.path[-5:] for r in worklist.media_filter(df, **options).collect())
    assert names(root="/T") == names(root="/T/") == ["a.mp4", "e.mp4", "f.mp4"]
    assert names(root="/T", work_dir="/T/work", max_depth=None, hidden=True) == ["a.mp4", "c.mp4", "d.MP4", "f.mp4", "g.mp4"]


def test_segments_split_a_text_once_a_row(spark, tmp_path):
    """Not once for each of its words, and the word before comes from the row."""
    spark.createDataFrame([(8, "так ли это? да нет"), (2, None), (3, "")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert plan(derived.segments(spark, str(tmp_path))).count(",  , -1)") == 1
    answers = queries.QUERIES["response_words"](spark, str(tmp_path))
    assert plan(answers).count(",  , -1)") == 1 and plan(answers).count("Window") == 1  # the segments' own
    assert [tuple(r) for r in answers.filter("recording_id = 8").sort("word_idx").collect()] == [(8, 0, 0, True), (8, 0, 1, False), (8, 0, 2, False), (8, 0, 3, True), (8, 0, 4, True)]
