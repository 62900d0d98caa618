import json
import random

import pytest

from utterlake.sources import files
from utterlake.sources.stage_source import JsonStream, stream_stage_files


def stream(text, step):
    data, at = text if isinstance(text, bytes) else text.encode(), [0]

    def read(n):
        got = data[at[0] : at[0] + n]
        at[0] += n
        return got

    return JsonStream(read, step)


def told(s):
    out = {}
    for name, element, value in s.members():
        if value is ...:
            out[name] = []
        elif element:
            out[name].append(value)
        else:
            out[name] = value
    return out


def test_any_cut_reads_the_same():
    doc = {"a": [1, -2.5e3, "q\"ü\\", [], {"x": [1, {"y": None}]}], "n": 1234567, "empty": [], "o": {"k": [1]}, "t": True, "s": "日本 ]}"}
    for text in (json.dumps(doc), json.dumps(doc, indent=3, ensure_ascii=False), " \n" + json.dumps(doc) + "\r\n\t"):
        for step in (1, 2, 3, 7, 1000):
            assert told(stream(text, step)) == doc
    assert told(stream("{}", 1)) == {}


@pytest.mark.parametrize("text", ["", "  ", "[]", "{", '{"a"', '{"a":', '{"a": [1', '{"a": [1,]}', '{"a": 1,}', '{"a": 1} x', '{1: 2}', "nul", '{"a": [1 2]}', b'{"a": "\xff"}'])
def test_broken_files(text):
    for step in (1, 1000):
        with pytest.raises(ValueError):
            told(stream(text, step))


def test_memory_is_that_of_an_element():
    one = json.dumps({"text": "x" * 1000}).encode()
    pieces = iter([b'{"segments": ['] + [one + b","] * 20_000 + [one, b'], "version": "6"}'])
    s = JsonStream(lambda n: next(pieces, b""), 4096)
    assert sum(1 for n, e, v in s.members() if v is not ...) == 20_002 and s.largest < 20_000


def test_like_the_built_in_reader(spark, tmp_path):
    rng = random.Random(2)
    word = lambda: rng.choice([{"word": "ü", "start": 0.5, "end": 1, "score": 0.25, "speaker": "S"}, {"word": "w"}, {"score": None, "word": "x"}])
    for i in range(12):
        rows = [{"start": k, "end": k + 0.5, "text": f"{i} {k}", "words": [word() for _ in range(k % 3)], "more": 1} for k in range(rng.choice((0, 1, 9)))]
        rows += [{"text": "bare"}, {"avg_logprob": -0.5, "no_speech_prob": None, "speaker": "S1", "is_placeholder": True, "words": None}]
        path = tmp_path / "in" / (f"a {i}" if i % 2 else f"b{i}") / "s2.json"
        path.parent.mkdir(parents=True)
        path.write_text(json.dumps({"version": "6", "segments": rows, "n_raw": 3} if i % 3 else {"segments": rows, "other": [1, [2]], "audio_duration": 7, "version": 6}))
    for i, text in enumerate(['{"segments": [', '{"n_raw": 1}', "", '{"segments": [{"start": "soon"}]}', '{"segments": 3}']):
        (tmp_path / "in" / f"bad{i}").mkdir()
        (tmp_path / "in" / f"bad{i}" / "s2.json").write_text(text)
    want = files.read_stage_json(spark, f"{tmp_path}/in/*/s2.json", 2)
    for options in ({}, {"files": 1}, {"bytes": 300}):
        got = stream_stage_files(spark, f"{tmp_path}/in", 2, **options)
        rows = got.filter("error is null")
        assert rows.select(*want.columns).exceptAll(want).isEmpty() and rows.count() == want.count() > 30
        assert {r.recording_id.split("/")[-2] for r in got.filter("error is not null and seq is null").collect()} == {f"bad{i}" for i in range(5)}
        heads = {(r.n_raw, r.audio_duration) for r in rows.collect()}
        assert heads == {(3, None), (None, 7.0)}


def test_hidden_names_and_other_roots(spark, tmp_path):
    (tmp_path / "_x_ckpt").mkdir()
    (tmp_path / "_x_ckpt" / "_s4.json").write_text('{"all_segments": [{"text": "t"}]}')
    (tmp_path / "_x_ckpt" / "note.txt").write_text("no stage file")
    for root in (str(tmp_path), f"file://{tmp_path}"):
        got = stream_stage_files(spark, root, 4).collect()
        assert [(r.recording_id, r.seq, r.text) for r in got] == [(f"file://{tmp_path}/_x_ckpt/_s4.json", 0, "t")]
    (tmp_path / "none").mkdir()
    assert stream_stage_files(spark, f"{tmp_path}/none", 2).isEmpty()
