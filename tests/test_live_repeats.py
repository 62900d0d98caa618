"""suppress_repeats on a stream: the same as on the whole table, after a restart too, with bounded state."""

import datetime
import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from utterlake.operators.clean import suppress_repeats
from utterlake.streaming.repeats import live_suppress_repeats

LONG = ["the quick brown fox jumps over it", "the quick brown fox jumps over it!", "nothing like the others at all", "И ещё одна длинная строка текста"]
SHORT = ["Yes", "yes", "no", "угу", "Угу", "", "fifteen letters", "sixteen letters."]
ZERO = datetime.datetime(2024, 1, 1)


def rows_of(seed, recordings=4, n=150):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(recordings):
        start = 0.0
        for seq in range(n):
            start += float(rng.choice([0, 0.5, 2, 4, 6, 30], p=[0.1, 0.3, 0.3, 0.15, 0.1, 0.05]))
            text = (LONG if rng.integers(2) else SHORT)[int(rng.integers(4 if rng.integers(2) else 3))]
            rows.append({"recording_id": f"r{i}", "seq": seq, "start": start, "text": text, "at": (ZERO + datetime.timedelta(seconds=7 * i + start)).isoformat()})
    return rows


def arrive(folder, rows, seed, size=40):
    """Files of rows that come up to 20 seconds late; the last one is a heartbeat that moves the watermark on."""
    rng = np.random.default_rng(seed)
    order = np.argsort([datetime.datetime.fromisoformat(r["at"]).timestamp() + rng.uniform(0, 20) for r in rows])
    parts = [[rows[i] for i in order[k : k + size]] for k in range(0, len(rows), size)]
    last = max(r["at"] for r in rows)
    parts.append([{"recording_id": "heartbeat", "seq": 0, "start": 0.0, "text": "x", "at": (datetime.datetime.fromisoformat(last) + datetime.timedelta(hours=1)).isoformat()}])
    os.makedirs(folder, exist_ok=True)
    for k, part in enumerate(parts):
        with open(f"{folder}/{k:04d}.json.tmp", "w") as f:
            f.write("\n".join(json.dumps(r) for r in part))
        os.utime(f"{folder}/{k:04d}.json.tmp", (1_700_000_000 + k, 1_700_000_000 + k))
    return [f"{folder}/{k:04d}.json" for k in range(len(parts))]


def show(names):
    for name in names:
        os.rename(f"{name}.tmp", name)


@pytest.fixture
def rocks(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def run(spark, tmp_path):
    stream = spark.readStream.schema("recording_id string, seq long, start double, text string, at timestamp").option("maxFilesPerTrigger", 1).json(f"{tmp_path}/in/*.json")
    out = live_suppress_repeats(stream).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/ckpt")
    q = out.trigger(availableNow=True).start()
    q.awaitTermination()
    return [p.stateOperators[0].numRowsTotal for p in q.recentProgress if p.stateOperators]


def test_stream_equals_table(spark, tmp_path, rocks):
    rows = rows_of(3)
    names = arrive(f"{tmp_path}/in", rows, 4)
    half = len(names) // 2
    show(names[:half])
    first = run(spark, tmp_path)
    assert spark.read.parquet(f"{tmp_path}/out").count() < len(rows) / 2
    show(names[half:])
    second = run(spark, tmp_path)
    got = sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").filter("recording_id <> 'heartbeat'").select("recording_id", "seq", "is_repeat").collect())
    table = spark.createDataFrame([(r["recording_id"], r["seq"], r["start"], r["text"]) for r in rows], "recording_id string, seq long, start double, text string")
    want = sorted(tuple(r) for r in suppress_repeats(table).select("recording_id", "seq", F.coalesce("is_repeat", F.lit(False))).collect())
    assert got == want and sum(r[2] for r in want) > 50
    # rows of the delay and of the long window, their timers, and nothing of what has ended but the heartbeat
    assert max(first + second) < 400 and second[-1] <= 4
