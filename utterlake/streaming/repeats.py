"""suppress_repeats on a live stream: rows in any order within the watermark, verdicts once a row's time has come.

A recording's state is the rows that wait for the watermark and the kept texts that can still make a later one a repeat. A timer at the
earliest waiting row's time takes the waiting rows in order up to the watermark, and says of each whether it is a repeat; kept
texts go when they are further back than their window, and so the state of a recording that has ended goes as well. State is bounded by the rows of the
watermark's delay and of the long window, whatever a recording's length.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from utterlake.functions import text as T
from utterlake.operators.clean import alike

WAITING = "seq bigint, at bigint, start double, said string, short boolean"
KEPT = "at bigint, start double, said string, short boolean"
COLUMNS = [c.split()[0] for c in WAITING.split(", ")]


class Repeats(StatefulProcessor):
    def __init__(self, key: str, short_len: int, short_win: float, long_win: float):
        self.key, self.short_len, self.windows = key, short_len, {True: short_win, False: long_win}

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting, self.kept = handle.getListState("waiting", WAITING), handle.getListState("kept", KEPT)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for batch in rows:
            new = list(batch[COLUMNS].itertuples(index=False, name=None))
            self.waiting.appendList(new)
            first = min([first, *(r[1] for r in new)], key=lambda at: (at is None, at))
        if first is not None:
            self.handle.registerTimer(-(-int(first) // 1000))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        rows = [tuple(r) for r in self.waiting.get()]
        ready, rest = sorted((r for r in rows if r[1] <= now), key=lambda r: (r[2], r[0])), [r for r in rows if r[1] > now]
        kept, out = [tuple(k) for k in self.kept.get()], []
        for seq, at, start, said, short in ready:
            kept = [k for k in kept if start - k[1] <= self.windows[bool(k[3])]]
            near = [k for k in kept if bool(k[3]) == bool(short) and start - k[1] <= self.windows[bool(short)]]
            repeat = any(k[2] == said or (not short and alike(k[2], said, self.short_len)) for k in near)
            if not repeat:
                kept.append((at, start, said, short))
            out.append((key[0], seq, repeat))
        ends = lambda k: k[0] + int(self.windows[bool(k[3])] * 1_000_000) + 1
        kept = [k for k in kept if ends(k) > now]
        for state, left in ((self.waiting, rest), (self.kept, kept)):
            state.put(left) if left else state.clear()
        times = [r[1] for r in rest] + [ends(k) for k in kept]
        if times:
            self.handle.registerTimer(-(-min(times) // 1000))
        if out:
            yield pd.DataFrame(out, columns=[self.key, "seq", "is_repeat"])

    def close(self) -> None:
        pass


def live_suppress_repeats(
    segments: DataFrame, delay: str = "30 seconds", short_len: int = 15, short_win: float = 6, long_win: float = 90, key: str = "recording_id"
) -> DataFrame:
    """recording_id, seq, is_repeat of a stream of segments (recording_id, seq, start, text, at), as suppress_repeats() says of the whole table.

    at: the time at which the segment began, as a timestamp: the recording's own begin and `start`. Rows may come in any order as long as
    none is later than `delay` behind the latest; those that are later are dropped, as are rows without a time. A recording's starts
    must not go back with seq. The state store has to be one that keeps lists and timers (RocksDB).
    """
    stripped = T.strip(F.coalesce("text", F.lit("")))
    rows = segments.filter("at is not null and start is not null").withWatermark("at", delay).select(
        key, "seq", F.unix_micros("at").alias("at_us"), "at", "start", F.lower(stripped).alias("said"), (F.length(stripped) <= short_len).alias("short")
    )
    rows = rows.withColumnsRenamed({"at": "event_time", "at_us": "at"})
    out = f"{key} {dict(segments.dtypes)[key]}, seq bigint, is_repeat boolean"
    return rows.groupBy(key).transformWithStateInPandas(Repeats(key, short_len, short_win, long_win), out, "Append", "EventTime")
