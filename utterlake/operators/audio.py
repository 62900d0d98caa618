"""Sample chunks: energy in ranges, levels per recording."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from utterlake.operators.intervals import cover

#: The highest level of an energy index: nodes of 2 ** 20 blocks, three days at a quarter of a second.
TOP = 20


def audio_partials(samples: Column, first: Column, last: Column, amp_min: float = 0.01) -> Column:
    """Of samples[first:last]: sum of squares, number above amp_min, number, largest; a struct column."""

    @F.pandas_udf("sq double, active long, n long, peak double")
    def partials(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for rows, a, b in batches:
            out = []
            for x, i, j in zip(rows, a, b, strict=True):
                v = np.abs(np.asarray(x, np.float64)[int(i) : int(j)])
                out.append((float(v @ v), int((v > amp_min).sum()), len(v), float(v.max(initial=0.0))))
            yield pd.DataFrame(out, columns=["sq", "active", "n", "peak"])

    return partials(samples, first, last)


def block_partials(samples: Column, offset: Column, block: int, amp_min: float) -> Column:
    """The same sums of each block of the recording (`at`: samples at * block and on) that a chunk of at least one sample has a part in."""

    @F.pandas_udf("array<struct<at:bigint,sq:double,active:bigint,n:bigint,peak:double>>")
    def partials(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for rows, offsets in batches:
            out = []
            for x, at in zip(rows, offsets, strict=True):
                v = np.abs(np.asarray(x, np.float64))
                first = int(at) // block
                cuts = np.maximum(np.arange(first, (int(at) + len(v) - 1) // block + 1) * block - int(at), 0)
                sums = np.add.reduceat(v * v, cuts), np.add.reduceat((v > amp_min).astype(np.int64), cuts), np.diff([*cuts, len(v)]), np.maximum.reduceat(v, cuts)
                out.append([{"at": first + k, "sq": float(q), "active": int(a), "n": int(n), "peak": float(p)} for k, (q, a, n, p) in enumerate(zip(*sums, strict=True))])
            yield pd.Series(out)

    return partials(samples, offset)


class EnergyIndex(NamedTuple):
    """nodes: recording_id, level, at, sq, active, n, peak; node (k, i) sums up the blocks i * 2 ** k up to (i + 1) * 2 ** k."""

    nodes: DataFrame
    block: int
    amp_min: float


def energy_index(audio: DataFrame, sr: int = 16000, block: int | None = None, amp_min: float = 0.01) -> EnergyIndex:
    """Sums of dyadic nodes over blocks of samples (a quarter of a second, at least 256 samples). Samples are read once, in place.

    A range's whole blocks are a few nodes of it, which are added up: no differences of running totals, so nothing cancels out, holes
    between chunks need no rows, and no window goes over a recording. Who reads the nodes often writes them first.
    """
    block = block or max(256, sr // 4)
    found = audio.filter(F.size("samples") > 0).select("recording_id", F.explode(block_partials(F.col("samples"), F.col("sample_offset"), block, amp_min)).alias("b"))
    levels = F.explode(F.sequence(F.lit(0), F.lit(TOP))).alias("level")
    up = found.select("recording_id", "b", levels).select("recording_id", "level", F.call_function("shiftright", F.col("b.at"), F.col("level")).alias("at"), "b.sq", "b.active", "b.n", "b.peak")
    sums = [F.sum(c).alias(c) for c in ("sq", "active", "n")]
    return EnergyIndex(up.groupBy("recording_id", "level", "at").agg(*sums, F.max("peak").alias("peak")), block, amp_min)


def _nodes(first: Column, last: Column) -> Column:
    """cover() with the nodes above the index's highest level cut into such of that level."""
    up = lambda x, k: F.call_function("shiftleft", x, k)
    node = lambda k, at: F.struct(k.alias("level"), at.alias("at"))

    def parts(x: Column) -> Column:
        over = x["level"] - TOP
        cut = F.transform(F.sequence(up(x["at"], over), up(x["at"] + 1, over) - 1), lambda at: node(F.lit(TOP), at))
        return F.when(over > 0, cut).otherwise(F.array(node(x["level"], x["at"])))

    return F.flatten(F.transform(cover(first, last), parts))


def speech_in_range(
    ranges: DataFrame, audio: DataFrame, sr: int = 16000, block: int | None = None, rms_min: float = 0.003, amp_min: float = 0.01, active_min: float = 0.05,
    index: EnergyIndex | None = None,
) -> DataFrame:
    """ranges with has_speech.

    A range's whole blocks are answered by the energy index (built here unless it is given; then its block and amp_min hold). Samples
    are read for the at most two blocks that a range cuts, and only those blocks are shuffled, never a chunk. Chunks may have any
    size and need not be numbered: they say themselves which samples they hold (sample_offset and size).
    """
    index = index or energy_index(audio, sr, block, amp_min)
    keys, size, amp_min = ["recording_id", "start", "end"], index.block, index.amp_min
    lo, hi = F.col("lo"), F.col("hi")
    r = ranges.select(*keys).distinct().withColumn("lo", F.greatest(F.lit(0), F.floor(F.col("start") * sr))).withColumn("hi", F.floor(F.col("end") * sr)).filter("hi > lo")
    r = r.withColumn("first", F.ceil(lo / size)).withColumn("after", F.floor(hi / size))  # the whole blocks, if first < after
    first, after = F.col("first"), F.col("after")
    whole = r.filter(first < after).select(*keys, F.explode(_nodes(first, after - 1)).alias("node")).select(*keys, "node.level", "node.at")
    whole = whole.join(index.nodes, ["recording_id", "level", "at"]).select(*keys, "sq", "active", "n")

    part = lambda at, i, j: F.struct(at.alias("at"), i.alias("i"), j.alias("j"))
    left = F.when(lo % size != 0, part(first - 1, lo, F.least(hi, first * size)))
    right = F.when((hi % size != 0) & (after * size >= lo), part(after, after * size, hi))
    cut = r.select(*keys, F.explode(F.array_compact(F.array(left, right))).alias("cut")).select(*keys, "cut.*")
    at, n = F.col("sample_offset"), F.size("samples")
    here = lambda b: F.greatest(F.lit(0), b * size - at)
    piece = lambda b: F.struct(b.alias("at"), (here(b) + at).alias("from"), F.slice("samples", (here(b) + 1).cast("int"), F.least(n, (b + 1) * size - at).cast("int") - here(b).cast("int")).alias("samples"))
    blocks = audio.filter(n > 0).select("recording_id", F.explode(F.transform(F.sequence(F.floor(at / size), F.floor((at + n - 1) / size)), piece)).alias("b"))
    near = cut.join(blocks.select("recording_id", "b.*"), ["recording_id", "at"]).filter((F.col("from") < F.col("j")) & (F.col("from") + n > F.col("i")))
    a, b = F.greatest(F.lit(0), F.col("i") - F.col("from")), F.least(n, F.col("j") - F.col("from"))
    edges = near.select(*keys, audio_partials(F.col("samples"), a, b, amp_min).alias("p")).select(*keys, "p.sq", "p.active", "p.n")

    sums = whole.unionByName(edges).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("sq", "active", "n")])
    loud = (F.col("n") >= sr // 4) & (F.sqrt(F.col("sq") / F.col("n")) >= rms_min) & (F.col("active") / F.col("n") > active_min)
    told = sums.select(*keys, loud.alias("has_speech"))
    return ranges.join(told, keys, "left").withColumn("has_speech", F.coalesce("has_speech", F.lit(False)))


def signal_stats(audio: DataFrame, sr: int = 16000, index: EnergyIndex | None = None) -> DataFrame:
    """recording_id, rms, peak, duration; from the blocks of an energy index, if there is one, without a sample."""
    p = audio.select("recording_id", audio_partials(F.col("samples"), F.lit(0), F.size("samples")).alias("p")).select("recording_id", "p.*")
    p = index.nodes.filter(F.col("level") == 0) if index else p
    sums = p.groupBy("recording_id").agg(F.sum("sq").alias("sq"), F.sum("n").alias("n"), F.max("peak").alias("peak"))
    return sums.select("recording_id", F.sqrt(F.col("sq") / F.col("n")).alias("rms"), "peak", (F.col("n") / sr).alias("duration"))


def peak_normalize(audio: DataFrame) -> DataFrame:
    """Samples over the recording's peak; unchanged where the peak is below 1e-6 or a sample is no number."""
    peak = audio.groupBy("recording_id").agg(
        F.max(F.array_max(F.transform("samples", lambda x: F.abs(x)))).alias("peak"),
        F.max(F.exists("samples", lambda x: F.isnan(x) | (F.abs(x) == float("inf")))).alias("odd"),
    )
    scaled = F.transform("samples", lambda x: x / (F.col("peak") + 1e-9))
    out = audio.join(peak, "recording_id")
    return out.withColumn("samples", F.when(F.col("odd") | (F.col("peak") < 1e-6), F.col("samples")).otherwise(scaled)).drop("peak", "odd")


def vad_speech_ratio(intervals: DataFrame, recordings: DataFrame) -> DataFrame:
    """recording_id, n_intervals, pct (0 and fallback without any)."""
    n = intervals.groupBy("recording_id").agg(F.count("*").alias("n_intervals"), F.sum(F.col("end") - F.col("start")).alias("speech"))
    r = recordings.select("recording_id", "duration").join(n, "recording_id", "left")
    pct = F.when(F.col("duration") > 0, F.coalesce("speech", F.lit(0.0)) / F.col("duration") * 100).otherwise(0.0)
    return r.select("recording_id", F.coalesce("n_intervals", F.lit(0)).alias("n_intervals"), pct.alias("pct"), F.col("n_intervals").isNull().alias("fallback"))
