"""Speaker changes inside and between segments."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from utterlake.functions import arrays, scan
from utterlake.functions import text as T
from utterlake.functions.fold import chain_map
from utterlake.functions.store import written
from utterlake.operators.intervals import WORDS, assign_speakers, renumber

def response_words(word: pa.Array, first: np.ndarray) -> np.ndarray:
    """T.is_response_word() of words in a row, where first marks the first ones of a segment."""
    said = pc.utf8_trim(word, T.WHITE).fill_null("")
    own = pc.is_in(pc.utf8_rtrim(pc.utf8_lower(said), ".,!?"), pa.array(T.RESPONSES)).to_numpy(zero_copy_only=False)
    asked = pc.ends_with(said, "?").to_numpy(zero_copy_only=False)
    return own | (np.append(False, asked[:-1]) & ~first)


def smoothed(gap: np.ndarray, who: np.ndarray, answers: np.ndarray, first: np.ndarray, last: np.ndarray, near: float = 0.25, edge: float = 0.45) -> np.ndarray:
    """The words' speakers once stray words follow their neighbours, for many rows of two or more words at once. gap[i] lies between the
    words i and i + 1; first and last mark the ends of rows.

    A word is stray if both neighbours have one other speaker. After a stray word that has changed, the next one has its own
    speaker on its left: so of stray words in a row every second one changes, from the first on.
    """
    out = who.copy()
    left, own, right = who[:-2], who[1:-1], who[2:]
    stray = np.zeros(len(who), bool)
    stray[1:-1] = (left == right) & (own != left) & (gap[:-1] < near) & (gap[1:] < near)
    stray &= ~(answers | first | last)
    place = np.arange(len(who))
    changes = stray & ((place - np.maximum.accumulate(np.where(stray, -1, place))) % 2 == 1)
    out[changes] = who[np.flatnonzero(changes) - 1]
    at = np.flatnonzero(first & ~answers)
    at = at[gap[at] < edge]
    out[at] = out[at + 1]
    at = np.flatnonzero(last & ~answers)
    at = at[gap[at - 1] < edge]
    out[at] = out[at - 1]
    return out


def runs_of(gap: np.ndarray, who: np.ndarray, answers: np.ndarray, first: np.ndarray, max_gap: float = 0.45) -> tuple[np.ndarray, np.ndarray]:
    """(first word, speaker) of each part: runs of one speaker in a row, where a lone word that is no answer joins the run before it
    within max_gap, else the one after it. For many rows at once; first marks their first words.

    A lone word goes forward only over a gap that the next run can't go back over, so that no run's choice depends on another's,
    but for one: a run that a lone word has joined from the left stays where it is.
    """
    at = np.flatnonzero(first | np.append(True, who[1:] != who[:-1]))
    lone = (np.append(at[1:], len(who)) - at == 1) & ~answers[at]
    back = np.append(False, gap[at[1:] - 1] < max_gap) & ~first[at]
    forward = lone & ~back & np.append(back[1:], False)
    joined = np.append(False, forward[:-1])
    back &= lone & ~joined
    return at[~(back | joined)], who[at[~(back | forward)]]


PIECE = "struct<speaker:string,start:double,end:double,text:string{}>"


def word_speaker_fix(max_gap: float = 0.45, cut: bool = True, whole: bool = True):
    """A vectorised helper: a row's words, speaker and is_placeholder to its words with missing speakers filled in and smoothed (if
    whole), the speaker that is left if there's only one run of several, and its parts (if cut; null unless there are two or more).

    Rows with fewer than two timed words, and placeholders, stay as they are; rows of one speaker have nothing to smooth.
    """
    words = f"words:{WORDS}"
    fields = [*([words] if whole else []), *(["only:string", f"pieces:array<{PIECE.format(f',{words}' if whole else '')}>"] if cut else [])]

    @F.arrow_udf(f"struct<{','.join(fields)}>")
    def fix(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for rows, speaker, mark in batches:
            n, word = arrays.flat(rows)
            row, place = np.repeat(np.arange(len(n)), n), arrays.places(n)
            raw = pc.struct_field(word, "speaker").cast(pa.string())
            start, end = pc.struct_field(word, "start"), pc.struct_field(word, "end")
            untimed = pc.or_(start.is_null(), end.is_null()).to_numpy(zero_copy_only=False)
            fit = (n > 1) & (np.bincount(row[untimed], minlength=len(n)) == 0) & ~mark.fill_null(False).to_numpy(zero_copy_only=False)
            named = lambda x: pc.if_else(pc.equal(x, ""), None, x)
            own = named(speaker.cast(pa.string())).fill_null("UNKNOWN")
            names = pc.coalesce(named(raw), own.take(pa.array(row))).dictionary_encode()
            who = names.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            differs = (place > 0) & np.append(False, who[1:] != who[:-1])
            several = fit & (np.bincount(row[differs], minlength=len(n)) > 0)
            at = np.flatnonzero(several[row])  # the words that may change, in a row
            first = place[at] == 0
            gap = (arrays.doubles(word, "start")[at][1:] - arrays.doubles(word, "end")[at][:-1]) if len(at) else np.zeros(0)
            answers = response_words(pc.struct_field(word, "word").take(pa.array(at)), first)
            who[at] = smoothed(gap, who[at], answers, first, np.append(first[1:], True)) if len(at) else who[at]
            told = pc.if_else(pa.array(fit[row]), names.dictionary.take(pa.array(who)), raw)
            word = arrays.with_speakers(word, told)
            out = [arrays.relist(n, word, rows.is_null())] if whole else []
            if cut:
                begins, of = runs_of(gap, who[at], answers, first, max_gap) if len(at) else (at, at)
                begins = at[begins]
                parts = np.bincount(row[begins], minlength=len(n))
                many = parts[row[begins]] > 1  # the parts of rows that are cut
                lone, left = begins[~many], of[~many]
                still = np.bincount(row[at][np.append(False, who[at][1:] != who[at][:-1]) & ~first] if len(at) else at, minlength=len(n)) > 0
                only = np.full(len(n), -1, np.int64)
                only[row[lone]] = left
                only[~still] = -1  # one speaker only: the row keeps its own
                out.append(names.dictionary.take(pa.array(only, mask=only < 0)))
                used = np.flatnonzero((parts > 1)[row])
                pieces = arrays.pieces(word.take(pa.array(used)), np.searchsorted(used, begins[many]), whole, speaker=names.dictionary.take(pa.array(of[many])))
                out.append(arrays.relist(np.where(parts > 1, parts, 0), pieces, pa.array(parts < 2)))
            yield pa.StructArray.from_arrays(out, [f.split(":")[0] for f in fields])

    return fix.asNondeterministic()  # it isn't, but so Spark neither repeats it nor moves it into another expression


def smooth_word_speakers(segments: DataFrame) -> DataFrame:
    """segments with the words' speakers smoothed; the rows' own speakers stay."""
    s = segments.withColumn("fix", word_speaker_fix(cut=False)("words", "speaker", "is_placeholder"))
    return s.select(*[F.col("fix.words").alias(c) if c == "words" else F.col(c) for c in segments.columns])


def split_by_speaker(segments: DataFrame, max_gap: float = 0.45, words: bool = True) -> DataFrame:
    """One row per run of a speaker; seq is new. words: whether the rows keep their words."""
    columns = [c for c in segments.columns if words or c != "words"]
    s = segments.withColumn("fix", word_speaker_fix(max_gap, whole=words)("words", "speaker", "is_placeholder"))
    kept = [F.col("fix.words").alias(c) if c == "words" else F.col(c) for c in columns]
    s = s.select(*kept, F.col("fix.only").alias("only"), F.posexplode_outer("fix.pieces").alias("part", "p"))
    cut = F.col("p").isNotNull()
    new = {c: F.when(cut, F.col(f"p.{c}")).otherwise(F.col(c)) for c in ("text", *(["words"] if words else []))} | {
        "speaker": F.when(cut, F.col("p.speaker")).otherwise(F.coalesce("only", "speaker")),
        "start": F.when(cut, F.round("p.start", 3)).otherwise(F.col("start")), "end": F.when(cut, F.round("p.end", 3)).otherwise(F.col("end")),
    }
    rows = s.filter("p is null or p.text <> ''").select(*[new.get(c, F.col(c)).alias(c) for c in columns], "part")
    return renumber(written(rows, "split"), "seq", "part").select(*columns)  # written: the helper runs once


def _settle(max_gap: float, max_passes: int):
    """Solve one chain: rows (start, end, n_words, fixed, speaker, and of the fixed row before the chain: its end and speaker).

    What a row may do depends on times and lengths alone: take the speaker that both neighbours share, or, as a lone word, that
    of one side (-1 or 1; 0: its own). Only the speakers change from pass to pass; a pass that changes none is the last.
    """

    def solve(rows: list[tuple]) -> list[str | None]:
        start, end, n_words, fixed, who, ends, said = map(list, zip(*rows, strict=True))
        led = fixed[0] is not None and ends[0] is not None and not math.isnan(ends[0])
        if led:
            start, end, n_words, fixed, who = [ends[0], *start], [ends[0], *end], [9, *n_words], [True, *fixed], [said[0], *who]
        gap = [math.inf, *(b - a for a, b in zip(end, start[1:])), math.inf]  # before each row, and after the last
        lone = [(-1 if gap[i] < 0.35 else int(gap[i + 1] < 0.35)) if n_words[i] < 2 else 0 for i in range(len(who))]
        moves = [(i, 0 < i < len(who) - 1 and min(gap[i : i + 2]) <= max_gap, lone[i]) for i in range(len(who)) if not fixed[i]]
        for _ in range(max_passes):
            was = list(who)
            for i, between, side in moves:
                shared = who[i - 1] if between and who[i - 1] == who[i + 1] else None
                who[i] = shared or who[i + side]
            if who == was:
                break
        return who[led:]

    return solve


def merge_short_segments(segments: DataFrame, min_dur: float = 0.7, max_words: int = 2, max_gap: float = 0.45, max_passes: int = 5) -> DataFrame:
    """segments with the speakers of micro-segments taken from their neighbours; rows are not joined.

    Segments that can't change are barriers: only the chains between them, with their fixed ends, meet the helper. Chains are numbered by
    bins of the recording, over narrow rows; a chain's first row brings the fixed row before it along. segments are evaluated three times.
    """
    n = T.word_count(F.col("text"))
    first = F.element_at(F.filter(F.split(F.coalesce("text", F.lit("")), r"(?U)\s+"), lambda x: x != ""), 1)
    first = F.when(n > 0, first).otherwise("")
    fixed = ((F.col("end") - F.col("start") >= min_dur) & (n > max_words)) | ((n <= 2) & T.is_response_word(first))
    s = segments.select("recording_id", "seq", "start", "end", "speaker", n.cast("int").alias("n_words"), F.coalesce(fixed, F.lit(True)).alias("fixed"))
    s = scan.numbered_runs(s, ["fixed", "end", "speaker"], lambda a, b: a["fixed"] & ~b["fixed"], ["seq"], "chain", before="before")
    led = ~F.col("fixed") & F.col("before.fixed")
    s = s.withColumn("ends", F.when(led, F.col("before.end"))).withColumn("said", F.when(led, F.col("before.speaker")))
    rows = s.filter(~F.col("fixed") | ~F.coalesce("before.fixed", F.lit(True)))  # movable ones, and the fixed one after them
    told = chain_map(rows, ["recording_id", "chain"], ["seq"], ["start", "end", "n_words", "fixed", "speaker", "ends", "said"], _settle(max_gap, max_passes), "new_speaker string")
    moved = written(told.join(s.filter("not fixed").select("recording_id", "seq"), ["recording_id", "seq"], "left_semi").select("recording_id", "seq", "new_speaker"), "settled")
    out = segments.join(moved.withColumn("moved", F.lit(True)), ["recording_id", "seq"], "left")
    return out.withColumn("speaker", F.when(F.col("moved"), F.col("new_speaker")).otherwise(F.col("speaker"))).select(*segments.columns)


def split_placeholders(segments: DataFrame) -> tuple[DataFrame, DataFrame]:
    mark = F.coalesce("is_placeholder", F.lit(False))
    return segments.filter(~mark), segments.filter(mark)


def reunite_placeholders(done: DataFrame, placeholders: DataFrame) -> DataFrame:
    """Both in the order of their starts, renumbered; at one start a placeholder comes after the rows."""
    both = done.withColumn("source", F.lit(0)).unionByName(placeholders.withColumn("source", F.lit(1)))
    return renumber(both.withColumn("old", F.col("seq")), "start", "source", "old").select(*done.columns)


def speaker_pipeline(segments: DataFrame, turns: DataFrame, words: bool = True) -> DataFrame:
    """Assign, smooth and split, settle short segments, and put the placeholders back in their place. words: whether the rows keep their words."""
    real, placeholders = split_placeholders(segments)
    parts = written(split_by_speaker(assign_speakers(real, turns), words=words), "numbered")  # read three times below
    done = merge_short_segments(parts)
    return reunite_placeholders(done, placeholders.select(*done.columns))


def speaker_stats(segments: DataFrame) -> DataFrame:
    real = split_placeholders(segments)[0]
    who = F.when(F.coalesce("speaker", F.lit("")) == "", "UNKNOWN").otherwise(F.col("speaker"))
    return real.groupBy("recording_id", who.alias("speaker")).agg(
        F.count("*").alias("n_segments"), F.sum(F.col("end") - F.col("start")).alias("duration"), F.sum(T.word_count(F.col("text"))).alias("n_words")
    )


def speaker_share(stats: DataFrame) -> DataFrame:
    total = F.sum("duration").over(W.partitionBy("recording_id"))
    return stats.withColumn("pct", F.when(total > 0, F.col("duration") / total * 100).otherwise(0.0))


def speaker_count(segments: DataFrame) -> DataFrame:
    real = split_placeholders(segments)[0]
    return real.groupBy("recording_id").agg(F.countDistinct(F.coalesce("speaker", F.lit("?"))).alias("n_speakers"))
