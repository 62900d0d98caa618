"""Clean-up of recognised segments, problem zones, and the merge of both passes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from utterlake.functions import arrays, scan
from utterlake.functions import text as T
from utterlake.functions.fold import ordered_fold
from utterlake.functions.recent import RecentTexts
from utterlake.functions.store import written
from utterlake.operators.audio import speech_in_range
from utterlake.operators.intervals import WORDS, hits, merge_zones, near_ranges, renumber


def flag(segments: DataFrame) -> DataFrame:
    """segments with hallucination (reason), short (too short), low (confidence flag)."""
    return segments.select(
        "*",
        T.hallucination_reason(F.col("text"), F.col("avg_logprob"), F.col("no_speech_prob")).alias("hallucination"),
        T.too_short(F.col("start"), F.col("end"), F.col("text"), F.col("no_speech_prob"), F.col("avg_logprob")).alias("short"),
    )


def _fold_equal(window: float):
    """State: start of the last kept segment with this text."""

    def step(kept, start):
        if kept is not None and start - kept <= window:
            return kept, True
        return start, False

    return step


def alike(a: str, b: str, least: int) -> bool:
    """One of two long texts holds the other and is not much longer."""
    short, long = sorted((a, b), key=len)
    return len(short) > least and short in long and len(short) / len(long) > 0.8


def _fold_similar(least: int):
    """State: the kept segments that no later one lay further away from than their own window."""

    def step(kept, text, start, window):
        kept = RecentTexts(least) if kept is None else kept
        kept.expire(start)
        if kept.near(text, start, window):
            return kept, True
        kept.keep(text, start, window)
        return kept, False

    return step


def suppress_repeats(segments: DataFrame, short_len: int = 15, short_win: float = 6, long_win: float = 90) -> DataFrame:
    """segments with is_repeat: a kept earlier one within the window says the same, or (long texts) almost the same.

    Short texts match equal ones only and fold per text; long texts fold per recording. Chains end where the row before with the
    same key lies further back than the window, so that a fold's work and state stay small. A recording whose starts go back
    somewhere folds as one chain of all its texts: there any row can end what an earlier one has left behind, and it stays so.
    Rows without a recording_id have no verdict (null), and verdicts() keeps them.
    """
    by_seq, whole = W.partitionBy("recording_id").orderBy("seq"), W.partitionBy("recording_id")
    stripped = T.strip(F.coalesce("text", F.lit("")))
    is_short = F.length(stripped) <= short_len
    s = segments.select(
        "recording_id", "seq", "start", F.lower(stripped).alias("said"), is_short.alias("is_short"),
        F.when(is_short, short_win).otherwise(long_win).cast("double").alias("window"), (F.col("start") < F.lag("start").over(by_seq)).alias("back"),
    )
    s = s.withColumn("back", F.coalesce(F.max("back").over(whole), F.lit(False)))

    def chained(df: DataFrame, key: list[str], window: float) -> DataFrame:
        w = W.partitionBy(*key).orderBy("seq")
        new = F.when(F.col("back") | (F.col("start") - F.lag("start").over(w) <= window), 0).otherwise(1)
        return df.withColumn("new", new).withColumn("chain", F.sum("new").over(w.rowsBetween(W.unboundedPreceding, 0)))

    short = chained(s.filter("is_short and not back"), ["recording_id", "said"], short_win)
    long = chained(s.filter("not is_short or back"), ["recording_id"], long_win)
    a = ordered_fold(short, ["recording_id", "said", "chain"], ["seq"], ["start"], _fold_equal(short_win), "is_repeat boolean")
    b = ordered_fold(long, ["recording_id", "chain"], ["seq"], ["said", "start", "window"], _fold_similar(short_len), "is_repeat boolean")
    keys = ["recording_id", "seq"]
    return segments.join(a.select(*keys, "is_repeat").unionByName(b.select(*keys, "is_repeat")), keys, "left")


def _edge_scores(words: Column) -> tuple[Column, Column]:
    """Scores of the first and the last word; 1 where there is none."""
    n = F.coalesce(F.size(words), F.lit(0))
    return tuple(F.when(n > 0, F.coalesce(F.get(words, at)["score"], F.lit(1.0))).otherwise(1.0) for at in (F.lit(0), n - 1))


ZONE = "struct<k:int,seq:bigint,start:double,end:double,reason:string,ask:boolean>"


def all_zones(rows: DataFrame, recordings: DataFrame | None = None) -> DataFrame:
    """recording_id, ord (k, seq), start, end, reason, ask: all zones before merging.

    rows: recording_id, seq, start, end, first_score, last_score, kept (clean), zone_reason. k: 0 for a row's own zone, 1 for a
    gap to the next clean row, 2 and 3 for the recording's edges (3 with recordings only). ask: counts only where there is speech.
    rows are evaluated twice: each bin of them hands on whether it has a clean row, and its first one to those before it.
    """
    kept = F.coalesce("kept", F.lit(False))
    r = scan.binned(rows, "seq").withColumn("clean", F.when(kept, F.struct("start", "first_score"))).withColumn("any", kept)
    bins = r.groupBy(scan.KEY, scan.BIN).agg(F.min_by("clean", F.when(kept, F.col("seq"))).alias("clean"), F.max("any").alias("any"))
    bins = bins.select(scan.KEY, scan.BIN, F.max("any").over(scan.before_bins()).alias("any"), F.last("clean", True).over(scan.after_bins()).alias("clean"))
    seed = lambda place, any_, clean_: F.struct(F.lit(place).alias(scan.PLACE), any_.alias("any"), clean_.alias("clean"))
    none = lambda c: F.when(F.lit(False), F.col(c))
    seeds = F.explode(F.array(seed(scan.START, F.col("any"), none("clean")), seed(scan.END, none("any"), F.col("clean")))).alias("h")
    seeds = bins.select(scan.KEY, scan.BIN, seeds).select(scan.KEY, scan.BIN, "h.*")
    back = W.partitionBy(scan.KEY, scan.BIN).orderBy(F.desc(scan.PLACE), F.desc("seq")).rowsBetween(W.unboundedPreceding, -1)
    ahead = scan.in_bin(["seq"]).rowsBetween(W.unboundedPreceding, -1)
    r = scan.seeded(r, seeds).withColumn("next", F.last("clean", True).over(back)).withColumn("kept_before", F.max("any").over(ahead))
    r = scan.rows_only(r, "clean", "any")
    zone = lambda k, start, end, reason, ask: F.struct(
        F.lit(k).alias("k"), F.when(F.lit(k < 2), F.col("seq")).otherwise(0).cast("long").alias("seq"), start.alias("start"), end.alias("end"), reason.alias("reason"), F.lit(ask).alias("ask")
    )
    start, end, then, zero = F.col("start"), F.col("end"), F.col("next.start"), F.lit(0.0)
    gap, kept = then - end, F.col("kept")
    unsure = (gap > 0.5) & (gap < 3.0) & ((F.col("last_score") < 0.5) | (F.col("next.first_score") < 0.5))
    found = [
        F.when(F.col("zone_reason").isNotNull(), zone(0, start, end, F.col("zone_reason"), False)),
        F.when(kept & unsure, zone(1, end - 1.0, then + 1.0, F.lit("chunk_boundary"), False)),
        F.when(kept & (gap > 3.0) & (gap < 60.0), zone(1, end, then, F.lit("large_gap_with_speech"), True)),
        F.when(kept & ~F.coalesce("kept_before", F.lit(False)) & (start > 3.0) & (start < 120.0), zone(2, zero, start, F.lit("missing_start"), True)),
    ]
    if recordings is not None:
        r = r.join(recordings.select("recording_id", "duration"), "recording_id", "left")
        rest = F.col("duration") - end
        found.append(F.when(kept & F.col("next").isNull() & (rest > 3.0) & (rest < 120.0), zone(3, end, F.col("duration"), F.lit("missing_end"), True)))
    zones = r.select("recording_id", F.explode(F.filter(F.array(*[f.cast(ZONE) for f in found]), lambda z: z.isNotNull())).alias("z"))
    return zones.select("recording_id", F.struct("z.k", "z.seq").alias("ord"), "z.start", "z.end", "z.reason", "z.ask")


def with_speech(zones: DataFrame, speech: DataFrame | None = None, audio: DataFrame | None = None, **sizes) -> DataFrame:
    """all_zones() without those that ask for speech where there is none: by a table of ranges (recording_id, start, end,
    has_speech) or by sample chunks (sizes: what speech_in_range() takes). Without both, speech is assumed."""
    if speech is None and audio is None:
        return zones
    asked = zones.filter("ask")
    if speech is None:
        heard = speech_in_range(asked, audio, **sizes).filter("has_speech").select(*zones.columns)
    else:
        heard = asked.join(speech.filter("has_speech").select("recording_id", "start", "end").distinct(), ["recording_id", "start", "end"], "left_semi")
    return zones.filter("not ask").unionByName(heard.select(*zones.columns))


def _clean_rows(clean: DataFrame) -> DataFrame:
    """clean: with words, or with the scores that verdicts() has taken from them."""
    first, last = (F.col("first_score"), F.col("last_score")) if "first_score" in clean.columns else _edge_scores(F.col("words"))
    return clean.select("recording_id", "seq", "start", "end", first.alias("first_score"), last.alias("last_score"), F.lit(True).alias("kept"), F.lit(None).cast("string").alias("zone_reason"))


def segment_gaps(clean: DataFrame, speech: DataFrame | None = None) -> DataFrame:
    """Zones (recording_id, ord_seq, start, end, reason) in the gaps between clean segments.

    speech: recording_id, start, end, has_speech of ranges; a long gap counts if its range has speech, or without a table.
    """
    z = with_speech(all_zones(_clean_rows(clean)).filter("ord.k = 1"), speech)
    return z.select("recording_id", F.col("ord.seq").alias("ord_seq"), "start", "end", "reason")


def gap_ranges(clean: DataFrame, recordings: DataFrame) -> DataFrame:
    """recording_id, start, end of the gaps for which segment_gaps() and edge_gaps() want to know whether they have speech."""
    return all_zones(_clean_rows(clean), recordings).filter("ask").select("recording_id", "start", "end").distinct()


def edge_gaps(clean: DataFrame, recordings: DataFrame | None = None, speech: DataFrame | None = None) -> DataFrame:
    """Zones at a recording's start, and (with recordings and speech) at its end."""
    z = all_zones(_clean_rows(clean), recordings if speech is not None else None).filter("ord.k > 1")
    return with_speech(z, speech).select("recording_id", "start", "end", "reason")


def verdicts(segments: DataFrame, low_conf: float = 0.45, texts: bool = True) -> DataFrame:
    """What the tests say of each segment, in their order: hallucination, too short, repeat, low confidence. Without its words.

    recording_id, seq, start, end, removed (why, null: kept), text (of removed ones; not without texts), detail, zone_reason, first_score,
    last_score. Zones and kept rows need no texts: without them, they aren't joined with what the search for repeats has found.
    The row tests are written once: the searches for repeats read them three more times, and must not search the texts again.
    """
    f = flag(segments)
    first, last = _edge_scores(F.col("words"))
    f = f.select(
        "recording_id", "seq", "start", "end", "text", "hallucination", "short", first.alias("first_score"), last.alias("last_score"),
        T.low_confidence_flag(F.col("avg_logprob"), F.col("words"), low_conf).alias("low"),
    )
    f = written(f, "flagged")
    rest = suppress_repeats(f.filter("hallucination is null and not short"))
    gone = f.filter("hallucination is not null or short").withColumn("is_repeat", F.lit(None).cast("boolean"))
    why = F.when(F.col("hallucination").isNotNull(), "hallucination").when(F.col("short"), "too_short").when(F.col("is_repeat"), "duplicate")
    v = rest.unionByName(gone).withColumn("removed", why)
    zone = F.when(F.col("removed") == "hallucination", "hallucination").when(F.col("removed").isNull(), F.col("low"))
    return v.select(
        "recording_id", "seq", "start", "end", "removed", *([F.when(F.col("removed").isNotNull(), F.col("text")).alias("text")] if texts else []),
        F.col("hallucination").alias("detail"), zone.alias("zone_reason"), "first_score", "last_score",
    )


def problem_zones(told: DataFrame, recordings: DataFrame | None = None, speech: DataFrame | None = None, audio: DataFrame | None = None, **sizes) -> DataFrame:
    """Merged zones from verdicts(): its own, those of gaps and of edges (at the end: with recordings and speech or audio)."""
    rows = told.withColumn("kept", F.col("removed").isNull())
    asked = recordings if speech is not None or audio is not None else None
    return merge_zones(with_speech(all_zones(rows, asked), speech, audio, **sizes))


def kept_rows(segments: DataFrame, told: DataFrame) -> DataFrame:
    """The segments that verdicts() has kept."""
    return segments.join(told.filter("removed is null").select("recording_id", "seq"), ["recording_id", "seq"], "left_semi").select(*segments.columns)


def removed_rows(told: DataFrame) -> DataFrame:
    """recording_id, seq, reason, text, time, detail of what verdicts() has removed."""
    return told.filter("removed is not null").select(
        "recording_id", "seq", F.col("removed").alias("reason"), "text", F.format_string("%.1fs", "start").alias("time"), "detail"
    )


def detect_problem_zones(
    segments: DataFrame, low_conf: float = 0.45, recordings=None, speech=None, audio=None, told: DataFrame | None = None, **sizes
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(clean, zones, removed). All three come from verdicts(segments), which is written once unless it is given as `told`.

    With audio (and recordings), the gaps that need speech are looked up in the sample chunks. The zones are computed at once (see
    merge_zones); who doesn't want them takes kept_rows() or removed_rows().
    """
    told = written(verdicts(segments, low_conf), "verdicts") if told is None else told
    return kept_rows(segments, told), problem_zones(told, recordings, speech, audio, **sizes), removed_rows(told)


def removal_counts(removed: DataFrame, raw: DataFrame | None = None) -> DataFrame:
    """Per recording and reason the number of removed rows; with the raw segments also n_removed and n_raw of the recording."""
    n = removed.groupBy("recording_id", "reason").agg(F.count("*").alias("n"))
    if raw is None:
        return n
    n = n.withColumn("n_removed", F.sum("n").over(W.partitionBy("recording_id")))
    return n.join(raw.groupBy("recording_id").agg(F.count("*").alias("n_raw")), "recording_id", "left")


def plan_pass2_windows(zones: DataFrame, recordings: DataFrame, pad: float = 4.0, min_len: float = 0.3, sr: int = 16000) -> DataFrame:
    """Padded windows in [0, duration] of at least min_len, with their sample ranges."""
    z = zones.join(recordings.select("recording_id", "duration"), "recording_id")
    z = z.withColumn("w_start", F.greatest(F.lit(0.0), F.col("start") - pad)).withColumn("w_end", F.least(F.col("duration"), F.col("end") + pad))
    return z.filter(F.col("w_end") - F.col("w_start") >= min_len).select(
        "recording_id", "zone_id", "w_start", "w_end",
        F.floor(F.col("w_start") * sr).alias("first_sample"), F.floor(F.col("w_end") * sr).alias("last_sample"),
    )


def placeholder_segments(zones: DataFrame) -> DataFrame:
    text = F.format_string("[неразборчиво — %.1fс]", F.col("end") - F.col("start"))
    return zones.select(
        "recording_id", "zone_id", F.round("start", 3).alias("start"), F.round("end", 3).alias("end"), text.alias("text"),
        F.lit("UNKNOWN").alias("speaker"), F.lit(True).alias("is_placeholder"),
    )


def recover(candidates: DataFrame, windows: DataFrame) -> DataFrame:
    """Good second-pass candidates at their place in the recording (rel_start and rel_end count from the window).

    A zone with an error (candidates may have the column) has none.
    """
    if "error" in candidates.columns:
        candidates = candidates.join(_failed(candidates), ["recording_id", "zone_id"], "left_anti")
    good = candidates.filter(T.hallucination_reason(F.col("text"), F.col("avg_logprob"), F.col("no_speech_prob")).isNull())
    good = good.join(windows.select("recording_id", "zone_id", "w_start"), ["recording_id", "zone_id"])
    return good.select(
        "recording_id", "zone_id", F.round(F.col("rel_start") + F.col("w_start"), 3).alias("start"),
        F.round(F.col("rel_end") + F.col("w_start"), 3).alias("end"), "text", "avg_logprob", "no_speech_prob",
    )


def _failed(candidates: DataFrame) -> DataFrame:
    """recording_id, zone_id, error of the zones whose second pass failed."""
    return candidates.filter("error is not null").groupBy("recording_id", "zone_id").agg(F.min("error").alias("error"))


def pass2_log(zones: DataFrame, good: DataFrame, candidates: DataFrame | None = None, windows: DataFrame | None = None) -> DataFrame:
    """Per zone: label, status, number of good candidates (good: recording_id, zone_id of each).

    candidates: a table with an error column, whose zones get the status `error: ` and 50 characters. windows: those of
    plan_pass2_windows; zones without one weren't tried and have no row.
    """
    keys = ["recording_id", "zone_id"]
    if windows is not None:
        zones = zones.join(windows.select(*keys), keys, "left_semi")
    n = good.groupBy(*keys).agg(F.count("*").alias("n"))
    z = zones.join(n, keys, "left").withColumn("n", F.coalesce("n", F.lit(0)))
    status = F.when(F.col("n") > 0, "recovered").otherwise("unrecognized_silence")
    if candidates is not None:
        z = z.join(_failed(candidates), keys, "left").withColumn("n", F.when(F.col("error").isNull(), F.col("n")).otherwise(0))
        status = F.when(F.col("error").isNotNull(), F.concat(F.lit("error: "), F.substring("error", 1, 50))).otherwise(status)
    place = lambda c: F.round(c, 1)  # noqa: E731  by itself, the format makes -0.0 of -0.04
    return z.select("recording_id", "zone_id", F.format_string("%.1f-%.1f", place("start"), place("end")).alias("zone"), status.alias("status"), "n")


def pass2_counts(log: DataFrame, merged: DataFrame | None = None, raw: DataFrame | None = None) -> DataFrame:
    """Per recording: zones recovered and not, good candidates; with the merged result also its n_placeholders and n_segments,
    with the raw segments n_raw. A recording that only some of the tables have counts 0 in the others."""
    out = log.groupBy("recording_id").agg(
        F.count_if(F.col("status") == "recovered").alias("recovered"), F.count_if(F.col("status") != "recovered").alias("not_recovered"), F.sum("n").alias("n")
    )
    more = []
    if merged is not None:
        more.append(merged.groupBy("recording_id").agg(F.count_if("is_placeholder").alias("n_placeholders"), F.count("*").alias("n_segments")))
    if raw is not None:
        more.append(raw.groupBy("recording_id").agg(F.count("*").alias("n_raw")))
    for counts in more:
        out = out.join(counts, "recording_id", "full")
    return out.fillna(0, [c for c in out.columns if c != "recording_id"])


def cut_words(near: Column, words: Column, margin: float, whole: bool = True) -> Column:
    """A struct of a row: timed (it has words, all of them timed), cut (it is timed, and its ranges reach into some words, when widened by
    margin), runs: what is left of the words of a row that is cut, as structs (run, start, end, text, words if whole)."""
    run = f"struct<run:int,start:double,end:double,text:string{f',words:{WORDS}' if whole else ''}>"

    @F.arrow_udf(f"struct<timed:boolean,cut:boolean,runs:array<{run}>>")
    def find(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for ranges, said in batches:
            (m, r), (n, w) = arrays.flat(ranges), arrays.flat(said)
            rows, place = np.arange(len(ranges)), arrays.places(n)
            row, start, end = np.repeat(rows, n), arrays.doubles(w, "start"), arrays.doubles(w, "end")
            untimed = pc.or_(pc.struct_field(w, "start").is_null(), pc.struct_field(w, "end").is_null()).to_numpy(zero_copy_only=False)
            timed = (n > 0) & (np.bincount(row[untimed], minlength=len(rows)) == 0)
            hit = hits(start, end, row, arrays.doubles(r, "start") - margin, arrays.doubles(r, "end") + margin, np.repeat(rows, m))
            cut = timed & (np.bincount(row[hit], minlength=len(rows)) > 0)
            left = ~hit & cut[row]
            begins = left & ((place == 0) | np.append(False, hit[:-1])[: len(hit)])
            used = np.flatnonzero(left)
            runs = arrays.pieces(
                arrays.with_speakers(w, pc.struct_field(w, "speaker").cast(pa.string())).take(pa.array(used)), np.searchsorted(used, np.flatnonzero(begins)), whole,
                run=pa.array(place[begins].astype(np.int32)),
            )
            told = arrays.relist(np.bincount(row[begins], minlength=len(rows)), runs, pa.array(~cut))
            yield pa.StructArray.from_arrays([pa.array(timed), pa.array(cut), told], ["timed", "cut", "runs"])

    return find.asNondeterministic()(near, words)  # it isn't, but so Spark neither repeats it nor moves it into another expression


def merge_pass2(clean: DataFrame, recovered: DataFrame, margin: float = 0.4, cover: float = 0.15, raw: DataFrame | None = None, words: bool = True) -> DataFrame:
    """Clean segments without what the second pass has replaced, and its segments, by start; seq is new.

    A recording without recovered segments keeps all of its own. Recovered rows of one start are put in order of their zone, end
    and text. The ranges come to the segments (see near_ranges), so that words are cut where they lie; the rows are written once before
    they are numbered. raw: the segments that clean is a part of; with it, what made clean runs once. words: whether the rows keep their words.
    """
    kept = [c for c in clean.columns if c != "near" and (words or c != "words")]
    s = near_ranges(clean, recovered, ["start", "end"], margin, raw=raw)
    near = F.coalesce("near", F.array().cast("array<struct<start:double,end:double>>"))
    s = s.withColumn("near", near).withColumn("left", cut_words(F.col("near"), F.col("words"), margin, words))
    shared = lambda r: F.round((F.least("end", r["end"]) - F.greatest("start", r["start"])) * 1000).cast("long")
    ms = F.aggregate("near", F.lit(0).cast("long"), lambda a, r: a + F.greatest(F.lit(0).cast("long"), shared(r)))
    covered = ms / 1000 / F.greatest(F.lit(0.01), F.col("end") - F.col("start"))
    s = s.filter(F.col("left.timed") | (covered < cover))
    s = s.select(*kept, F.col("left.cut").alias("cut"), F.explode_outer("left.runs").alias("r")).filter(~F.col("cut") | (F.col("r").isNotNull() & ~T.punct_only(F.col("r.text"))))
    new = {"start": F.round("r.start", 3), "end": F.round("r.end", 3)} | {c: F.col(f"r.{c}") for c in ("text", *(["words"] if words else []))}
    columns = [c for c in kept if c != "seq"]
    own = [F.when(F.col("cut"), new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in columns]
    own = s.select(*own, F.lit(0).alias("source"), F.col("seq").alias("old"), F.coalesce("r.run", F.lit(0)).alias("run"))
    more = recovered.select(*[c for c in recovered.columns if c in columns], F.lit(1).alias("source"), *([F.col("zone_id").alias("old")] if "zone_id" in recovered.columns else []))
    rows = written(own.unionByName(more, allowMissingColumns=True), "merged")  # the numbering below reads it twice
    return renumber(rows, "start", "source", "old", "run", "end", "text").drop("source", "old", "run")
