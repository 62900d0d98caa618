"""Labels, blocks, paragraphs and the readable transcript."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from utterlake.functions import scan
from utterlake.functions import text as T
from utterlake.functions.fold import ordered_fold
from utterlake.functions.store import written

PREFIX = "Спикер"


def speaker_labels(segments: DataFrame, prefix: str = PREFIX) -> DataFrame:
    """Segments with text, and `label`: speakers numbered by their first appearance."""
    said = segments.filter(T.strip(F.coalesce("text", F.lit(""))) != "")
    named = (F.coalesce("speaker", F.lit("")) != "") & (F.col("speaker") != "UNKNOWN") & ~F.coalesce("is_placeholder", F.lit(False))
    first = said.filter(named).groupBy("recording_id", "speaker").agg(F.min("seq").alias("first"))
    number = F.row_number().over(W.partitionBy("recording_id").orderBy("first"))
    first = first.select("recording_id", F.col("speaker").alias("who"), F.concat(F.lit(f"{prefix} "), number.cast("string")).alias("label"))
    own = said.withColumn("who", F.when(named, F.col("speaker")))
    return own.join(first, ["recording_id", "who"], "left").withColumn("label", F.coalesce("label", F.lit(f"{prefix} ?"))).drop("who")


def speaker_blocks(labelled: DataFrame) -> DataFrame:
    """labelled with block_id: consecutive segments of one label. labelled is evaluated twice."""
    return scan.numbered_runs(labelled, ["label"], lambda a, b: a["label"] != b["label"], ["seq"], "block_id")


def _pack(max_sec: float, max_chars: int):
    """State: (number, start, characters) of the open paragraph of a chain; the verdict is the paragraph's number."""

    def step(state, start, end, n):
        if state is not None and end - state[1] <= max_sec and state[2] + n <= max_chars:
            return (state[0], state[1], state[2] + 1 + n), state[0]
        k = 0 if state is None else state[0] + 1
        return (k, start, n), k

    return step


def paragraphs(segments: DataFrame, split_pause: float = 2.5, max_sec: float = 45.0, max_chars: int = 450, prefix: str = PREFIX) -> DataFrame:
    """recording_id, block_id, par_id, label, start, text.

    A change of label or a long pause to the row before is a barrier; between barriers a fold packs greedily, over times and
    lengths only; texts are joined afterwards. Barriers and paragraphs are numbered by bins of a recording; the rows and the
    paragraphs are written once each, as both the numbering and the fold read them again. Rows without a recording_id are left out.
    """
    s = speaker_labels(segments, prefix).withColumn("text", T.strip(F.col("text")))
    s = s.withColumn("start", F.coalesce("start", F.lit(0.0)))
    s = s.withColumn("end", F.when(F.coalesce("end", F.lit(0.0)) == 0, F.col("start")).otherwise(F.col("end")))
    s = written(s.select("recording_id", "seq", "start", "end", "label", "text", F.length("text").alias("n")), "labelled")
    parts = lambda a, b: (a["label"] != b["label"]) | ~(b["start"] - a["end"] <= split_pause)
    s = scan.numbered_runs(s, ["label", "start", "end"], parts, ["seq"], "chain")
    k = ordered_fold(s, ["recording_id", "chain"], ["seq"], ["start", "end", "n"], _pack(max_sec, max_chars), "k long")
    s = s.join(k.select("recording_id", "seq", "k"), ["recording_id", "seq"])
    told = F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda x: x["text"])
    p = s.groupBy("recording_id", "chain", "k").agg(F.first("label").alias("label"), F.min_by("start", "seq").alias("start"), F.array_join(told, " ").alias("text"))
    p = written(p, "paragraphs")
    p = scan.running_sum(p, F.lit(1), ["chain", "k"], "n").withColumn("par_id", F.col("n") - 1)
    p = scan.numbered_runs(p, ["label"], lambda a, b: a["label"] != b["label"], ["chain", "k"], "block_id")
    return p.select("recording_id", "block_id", "par_id", "label", "start", "text")


def transcript_lines(pars: DataFrame, recordings: DataFrame) -> DataFrame:
    """recording_id, line_no, line: the file's name, then a label line per block and a timed line per paragraph."""
    name = recordings.select("recording_id", F.lit(-1).cast("long").alias("block_id"), F.lit(-1).cast("long").alias("par_id"), F.lit(0).alias("k"), F.substring_index("path", "/", -1).alias("line"))
    heads = pars.groupBy("recording_id", "block_id").agg(F.min("par_id").alias("par_id"), F.first("label").alias("label"))
    heads = heads.select("recording_id", "block_id", "par_id", F.lit(0).alias("k"), F.concat("label", F.lit(":")).alias("line"))
    body = pars.select("recording_id", "block_id", "par_id", F.lit(1).alias("k"), F.concat(T.fmt_hms(F.col("start")), F.lit(" - "), "text").alias("line"))
    w = W.partitionBy("recording_id").orderBy("block_id", "par_id", "k")
    lines = name.unionByName(heads).unionByName(body)
    return lines.select("recording_id", (F.row_number().over(w) - 1).cast("long").alias("line_no"), "line")
