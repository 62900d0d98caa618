"""Transcript-shaped tables, derived from the given tables by whole-number arithmetic."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from utterlake.functions import arrays

WORD = "struct<word:string,start:double,end:double,score:double,speaker:string>"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cs(c) -> F.Column:
    """Centiseconds to seconds."""
    return (F.col(c) if isinstance(c, str) else c) / F.lit(100).cast("double")


def segment_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments in centiseconds."""
    lines = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("recording_id"), F.split("text", "\n", -1).alias("l"))
    r = lines.select("recording_id", F.element_at("l", 1).alias("first"), F.posexplode_outer("l").alias("seq", "line")).filter("seq is not null")
    r = r.withColumn("seq", F.col("seq").cast("long"))
    i, s = F.col("recording_id"), F.col("seq")
    m, p = (i + 3 * s) % 23, (7 * i + 13 * s) % 11
    text = (
        F.when(m == 0, "Спасибо за просмотр").when(m == 1, "...").when(m.isin(2, 4), "угу").when(m == 3, "Угу").when(m == 5, "да")
        .when(m == 6, F.col("first")).when(m == 7, F.concat("first", F.lit(" ok"))).otherwise(F.col("line"))
    )
    pause = F.when(p == 0, 350 + (i + s) % 5 * 1400).when(p.isin(1, 2), 120).otherwise(20).cast("long")
    r = r.select("recording_id", "seq", text.alias("text"), pause.alias("pause_cs"))
    r = r.withColumn("dur_cs", F.least(F.lit(3000), F.greatest(F.lit(10), 6 * F.length("text"))).cast("long"))
    w = W.partitionBy("recording_id").orderBy("seq").rowsBetween(W.unboundedPreceding, 0)
    r = r.withColumn("end_cs", F.sum(F.col("pause_cs") + F.col("dur_cs")).over(w))
    return r.withColumn("start_cs", F.col("end_cs") - F.col("dur_cs"))


def _words_of():
    """A vectorised helper: a segment's keys, times and text to its words, made column-wise for a batch of rows."""

    @F.arrow_udf(f"array<{WORD}>")
    def make(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        whole = lambda x: x.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        cents = lambda x: np.rint(x.fill_null(0.0).to_numpy(zero_copy_only=False) * 100).astype(np.int64)
        for recording, seq, start, end, text in batches:
            n, word = arrays.flat(pc.split_pattern(text, " "))
            i, s, k = np.repeat(whole(recording), n), np.repeat(whole(seq), n), arrays.places(n)
            begin, dur, many = np.repeat(cents(start), n), np.repeat(cents(end) - cents(start), n), np.repeat(n, n)
            at = begin + dur * k // many
            score = np.fmod(3 * i + 5 * s + 7 * k, 100) / 100
            score = pa.array(score, mask=np.fmod(i + s + k, 17) == 0)
            till = (at + np.maximum(1, 3 * dur // (4 * many))) / 100
            words = pa.StructArray.from_arrays([word, pa.array(at / 100), pa.array(till), score, pa.nulls(len(at), pa.string())], ["word", "start", "end", "score", "speaker"])
            yield arrays.relist(n, words, text.is_null())

    return make.asNondeterministic()  # it isn't, but so Spark neither repeats it nor moves it into another expression


def with_words(rows: DataFrame) -> DataFrame:
    """segments() without words, with them: what joins or sorts segments can do so while they are texts only."""
    return rows.withColumn("words", _words_of()("recording_id", "seq", "start", "end", "text"))


def segments(spark: SparkSession, sf_dir: str, words: bool = True) -> DataFrame:
    """recording_id, seq, start, end, text, avg_logprob, no_speech_prob, speaker, is_placeholder, words."""
    r = segment_rows(spark, sf_dir)
    i, s = F.col("recording_id"), F.col("seq")
    r = r.select(
        "recording_id", "seq", cs("start_cs").alias("start"), cs("end_cs").alias("end"), "text",
        cs(-((31 * i + 17 * s) % 140)).alias("avg_logprob"), cs((11 * i + 29 * s) % 100).alias("no_speech_prob"),
        F.when((5 * i + 3 * s) % 13 != 0, F.concat(F.lit("SPEAKER_0"), ((i + F.floor(s / 2)) % 3).cast("string"))).alias("speaker"),
        F.lit(False).alias("is_placeholder"),
    )
    return with_words(r) if words else r


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = segment_rows(spark, sf_dir).groupBy("recording_id").agg(F.max("end_cs").alias("m"))
    t = last.select("recording_id", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("m") / 700))).alias("k"))
    at = 700 * F.col("k") + 50 * (F.col("recording_id") % 3)
    speaker = F.concat(F.lit("SPEAKER_0"), ((F.col("k") * F.col("k") + F.col("recording_id")) % 3).cast("string"))
    return t.select("recording_id", cs(at).alias("start"), cs(at + 800).alias("end"), speaker.alias("speaker"))


def recovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = segment_rows(spark, sf_dir).filter("seq % 5 = 2")
    i, s = F.col("recording_id"), F.col("seq")
    return r.select(
        "recording_id", cs(F.col("start_cs") + 30).alias("start"), cs(F.col("end_cs") + 40).alias("end"),
        F.concat("text", F.lit(" (2)")).alias("text"), cs(-((13 * i + 7 * s) % 130)).alias("avg_logprob"),
        F.floor(s / 5).alias("zone_id"),
    )


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second-pass candidates: times count from their zone's window; every 19th has an error instead."""
    r = segment_rows(spark, sf_dir).filter("seq % 5 = 2")
    i, s = F.col("recording_id"), F.col("seq")
    at, failed = 30 + i % 7 * 10, (i + s) % 19 == 0
    return r.select(
        "recording_id", F.floor(s / 5).alias("zone_id"), cs(at).alias("rel_start"), cs(at + F.col("dur_cs")).alias("rel_end"),
        F.when(~failed, F.concat("text", F.lit(" (2)"))).alias("text"), cs(-((13 * i + 7 * s) % 130)).alias("avg_logprob"),
        cs((3 * i + s) % 100).alias("no_speech_prob"), F.when(failed, F.concat(F.lit("the model ran out of memory while it read the chunk "), s.cast("string"))).alias("error"),
    )


def recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = segment_rows(spark, sf_dir).groupBy("recording_id").agg(F.max("end_cs").alias("m"), F.count("*").alias("n_raw"))
    path = F.concat(F.lit("/Transcribe/rec"), F.col("recording_id").cast("string"), F.lit(".mp4"))
    return r.select("recording_id", path.alias("path"), cs(F.col("m") + 1000).alias("duration"), "n_raw", cs(F.col("m") * 7).alias("elapsed"))


def audio_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen samples a second, 64 to a chunk."""
    e = read(spark, sf_dir, "embeddings").select(F.col("label").cast("long").alias("recording_id"), "vec_id", "embedding")
    e = e.withColumn("chunk_idx", (F.row_number().over(W.partitionBy("recording_id").orderBy("vec_id")) - 1).cast("long"))
    by = F.when(F.col("chunk_idx") % 3 == 0, F.lit(0.01)).otherwise(F.lit(1.0))
    samples = F.transform("embedding", lambda x: x.cast("double") * by)
    return e.select("recording_id", "chunk_idx", (64 * F.col("chunk_idx")).alias("sample_offset"), samples.alias("samples"))


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("page_id")
    folder = F.when(i % 7 == 0, "/_results").when(i % 7 == 1, "/a/b").when(i % 7 == 2, "/1/2/3/4/5/6").when(i % 7 == 3, "/a/_x/y").otherwise("")
    ext = F.when(i % 9 == 0, ".MP4").when(i % 9 == 1, ".txt").when(i % 9 == 2, ".zip").when(i % 9 == 3, ".mov").when(i % 9 == 4, "").when(i % 9 == 5, ".webm").otherwise(".mp4")
    path = F.concat(F.lit("/Transcribe"), folder, F.lit("/rec"), (i % 40).cast("string"), ext)
    f = read(spark, sf_dir, "pages").select(path.alias("path"), (1000 * i).alias("size"), (i % 5 == 0).alias("done"))
    return f.withColumn("name", F.substring_index("path", "/", -1))


def stage_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, i = read(spark, sf_dir, "events"), F.col("event_id")
    status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "view", "skipped").otherwise("done")
    stage = (2 + i % 5).cast("int")
    version = F.when(stage == 2, F.when(i % 4 == 0, "5").otherwise("6")).when(stage == 3, F.when(i % 3 == 0, "10").otherwise("11"))
    return e.select(
        F.col("user_id").alias("recording_id"), stage.alias("stage"), status.alias("status"), version.alias("version"), "ts",
        F.col("value").alias("seconds"), i.alias("event_id"),
    )


#: The same tables as DuckDB's WITH clauses.
SQL = """
raw AS (SELECT recording_id, l[1] AS first, unnest(l) AS line, generate_subscripts(l, 1) - 1 AS seq
        FROM (SELECT doc_id AS recording_id, string_split(text, chr(10)) AS l FROM documents)),
seg0 AS (SELECT recording_id, seq, CASE (recording_id + 3 * seq) % 23 WHEN 0 THEN 'Спасибо за просмотр' WHEN 1 THEN '...' WHEN 2 THEN 'угу'
             WHEN 4 THEN 'угу' WHEN 3 THEN 'Угу' WHEN 5 THEN 'да' WHEN 6 THEN first WHEN 7 THEN first || ' ok' ELSE line END AS text,
             CASE (7 * recording_id + 13 * seq) % 11 WHEN 0 THEN 350 + (recording_id + seq) % 5 * 1400 WHEN 1 THEN 120 WHEN 2 THEN 120 ELSE 20 END AS pause_cs
         FROM raw),
seg1 AS (SELECT *, least(3000, greatest(10, 6 * length(text))) AS dur_cs FROM seg0),
seg2 AS (SELECT *, CAST(sum(pause_cs + dur_cs) OVER (PARTITION BY recording_id ORDER BY seq) AS BIGINT) AS end_cs FROM seg1),
segments AS (SELECT recording_id, seq, text, dur_cs, end_cs, end_cs - dur_cs AS start_cs,
             CAST(end_cs - dur_cs AS DOUBLE) / 100 AS "start", CAST(end_cs AS DOUBLE) / 100 AS "end",
             CAST(-((31 * recording_id + 17 * seq) % 140) AS DOUBLE) / 100 AS avg_logprob,
             CAST((11 * recording_id + 29 * seq) % 100 AS DOUBLE) / 100 AS no_speech_prob,
             CASE WHEN (5 * recording_id + 3 * seq) % 13 <> 0 THEN 'SPEAKER_0' || CAST((recording_id + seq // 2) % 3 AS VARCHAR) END AS speaker
             FROM seg2),
words AS (SELECT recording_id, seq, i AS word_idx, word, CAST(t_at AS DOUBLE) / 100 AS "start",
          CAST(t_at + greatest(1, (3 * dur_cs) // (4 * nw)) AS DOUBLE) / 100 AS "end",
          CASE WHEN (recording_id + seq + i) % 17 <> 0 THEN CAST((3 * recording_id + 5 * seq + 7 * i) % 100 AS DOUBLE) / 100 END AS score
          FROM (SELECT *, start_cs + (dur_cs * i) // nw AS t_at FROM
                (SELECT recording_id, seq, dur_cs, start_cs, len(p) AS nw, unnest(p) AS word, generate_subscripts(p, 1) - 1 AS i
                 FROM (SELECT *, string_split(text, ' ') AS p FROM segments)))),
turns AS (SELECT recording_id, CAST(t_at AS DOUBLE) / 100 AS "start", CAST(t_at + 800 AS DOUBLE) / 100 AS "end", speaker FROM
          (SELECT recording_id, 700 * k + 50 * (recording_id % 3) AS t_at, 'SPEAKER_0' || CAST((k * k + recording_id) % 3 AS VARCHAR) AS speaker FROM
           (SELECT recording_id, unnest(range(0, max(end_cs) // 700 + 1)) AS k FROM segments GROUP BY recording_id))),
recovered AS (SELECT recording_id, seq, CAST(start_cs + 30 AS DOUBLE) / 100 AS "start", CAST(end_cs + 40 AS DOUBLE) / 100 AS "end", text || ' (2)' AS text,
              CAST(-((13 * recording_id + 7 * seq) % 130) AS DOUBLE) / 100 AS avg_logprob, seq // 5 AS zone_id
              FROM segments WHERE seq % 5 = 2),
candidates AS (SELECT recording_id, seq // 5 AS zone_id, CAST(30 + recording_id % 7 * 10 AS DOUBLE) / 100 AS rel_start, CAST(30 + recording_id % 7 * 10 + dur_cs AS DOUBLE) / 100 AS rel_end,
               CASE WHEN (recording_id + seq) % 19 <> 0 THEN text || ' (2)' END AS text, CAST(-((13 * recording_id + 7 * seq) % 130) AS DOUBLE) / 100 AS avg_logprob,
               CAST((3 * recording_id + seq) % 100 AS DOUBLE) / 100 AS no_speech_prob,
               CASE WHEN (recording_id + seq) % 19 = 0 THEN 'the model ran out of memory while it read the chunk ' || seq END AS error
               FROM segments WHERE seq % 5 = 2),
recordings AS (SELECT recording_id, '/Transcribe/rec' || recording_id || '.mp4' AS path, CAST(max(end_cs) + 1000 AS DOUBLE) / 100 AS duration,
               count(*) AS n_raw, CAST(max(end_cs) * 7 AS DOUBLE) / 100 AS elapsed FROM segments GROUP BY recording_id),
audio AS (SELECT recording_id, chunk_idx, 64 * chunk_idx + i - 1 AS pos, CAST(embedding[i] AS DOUBLE) * CASE WHEN chunk_idx % 3 = 0 THEN 0.01::DOUBLE ELSE 1.0::DOUBLE END AS x
          FROM (SELECT *, unnest(range(1, 65)) AS i FROM (SELECT CAST(label AS BIGINT) AS recording_id, embedding,
                row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS chunk_idx FROM embeddings))),
files AS (SELECT path, size, done, regexp_extract(path, '[^/]*$') AS name FROM (SELECT '/Transcribe'
          || CASE page_id % 7 WHEN 0 THEN '/_results' WHEN 1 THEN '/a/b' WHEN 2 THEN '/1/2/3/4/5/6' WHEN 3 THEN '/a/_x/y' ELSE '' END
          || '/rec' || page_id % 40
          || CASE page_id % 9 WHEN 0 THEN '.MP4' WHEN 1 THEN '.txt' WHEN 2 THEN '.zip' WHEN 3 THEN '.mov' WHEN 4 THEN '' WHEN 5 THEN '.webm' ELSE '.mp4' END AS path,
          1000 * page_id AS size, page_id % 5 = 0 AS done FROM pages)),
manifest AS (SELECT user_id AS recording_id, CAST(2 + event_id % 5 AS INTEGER) AS stage,
             CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'skipped' ELSE 'done' END AS status,
             CASE 2 + event_id % 5 WHEN 2 THEN CASE WHEN event_id % 4 = 0 THEN '5' ELSE '6' END WHEN 3 THEN CASE WHEN event_id % 3 = 0 THEN '10' ELSE '11' END END AS version,
             ts, value AS seconds, event_id FROM events)
"""
