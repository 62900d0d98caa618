"""Readers and writers: stage files, media listings, the ledger, transcripts, audio chunks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from utterlake.sources.derived import WORD

SEGMENT = (
    "start double, end double, text string, avg_logprob double, no_speech_prob double, speaker string, is_placeholder boolean, "
    f"words array<{WORD}>"
)
#: The array that holds a stage's segments, by stage.
ARRAYS = {2: "segments", 3: "segments_merged", 4: "all_segments", 5: "segments"}
#: Columns that are absent from older files get these values.
DEFAULTS = {"avg_logprob": 0.0, "no_speech_prob": 0.0, "is_placeholder": False}


def stage_schema(stage: int) -> str:
    typed = ", ".join(f"{c.split(' ', 1)[0]}:{c.split(' ', 1)[1]}" for c in SEGMENT.split(", "))
    return f"{ARRAYS[stage]} array<struct<{typed}>>, n_raw bigint, audio_duration double, version string, _corrupt string"


def parsed_stage(text: Column, stage: int) -> tuple[Column, Column]:
    """(the segments of a stage file's whole text, whether it can be read). Empty and corrupt files, and such without the array, can't."""
    told = F.from_json(text, stage_schema(stage), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    return told[ARRAYS[stage]], F.coalesce(told["_corrupt"].isNull() & told[ARRAYS[stage]].isNotNull(), F.lit(False))


def read_stage_json(spark: SparkSession, path: str, stage: int) -> DataFrame:
    """recording_id (the file's path), seq, the segment's fields, version. Corrupt files count as missing.

    path may be a glob: names that begin with _ are found only by an explicit one.
    """
    raw = (
        spark.read.schema(stage_schema(stage)).option("multiLine", True).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt").json(path).withColumn("recording_id", F.input_file_name())
    )
    rows = raw.filter(F.col("_corrupt").isNull() & F.col(ARRAYS[stage]).isNotNull())
    rows = rows.select("recording_id", "version", F.posexplode(ARRAYS[stage]).alias("seq", "s"))
    return rows.select("recording_id", F.col("seq").cast("long").alias("seq"), "s.*", "version").fillna(DEFAULTS)


def read_stage_files(spark: SparkSession, path: str, stage: int) -> DataFrame:
    """One row per file: recording_id (the file's path), version, n_raw, audio_duration, n_segments, and readable (false: corrupt or empty)."""
    raw = spark.read.option("wholetext", True).text(path).withColumn("recording_id", F.input_file_name())
    told = F.from_json("value", stage_schema(stage), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    files = raw.select("recording_id", told.alias("t"), parsed_stage(F.col("value"), stage)[1].alias("readable"))
    n = F.when(F.col("readable"), F.size(f"t.{ARRAYS[stage]}")).cast("long")
    return files.select("recording_id", "t.version", "t.n_raw", "t.audio_duration", n.alias("n_segments"), "readable")


def write_stage(df: DataFrame, path: str, stage: int, version: str) -> None:
    """Write one stage's rows; other stages in path stay."""
    df.drop("stage").withColumn("version", F.lit(version)).write.mode("overwrite").parquet(f"{path}/stage={stage}")  # there even without rows


def list_media_files(spark: SparkSession, root: str) -> DataFrame:
    """path, name, size of all files below root (contents are not read). Spark's listing leaves out names that begin with _."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    path = F.regexp_replace("path", "^file:/+", "/")
    return found.select(path.alias("path"), F.substring_index("path", "/", -1).alias("name"), F.col("length").alias("size"))


def found_path(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table that jobs append to; a missing one is empty, columns that older parts lack are null."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_json_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The keys of a file like {"transcribed": ["path or name", ...]}; a missing, empty or broken one has none."""
    if not found_path(spark, path):
        return spark.createDataFrame([], "key string")
    told = F.from_json("value", "transcribed array<string>")["transcribed"]
    return spark.read.option("wholetext", True).text(path).select(F.explode(told).alias("key")).filter("key is not null").distinct()


def read_ledger(spark: SparkSession, path: str, but: str | None = None) -> DataFrame:
    """The distinct keys of finished files, without those that only the batch `but` has entered; a missing ledger is empty.

    path: a table of append_ledger(), or (by its ending) a JSON file as in read_json_ledger().
    """
    if path.endswith(".json"):
        return read_json_ledger(spark, path)
    entries = read_table(spark, path, "key string, batch string")
    if but is not None:
        entries = entries.filter(~F.col("batch").eqNullSafe(F.lit(but)))
    return entries.select("key").distinct()


def append_ledger(done: DataFrame, path: str, batch: str | None = None) -> None:
    """Add the paths of finished files, and the archives they came from (column from_zip, if there), as entered by `batch`."""
    keys = done.select(F.col("path").alias("key"))
    if "from_zip" in done.columns:
        keys = keys.unionByName(done.filter("from_zip is not null").select(F.col("from_zip").alias("key")).distinct())
    keys.withColumn("batch", F.lit(batch).cast("string")).write.mode("append").parquet(path)


def write_transcript(lines: DataFrame, path: str, buckets: int = 256, form: str = "parquet") -> None:
    """One text per recording, in buckets of recordings: a table (recording_id, text), or with form="text" a folder for each
    recording (name=...) with its lines as a text file."""
    bucket = F.pmod(F.xxhash64("recording_id"), F.lit(buckets)).alias("bucket")
    if form == "text":
        rows = lines.select("line", "line_no", bucket, F.col("recording_id").cast("string").alias("name"))
        dealt = rows.repartition("bucket", "name").sortWithinPartitions("bucket", "name", "line_no")
        dealt.select("line", "bucket", "name").write.mode("overwrite").partitionBy("bucket", "name").text(path)
        return
    told = F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"])
    texts = lines.groupBy("recording_id").agg(F.array_join(told, "\n").alias("text"))
    texts.withColumn("bucket", bucket).write.mode("overwrite").partitionBy("bucket").parquet(path)


def read_audio_chunks(spark: SparkSession, path: str) -> DataFrame:
    """recording_id (a string or a number, as the files have it), chunk_idx, sample_offset, samples."""
    found = spark.read.parquet(path).schema
    kind = found["recording_id"].dataType.simpleString() if "recording_id" in found.names else "bigint"
    return spark.read.schema(f"recording_id {kind}, chunk_idx bigint, sample_offset bigint, samples array<float>").parquet(path)


def audio_durations(audio: DataFrame, sr: int = 16000) -> DataFrame:
    return audio.groupBy("recording_id").agg((F.sum(F.size("samples")) / sr).alias("duration"))
