"""Job: what queue, manifest and ledger leave to do, from stage-2 files to transcripts.

    python -m utterlake.jobs.batch 'in/*/s2.json' turns.parquet recordings.parquet manifest.parquet ledger.parquet out name [candidates.parquet [audio.parquet]]
"""

from __future__ import annotations

import sys
import time
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from utterlake.jobs import clean_up, second_pass, speakers, transcript
from utterlake.operators.worklist import latest_stage_status, pending_files, plan_stages, skip_reason
from utterlake.sources.files import append_ledger, found_path, read_audio_chunks, read_ledger, read_stage_files, read_stage_json, read_table

VERSIONS = {2: "6", 3: "11"}
MANIFEST = "recording_id string, stage int, status string, version string, ts timestamp, seconds double, error string, batch string"


def read_manifest(spark: SparkSession, path: str, but: str) -> DataFrame:
    """The manifest's rows without those of the run `but`; a missing manifest is empty."""
    return read_table(spark, path, MANIFEST).filter(~F.col("batch").eqNullSafe(F.lit(but)))


def _entries(df: DataFrame, name: str) -> DataFrame:
    """Rows of the manifest from recording_id, stage, status and perhaps version, seconds, error."""
    none = {"version": "string", "seconds": "double", "error": "string"}
    df = df.withColumns({c: F.lit(None).cast(t) for c, t in none.items() if c not in df.columns} | {"ts": F.current_timestamp(), "batch": F.lit(name)})
    return df.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in MANIFEST.split(", ")])


def left_out(found: DataFrame, recordings: DataFrame, min_duration: float) -> DataFrame:
    """recording_id, stage, status, error of the files that can't be read (failed) and of recordings that aren't worth it (skipped)."""
    broken = found.filter("not readable").select("recording_id", F.lit(2).alias("stage"), F.lit("failed").alias("status"), F.lit("unreadable stage file").alias("error"))
    known = found.filter("readable").join(recordings.select("recording_id", "duration"), "recording_id", "left")
    known = known.withColumn("duration", F.coalesce("duration", "audio_duration", F.lit(float("inf")))).withColumn("n_raw", F.least(F.coalesce("n_raw", "n_segments"), F.col("n_segments")))
    skips = skip_reason(known, min_duration).filter("skip_reason is not null")
    return broken.unionByName(skips.select("recording_id", F.lit(3).alias("stage"), F.lit("skipped").alias("status"), F.col("skip_reason").alias("error")))


#: Where a run keeps the rows of a stage that later stages start from.
KEPT = {2: "stage2", 3: "merged/segments/stage=3"}


def redo(spark: SparkSession, manifest: DataFrame, out: str, versions: dict[int, str]) -> DataFrame:
    """recording_id, base, run, void: what the manifest has voided or never had, and the stored stage that it is redone from.

    base 2: stage 3 and later ones, from the stage-2 rows that `run` has kept; base 3: later ones only, from its stage-3 rows; null: a
    stage 2 of the wrong version (void), which only a new file mends. Runs whose rows are gone are no base. The driver sees the names of runs.
    """
    last = latest_stage_status(manifest).filter("status = 'done'").select("recording_id", "stage", F.col("batch").alias("run"))
    plan = plan_stages(manifest, versions).filter(F.size("stages") > 0).withColumn("void", F.array_contains("stages", 2))
    base = F.when(F.array_contains("stages", 3) & ~F.col("void"), 2).when(~F.array_contains("stages", 3) & ~F.col("void"), 3)
    plan = plan.withColumn("base", base).drop("stages")
    runs = [r.run for r in last.filter("run is not null").select("run").distinct().collect()]
    there = [(k, r) for k, where in KEPT.items() for r in runs if found_path(spark, f"{out}/run={r}/{where}")]
    kept = last.join(spark.createDataFrame(there, "stage int, run string"), ["stage", "run"], "left_semi")
    bound = plan.filter("base is not null").join(kept.withColumnRenamed("stage", "base"), ["recording_id", "base"])
    void = plan.filter("void").join(last.filter("stage = 2").select("recording_id"), "recording_id", "left_semi")
    return bound.select("recording_id", "base", "run", "void").unionByName(void.select("recording_id", "base", F.lit(None).cast("string").alias("run"), "void"))


def kept_rows(spark: SparkSession, out: str, work: DataFrame, stage: int) -> DataFrame | None:
    """The stored rows of a stage for the recordings of `work` that start from it; None: there are none."""
    mine = work.filter(F.col("base") == stage).select("recording_id", "run")
    runs = [r.run for r in mine.select("run").distinct().collect()]
    if not runs:
        return None
    rows = spark.read.option("mergeSchema", True).parquet(*[f"{out}/run={r}/{KEPT[stage]}" for r in runs])
    run_of = F.regexp_extract(F.url_decode(F.col("_metadata.file_path")), f"/run=([^/]+)/{KEPT[stage]}/[^/]+$", 1)
    rows = rows.withColumn("run", run_of).join(mine, ["recording_id", "run"], "left_semi")
    return rows.drop("run", "stage", "version")


def _together(*parts: DataFrame | None) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [p for p in parts if p is not None])


def run(
    spark: SparkSession, source: str, turns: str, recordings: str, manifest: str, ledger: str, out: str, name: str, candidates: str | None = None, audio: str | None = None,
    min_duration: float = 0.0, versions: dict[int, str] | None = None, **sizes,
) -> bool:
    """Stages 3 to 5 and the transcripts of all recordings that aren't finished, below out/run=name.

    A recording is left to the recogniser if its stage-2 file has another version; it is finished if the ledger has its file, and
    with nothing to redo by the manifest if that knows it. What the manifest has done with other versions is redone, whatever
    the ledger says, from the last stage that still holds (see redo()): a new version of stage 3 starts from the stage-2 rows
    that an earlier run has kept, without its file. A run that was lost is started again under its name: what it has entered
    itself doesn't count, so that it does the same work and writes to the same place; nothing counts before the manifest has its
    entries, which are appended at once. False: nothing was left to do.

    candidates: the second pass's table; without one, placeholders stand for the zones. audio: sample chunks, in which gaps and edges
    are looked up. Files that can't be read are `failed` in the manifest and recordings shorter than min_duration seconds or without a
    segment `skipped`, with the reason as error: once, until that changes; they are tried again in each run and never enter the
    ledger. seconds are those of the stage for the whole run.
    """
    own, versions = f"{out}/run={name}", versions or VERSIONS
    found = read_stage_files(spark, source, 2)
    found.write.mode("overwrite").parquet(f"{own}/found")
    found = spark.read.parquet(f"{own}/found")
    rest = left_out(found, spark.read.parquet(recordings), min_duration)
    before = read_manifest(spark, manifest, name)
    last = latest_stage_status(before).filter("status in ('skipped', 'failed')").select("recording_id", "stage", "status", "error")
    left = pending_files(rest.withColumnRenamed("recording_id", "path"), read_ledger(spark, ledger, but=name)).withColumnRenamed("path", "recording_id")
    left.write.mode("overwrite").parquet(f"{own}/left_out")
    left = spark.read.parquet(f"{own}/left_out")
    left.join(last, ["recording_id", "stage", "status", "error"], "left_anti").write.mode("overwrite").parquet(f"{own}/news")
    news = _entries(spark.read.parquet(f"{own}/news"), name)

    again = redo(spark, before, out, versions).join(left.select("recording_id"), "recording_id", "left_anti")
    again.write.mode("overwrite").parquet(f"{own}/again")
    again = spark.read.parquet(f"{own}/again")
    files = found.filter((F.col("version") == versions[2]) & F.col("readable")).join(left.select("recording_id"), "recording_id", "left_anti").select("recording_id").distinct()
    files = files.join(again.filter("base is not null").select("recording_id"), "recording_id", "left_anti")
    new = pending_files(files.withColumnRenamed("recording_id", "path"), read_ledger(spark, ledger, but=name)).withColumnRenamed("path", "recording_id")
    whole = plan_stages(before, versions).filter(F.size("stages") == 0)
    new = new.join(whole.select("recording_id"), "recording_id", "left_anti")
    new = new.unionByName(files.join(again.filter("void").select("recording_id"), "recording_id", "left_semi")).distinct()
    work = new.select("recording_id", F.lit(0).alias("base"), F.lit(None).cast("string").alias("run")).unionByName(again.filter("base is not null").drop("void"))
    work.write.mode("overwrite").parquet(f"{own}/todo")  # every later step works on these
    work = spark.read.parquet(f"{own}/todo")
    if work.isEmpty():
        if not news.isEmpty():
            news.write.mode("append").parquet(manifest)
        return False
    bases, took = {r.base for r in work.select("base").distinct().collect()}, {2: None}
    only = lambda df, which="true": df.join(work.filter(which).select("recording_id"), "recording_id", "left_semi")

    began, read = time.time(), None
    if 0 in bases:
        only(read_stage_json(spark, source, 2), "base = 0").write.mode("overwrite").parquet(f"{own}/stage2")
        read = spark.read.parquet(f"{own}/stage2").drop("version")
    only(spark.read.parquet(recordings)).write.mode("overwrite").parquet(f"{own}/recordings")
    merged = None
    if bases & {0, 2}:
        heard = {"recordings": spark.read.parquet(f"{own}/recordings"), "audio": only(read_audio_chunks(spark, audio), "base < 3")} if audio else {}
        clean_up.clean(_together(read, kept_rows(spark, out, work, 2)), f"{own}/cleaned", versions[3], **heard, **sizes)
        second = None
        if candidates:
            second = f"{own}/candidates"
            only(spark.read.parquet(candidates), "base < 3").write.mode("overwrite").parquet(second)
        second_pass.run(spark, f"{own}/cleaned", f"{own}/merged", second, f"{own}/recordings", version=versions[3])
        merged = spark.read.parquet(f"{own}/{KEPT[3]}").drop("version")
    took[3], began = time.time() - began, time.time()
    speakers.label(_together(merged, kept_rows(spark, out, work, 3)), spark.read.parquet(turns), f"{own}/labelled")
    took[4] = took[5] = time.time() - began
    transcript.run(spark, f"{own}/labelled", f"{own}/recordings", own)

    stages = F.explode(F.array(*[F.struct(F.lit(k).alias("stage"), F.lit(versions.get(k)).cast("string").alias("version"), F.lit(s).cast("double").alias("seconds")) for k, s in took.items()]))
    done = work.select("recording_id", "base", stages.alias("s")).filter(F.col("s.stage") > F.col("base"))
    done = done.select("recording_id", "s.stage", F.lit("done").alias("status"), "s.version", "s.seconds")
    _entries(done, name).unionByName(news).write.mode("append").parquet(manifest)
    append_ledger(pending_files(work.select(F.col("recording_id").alias("path")), read_ledger(spark, ledger, but=name)), ledger, name)
    return True


if __name__ == "__main__":
    run(SparkSession.builder.getOrCreate(), *sys.argv[1:10])
