"""A run that can be stopped and started: each transcript file is processed once, and a repaired one after all.

A stream finds new files; its checkpoint remembers their names. A file that can't be read (corrupt or cut off) goes into a quarantine
table with its identity: path, time and length. Each run begins with a retry: files of the quarantine whose identity has changed since are
read again, as a batch of their own. A file that the ledger has isn't taken again, whoever entered it. A file of no bytes is no file
to Spark's readers, but the stream remembers its name: writers should fill files elsewhere and move them in.

Each batch reads its files once, into a table of one row a file; rows, ledger and quarantine come from that table, so that a
file that changes meanwhile is either good or bad in all of them. Replays write the same places again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from utterlake.operators.worklist import pending_files
from utterlake.sources.files import DEFAULTS, append_ledger, parsed_stage, read_ledger, read_table

QUARANTINE = "path string, modified timestamp, length bigint, batch string"
IDENTITY = ("path", "modified", "length")


def _identified(df: DataFrame, *more: str) -> DataFrame:
    m = "_metadata"
    return df.select(F.col(f"{m}.file_path").alias("path"), F.col(f"{m}.file_modification_time").alias("modified"), F.col(f"{m}.file_size").alias("length"), *more)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, QUARANTINE)


class Intake:
    """What becomes of a batch of files: rows of `job` below out_dir, entries in the ledger or in the quarantine."""

    def __init__(self, out_dir: str, ledger: str, quarantine: str, job: Callable[[DataFrame], DataFrame], stage: int):
        self.out_dir, self.ledger, self.quarantine, self.job, self.stage = out_dir, ledger, quarantine, job, stage

    def take(self, files: DataFrame, name: str) -> None:
        """files: path, modified, length, value (the whole text). name: the batch's folder; taken again, its own entries don't count."""
        spark = files.sparkSession
        fresh = pending_files(files, read_ledger(spark, self.ledger, but=name))
        segments, ok = parsed_stage(F.col("value"), self.stage)
        staged = f"{self.out_dir}/_staged/{name}"
        fresh.select(*IDENTITY, ok.alias("ok"), F.when(ok, segments).alias("segments")).write.mode("overwrite").parquet(staged)
        read = spark.read.parquet(staged)
        good, bad = read.filter("ok"), read.filter("not ok")
        rows = good.select(F.col("path").alias("recording_id"), F.posexplode("segments").alias("seq", "s"))
        rows = rows.select("recording_id", F.col("seq").cast("long").alias("seq"), "s.*").fillna(DEFAULTS)
        self.job(rows).write.mode("overwrite").parquet(f"{self.out_dir}/{name}")
        held = read_quarantine(spark, self.quarantine).filter(F.col("batch") == name).select(*IDENTITY)
        bad.select(*IDENTITY).join(held, list(IDENTITY), "left_anti").withColumn("batch", F.lit(name)).write.mode("append").parquet(self.quarantine)
        append_ledger(good.select("path").distinct(), self.ledger, name)

    def retry(self, spark: SparkSession, in_dir: str) -> int | None:
        """Read the quarantine's files again that have changed, and those of a retry that was lost on the way; its number, if there was any.

        What a retry is about to take is written first (a plan), so that a lost one is taken again as a whole. Only names go through
        the driver, as in any listing.
        """
        plans = read_table(spark, f"{self.quarantine}-plans", "path string, plan int")
        number = plans.agg(F.max("plan")).first()[0]
        seen = read_quarantine(spark, self.quarantine)
        listed = _identified(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(in_dir), F.col("path").alias("file"))
        if number is not None:
            own = plans.filter(F.col("plan") == number).select("path").distinct()
            left = own.join(read_ledger(spark, self.ledger).withColumnRenamed("key", "path"), "path", "left_anti")
            left = left.join(seen.filter(F.col("batch") == f"query=retry/batch={number}"), "path", "left_anti")
            if not left.isEmpty():
                self._take_again(spark, listed.join(own, "path", "left_semi"), number)
        changed = listed.join(seen.select("path").distinct(), "path", "left_semi").join(read_quarantine(spark, self.quarantine).select(*IDENTITY), list(IDENTITY), "left_anti")
        changed = pending_files(changed, read_ledger(spark, self.ledger))
        if changed.isEmpty():
            return number
        number = 0 if number is None else number + 1
        plan = changed.select("path").withColumn("plan", F.lit(number))
        plan.write.mode("append").parquet(f"{self.quarantine}-plans")
        own = read_table(spark, f"{self.quarantine}-plans", "path string, plan int").filter(F.col("plan") == number)
        self._take_again(spark, listed.join(own, "path", "left_semi"), number)
        return number

    def _take_again(self, spark: SparkSession, listed: DataFrame, number: int) -> None:
        paths = [r.file for r in listed.select("file").collect()]
        if paths:
            self.take(_identified(spark.read.option("wholetext", True).text(paths), "value"), f"query=retry/batch={number}")


def incremental_ingest(
    spark: SparkSession, in_dir: str, out_dir: str, ledger: str, checkpoint: str, job: Callable[[DataFrame], DataFrame], stage: int = 2, quarantine: str | None = None
) -> StreamingQuery:
    """Take new stage files from in_dir, run `job` on their segments, write to out_dir, and enter the files in the ledger.

    A batch writes out_dir/query=ID/batch=N, where ID is the checkpoint's own (or `retry`), and enters its files under that name afterwards.
    When a batch is replayed (a crash before its commit), its own entries don't count, so that it writes the same rows to the same
    folder again. All readable files of a batch are entered, also those of which the job leaves no row; the others go to the
    quarantine (by default beside the ledger).
    """
    intake = Intake(out_dir, ledger, quarantine or f"{ledger}-quarantine", job, stage)
    if not read_quarantine(spark, intake.quarantine).isEmpty():
        intake.retry(spark, in_dir)
    raw = _identified(spark.readStream.format("text").option("wholetext", True).load(in_dir), "value")

    def batch(df: DataFrame, number: int) -> None:
        query = df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        intake.take(df, f"query={query}/batch={number}")

    return raw.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
