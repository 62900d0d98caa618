"""Job: what clean_up wrote, and the second pass over its zones, to merged stage-3 segments, a log and counts.

    python -m utterlake.jobs.second_pass cleaned out [candidates.parquet recordings.parquet]

Without candidates, placeholders stand for the zones.
"""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from utterlake.operators.clean import merge_pass2, pass2_counts, pass2_log, placeholder_segments, plan_pass2_windows, recover
from utterlake.sources.files import write_stage


def run(spark: SparkSession, cleaned: str, out: str, candidates: str | None = None, recordings: str | None = None, version: str = "11") -> None:
    clean = spark.read.parquet(f"{cleaned}/segments").filter("stage = 3").drop("stage", "version")
    zones = spark.read.parquet(f"{cleaned}/zones")
    if candidates is None:
        write_stage(merge_pass2(clean, placeholder_segments(zones)), f"{out}/segments", 3, version)
        return
    heard = spark.read.parquet(candidates)
    windows = plan_pass2_windows(zones, spark.read.parquet(recordings))
    recover(heard, windows).write.mode("overwrite").parquet(f"{out}/recovered")  # the log and the merge read it
    good = spark.read.parquet(f"{out}/recovered")
    write_stage(merge_pass2(clean, good), f"{out}/segments", 3, version)
    pass2_log(zones, good, heard, windows).write.mode("overwrite").parquet(f"{out}/log")
    merged = spark.read.parquet(f"{out}/segments").filter("stage = 3")
    pass2_counts(spark.read.parquet(f"{out}/log"), merged).write.mode("overwrite").parquet(f"{out}/counts")


if __name__ == "__main__":
    run(SparkSession.builder.getOrCreate(), *sys.argv[1:5])
