"""Job: segments and speaker turns to speaker-labelled segments.

    python -m utterlake.jobs.speakers segments.parquet turns.parquet out
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession

from utterlake.operators.speakers import speaker_pipeline


def label(segments: DataFrame, turns: DataFrame, out: str) -> None:
    speaker_pipeline(segments, turns).write.mode("overwrite").parquet(out)


def run(spark: SparkSession, segments: str, turns: str, out: str) -> None:
    label(spark.read.parquet(segments), spark.read.parquet(turns), out)


if __name__ == "__main__":
    run(SparkSession.builder.getOrCreate(), *sys.argv[1:4])
