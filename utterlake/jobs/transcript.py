"""Job: labelled segments to readable transcripts and speaker statistics.

    python -m utterlake.jobs.transcript segments.parquet recordings.parquet out
"""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from utterlake.operators.report import paragraphs, transcript_lines
from utterlake.operators.speakers import speaker_share, speaker_stats
from utterlake.sources.files import write_transcript


def run(spark: SparkSession, segments: str, recordings: str, out: str) -> None:
    s = spark.read.parquet(segments)
    write_transcript(transcript_lines(paragraphs(s), spark.read.parquet(recordings)), f"{out}/transcripts")
    speaker_share(speaker_stats(s)).write.mode("overwrite").parquet(f"{out}/speakers")


if __name__ == "__main__":
    run(SparkSession.builder.getOrCreate(), *sys.argv[1:4])
