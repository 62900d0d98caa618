"""Job: stage-2 segments to clean segments, removed rows and problem zones.

    python -m utterlake.jobs.clean_up 'in/*/s2.json' out [recordings.parquet audio.parquet]

With recordings and sample chunks, gaps and edges count as zones where there is speech.
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession

from utterlake.operators.clean import detect_problem_zones, verdicts
from utterlake.sources.files import read_audio_chunks, read_stage_json, write_stage


def clean(segments: DataFrame, out: str, version: str = "11", recordings: DataFrame | None = None, audio: DataFrame | None = None, **sizes) -> None:
    """sizes: what speech_in_range() takes (sr and so on)."""
    verdicts(segments).write.mode("overwrite").parquet(f"{out}/verdicts")  # all three results read it
    told = segments.sparkSession.read.parquet(f"{out}/verdicts")
    kept, zones, removed = detect_problem_zones(segments, told=told, recordings=recordings, audio=audio, **sizes)
    write_stage(kept, f"{out}/segments", 3, version)
    zones.write.mode("overwrite").parquet(f"{out}/zones")
    removed.write.mode("overwrite").parquet(f"{out}/removed")


def run(spark: SparkSession, source: str, out: str, recordings: str | None = None, audio: str | None = None, version: str = "11", **sizes) -> None:
    tables = {"recordings": spark.read.parquet(recordings), "audio": read_audio_chunks(spark, audio)} if recordings and audio else {}
    clean(read_stage_json(spark, source, 2).drop("version"), out, version, **tables, **sizes)


if __name__ == "__main__":
    run(SparkSession.builder.getOrCreate(), *sys.argv[1:5])
