"""Job: the rules that stage files break, with the number of rows and of recordings of each.

    python -m utterlake.jobs.validate 'in/*/s2.json' out
"""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from utterlake.operators.validate import violations
from utterlake.sources.files import read_stage_json


def run(spark: SparkSession, source: str, out: str, stage: int = 2) -> None:
    violations(read_stage_json(spark, source, stage)).write.mode("overwrite").parquet(f"{out}/violations")
    found = spark.read.parquet(f"{out}/violations").groupBy("rule", "recording_id").agg(F.count("*").alias("n"))
    counts = found.groupBy("rule").agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_recordings"))
    counts.write.mode("overwrite").parquet(f"{out}/counts")


if __name__ == "__main__":
    run(SparkSession.builder.getOrCreate(), *sys.argv[1:3])
