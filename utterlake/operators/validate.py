"""What the other operators expect of a table of segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def violations(segments: DataFrame) -> DataFrame:
    """recording_id, seq, rule: one row for each rule that a segment breaks; none for a table as it should be.

    no_time (start or end is null), ends_early (before its start), goes_back (starts before the last row with a start), repeated_seq
    (a row before has the same seq). One pass, partitioned by recording; words aren't read.
    """
    w = W.partitionBy("recording_id").orderBy("seq", "start", "end")
    start, end = F.col("start"), F.col("end")
    before = F.last("start", True).over(w.rowsBetween(W.unboundedPreceding, -1))
    rules = {
        "no_time": start.isNull() | end.isNull(), "ends_early": end < start,
        "goes_back": start < before, "repeated_seq": F.col("seq").eqNullSafe(F.lag("seq").over(w)) & (F.row_number().over(w) > 1),
    }
    told = segments.select("recording_id", "seq", "start", "end").select(
        "recording_id", "seq", F.array(*[F.when(broken, F.lit(rule)) for rule, broken in rules.items()]).alias("rules")
    )
    return told.select("recording_id", "seq", F.explode(F.array_compact("rules")).alias("rule"))
