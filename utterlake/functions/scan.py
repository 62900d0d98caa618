"""Prefix scans: running sums, greatest values, neighbours and runs in a recording's order, without a task that holds the recording.

A recording's rows are dealt to bins of their order (a range of seq, or of time). Each bin is summed up to one row; the summaries,
one row a bin, are scanned in one window; what a bin takes over from those before it (or after it) becomes a seed row at its
beginning (or end), and a window over (recording, bin) does the rest. So the rows are evaluated twice: who gives a table that is dear
to compute writes it first (store.written).

Rows without an order value are the first bin. Null recordings are a recording of their own, as in a window.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W
from pyspark.sql.window import WindowSpec

#: Rows (by seq) and seconds (by start) of a bin.
SEQ_BIN, SEC_BIN = 4096, 3600.0
KEY, BIN, PLACE, OWN, FIRST, LAST, INNER = "recording_id", "__bin", "__place", "__own", "__first", "__last", "__inner"
START, DATA, END = 0, 1, 2


def bin_of(df: DataFrame, by: str, size: float | None = None) -> Column:
    """The bin of a row by its first order column: seconds if that is a double, numbers of rows otherwise."""
    real = dict(df.dtypes)[by] in ("double", "float")
    size = size or (SEC_BIN if real else SEQ_BIN)
    value = F.when(~F.isnan(by), F.col(by)).otherwise(F.lit(1e18)) if real else F.col(by)  # NaN is greater than all
    return F.coalesce(F.when(F.col(by).isNotNull(), F.floor(value / size).cast("long")), F.lit(-(2**63)).cast("long"))


def binned(df: DataFrame, by: str, size: float | None = None) -> DataFrame:
    return df.withColumn(BIN, bin_of(df, by, size)).withColumn(PLACE, F.lit(DATA))


def in_bin(order: list[str]) -> WindowSpec:
    """A bin's rows in order, between its seeds."""
    return W.partitionBy(KEY, BIN).orderBy(PLACE, *order)


def before_bins() -> WindowSpec:
    return W.partitionBy(KEY).orderBy(BIN).rowsBetween(W.unboundedPreceding, -1)


def after_bins() -> WindowSpec:
    return W.partitionBy(KEY).orderBy(F.desc(BIN)).rowsBetween(W.unboundedPreceding, -1)


def seeded(rows: DataFrame, seeds: DataFrame) -> DataFrame:
    """binned rows with their bins' seeds (KEY, BIN, PLACE and some of the columns; the others are null there)."""
    return rows.unionByName(seeds, allowMissingColumns=True)


def rows_only(df: DataFrame, *more: str) -> DataFrame:
    return df.filter(F.col(PLACE) == DATA).drop(BIN, PLACE, *more)


def running_sum(df: DataFrame, value: Column, order: list[str], name: str, size: float | None = None) -> DataFrame:
    """df with `name`: the sum of value over the recording's rows up to and including this one. Ties of the order are settled by chance."""
    rows = binned(df, order[0], size).withColumn(OWN, value)
    sums = rows.groupBy(KEY, BIN).agg(F.sum(OWN).alias(OWN))
    seeds = sums.select(KEY, BIN, F.lit(START).alias(PLACE), F.sum(OWN).over(before_bins()).alias(OWN)).filter(F.col(OWN).isNotNull())
    so_far = F.sum(OWN).over(in_bin(order).rowsBetween(W.unboundedPreceding, 0))
    return rows_only(seeded(rows, seeds).withColumn(name, so_far), OWN)


def greatest_before(df: DataFrame, value: Column, order: list[str], name: str, size: float | None = None) -> DataFrame:
    """df with `name`: the greatest value of the recording's rows before this one; null at the first."""
    rows = binned(df, order[0], size).withColumn(OWN, value)
    most = rows.groupBy(KEY, BIN).agg(F.max(OWN).alias(OWN))
    seeds = most.select(KEY, BIN, F.lit(START).alias(PLACE), F.max(OWN).over(before_bins()).alias(OWN)).filter(F.col(OWN).isNotNull())
    reach = F.max(OWN).over(in_bin(order).rowsBetween(W.unboundedPreceding, -1))
    return rows_only(seeded(rows, seeds).withColumn(name, reach), OWN)


def numbered_runs(df: DataFrame, values: list[str], breaks: Callable[[Column, Column], Column], order: list[str], name: str, size: float | None = None, before: str | None = None) -> DataFrame:
    """df with `name`: the number of the row's run in its recording, from 0. A run begins at the first row and wherever
    breaks(row before, row) isn't false (both: structs of `values`). before: a name for the row before as a struct of `values`, if wanted.

    A bin's summary is its first and last row and the number of breaks between; that is enough for all bins after it.
    """
    own = F.struct(*values)
    rows = binned(df, order[0], size).withColumn(OWN, own)
    new = lambda before: F.when(before.isNotNull() & ~F.coalesce(breaks(before, F.col(OWN)), F.lit(True)), 0).otherwise(1)
    place = F.struct(*order)
    inner = F.when(F.lag(OWN).over(in_bin(order)).isNotNull(), new(F.lag(OWN).over(in_bin(order)))).otherwise(0)
    told = rows.select(KEY, BIN, PLACE, *dict.fromkeys(order), OWN).withColumn(INNER, inner)
    bins = told.groupBy(KEY, BIN).agg(F.min_by(OWN, place).alias(FIRST), F.max_by(OWN, place).alias(LAST), F.sum(INNER).alias(INNER))
    by_bin = W.partitionBy(KEY).orderBy(BIN)
    opens = F.when(F.lag(LAST).over(by_bin).isNotNull() & ~F.coalesce(breaks(F.lag(LAST).over(by_bin), F.col(FIRST)), F.lit(True)), 0).otherwise(1)
    bins = bins.withColumn("__opens", opens)
    seeds = bins.select(
        KEY, BIN, F.lit(START).alias(PLACE), F.lag(LAST).over(by_bin).alias(OWN), F.sum(F.col(INNER) + F.col("__opens")).over(before_bins()).alias("__runs")
    ).filter(F.col(OWN).isNotNull())
    both = seeded(rows.withColumn("__runs", F.lit(None).cast("long")), seeds)
    begun = F.when(F.col(PLACE) == DATA, new(F.lag(OWN).over(in_bin(order)))).otherwise(F.col("__runs"))
    if before:
        both = both.withColumn(before, F.lag(OWN).over(in_bin(order)))
    both = both.withColumn("__runs", begun).withColumn(name, F.sum("__runs").over(in_bin(order).rowsBetween(W.unboundedPreceding, 0)) - 1)
    return rows_only(both, OWN, "__runs")
