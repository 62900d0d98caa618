"""What the training-data operators share: tables, the shared folder, bounded training samples."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: The six white-space characters that separate words in every contract here (bytes.split() splits on the same six).
SPACES = " \t\n\x0b\x0c\r"

#: Rows in an Arrow batch. Texts can be long, so that the default of 10,000 rows is too much for a worker's memory.
BATCH_ROWS = 512
#: Bytes in an Arrow batch. One longer row is a batch of its own.
BATCH_BYTES = 32 * 1024 * 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS, size: int = BATCH_BYTES) -> None:
    """Bound the Arrow batches of the session's Python operators, by rows and by bytes.

    Spark reads both settings when a query starts, so that they can't be put back here; they are only ever lowered.
    """
    for name, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows), ("spark.sql.execution.arrow.maxBytesPerBatch", size)):
        now = spark.conf.get(name, None)
        number = int(now) if now and now.lstrip("-").isdigit() else 0
        if number <= 0 or number > most:
            spark.conf.set(name, str(most))


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder's name below the cluster's shared folder (spark.checkpoint.dir), with its file system's name in front.

    Only a local session (as in tests) may go without the setting; a temporary folder is set there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='utterlake-')}"
        spark.sparkContext.setCheckpointDir(base)
    path, system = _file_system(spark, f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return system.makeQualified(path).toString()


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


#: Paths of the tables that finished() deletes when it is done, innermost call last.
_SCRATCH: list[list[str]] = []


#: Bytes in a row group of a table of long rows.
GROUP_BYTES = 8 * 1024 * 1024


def stored(df: DataFrame, name: str, long_rows: bool = False) -> DataFrame:
    """Write df to the shared folder and read it back: lineage is cut and nothing is computed twice.

    long_rows: rows can have megabytes. Parquet looks at a row group's size after 100 rows only, and a row group is held whole by its
    writer and its reader; with this, its size is looked at after each row, so that a task holds a few rows, however many it has.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    group = {"parquet.block.size": GROUP_BYTES, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1}
    df.write.options(**(group if long_rows else {})).parquet(path)
    if _SCRATCH:
        _SCRATCH[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


def finished(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """stored(make()); the tables that make() has stored on its way are deleted afterwards."""
    _SCRATCH.append([])
    try:
        df = make()
    finally:
        between = _SCRATCH.pop()
    out = stored(df, name)
    for path in between:
        where, system = _file_system(spark, path)
        system.delete(where, True)
    return out


def crc_bucket(doc_id: Column, n: int) -> Column:
    """crc32(doc_id as text) mod n; a null id counts as remainder 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % n, F.lit(0))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, train: Column, max_rows: int, max_chars: int, max_total: int = 16_000_000
) -> list[tuple[str, int]]:
    """At most max_rows labelled texts, half of each label, for fitting a model on the driver.

    Rows are taken in order of a hash of doc_id. train: which rows of labels may be learned from. The bounds are parameters: max_rows
    rows, only texts of at most max_chars characters, and of these the first max_total characters' worth; scoring has no such
    bounds. Null ids, labels and texts don't train. Repeated ids are one row (the least text, the greater label) before anything is collected.
    """
    own = (
        labels.select(F.col("doc_id"), F.col(label).cast("int").alias("y"))
        .filter(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & train)
        .groupBy("doc_id")
        .agg(F.max("y").alias("y"))
        .withColumn("o", F.xxhash64("doc_id"))
    )
    halves = [own.filter(F.col("y") == y).orderBy("o", "doc_id").limit(max_rows // 2) for y in (0, 1)]
    chosen = halves[0].unionByName(halves[1])  # max_rows small rows: broadcast
    texts = (
        docs.select("doc_id", "text")
        .filter(F.col("text").isNotNull() & (F.length("text") <= max_chars))
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"), F.first("y").alias("y"), F.first("o").alias("o"))
    )
    so_far = F.sum(F.length("text")).over(Window.orderBy("o", "doc_id"))  # max_rows rows of max_chars at most
    rows = texts.withColumn("so_far", so_far).filter(F.col("so_far") <= max_total).select("doc_id", "text", "y").collect()
    return [(r.text, r.y) for r in sorted(rows, key=lambda r: r.doc_id)]
