"""The file queue, the ledger of finished files, and the stage manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from utterlake.functions.store import written
from utterlake.functions.text import file_parts

EXTENSIONS = ("mp4", "mov", "avi", "mkv", "webm", "m4v", "zip")


def _below(path: F.Column, folder: str) -> F.Column:
    """Whether a path lies below a folder, by whole names: /a/b is no part of /a/bc."""
    return F.startswith(path, F.lit(folder.rstrip("/") + "/"))


def media_filter(files: DataFrame, root: str, max_depth: int | None = 5, work_dir: str | None = None, hidden: bool = False) -> DataFrame:
    """Wanted extensions, at most max_depth folders below root, none of which starts with _ (unless hidden); with is_zip.

    A scan of local folders leaves out what lies below work_dir, and has no other rule: max_depth=None, hidden=True.
    """
    p, path = file_parts(F.col("path")), F.col("path")
    folders = F.filter(F.split(F.substr(p["folder"], F.lit(len(root.rstrip("/")) + 1)), "/"), lambda x: x != "")
    ok = _below(path, root) & p["ext"].isin(*EXTENSIONS)
    if max_depth is not None:
        ok = ok & (F.size(folders) <= max_depth)
    if not hidden:
        ok = ok & ~F.exists(folders, lambda x: F.startswith(x, F.lit("_")))
    if work_dir:
        ok = ok & ~_below(path, work_dir)
    return files.filter(ok).withColumn("is_zip", p["ext"] == "zip")


def pending_files(files: DataFrame, ledger: DataFrame, by: str = "path", skip_done: bool = True) -> DataFrame:
    """files whose path (by='path'), or neither name nor path ('name_or_path'), is in the ledger's keys."""
    if not skip_done:
        return files
    done = ledger.select("key").distinct()
    out = files.join(done.withColumnRenamed("key", "path"), "path", "left_anti")
    if by == "name_or_path":
        out = out.join(done.withColumnRenamed("key", "name"), "name", "left_anti")
    return out.select(*files.columns)


def queue_limit(files: DataFrame, max_videos: int = 0) -> DataFrame:
    """The first by name and path; 0: all."""
    return files.orderBy("name", "path").limit(max_videos) if max_videos else files


def queue_preview(files: DataFrame, n: int = 20) -> DataFrame:
    """The first n names, with the number of all."""
    total = files.agg(F.count("*").alias("total"))
    return files.orderBy("name", "path").limit(n).select("name", "path").join(F.broadcast(total))  # one row


def _rank(df: DataFrame, keys: list[str], at: str, order: list[str], size: int = 4096) -> DataFrame:
    """df with rank (from 1) among the rows of the same keys by `order`, whose first column is the number `at`: rows are counted in bins
    of `size` numbers, and only the bins, a row each, meet in a window over the keys. df is evaluated twice."""
    binned = df.withColumn("__bin", F.floor(F.col(at) / size))
    ahead = W.partitionBy(*keys).orderBy("__bin").rowsBetween(W.unboundedPreceding, -1)
    bins = binned.groupBy(*keys, "__bin").agg(F.count("*").alias("n")).select(*keys, "__bin", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("__before"))
    own = F.row_number().over(W.partitionBy(*keys, "__bin").orderBy(*order))
    return binned.withColumn("rank", own).join(bins, [*keys, "__bin"]).withColumn("rank", F.col("rank") + F.col("__before")).drop("__bin", "__before")


def unique_names(files: DataFrame) -> DataFrame:
    """files with unique_name: same names become base_1.ext, base_2.ext, ...; numbers that real names use are skipped.

    Files are dealt to ranges of (name, path), so that a name of any number of files lies on all tasks; the k-th of a name counts those
    of the ranges before its own. Its number is k plus the used ones below it: of the used numbers u1 < u2 < ..., ui has ui - i
    free ones before it, so that these are the i with ui - i < k. Both are counted in bins. Files without a name stay so.
    """
    p = file_parts(F.col("name"))
    dotted = F.when(p["ext"] != "", F.regexp_extract("name", r"(\.[^.]*)$", 1)).otherwise("")
    dealt = written(files.repartitionByRange("name", "path").withColumn("__part", F.spark_partition_id()), "names")
    sizes = dealt.groupBy("name", "__part").agg(F.count("*").alias("n"))
    ahead = W.partitionBy("name").orderBy("__part")
    before = F.coalesce(F.sum("n").over(ahead.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("name", "__part", before.alias("before"), F.sum("n").over(W.partitionBy("name")).alias("all"))
    k = F.row_number().over(W.partitionBy("name", "__part").orderBy("path")) + F.col("before") - 1
    # a join on both keys, so that no task gets all files of a name
    f = dealt.join(sizes, ["name", "__part"]).withColumn("k", k).withColumn("base", F.coalesce(p["stem"], F.lit(""))).withColumn("dotted", F.coalesce(dotted, F.lit("")))

    number = r"^(.+)_([1-9][0-9]{0,17})(\.[^.]*)?$"
    used = dealt.select("name").distinct().select(*[F.regexp_extract("name", number, i).alias(c) for i, c in ((1, "base"), (2, "u"), (3, "dotted"))]).filter("u <> ''")
    several = sizes.filter("all > 1").select("name").distinct().select(p["stem"].alias("base"), dotted.alias("dotted")).distinct()
    used = used.withColumn("u", F.col("u").cast("long")).join(several, ["base", "dotted"], "left_semi")
    used = written(_rank(used, ["base", "dotted"], "u", ["u"]).select("base", "dotted", (F.col("u") - F.col("rank")).alias("k")), "used")
    nameless = dealt.filter("name is null").withColumn("unique_name", F.col("name"))
    return _numbered(f, used).unionByName(nameless, allowMissingColumns=True).select(*files.columns, "unique_name")


def _numbered(f: DataFrame, used: DataFrame, size: int = 4096) -> DataFrame:
    """f (base, dotted, k; k = 0: the name stays) with unique_name; used: base, dotted, k = the free numbers below a used one."""
    rows = f.withColumn("bound", F.lit(0)).unionByName(used.withColumn("bound", F.lit(1)), allowMissingColumns=True).withColumn("__bin", F.floor(F.col("k") / size))
    keys = ["base", "dotted"]
    ahead = W.partitionBy(*keys).orderBy("__bin").rowsBetween(W.unboundedPreceding, -1)
    bins = rows.groupBy(*keys, "__bin").agg(F.sum("bound").alias("n")).select(*keys, "__bin", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("below"))
    # a file comes before an equal bound: only bounds below its k count
    own = F.sum("bound").over(W.partitionBy(*keys, "__bin").orderBy("k", "bound").rowsBetween(W.unboundedPreceding, W.currentRow))
    rows = rows.withColumn("own", own).filter("bound = 0").join(bins, [*keys, "__bin"])
    number = (F.col("k") + F.col("own") + F.col("below")).cast("string")
    return rows.withColumn("unique_name", F.when(F.col("k") == 0, F.col("name")).otherwise(F.concat("base", F.lit("_"), number, "dotted")))


def latest_stage_status(manifest: DataFrame) -> DataFrame:
    """The last write of each (recording_id, stage)."""
    rest = [c for c in manifest.columns if c not in ("recording_id", "stage")]
    last = F.max_by(F.struct(*rest), F.struct("ts", "event_id") if "event_id" in rest else F.col("ts"))
    return manifest.groupBy("recording_id", "stage").agg(last.alias("l")).select("recording_id", "stage", "l.*")


def plan_stages(manifest: DataFrame, versions: dict[int, str] | None = None) -> DataFrame:
    """recording_id and the stages of 2 to 5 to recompute.

    A stage 2 or 3 that is there with the wrong version voids itself and all later ones; an absent one only itself.
    """
    versions = versions or {2: "6", 3: "11"}
    last = latest_stage_status(manifest)
    has = lambda k: F.max(F.when(F.col("stage") == k, F.lit(1)).otherwise(0)) == 1
    bad = lambda k: F.max(F.when((F.col("stage") == k) & ~F.col("version").eqNullSafe(F.lit(versions[k])), 1).otherwise(0)) == 1
    g = last.groupBy("recording_id").agg(*[has(k).alias(f"has{k}") for k in (2, 3, 4, 5)], bad(2).alias("bad2"), bad(3).alias("bad3"))
    need = {2: ~F.col("has2") | F.col("bad2")} | {3: ~F.col("has3") | F.col("bad2") | F.col("bad3")}
    need |= {k: ~F.col(f"has{k}") | F.col("bad2") | F.col("bad3") for k in (4, 5)}
    stages = F.filter(F.array(*[F.when(c, F.lit(k)) for k, c in need.items()]), lambda x: x.isNotNull())
    return g.select("recording_id", stages.alias("stages"))


def skip_reason(recordings: DataFrame, min_duration: float = 30.0) -> DataFrame:
    why = F.when(F.col("duration") < min_duration, "too_short").when(F.col("n_raw") == 0, "no_speech")
    return recordings.select("recording_id", why.alias("skip_reason"))


def rtf_report(recordings: DataFrame) -> DataFrame:
    """elapsed over duration: with a floor of one second, and for the first pass 0 without a duration."""
    floor = F.col("elapsed") / F.greatest(F.col("duration"), F.lit(1.0))
    first = F.when(F.col("duration") > 0, F.col("elapsed") / F.col("duration")).otherwise(0.0)
    return recordings.select("recording_id", floor.alias("rtf"), first.alias("rtf_pass1"))
