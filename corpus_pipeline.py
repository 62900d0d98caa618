"""The training-corpus pipeline: rules, toxicity, near-duplicates, personal data, packing.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is written and
read again as the next one's docs. All but the last return the columns of documents (others that docs has are kept).

Defined cases: a null text counts as empty, and the quality rules reject it; of rows that repeat a kept doc_id and its
words one stays, different texts of one doc_id are different documents; rows without a doc_id stay where no kept document has their words; an empty table stays empty;
very long texts are read whole by every stage; other columns that docs has are carried along by all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from utterlake.llm import near_dup, packing, pii, quality_rules, toxicity
from utterlake.llm.common import finished, small_batches, stored, table


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules (operator 9) keep."""
    small_batches(spark)
    trees = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    return docs.filter(quality_rules.verdict(F.col("text"), trees)["kept"])


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier (operator 2) doesn't predict to be toxic."""
    small_batches(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return docs.filter(toxicity.score(F.col("text"), model) < 0.5)


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (operator 1): the one with the least doc_id."""
    key = {"doc_id": "__id", "node": "__node"}
    kept = stored(near_dup.representatives(docs).withColumnsRenamed(key), "kept")
    node = near_dup.node_column(F.col("text"))
    named = docs.withColumns({"__id": F.col("doc_id").cast("long"), "__node": F.coalesce(node, near_dup.node_column(F.lit("")))})
    one = named.join(kept, ["__id", "__node"], "left_semi").dropDuplicates(["__id", "__node"]).drop("__id", "__node")
    if docs.filter("doc_id is null").isEmpty():
        return one
    texts = stored(one.select(node.alias("__node")).distinct(), "nodes")
    rest = docs.filter("doc_id is null").withColumn("__node", node).join(texts, "__node", "left_anti").drop("__node")
    return one.unionByName(rest)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with each span of personal data (operator 7) replaced by its kind; n_chars follows."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")  # names can't clash
    read = docs.select(row, F.coalesce("text", F.lit("")).alias("text"))
    found = pii.with_candidates(read, "text")
    weights = pii.fit(stored(found.select("base", "wide"), "spans"))
    text = pii.redacted(F.col("text"), pii.all_spans(weights))
    new = {"text": F.col("clean")} | ({"n_chars": F.length("clean").cast("long")} if "n_chars" in docs.columns else {})
    return found.select("row", text.alias("clean")).select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in packed sequences (operator 5)."""
    return packing.best_fit_packing(docs)


STAGES = [
    ("quality rules", rules_stage),
    ("toxicity", toxicity_stage),
    ("near-duplicates", near_dup_stage),
    ("personal data", pii_stage),
    ("packing", packing_stage),
]

#: SQL can't express the fitted models and the tokeniser.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = finished(spark, lambda: stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
