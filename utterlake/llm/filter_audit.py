"""Filter interaction audit: what five document filters take away, alone and after each other, in every order.

Failure conditions: A under MIN_WORDS words; B 100 * distinct words < DISTINCT * words; C 100 * capitals A-Z > CAPITALS * code points;
D holds a character of `[#$%&*|]`; E identical to the text of a smaller doc_id, table-wide.

Relational from end to end. Words are exploded, counted by (document, word) and then by document. The texts are dealt by document once;
both counts need no further exchange. The other flags come from a second, narrow pass and are outer-joined. A document's five flags are
one number from 0 to 31; 32 conditional counts per part (of all documents, of good ones, of toxic ones) hold all that any order of the
filters can ask for, so that the 120 orders are arithmetic on one small row per part.

Rows that repeat a doc_id and its text are counted as one document here and weighed by their number. Of a text's rows only
those of its smallest doc_id aren't duplicates; these are found by an aggregation and an outer join on doc_id, so that no
task holds a group of copies. A hot part is summed before it is shuffled.

Defined cases: a null or empty text has no words (fails A; passes B, C and D) and equals other empty texts; a null doc_id is no smaller
than any and has none smaller, so that it never fails E and never makes another fail; equal doc_ids aren't smaller than each other; a
null source is the part ''; labels of one doc_id count by their greatest value; documents without labels are neither good nor toxic;
very long texts are read whole; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from utterlake.llm.common import table

FILTERS = "ABCDE"
MIN_WORDS, DISTINCT, CAPITALS = 50, 65, 5
MARKS = "[#$%&*|]"
SPACE = r"[ \t\n\x0B\f\r]+"
COUNTS = ("all", "good", "toxic")


def _own(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))


def word_counts(docs: DataFrame) -> DataFrame:
    """doc_id, h (a 64-bit hash that tells texts of one doc_id apart), n_words, n_distinct: one row per document that has words.

    A document is a doc_id and a text: equal ones are one before they are shuffled.
    """
    own = _own(docs).select("doc_id", F.xxhash64("text").alias("h"), "text")
    one = own.groupBy("doc_id", "h").agg(F.first("text").alias("text"))
    words = one.select("doc_id", "h", F.explode(F.split("text", SPACE)).alias("word")).filter("word <> ''")
    each = words.groupBy("doc_id", "h", "word").agg(F.count("*").alias("n"))
    return each.groupBy("doc_id", "h").agg(F.sum("n").alias("n_words"), F.count("*").alias("n_distinct"))


def flagged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, doc_id and text: part, n (rows), failed (bit k: fails the k-th filter), good and toxic (0 or 1)."""
    text = F.col("text")
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    own = _own(docs).select(
        "doc_id", "part", F.xxhash64("text").alias("h"), F.sha2(text, 256).alias("digest"),
        (100 * capitals.cast("long") > CAPITALS * F.length(text)).alias("c"), text.rlike(MARKS).alias("d"),
    ).groupBy("doc_id", "part", "h", "digest", "c", "d").agg(F.count("*").alias("n"))
    first = own.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).filter("doc_id is not null").withColumn("is_first", F.lit(True))
    marks = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        *[F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(name) for c, name in (("quality", "good"), ("toxic", "toxic"))]
    )

    def place(df: DataFrame, *keys: str) -> DataFrame:
        """Rows without a doc_id are dealt by their text; `known` keeps them apart from real ids."""
        return df.select(F.coalesce("doc_id", *keys, F.lit(0)).alias("at"), F.col("doc_id").isNotNull().alias("known"), *[c for c in df.columns if c != "doc_id"])

    rows = place(own, "h").join(place(word_counts(docs), "h"), ["at", "known", "h"], "left")
    rows = rows.join(place(first), ["at", "known", "digest"], "left").join(place(marks), ["at", "known"], "left")
    n_words, n_distinct = F.coalesce("n_words", F.lit(0)), F.coalesce("n_distinct", F.lit(0))
    fails = (n_words < MIN_WORDS, 100 * n_distinct < DISTINCT * n_words, F.col("c"), F.col("d"), F.col("known") & F.col("is_first").isNull())
    failed = sum((F.when(x, 1 << k).otherwise(0) for k, x in enumerate(fails)), F.lit(0))
    return rows.select("part", "n", failed.cast("int").alias("failed"), F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))


def interactions(rows: DataFrame) -> DataFrame:
    """One row per part: for each of all, good and toxic an array of 32 numbers of documents, by their failed filters."""
    only = {"all": F.lit(True), "good": F.col("good") == 1, "toxic": F.col("toxic") == 1}
    count = lambda kind, k: F.sum(F.when((F.col("failed") == k) & only[kind], F.col("n")).otherwise(0)).alias(f"{kind}_{k}")
    cells = rows.groupBy("part", "failed", "good", "toxic").agg(F.sum("n").alias("n"))  # at most 128 rows a part
    sums = cells.groupBy("part").agg(*[count(kind, k) for kind in COUNTS for k in range(32)])
    return sums.select("part", *[F.array(*[F.col(f"{kind}_{k}") for k in range(32)]).alias(kind) for kind in COUNTS])


def _total(numbers: str, ok) -> Column:
    """Sum of those of 32 numbers whose index is ok(index)."""
    each = F.transform(F.col(numbers), lambda x, i: F.when(ok(i), x).otherwise(F.lit(0).cast("long")))
    return F.aggregate(each, F.lit(0).cast("long"), lambda a, x: a + x)


def all_orders(sums: DataFrame) -> DataFrame:
    """interactions() as one row per part, filter_order and step.

    What a step does depends on its filter and the set of those before it: 80 cases, each of which some orders share.
    """
    orders: dict[tuple[int, int], list[str]] = {}
    for order in map("".join, permutations(FILTERS)):
        for j, x in enumerate(order):
            orders.setdefault((1 << FILTERS.index(x), sum(1 << FILTERS.index(y) for y in order[:j])), []).append(order)
    cases = [F.struct(F.lit(own).alias("own"), F.lit(gone).alias("gone"), F.array(*map(F.lit, shared)).alias("orders")) for (own, gone), shared in orders.items()]
    rows = sums.select("part", *COUNTS, F.explode(F.array(*cases)).alias("s")).select("part", *COUNTS, "s.*")
    own, gone = F.col("own"), F.col("gone")
    here = lambda i: (i.bitwiseAND(own) > 0) & (i.bitwiseAND(gone) == 0)
    # of a document's k failed filters each comes first in one k-th of all orders
    share = F.aggregate(
        F.transform("all", lambda x, i: F.when(i.bitwiseAND(own) > 0, x * (120 / F.bit_count(i)).cast("long")).otherwise(F.lit(0).cast("long"))),
        F.lit(0).cast("long"), lambda a, x: a + x,
    )
    told = rows.select(
        "part", "orders", (F.bit_count("gone") + 1).cast("int").alias("step"), _total("all", lambda i: i.bitwiseAND(own.bitwiseOR(gone)) == 0).alias("kept"),
        _total("all", here).alias("removed"), _total("all", lambda i: (i.bitwiseAND(own) > 0) & (i.bitwiseAND(gone) > 0)).alias("redundant"),
        F.get("all", own).alias("unique_fails"), _total("good", here).alias("good_lost"), _total("toxic", here).alias("toxic_lost"), share.alias("shapley"),
    )
    return told.select("part", F.explode("orders").alias("filter_order"), *[c for c in told.columns if c not in ("part", "orders")])


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part (source), order of the five filters and step, as in the module's description."""
    return all_orders(interactions(flagged(docs, labels)))


def op13_filter_audit(spark, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS words, min(doc_id) OVER (PARTITION BY text) AS first_id FROM t),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, struct_pack(A := len(words) < 50, B := 100 * len(list_distinct(words)) < 65 * len(words),
      C := 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * length(text), D := regexp_matches(text, '[#$%&*|]'), E := coalesce(first_id < doc_id, false)) AS x
      FROM w LEFT JOIN l USING (doc_id)),
cells AS (SELECT part, good, toxic, [x.A, x.B, x.C, x.D, x.E] AS fails, count(*) AS n FROM f GROUP BY ALL),
k AS (SELECT unnest(range(1, 6)) AS i),
orders AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM k a, k b, k c, k d, k e WHERE a.i NOT IN (b.i, c.i, d.i, e.i) AND b.i NOT IN (c.i, d.i, e.i) AND c.i NOT IN (d.i, e.i) AND d.i <> e.i),
steps AS (SELECT array_to_string(list_transform(o, lambda i: substr('ABCDE', i, 1)), '') AS filter_order, s.i AS step, o[s.i] AS own, o[1:s.i - 1] AS gone FROM orders, k s),
told AS (SELECT part, filter_order, step, own, n, good, toxic, fails[own] AS hit, len(list_filter(gone, lambda i: fails[i])) > 0 AS lost, len(list_filter(fails, lambda b: b)) AS n_fails FROM cells, steps),
r AS (SELECT part, filter_order, step, any_value(own) AS own, coalesce(sum(n) FILTER (NOT lost AND NOT hit), 0) AS kept, coalesce(sum(n) FILTER (NOT lost AND hit), 0) AS removed,
      coalesce(sum(n) FILTER (lost AND hit), 0) AS redundant, coalesce(sum(n) FILTER (hit AND n_fails = 1), 0) AS unique_fails,
      coalesce(sum(n) FILTER (NOT lost AND hit AND good = 1), 0) AS good_lost, coalesce(sum(n) FILTER (NOT lost AND hit AND toxic = 1), 0) AS toxic_lost FROM told GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM r
"""
