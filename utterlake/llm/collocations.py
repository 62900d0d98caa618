"""Phrase collocations: words that stand beside each other more often than their own counts suggest, per language.

Texts are gathered into shards, each in one task, without a shuffle. A shard is held vertically: for each of its words a compressed
bitmap of the positions where it stands, as pairs of a block's number and a mask of its 16 positions; blocks without the word
aren't there. Pieces are one empty position apart, so that nothing reaches from one into the next.

A phrase's bitmap, shifted by one position, ANDed with a word's, is the bitmap of the longer phrase, and the sum of its masks' bits
is the phrase's count in the shard. Depth first: the phrases that begin with some of the words are extended to their
full length before those of the next words, and a block is met with the words of that block only, so that no pair of words
that never meet is tried. Counts are summed over the shards, exactly: no shard leaves out a phrase because it is rare there.

What can't be frequent is pruned, level by level: a phrase that occurs n times has no part that occurs less often. Frequent parts are sent
to the shards as a bit table of fixed size (hashes), which may let others pass but never holds one back; as their counts
are exact too, the table's size changes the work and no result.

Scores are whole numbers by decimal arithmetic of 38 digits (counts up to 10 ** 15). Each language's best are taken in two steps, so that no task
holds a language's phrases.

Defined cases: null and empty texts have no words; a null lang is `und`; rows that repeat a text or a doc_id count each; ties are
settled by count and then by the phrase's bytes; a text longer than a shard is one shard; an empty table gives no rows; extra columns are
ignored; doc_id isn't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from utterlake.llm.common import small_batches, stored, table

#: Ends of pieces become this word, which no text has; white space in pieces is a space or a tab.
END = b"."
TABLE = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", b"\n" * 10)
BITS = 16
SHARD = "lang string, words array<string>, n array<int>, first array<int>, blocks binary, masks binary"
COUNTS = "lang string, phrase string, n long"
#: Bits of the table of frequent phrases (8 MB).
FILTER_BITS = 1 << 26


class Vocabulary(dict):
    """Word to number, in order of appearance; END is 0."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def tokens(text: str) -> list[bytes]:
    """The text's words, A-Z lowered, with END after each piece."""
    return (text.encode("utf-8", "surrogatepass").lower().translate(TABLE).replace(b"\n", b" . ") + b" .").split()


class Gathered:
    """The texts of one language that become one shard."""

    def __init__(self):
        self.known, self.ids, self.size = Vocabulary({END: 0}), [], 0

    def add(self, text: str) -> None:
        found = tokens(text)
        self.ids.append(np.fromiter(map(self.known.__getitem__, found), np.int32, len(found)))
        self.size += len(found)

    def shard(self, lang: str) -> dict:
        ids = np.concatenate(self.ids)
        order = np.argsort(ids, kind="stable")
        order = order[np.searchsorted(ids[order], 1) :]
        word, block, mask = ids[order], (order // BITS).astype(np.int32), (1 << (order % BITS)).astype(np.uint16)
        new = np.flatnonzero(np.append(True, (word[1:] != word[:-1]) | (block[1:] != block[:-1]))[: len(word)])
        word, block, mask = word[new], block[new], np.bitwise_or.reduceat(mask, new) if len(new) else mask
        names = list(self.known)[1:]
        first = np.searchsorted(word, np.arange(1, len(names) + 2)).astype(np.int32)
        n = np.bincount(ids, minlength=len(names) + 1)[1:]
        words = [w.decode("utf-8", "surrogatepass") for w in names]
        return {"lang": lang, "words": words, "n": n.tolist(), "first": first.tolist(), "blocks": block.tobytes(), "masks": mask.tobytes()}


def shards(docs: DataFrame, most: int = 1_500_000) -> DataFrame:
    """SHARD's columns: rows of one language each, of about `most` words of all languages together in a task at a time."""
    small_batches(docs.sparkSession)

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, Gathered] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                held.setdefault(lang, Gathered()).add(text)
                if sum(g.size for g in held.values()) >= most:
                    for name in list(held):
                        yield pd.DataFrame([held.pop(name).shard(name)])
        for name in list(held):
            yield pd.DataFrame([held.pop(name).shard(name)])

    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text")).mapInPandas(gather, SHARD)


# ---- hashes of phrases, and the table of frequent ones

_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def word_hashes(lang: str, words: list[str]) -> np.ndarray:
    seed = xxhash.xxh32_intdigest(lang.encode("utf-8", "surrogatepass"))
    return np.fromiter((xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"), seed) for w in words), np.uint64, len(words))


def longer_hash(phrase: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase with one more word, from theirs."""
    h = (phrase * _STEP + word) * _MIX
    return h ^ (h >> np.uint64(31))


def slot(h: np.ndarray, bits: int) -> np.ndarray:
    return ((h * _MIX) >> np.uint64(20)) % np.uint64(bits)


def frequent_table(frequent: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """A bit for each frequent phrase (lang, phrase) at its slot, as `bits` / 64 whole numbers: no more, whatever the number of phrases."""

    def slots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for lang, phrases in batch.groupby("lang")["phrase"]:
                words = [p.split(" ") for p in phrases]
                names = {w: i for i, w in enumerate(dict.fromkeys(w for p in words for w in p))}
                hashes = word_hashes(lang, list(names))
                for n in {len(p) for p in words}:
                    ids = np.array([[names[w] for w in p] for p in words if len(p) == n])
                    h = hashes[ids[:, 0]]
                    for k in range(1, n):
                        h = longer_hash(h, hashes[ids[:, k]])
                    out.append(slot(h, bits))
            at = np.concatenate(out) if out else np.zeros(0, np.uint64)
            yield pd.DataFrame({"place": (at >> np.uint64(6)).astype(np.int64), "bits": (np.uint64(1) << (at & np.uint64(63))).view(np.int64)})

    rows = frequent.select("lang", "phrase").mapInPandas(slots, "place long, bits long").groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[rows["place"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return out


def passes(filled: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = slot(h, len(filled) * 64)
    return (filled[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) > 0


# ---- bitmaps


def shifted(owner: np.ndarray, block: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bitmaps (owner, block, mask) moved on by one position; the last position of a block goes to the next."""
    out = np.flatnonzero(mask >> np.uint16(BITS - 1))
    low = (mask << np.uint16(1)).astype(np.uint16)
    keep = np.flatnonzero(low)
    return np.concatenate([owner[keep], owner[out]]), np.concatenate([block[keep], block[out] + 1]), np.concatenate([low[keep], np.ones(len(out), np.uint16)])


class Vertical:
    """One shard's bitmaps: by word, and the words of each block."""

    def __init__(self, first: np.ndarray, blocks: np.ndarray, masks: np.ndarray, wanted: np.ndarray):
        word = np.repeat(np.arange(len(first) - 1, dtype=np.int32), np.diff(first))
        keep = wanted[word]
        self.word, self.block, self.mask = word[keep], blocks[keep], masks[keep]
        order = np.argsort(self.block, kind="stable")
        self.by_block, self.by_mask = self.word[order], self.mask[order]
        last = int(self.block.max(initial=-1)) + 2
        self.at = np.searchsorted(self.block[order], np.arange(last + 1))

    def extended(self, owner: np.ndarray, block: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, ...]:
        """(owner, word, block, mask) of all extensions of the bitmaps by one word that occur."""
        owner, block, mask = shifted(owner, block, mask)
        size = self.at[block + 1] - self.at[block]
        place = np.repeat(self.at[block] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        both = np.repeat(mask, size) & self.by_mask[place]
        hit = np.flatnonzero(both)
        row = np.repeat(np.arange(len(owner)), size)[hit]
        return owner[row], self.by_block[place[hit]], block[row], both[hit]

    def starts(self, most: int) -> Iterator[slice]:
        """The rows of some words at a time: whole words, of about `most` rows."""
        ends = np.flatnonzero(np.append(self.word[1:] != self.word[:-1], True)) + 1 if len(self.word) else []
        begin = 0
        for end in ends:
            if end - begin >= most:
                yield slice(begin, end)
                begin = end
        if len(self.word) > begin:
            yield slice(begin, len(self.word))


def grouped(owner: np.ndarray, word: np.ndarray, block: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, ...]:
    """The extensions in order of their phrases: (number of the phrase for each bitmap row, block, mask, and the phrases' owner, word and count)."""
    key = owner.astype(np.int64) << 32 | word
    order = np.argsort(key, kind="stable")
    key, block, mask = key[order], block[order], mask[order]
    new = np.append(True, key[1:] != key[:-1])[: len(key)]
    first = np.flatnonzero(new)
    count = np.add.reduceat(np.bitwise_count(mask), first, dtype=np.int64) if len(first) else np.zeros(0, np.int64)
    return np.cumsum(new) - 1, block, mask, key[first] >> 32, key[first] & 0xFFFFFFFF, count


def phrase_counts(held: DataFrame, length: int, filters: list[np.ndarray], rows: int = 100_000) -> DataFrame:
    """COUNTS' columns: phrases of `length` words with their counts in each shard, as far as all their parts pass the filters.

    filters: the tables of frequent phrases of 1, 2, ... words, length - 1 of them.
    """
    sent = held.sparkSession.sparkContext.broadcast(filters)  # of FILTER_BITS bits each

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = sent.value
        for batch in batches:
            for r in range(batch.num_rows):
                lang, words = batch["lang"][r].as_py(), batch["words"][r].values
                hashes = word_hashes(lang, words.to_pylist())
                first = batch["first"][r].values.to_numpy()
                blocks, masks = np.frombuffer(batch["blocks"][r].as_py(), np.int32), np.frombuffer(batch["masks"][r].as_py(), np.uint16)
                v = Vertical(first, blocks, masks, passes(tables[0], hashes))
                for part in v.starts(rows):
                    # phrases of k words: numbers of the words (a row each), hashes of the phrase and of all its ends
                    ids = np.unique(v.word[part])[None, :]
                    ends = [hashes[ids[0]]]
                    owner, block, mask = np.searchsorted(ids[0], v.word[part]), v.block[part], v.mask[part]
                    for k in range(2, length + 1):
                        number, block, mask, before, word, n = grouped(*v.extended(owner, block, mask))
                        ids = np.vstack([ids[:, before], word])
                        ends = [longer_hash(e[before], hashes[word]) for e in ends] + [hashes[word]]
                        if k == length:  # all but the whole phrase have to be frequent; its beginning is
                            ok = passes(tables[k - 2], ends[1])
                            ids, n = ids[:, ok], n[ok]
                            break
                        ok = passes(tables[k - 1], ends[0])
                        renumber = np.cumsum(ok) - 1
                        keep = ok[number]
                        owner, block, mask, ids, ends = renumber[number[keep]], block[keep], mask[keep], ids[:, ok], [e[ok] for e in ends]
                    if ids.shape[1]:
                        phrase = pc.binary_join_element_wise(*[words.take(pa.array(i)) for i in ids], " ")
                        lang_column = pa.repeat(pa.scalar(lang), len(n))
                        yield pa.RecordBatch.from_arrays([lang_column, phrase.cast(pa.string()), pa.array(n)], names=["lang", "phrase", "n"])

    return held.mapInArrow(count, COUNTS)


def frequent_phrases(docs: DataFrame, least: int = 10, longest: int = 3, bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """(all phrases of 1 to `longest` words that occur `least` times or more: lang, phrase, words, n), and (lang, total: all words)."""
    held = stored(shards(docs), "shards", long_rows=True)
    pairs = F.explode(F.arrays_zip(F.col("words").alias("phrase"), F.col("n").alias("n"))).alias("w")
    words = held.select("lang", pairs).select("lang", "w.phrase", F.col("w.n").cast("long").alias("n"))
    total = words.groupBy("lang").agg(F.sum("n").alias("total"))
    out, filters = None, []
    for k in range(1, longest + 1):
        seen = words if k == 1 else phrase_counts(held, k, filters)
        if k > 1:  # a shard's phrases are counted already: a second map of them all before the shuffle would gain nothing
            seen = seen.repartition("lang", "phrase")
        often = stored(seen.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).withColumn("words", F.lit(k)), f"phrases-{k}")
        out = often if out is None else out.unionByName(often)
        if k < longest:
            filters.append(frequent_table(often, bits))
    return out, total


def scored(often: DataFrame) -> DataFrame:
    """lang, phrase, words, a, l, r, score of each phrase of two words or more: by its cut of the lowest score, of these the first."""
    parts = F.split("phrase", " ")
    cuts = F.transform(F.sequence(F.lit(1), F.col("words") - 1), lambda k: F.struct(
        k.alias("k"), F.array_join(F.slice(parts, F.lit(1), k), " ").alias("left"), F.array_join(F.slice(parts, k + 1, F.col("words") - k), " ").alias("right")
    ))
    each = often.filter("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"), F.explode(cuts).alias("c")).select("lang", "phrase", "words", "a", "c.*")
    count = lambda name, n: often.select("lang", F.col("phrase").alias(name), F.col("n").alias(n))
    each = each.join(count("left", "l"), ["lang", "left"]).join(count("right", "r"), ["lang", "right"])
    exact = lambda c: F.col(c).cast("decimal(19, 0)")
    product, below = (exact("a") * exact("a") * F.lit(1_000_000).cast("decimal(7, 0)")).alias("x"), (exact("l") * exact("r")).alias("y")
    each = each.select("*", product, below).withColumn("score", F.expr("x div y"))
    best = each.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
    return best.select("lang", "phrase", "words", "a", "b.l", "b.r", "b.score")


def without_parts(phrases: DataFrame, share: int = 50) -> DataFrame:
    """phrases without those that stand inside a longer one which has `share` percent of their count or more."""
    parts, size = F.split("phrase", " "), F.col("words")
    within = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda k: F.transform(F.sequence(F.lit(1), size - k + 1), lambda i: F.array_join(F.slice(parts, i, k), " "))))
    inside = phrases.filter("words > 2").select("lang", F.explode(within).alias("phrase"), F.col("a").alias("around"))
    most = inside.groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    left = phrases.join(most, ["lang", "phrase"], "left").filter(F.col("around").isNull() | (100 * F.col("around") < share * F.col("a")))
    return left.drop("around")


def best_of(phrases: DataFrame, top: int = 2000, salts: int = 32) -> DataFrame:
    """The first `top` of each lang by score, count and phrase, with their rank: first in each of `salts` parts, then of what is left."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = phrases.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(salts)))
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top).drop("salt")


def collocations(docs: DataFrame, least: int = 10, longest: int = 3, share: int = 50, top: int = 2000, bits: int = FILTER_BITS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n (all words of the lang), score."""
    often, total = frequent_phrases(docs, least, longest, bits)
    best = best_of(without_parts(scored(often), share), top)
    return best.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")


def op11_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT id, lang, unnest(l) AS piece, generate_subscripts(l, 1) AS p FROM (SELECT id, lang, regexp_split_to_array(text, '[.,;:!?\n\x0B\f\r]') AS l FROM d)),
u AS (SELECT id, lang, p, unnest(l) AS w, generate_subscripts(l, 1) AS i FROM (SELECT id, lang, p, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS l FROM p)),
g AS (SELECT lang, w, lead(w) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM u WINDOW o AS (PARTITION BY id, p ORDER BY i)),
f1 AS (SELECT lang, w AS phrase, count(*) AS n FROM g GROUP BY ALL),
f2 AS (SELECT lang, w, w2, count(*) AS n FROM g WHERE w2 IS NOT NULL GROUP BY ALL),
f3 AS (SELECT lang, w, w2, w3, count(*) AS n FROM g WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
cut AS (SELECT c.lang, c.w || ' ' || c.w2 AS phrase, 1 AS k, c.n AS a, x.n AS l, y.n AS r FROM f2 c JOIN f1 x ON x.lang = c.lang AND x.phrase = c.w JOIN f1 y ON y.lang = c.lang AND y.phrase = c.w2 WHERE c.n >= 10
        UNION ALL SELECT c.lang, c.w || ' ' || c.w2 || ' ' || c.w3, 1, c.n, x.n, y.n FROM f3 c JOIN f1 x ON x.lang = c.lang AND x.phrase = c.w JOIN f2 y ON y.lang = c.lang AND y.w = c.w2 AND y.w2 = c.w3
        UNION ALL SELECT c.lang, c.w || ' ' || c.w2 || ' ' || c.w3, 2, c.n, x.n, y.n FROM f3 c JOIN f2 x ON x.lang = c.lang AND x.w = c.w AND x.w2 = c.w2 JOIN f1 y ON y.lang = c.lang AND y.phrase = c.w3),
s AS (SELECT *, CAST(1000000::HUGEINT * a * a // (l::HUGEINT * r) AS BIGINT) AS score FROM cut),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS c FROM s) WHERE c = 1),
inside AS (SELECT lang, phrase, max(n) AS around FROM (SELECT lang, w || ' ' || w2 AS phrase, n FROM f3 UNION ALL SELECT lang, w2 || ' ' || w3, n FROM f3) GROUP BY ALL),
kept AS (SELECT b.* FROM b LEFT JOIN inside USING (lang, phrase) WHERE around IS NULL OR 100 * around < 50 * a),
total AS (SELECT lang, sum(n) AS n FROM f1 GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, CAST(total.n AS BIGINT) AS n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""
