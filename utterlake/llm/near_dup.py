"""Near-duplicates by HyperMinHash: compressed registers are banded, estimates are corrected, links are verified.

1. A text's distinct 5-word shingles are hashed to 64 bits. The hash's first 7 bits choose one of 128 buckets; a
   bucket's least hash is stored as its number of leading zeros (6 bits) and the 10 bits after the first one:
   a 16-bit register. Empty buckets borrow the register of the first filled bucket in a fixed random order.
2. Rows with the same words in the same order are one node. Four registers are one band key (64 bits, 32 bands): texts
   with similarity 0.75 share no band with a probability of (1 - 0.75**4)**32, about 5 in a million.
3. In each bucket of equal band keys every node is paired with one pivot (a star, not all pairs). Pairs whose
   Jaccard estimate, corrected for chance equality of registers, is far below the threshold are dropped; the others
   are verified on their full sets. Links give components (alternating stars of minima, written each round).
4. What then still lies in a bucket beside another component is compared with all members of the bucket, in blocks
   and on full sets, so that no link between bucket mates is lost; these pairs are never rows.

Defined cases: a text without words (null, empty) has n_shingles 0, links with nothing and is a component of its
own; repeated rows each give a row; a null doc_id takes part by its text, never names a component where another
id does, and is not kept; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from utterlake.llm.common import finished, small_batches, stored, table

WORDS = 5
BUCKETS = 128
MANTISSA = 10
ROWS = 4
BANDS = BUCKETS // ROWS
#: A pair is linked when 100 * intersection >= PERCENT * union.
PERCENT = 75

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
SKETCH = "doc_id long, node binary, n_shingles long, keys array<long>"


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Word to a 64-bit hash; bounded."""

    def __init__(self, most: int = 400_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.most:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words of the whole text."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def node_of(words: list[bytes]) -> bytes:
    """Equal for equal word sequences."""
    return hashlib.md5(b" ".join(words)).digest()


def node_column(text: Column) -> Column:
    """node_of() as SQL."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.unhex(F.md5(F.trim(F.regexp_replace(lower, r"[\x20\x09-\x0D]+", " ")).cast("binary")))


def shingle_set(words: list[bytes], known: WordHashes, width: int = WORDS) -> np.ndarray:
    """The distinct shingles' hashes, sorted; a shorter text is one shingle, one without words none."""
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = len(h) - width + 1
    if n < 1:
        width, n, out = len(h), 1, np.full(1, len(h), np.uint64)
    else:
        out = np.zeros(n, np.uint64)
    for j in range(width):
        out = out * _MULTIPLIER + h[j : j + n]
    return np.unique(mix(out))


def _probes() -> np.ndarray:
    """For each bucket a fixed random order of all buckets."""
    ids = np.arange(BUCKETS * BUCKETS, dtype=np.uint64)
    return np.argsort(mix(ids + np.uint64(0x5DEECE66D)).reshape(BUCKETS, BUCKETS), axis=1)


_PROBES = _probes()


def registers(hashes: np.ndarray) -> np.ndarray:
    """The 128 16-bit registers of a sorted, non-empty set."""
    bucket = (hashes >> np.uint64(57)).astype(np.int64)
    first = np.searchsorted(bucket, np.arange(BUCKETS))
    filled = np.zeros(BUCKETS, bool)
    filled[bucket] = True
    rest = hashes[np.minimum(first, len(hashes) - 1)] << np.uint64(7)
    exponent = np.frexp((rest >> np.uint64(11)).astype(np.float64))[1]
    zeros = np.where(exponent > 0, 53 - exponent, 53).astype(np.uint64)
    mantissa = (rest << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA)
    out = ((zeros << np.uint64(MANTISSA)) | mantissa).astype(np.uint16)
    if not filled.all():
        source = _PROBES[np.arange(BUCKETS), filled[_PROBES].argmax(1)]
        out = np.where(filled, out, out[source])
    return out


def corrected_jaccard(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int) -> float:
    """Share of equal registers, less those that are equal by chance (expected from both cardinalities)."""
    equal = float((a == b).mean())
    ratio = max(n_a, n_b) / max(min(n_a, n_b), 1)
    chance = 0.169919487159739 * 2.0**-MANTISSA * 4 * ratio / (1 + ratio) ** 2
    return max(0.0, (equal - chance) / (1 - chance))


def may_link(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int) -> bool:
    """False only if the estimate lies 6 standard errors below the threshold, or the sizes alone rule a link out."""
    if 100 * min(n_a, n_b) < PERCENT * max(n_a, n_b):
        return False
    t = PERCENT / 100
    error = (t * (1 - t) * (1 / BUCKETS + 1 / min(n_a, n_b))) ** 0.5
    return corrected_jaccard(a, b, n_a, n_b) >= t - 6 * error


def sketches(docs: DataFrame) -> DataFrame:
    """SKETCH's columns for every row: node identifies the word sequence, keys are the bands (registers by fours)."""
    small_batches(docs.sparkSession)

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                words = words_of(text)
                s = shingle_set(words, known)
                keys = registers(s).view(np.int64) if len(s) else None
                rows.append((doc_id, node_of(words) if len(s) else None, len(s), keys))
            yield pd.DataFrame(rows, columns=["doc_id", "node", "n_shingles", "keys"]).astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInPandas(sketch, SKETCH)


def components(links: DataFrame) -> DataFrame:
    """(node, component): the least node that links (a, b) reach, for every node with a link.

    Alternating large and small stars of minima, until each node points to one root and no root points on; each step is
    written, so that joins see two stored tables.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v"), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "least")
        large = stored(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct(), "large")
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
            edges.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into"))
        )
        seen = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
        if seen.filter("out > 1 or (out > 0 and into > 0)").isEmpty():
            break
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return stored(edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots), "components")


class NearDuplicates:
    """One run's tables: nodes (distinct texts), and members (who shares a band key with whom)."""

    def __init__(self, docs: DataFrame, sketched: DataFrame):
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        self.sketched = sketched
        self.nodes = stored(
            self.sketched.filter("n_shingles > 0").groupBy("node", "n_shingles", "keys").agg(F.min("doc_id").alias("rep")), "nodes"
        )
        bands = self.nodes.select("node", F.posexplode("keys").alias("band", "key"))
        shared = stored(
            bands.groupBy("band", "key").agg(F.count("*").alias("n"), F.min("node").alias("pivot")).filter("n > 1").drop("n"), "buckets"
        )
        self.members = stored(bands.join(shared, ["band", "key"]), "members")
        named = self.members.select("node").distinct().join(self.nodes.select("node", "rep"), "node")
        # a hash join: the texts are streamed past the small side and need no sort
        own = self.docs.join(named.withColumnRenamed("rep", "doc_id").hint("shuffle_hash"), "doc_id").filter(node_column(F.col("text")) == F.col("node"))
        lost = self.docs.filter("doc_id is null").withColumn("node", node_column(F.col("text")))
        lost = lost.join(named.filter("rep is null").select("node"), "node", "left_semi")
        self.texts = stored(
            own.dropDuplicates(["doc_id", "node"]).select("node", "text").unionByName(lost.dropDuplicates(["node"]).select("node", "text")), "texts"
        )

    def estimated(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that may_link() lets through."""
        side = lambda c: self.nodes.select(F.col("node").alias(c), F.col("keys").alias(f"keys_{c}"), F.col("n_shingles").alias(f"n_{c}"))

        def estimate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for p in batches:
                keep = [
                    may_link(np.asarray(x, np.int64).view(np.uint16), np.asarray(y, np.int64).view(np.uint16), n, m)
                    for x, y, n, m in zip(p["keys_a"], p["keys_b"], p["n_a"], p["n_b"], strict=True)
                ]
                yield p.loc[np.array(keep, bool), ["a", "b"]]

        return pairs.join(side("a"), "a").join(side("b"), "b").mapInPandas(estimate, "a binary, b binary")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose full shingle sets reach the threshold, stored."""
        side = lambda c: self.texts.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}"))

        def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            known = WordHashes()
            last: OrderedDict[bytes, np.ndarray] = OrderedDict()

            def full(node: bytes, text: str) -> np.ndarray:
                if node not in last:
                    last[node] = shingle_set(words_of(text), known)
                    while len(last) > 1 and (len(last) > 32 or sum(map(len, last.values())) > 4_000_000):
                        last.popitem(last=False)
                return last[node]

            for p in batches:
                keep = []
                for a, b, x, y in zip(p["a"], p["b"], p["text_a"], p["text_b"], strict=True):
                    s, t = full(bytes(a), x), full(bytes(b), y)
                    both = len(np.intersect1d(s, t, assume_unique=True))
                    keep.append(100 * both >= PERCENT * (len(s) + len(t) - both))
                yield p.loc[np.array(keep, bool), ["a", "b"]]

        return stored(pairs.join(side("a"), "a").join(side("b"), "b").mapInPandas(verify, "a binary, b binary"), "links")

    def with_component(self, found: DataFrame) -> DataFrame:
        """Members of buckets in which more than one component is left: + component, main and size (the bucket's largest one, its rows)."""
        own = self.members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
        own = stored(own.select("band", "key", "node", "component"), "own")
        main = stored(
            own.groupBy("band", "key", "component").agg(F.count("*").alias("n"))
            .groupBy("band", "key").agg(F.count("*").alias("parts"), F.sum("n").alias("size"), F.max_by("component", F.struct("n", "component")).alias("main"))
            .filter("parts > 1").drop("parts"),
            "main",
        )
        return stored(own.join(main, ["band", "key"]), "mixed")

    def links(self) -> DataFrame:
        """Verified links (a, b), some of them replaced by paths of links; their transitive closure is that of all links."""
        first = (
            self.members.filter("node != pivot").groupBy("node", "pivot").agg(F.count("*").alias("n"))
            .groupBy("node").agg(F.max_by("pivot", F.struct("n", "pivot")).alias("b")).withColumnRenamed("node", "a")
        )
        links = self.verified(self.estimated(first))
        mixed = self.with_component(components(links))
        return links.unionByName(self.blocked(mixed))

    def blocked(self, mixed: DataFrame, block: int = 1024, block_shingles: int = 1_000_000) -> DataFrame:
        """Links between members of mixed buckets, at least all those between different components.

        A bucket's hub is the member with the most bucket mates, so that the buckets of one family of texts have few hubs.
        Members outside their bucket's main component are put into blocks by their largest such bucket's hub: about `block`
        nodes, or `block_shingles` shingles where texts are long. Every member of a bucket meets the blocks of the bucket's
        strays, by chunks of about `block`. A task holds one block's shingle sets and streams a chunk's texts past them; of
        its links only a star to each linked set's least node leaves it.
        """
        weight = mixed.groupBy("node").agg(F.sum("size").alias("weight"))
        hubs = mixed.join(weight, "node").groupBy("band", "key").agg(F.max(F.struct("weight", "node")).alias("hub"))
        stray = mixed.filter("component != main").join(hubs, ["band", "key"]).groupBy("node").agg(F.max(F.struct("size", "hub"))["hub"]["node"].alias("hub"))
        stray = stored(stray.join(self.nodes.select("node", "n_shingles"), "node"), "stray")
        blocks = F.greatest(F.ceil(F.count("*") / block), F.ceil(F.sum("n_shingles") / block_shingles))
        stray = stray.join(stray.groupBy("hub").agg(blocks.alias("n")), "hub")
        stray = stored(stray.select("node", "hub", F.xxhash64("hub", F.pmod(F.xxhash64("node"), F.col("n"))).alias("block")), "blocks")
        at = stored(mixed.filter("component != main").select("band", "key", "node").join(stray, "node").select("band", "key", "hub").distinct(), "block-buckets")
        near = stored(mixed.select("band", "key", "node").join(at, ["band", "key"]).select("node", "hub").distinct(), "near")
        meets = stored(near.join(stray.select("hub", "block").distinct(), "hub").select("node", "block").distinct(), "meets")
        stray = stray.select("node", "block")
        chunks = stored(meets.groupBy("block").agg(F.ceil(F.count("*") / block).alias("chunks")), "chunks")
        rows = meets.join(chunks, "block").select("node", "block", F.pmod(F.xxhash64("node"), F.col("chunks")).alias("chunk"), F.lit(1).alias("side"))
        own = stray.join(chunks, "block").select("node", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"), F.lit(0).alias("side"))
        dealt = own.unionByName(rows).join(self.texts, "node").repartition("block", "chunk").sortWithinPartitions("block", "chunk", "side")

        def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            known = WordHashes()
            last, nodes, sets, index = None, [], [], None
            root: dict[bytes, bytes] = {}  # towards the least node that a block and chunk link a node with

            def top(node: bytes) -> bytes:
                while root.get(node, node) != node:
                    root[node] = node = root.get(root[node], root[node])
                return node

            def flush() -> list[tuple[bytes, bytes]]:
                stars = [(node, top(node)) for node in root]
                root.clear()
                return stars

            for batch in batches:
                out = []
                for key, side, node, text in zip(zip(batch["block"], batch["chunk"], strict=True), batch["side"], batch["node"], batch["text"], strict=True):
                    if key != last:
                        last, nodes, sets, index = key, [], [], None
                        out += flush()
                    s = shingle_set(words_of(text), known)
                    if side == 0:
                        nodes.append(bytes(node))
                        sets.append(s)
                        continue
                    if not sets:
                        continue
                    if index is None:  # the block is complete: its shingles in order, and whose they are
                        whose = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
                        flat = np.concatenate(sets)
                        order = np.argsort(flat, kind="stable")
                        index, sizes = (flat[order], whose[order]), np.array([len(x) for x in sets])
                    lo, hi = np.searchsorted(index[0], s, "left"), np.searchsorted(index[0], s, "right")
                    some = hi > lo
                    lo, n = lo[some], (hi - lo)[some]
                    at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
                    both = np.bincount(index[1][at], minlength=len(sets))
                    for i in np.flatnonzero(100 * both >= PERCENT * (sizes + len(s) - both)):
                        a, b = top(nodes[i]), top(bytes(node))
                        if a != b:
                            root[max(a, b)] = min(a, b)
                yield pd.DataFrame(out, columns=["a", "b"])
            yield pd.DataFrame(flush(), columns=["a", "b"])

        return stored(dealt.mapInPandas(compare, "a binary, b binary"), "block-links")

    def named(self) -> DataFrame:
        """node, rep, component, component_id (the component's least id) of each node."""
        found = components(self.links())
        own = stored(self.nodes.select("node", "rep").join(found, "node", "left").withColumn("component", F.coalesce("component", "node")), "own-component")
        least = stored(own.groupBy("component").agg(F.min("rep").alias("component_id")), "least")
        return own.join(least, "component")


def named_nodes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """sketches() and NearDuplicates.named(), stored; all tables on the way to them are deleted."""
    sketched = stored(sketches(docs), "sketches")
    return sketched, finished(docs.sparkSession, lambda: NearDuplicates(docs, sketched).named(), "named")


def representatives(docs: DataFrame) -> DataFrame:
    """doc_id, node of one text of each component that has ids, with its least id, and of each id's text without words."""
    sketched, named = named_nodes(docs)
    first = named.filter("rep is not null").groupBy("component").agg(F.min(F.struct("rep", "node")).alias("m"))
    empty = sketched.filter("n_shingles = 0 and doc_id is not null").select("doc_id").distinct()
    return first.select(F.col("m.rep").alias("doc_id"), "m.node").unionByName(empty.withColumn("node", node_column(F.lit(""))))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept."""
    sketched, named = named_nodes(docs)
    own = sketched.select("doc_id", "n_shingles", "node").join(named.select("node", "component_id"), "node", "left")
    name = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return own.select("doc_id", "n_shingles", name.alias("component_id"), F.coalesce(F.col("doc_id") == name, F.lit(False)).alias("kept"))


def op1_near_dup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
