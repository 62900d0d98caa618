"""Best-fit packing of token sequences, certified by lower bounds.

1. Each text is tokenised, ended with id 2 and, if longer than a sequence, cut: the first piece takes the
   remainder, all others are full. Full pieces are sequences of their own.
2. The rest is dealt over partitions of about `part_items` pieces by a hash, and each partition is packed by
   best-fit decreasing. A lower bound from dual-feasible functions on its sizes certifies the number of its bins.
3. A partition with as many bins as its bound is done but for its last open bin. Any other keeps its full bins and
   gives up the pieces of those with gaps. What partitions give up meets in fewer, newly dealt partitions and is
   packed again, until all that is left fits one partition or a round has no fewer bins than the one before, whose
   bins then stay. packed_bins() gives the number of all bins and the bound on all sizes.

Each round is written to the shared folder, so that lost executors repeat one round at most; a task holds one
partition's sizes and ids, never texts.

Defined cases: a null text counts as empty (one piece: id 2); repeated rows and null ids are packed as rows of
their own; very long texts are encoded whole and cut; pieces of equal length are taken in the order of doc_id, piece and checksum;
extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from utterlake.llm.common import small_batches, stored, table
from utterlake.llm.units import UnitIds

END = 2
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = f"{PIECE}, sequence_id long, offset long, bins int, bound int, open boolean"


def added_tokens(path: str) -> dict[str, int]:
    """The tokens that a tokenizer's json file adds to its vocabulary: they are cut out of a text before anything else."""
    with open(path, encoding="utf-8") as f:
        tokens = json.load(f)["added_tokens"]
    if odd := [t["content"] for t in tokens if t["single_word"] or t["lstrip"] or t["rstrip"]]:
        raise ValueError(f"added tokens that depend on what stands beside them: {odd}")
    return {t["content"]: t["id"] for t in tokens}


def token_pieces(docs: DataFrame, ranks_path: str | None = None, size: int = 1024, added: dict[str, int] | None = None) -> DataFrame:
    """The pieces of each text: PIECE's columns, in pieces of at most `size` tokens.

    The ids are those of the tokenizer in json form that goes with the ranks: added tokens (those of the public file by default) are
    one id each, wherever they stand; what lies between them is encoded by the ranks.
    """
    small_batches(docs.sparkSession)
    added = added_tokens(public_tokenizers.path("byte_bpe_50k.json")) if added is None else added

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken

        from utterlake.llm.byte_bpe import read_ranks

        tokens = read_ranks(ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"))
        bpe = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
        units = UnitIds(bpe.encode_ordinary)
        end = np.array([END], "<u4").tobytes()
        own = {token: np.array([i], "<u4").tobytes() for token, i in added.items()}
        around = re.compile("(" + "|".join(map(re.escape, sorted(own, key=len, reverse=True))) + ")") if own else None

        def encode(text: str) -> bytes:
            if around is None or not around.search(text):
                return units.ids(text)
            return b"".join(own[part] if part in own else units.ids(part) for part in around.split(text))

        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = memoryview(encode(text or "") + end)
                n = len(ids) // 4
                start, piece = 0, 0
                while start < n:
                    length = (n % size or size) if start == 0 else size
                    rows.append((doc_id, piece, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])))
                    start, piece = start + length, piece + 1
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield out.astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInPandas(cut, PIECE)


def best_fit_decreasing(sizes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item: largest first, into the fullest bin that has room."""
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    room: list[list[int]] = [[] for _ in range(size + 1)]  # bins by the room they have
    has, n = 0, 0  # bit r of `has`: some bin has room r
    for i in np.argsort(-sizes, kind="stable").tolist():
        s = int(sizes[i])
        fits = has >> s
        if fits:
            r = s + (fits & -fits).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                has &= ~(1 << r)
        else:
            b, r, n = n, size, n + 1
        bins[i], offsets[i] = b, size - r
        if r > s:
            room[r - s].append(b)
            has |= 1 << (r - s)
    return bins, offsets


def lower_bound(sizes: np.ndarray, size: int, counts: np.ndarray | None = None) -> int:
    """Bins that any packing of `sizes` (each as often as its count) needs, by two families of dual-feasible functions.

    f maps sizes so that no full bin's items exceed 1 together; then no packing has fewer bins than the sum of f.
    """
    if not len(sizes):
        return 0
    x, n = np.unique(sizes, return_counts=True) if counts is None else (sizes, counts)
    best = math.ceil((x * n).sum() / size)
    for k in range(1, 21):  # u_k: round (k+1)x/C down unless it is whole
        up = (k + 1) * x
        f = np.where(up % size == 0, x * k, (up // size) * size)  # in units of 1 / (k * size)
        best = max(best, -(-int((f * n).sum()) // (k * size)))
    for cut in np.unique(np.minimum(x, size - x)[np.minimum(x, size - x) <= size // 2]):  # above C - cut count 1, below cut 0
        f = np.where(x > size - cut, size, np.where(x >= cut, x, 0))
        best = max(best, -(-int((f * n).sum()) // size))
    return int(best)


def _pack(size: int, gap: int, first_id: int):
    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=False, kind="stable").reset_index(drop=True)
        sizes = group["length"].to_numpy(np.int64)
        bins, offsets = best_fit_decreasing(sizes, size)
        fill = np.bincount(bins, sizes)
        part = int(group["part"].iloc[0])
        bound = lower_bound(sizes, size)
        gaps = size - fill >= gap
        if len(fill) == bound:  # certified: only the emptiest bin may still go
            gaps &= np.arange(len(fill)) == fill.argmin()
        return group.drop(columns="part").assign(
            sequence_id=first_id + (part << 24) + bins,
            offset=offsets,
            bins=len(fill),
            bound=bound,
            open=gaps[bins],
        )

    return pack


def pack(pieces: DataFrame, size: int = 1024, part_items: int = 2000, gap: int = 3) -> DataFrame:
    """PIECE's columns with sequence_id and offset, and the last partition's number of bins and its bound.

    pieces must be stored (it is read once per round). gap: the room from which a bin of a partition that isn't
    certified is given up. Full pieces have bins and bound 1.
    """
    full = pieces.filter(F.col("length") == size).select(
        "*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
        F.lit(1).alias("bins"), F.lit(1).alias("bound"),
    )
    left, done = pieces.filter(F.col("length") < size), [full]
    given, before = None, None  # the bins given up last, and their number
    for k in range(127):  # ids have room for as many
        n = left.count()
        if not n:
            break
        parts = -(-n // part_items)
        row = F.monotonically_increasing_id()  # equal pieces aren't dealt to one part
        dealt = left.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", row, F.lit(k)), F.lit(parts)))
        out = stored(dealt.groupBy("part").applyInPandas(_pack(size, gap, k << 56), PACKED), "packed")
        first = F.col("offset") == 0
        bins, opened = out.agg(F.count_if(first), F.count_if(first & F.col("open"))).first()
        if given is not None and bins >= before:
            break
        if parts == 1:
            given = out.drop("open")
            break
        done.append(out.filter(~F.col("open")).drop("open"))
        given, before = out.filter("open").drop("open"), opened
        left = given.select("doc_id", "piece", "start", "length", "ids_crc32")
    if given is not None:
        done.append(given)
    result = done[0]
    for d in done[1:]:
        result = result.unionByName(d)
    return result


def packed_bins(packed: DataFrame, size: int = 1024) -> tuple[int, int]:
    """The number of sequences and a lower bound on it from all sizes."""
    rows = packed.groupBy("length").agg(F.count("*").alias("n"), F.count_if(F.col("offset") == 0).alias("bins")).collect()
    rows.sort(key=lambda r: r["length"])
    return sum(r.bins for r in rows), lower_bound(np.array([r["length"] for r in rows]), size, np.array([r.n for r in rows]))


def best_fit_packing(docs: DataFrame, ranks_path: str | None = None, size: int = 1024) -> DataFrame:
    return pack(stored(token_pieces(docs, ranks_path, size), "pieces"), size)


def op5_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return best_fit_packing(table(spark, sf_dir, "documents").select("doc_id", "text"))
