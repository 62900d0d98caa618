"""Media columns: payloads live in tar shards under their digest; rows carry digest, shard, offset and length.

Each text's bytes, filled up with bytes 255 to a positive multiple of 576, are stored without loss as the samples of
a grey 8-bit PNG that is 576 wide. A task streams its rows into one shard in the shared folder; the same media meets
the same digest, so that a shard holds each payload once, whatever number of rows carry it. The rows (the manifest)
are written beside the shards, and only they move between stages; payloads are never shuffled.

read_headers() fills width, height and bit depth from the first 33 bytes at a row's offset. read_media() reads the
stored bytes whole, checks nothing but what it finds, and computes digests and features.

A task that is repeated after the loss of an executor writes a new shard under a new name and its rows refer to that
one; a shard without rows is waste, not an error.

Defined cases: a null text counts as empty (one row of samples, all 255); very long texts are one payload each; every input row
gives one output row, null ids and repeated rows included (equal texts have equal digests; where two tasks hold them, each stores them); extra columns are ignored; an empty table gives an empty manifest and no shard.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from utterlake.llm.common import shared_dir, small_batches, table

#: Hadoop's names of file systems, and Arrow's, where they differ.
SCHEMES = {"s3a": "s3", "s3n": "s3", "wasbs": "abfs"}

WIDTH = 576
HEADER = 33  # PNG signature and IHDR chunk
MANIFEST = "doc_id long, n_bytes long, digest string, shard string, offset long, length long"
MEDIA = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def payload_of(text: str | None) -> tuple[int, bytes]:
    """Number of UTF-8 bytes, and the bytes filled up with 255."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return len(data), data + b"\xff" * (-len(data) % WIDTH or (0 if data else WIDTH))


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def to_png(payload: bytes, level: int = 6) -> bytes:
    """A grey 8-bit image, one row for each 576 bytes, no row filter."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    raw = np.hstack([np.zeros((len(rows), 1), np.uint8), rows]).tobytes()
    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(raw, level)) + _chunk(b"IEND", b"")


def png_header(head: bytes) -> tuple[int, int, int]:
    """Width, height and bit depth, from an image's first 33 bytes."""
    width, height, depth = struct.unpack(">IIB", head[16:25])
    return width, height, depth


def from_png(image: bytes) -> bytes:
    """The samples of an image that to_png() wrote."""
    at, packed = 8, []
    while at < len(image):
        n, kind = struct.unpack(">I4s", image[at : at + 8])
        if kind == b"IDAT":
            packed.append(image[at + 8 : at + 8 + n])
        at += 12 + n
    width, height, _ = png_header(image)
    rows = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8).reshape(height, width + 1)
    return rows[:, 1:].tobytes()


def _tar_header(name: str, size: int) -> bytes:
    head = bytearray(512)
    for at, value in (
        (0, name.encode()), (100, b"0000644\0"), (108, b"0000000\0"), (116, b"0000000\0"), (124, b"%011o\0" % size),
        (136, b"00000000000\0"), (148, b" " * 8), (156, b"0"), (257, b"ustar\x0000"),
    ):
        head[at : at + len(value)] = value
    head[148:156] = b"%06o\0 " % sum(head)
    return bytes(head)


def feature_of(payload: bytes, width: int, height: int) -> str:
    """Shape, mean, deviation and entropy of the samples, and their shares in eight equal ranges (thousandths)."""
    n = np.bincount(np.frombuffer(payload, np.uint8), minlength=256).astype(np.float64)
    p = n / n.sum()
    level = np.arange(256)
    mean = float((p * level).sum())
    spread = float(np.sqrt((p * (level - mean) ** 2).sum()))
    entropy = float((p[p > 0] * np.log2(1 / p[p > 0])).sum())
    ranges = ",".join(str(round(1000 * v)) for v in p.reshape(8, 32).sum(1))
    return f"{width}x{height};mean={mean:.4f};std={spread:.4f};entropy={entropy:.4f};hist={ranges}"


def arrow_uri(uri: str) -> str:
    """The address of a folder as Arrow has it; an error where Arrow can't reach its file system."""
    scheme, rest = uri.split(":", 1)
    uri = f"{SCHEMES.get(scheme, scheme)}:{rest if rest.startswith('//') else '//' + rest}"
    fs.FileSystem.from_uri(uri)
    return uri


def write_shards(docs: DataFrame, level: int = 6, remember: int = 200_000) -> DataFrame:
    """Store every text; returns the stored manifest (MANIFEST's columns), whose rows point into the shards.

    remember: a shard's index forgets its oldest digests beyond this number; a payload may then be stored again.
    """
    spark = docs.sparkSession
    small_batches(spark)
    path = shared_dir(spark, "media")  # with its file system's name: Arrow opens what Spark means
    base = arrow_uri(path)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        where, root = fs.FileSystem.from_uri(base)
        shard = f"shard-{uuid.uuid4().hex}.tar"
        out, at, index = None, 0, OrderedDict()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                n, payload = payload_of(text)
                key = hashlib.sha256(payload).digest()
                if key not in index:
                    if out is None:
                        where.create_dir(root, recursive=True)
                        out = where.open_output_stream(f"{root}/{shard}")
                    image = to_png(payload, level)
                    digest = hashlib.sha256(image).hexdigest()
                    out.write(_tar_header(f"{digest}.png", len(image)) + image + b"\0" * (-len(image) % 512))
                    index[key] = (digest, at + 512, len(image))
                    at += 512 + len(image) + -len(image) % 512
                    if len(index) > remember:
                        index.popitem(last=False)
                rows.append((doc_id, n, index[key][0], f"{base}/{shard}", *index[key][1:]))
            yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "digest", "shard", "offset", "length"]).astype({"doc_id": "Int64"})
        if out is not None:
            out.write(b"\0" * 1024)
            out.close()

    path = f"{path}/manifest"
    docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInPandas(write, MANIFEST).write.parquet(path)
    return spark.read.schema(MANIFEST).parquet(path)


class _Ranges:
    """Range reads from shards; one shard is open at a time (a manifest file's rows share one)."""

    def __init__(self):
        self.name, self.file = None, None

    def read(self, shard: str, offset: int, length: int) -> bytes:
        if shard != self.name:
            where, path = fs.FileSystem.from_uri(shard)
            self.name, self.file = shard, where.open_input_file(path)
        return self.file.read_at(length, offset)


def read_headers(manifest: DataFrame) -> DataFrame:
    """The manifest with width, height and bit_depth, from 33 bytes of each row's payload."""

    @F.pandas_udf("width int, height int, bit_depth int")
    def header(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        ranges = _Ranges()
        for shards, offsets in batches:
            rows = [png_header(ranges.read(s, o, HEADER)) for s, o in zip(shards, offsets, strict=True)]
            yield pd.DataFrame(rows, columns=["width", "height", "bit_depth"], dtype="int32")

    return manifest.withColumn("h", header("shard", "offset")).select(*manifest.columns, "h.*")


def read_media(headed: DataFrame, remember: int = 256) -> DataFrame:
    """read_headers()' rows with MEDIA's columns, from the stored bytes."""

    @F.pandas_udf(MEDIA)
    def media(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        ranges, last = _Ranges(), OrderedDict()
        for batch in batches:
            rows = []
            for shard, offset, length, width, height in zip(*batch, strict=True):
                if (shard, offset) not in last:
                    image = ranges.read(shard, offset, length)
                    payload = from_png(image)
                    last[shard, offset] = (
                        len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(image),
                        hashlib.sha256(image).hexdigest(), feature_of(payload, width, height),
                    )
                    if len(last) > remember:
                        last.popitem(last=False)
                rows.append(last[shard, offset])
            yield pd.DataFrame(rows, columns=["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    return headed.withColumn("m", media("shard", "offset", "length", "width", "height")).select(*headed.columns, "m.*")


def media_columns(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, where the payload lies, header fields, and MEDIA's columns."""
    return read_media(read_headers(write_shards(docs)))


def op3_media_columns(spark, sf_dir: str) -> DataFrame:
    """Without shard and offset: equal texts that two tasks have stored lie in two places."""
    return media_columns(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("shard", "offset")
