"""Byte-level BPE with sentencepiece: its model file is written straight from a rank vocabulary.

Every token's bytes become characters (printable bytes themselves, the others shifted above U+0100), a piece's
score is its negative rank, normalisation is the identity, and no space is added, doubled or marked. Merging
the pair with the best score first is then merging the lowest rank first, so that ids equal ranks. Pre-tokens
(matches of the public pattern) are encoded one by one; decoding maps pieces' characters back to bytes.

Defined cases: a null text counts as empty (no ids, the digests of nothing); very long texts are encoded whole, one pre-token at a
time; every input row gives one output row, repeated rows and null ids included; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from utterlake.llm.common import small_batches, table
from utterlake.llm.units import UnitIds

SCHEMA = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_characters() -> list[str]:
    """The character that stands for each byte in a piece."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, shift = [], 0
    for b in range(256):
        if b in plain:
            out.append(chr(b))
        else:
            out.append(chr(256 + shift))
            shift += 1
    return out


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file, by rank."""
    with open(path, "rb") as f:
        ranks = {int(n): base64.b64decode(token) for token, n in map(bytes.split, f)}
    return [ranks[i] for i in range(len(ranks))]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: int | bytes | np.float32) -> bytes:
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, np.float32):
        return _varint(number << 3 | 5) + value.tobytes()
    return _varint(number << 3) + _varint(value)


def sentencepiece_model(tokens: list[bytes]) -> bytes:
    """The serialised model (sentencepiece's public message format)."""
    chars = byte_characters()
    normal, unknown, bpe = 1, 2, 2
    pieces = [_field(1, _field(1, "".join(chars[b] for b in t).encode()) + _field(2, np.float32(-i)) + _field(3, normal)) for i, t in enumerate(tokens)]
    pieces.append(_field(1, _field(1, b"<unk>") + _field(2, np.float32(0)) + _field(3, unknown)))
    trainer = _field(3, bpe) + _field(4, len(tokens) + 1) + _field(40, len(tokens))  # model type, size, id of <unk>
    normalizer = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)  # no dummy prefix, no changes to spaces
    return b"".join(pieces) + _field(2, trainer) + _field(3, normalizer)


class ByteBpe:
    """Encoder and decoder of one worker."""

    def __init__(self, ranks_path: str | None = None):
        import regex
        import sentencepiece

        self.tokens = read_ranks(ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"))
        self.model = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(self.tokens))
        self.pre_tokens = regex.compile(public_tokenizers.PATTERN).findall
        self.to_char = dict(enumerate(byte_characters()))
        back = {c: b for b, c in enumerate(byte_characters())}
        self.decoded = [bytes(back[c] for c in self.model.id_to_piece(i)) for i in range(len(self.tokens))]
        self.whole = {t: i for i, t in enumerate(self.tokens)}
        self.units = UnitIds(self._encode_unit)

    def _encode_unit(self, unit: str) -> list[int]:
        ids: list[int] = []
        for p in self.pre_tokens(unit):
            data = p.encode()
            if data in self.whole:
                ids.append(self.whole[data])
            else:
                ids += self.model.encode(data.decode("latin-1").translate(self.to_char))
        return ids

    def encode(self, text: str | None) -> np.ndarray:
        return np.frombuffer(self.units.ids(text or ""), "<u4")

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.decoded.__getitem__, ids))


def encoded(text: Column, ranks_path: str | None = None) -> Column:
    """A struct column: n_tokens, ids_sha256 (decimal ids joined by a space), decoded_sha256."""

    @F.pandas_udf(SCHEMA)
    def digests(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = ByteBpe(ranks_path)
        for texts in batches:
            rows = []
            for text in texts:
                ids = bpe.encode(text).tolist()
                rows.append((len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(bpe.decode(ids)).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return digests(text)


def encode_ids(text: Column, ranks_path: str | None = None) -> Column:
    """The ids themselves: array<int>."""

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = ByteBpe(ranks_path)
        for texts in batches:
            yield pd.Series([bpe.encode(t).astype(np.int32) for t in texts], dtype=object)

    return ids(text)


def decode_ids(ids: Column, ranks_path: str | None = None) -> Column:
    """The text of an ids column, by the inverse mapping (null for null; bytes that are no UTF-8 become U+FFFD)."""

    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = ByteBpe(ranks_path)
        for rows in batches:
            yield pd.Series([None if r is None else bpe.decode(list(r)).decode("utf-8", "replace") for r in rows], dtype=object)

    return texts(ids)


def byte_bpe(docs: DataFrame, ranks_path: str | None = None) -> DataFrame:
    """One row per row of docs: doc_id and the fields of encoded()."""
    small_batches(docs.sparkSession)
    return docs.select("doc_id", encoded(F.col("text"), ranks_path).alias("e")).select("doc_id", "e.*")


def op10_byte_bpe(spark, sf_dir: str) -> DataFrame:
    return byte_bpe(table(spark, sf_dir, "documents").select("doc_id", "text"))
