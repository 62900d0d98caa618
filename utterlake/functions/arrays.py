"""Arrow arrays of a batch's rows: lists as their lengths and their elements in a row, so that numpy works on all rows at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from utterlake.functions import text as T


def flat(lists: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The lengths of the lists (null: 0), and their elements."""
    return pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), lists.flatten()


def relist(lengths: np.ndarray, values: pa.Array, null: pa.Array | None = None) -> pa.Array:
    """flat() undone."""
    offsets = pa.array(np.append(0, np.cumsum(lengths)).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, values, mask=null)


def places(lengths: np.ndarray) -> np.ndarray:
    """Each element's place in its list, from 0."""
    return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def doubles(structs: pa.Array, field: str) -> np.ndarray:
    """A field of structs; NaN where it is null."""
    return pc.struct_field(structs, field).cast(pa.float64()).to_numpy(zero_copy_only=False)


def with_speakers(words: pa.Array, speakers: pa.Array) -> pa.Array:
    """Words (structs) with other speakers."""
    kept = [pc.struct_field(words, c) for c in ("word", "start", "end", "score")]
    return pa.StructArray.from_arrays([*kept, speakers], ["word", "start", "end", "score", "speaker"])


def pieces(word: pa.Array, begins: np.ndarray, whole: bool, **fields: pa.Array) -> pa.Array:
    """Structs, one for each part of words in a row, each from one of `begins` on: other fields, extremes of the times, text, and the words if wanted."""
    start, end = doubles(word, "start"), doubles(word, "end")
    said = pc.utf8_trim(pc.struct_field(word, "word"), T.WHITE)
    n = np.add.reduceat(said.is_valid().to_numpy(zero_copy_only=False).astype(np.int64), begins) if len(begins) else begins
    text = pc.utf8_trim(pc.binary_join(relist(n, said.drop_null()), " "), T.WHITE)
    first, last = (pa.array(f.reduceat(x, begins) if len(begins) else x) for f, x in ((np.fmin, start), (np.maximum, end)))
    out = fields | {"start": first, "end": last, "text": text}
    if whole:
        out["words"] = relist(np.diff(np.append(begins, len(word))), word)
    return pa.StructArray.from_arrays(list(out.values()), list(out))
