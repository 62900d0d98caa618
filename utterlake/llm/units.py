"""Cut a text into units that byte-level BPE never merges across, so that a unit's ids can be remembered.

public_tokenizers.PATTERN decides on white space in the same way as UNIT: an optional space belongs to the
run of other characters after it; of longer white space all but the last character is one match. So a unit
is a concatenation of whole matches of PATTERN, and a text's ids are its units' ids in order.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable

#: The pattern's \s (Unicode White_Space; Python's own \s adds U+001C to U+001F).
WHITE = r"\t-\r \x85\xa0  -     　"
UNIT = re.compile(rf" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
#: White space that a unit of the fast way never holds (but for a line break at its start).
ODD = re.compile(rf"[{WHITE}]")


class _OddSpace(Exception):
    """The text has other white space than single spaces and line breaks between words."""


class UnitIds(dict):
    """Unit to the bytes of its ids (little-endian unsigned 32-bit); emptied when it holds `most` units.

    The keys are what stands between single spaces: 'word' for ' word', '\\nword' for '\\n' and 'word'. Texts with other
    white space are cut by UNIT.
    """

    def __init__(self, encode: Callable[[str], list[int]], most: int = 1_000_000, longest: int = 64):
        super().__init__()
        self.encode, self.most, self.longest = encode, most, longest

    def _bytes(self, unit: str) -> bytes:
        ids = self.encode(unit)
        return struct.pack(f"<{len(ids)}I", *ids)

    def __missing__(self, unit: str) -> bytes:
        word = unit[1:] if unit[:1] == "\n" else unit
        if not word or ODD.search(word):
            raise _OddSpace
        ids = self._bytes("\n") + self._bytes(word) if unit[0] == "\n" else self._bytes(" " + word)
        if len(unit) <= self.longest:
            if len(self) >= self.most:
                self.clear()
            self[unit] = ids
        return ids

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        first, *rest = text.replace("\n", " \n").split(" ")
        try:
            if not first or ODD.search(first):
                raise _OddSpace
            return self._bytes(first) + b"".join(map(self.__getitem__, rest))
        except _OddSpace:
            return b"".join(self[u[1:]] if u[0] == " " and len(u) > 1 and not u[1].isspace() else self._bytes(u) for u in UNIT.findall(text))
