"""Kept texts of a window, found again by their anchors: equal ones, and such of which one holds the other."""

from __future__ import annotations

import heapq
from collections import defaultdict

#: The longest anchor, in characters.
ANCHOR = 256


def _anchor_size(n: int) -> int:
    """A text of n characters is anchored by its first 2 ** k, more than half of it, at most ANCHOR."""
    return min(1 << (n.bit_length() - 1), ANCHOR)


def _anchor(text: str) -> int:
    return hash(text[: _anchor_size(len(text))])


class RecentTexts:
    """Texts with a start and a window; each is dropped for good when a later start lies further away than its window.

    Of two alike texts the shorter one has more than `ratio` of the longer one's length, so it begins within the longer one's first
    1 - ratio. Each kept text is entered under its own anchor, and under the anchors that a shorter one in it could have. A new
    text meets those it shares an anchor with, however many are kept; entries grow with the texts' lengths. Only texts that have
    their first ANCHOR characters (or more than half of a shorter one) in common still meet each other.
    """

    def __init__(self, least: int, ratio: float = 0.8) -> None:
        self.least, self.ratio = least, ratio
        self.alive: dict[int, tuple[str, float, tuple]] = {}  # with its entries
        self.last: tuple[str | None, set[int]] = (None, set())
        self.next = 0
        self.equal, self.begins, self.holds = defaultdict(set), defaultdict(set), defaultdict(set)
        self.ends: dict[float, list[tuple[float, int]]] = {}  # by window: the earliest start first

    def _inner(self, text: str) -> set[int]:
        """Hashes of the anchors that a shorter text inside `text` can have."""
        if self.last[0] is text:  # a text is looked up, and then kept
            return self.last[1]
        n, found = len(text), set()
        shortest = max(int(n * self.ratio), self.least) + 1
        if shortest <= n:
            sizes = {_anchor_size(shortest), _anchor_size(n)}  # less than twice as long: no third size lies between
            found = {hash(text[at : at + k]) for k in sizes for at in range(n - max(shortest, k) + 1)}
        self.last = (text, found)
        return found

    def _drop(self, i: int) -> None:
        text, _, entries = self.alive.pop(i)
        for index, anchors in ((self.equal, (text,)), *entries):
            for a in anchors:
                index[a].discard(i)
                if not index[a]:
                    del index[a]

    def _entries(self, text: str) -> tuple:
        if len(text) <= self.least:
            return ()
        return (self.begins, (_anchor(text),)), (self.holds, self._inner(text))

    def expire(self, start: float) -> None:
        for window, heap in self.ends.items():
            while heap and not start - heap[0][0] <= window:
                self._drop(heapq.heappop(heap)[1])

    def near(self, text: str, start: float, window: float) -> bool:
        """Whether a kept text within the window is equal to this one, or alike."""
        within = lambda i: start - self.alive[i][1] <= window
        if any(within(i) for i in self.equal.get(text, ())):
            return True
        n = len(text)
        if n <= self.least:
            return False
        longer = self.holds.get(_anchor(text), ())
        if any(within(i) and self._alike(text, self.alive[i][0]) for i in longer):
            return True
        return any(within(i) and self._alike(self.alive[i][0], text) for a in self._inner(text) if a in self.begins for i in self.begins[a])

    def _alike(self, short: str, long: str) -> bool:
        return len(short) / len(long) > self.ratio and short in long if len(short) <= len(long) else False

    def keep(self, text: str, start: float, window: float) -> None:
        if start != start:  # NaN: no later start is near it
            return
        i, self.next = self.next, self.next + 1
        entries = self._entries(text)
        self.alive[i] = (text, start, entries)
        self.equal[text].add(i)
        for index, anchors in entries:
            for a in anchors:
                index[a].add(i)
        heapq.heappush(self.ends.setdefault(window, []), (start, i))
