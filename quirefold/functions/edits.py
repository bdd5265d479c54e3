"""Character edits between two texts: matching blocks, the longest first, in memory that follows the texts.

The longest run of characters that both texts have is a block (the first in the left
text, then in the right one, if several are as long), and so on to its left and right.
Characters that make up more than a hundredth of a long right text begin no block, but
extend one.
"""

from __future__ import annotations

import numpy as np

#: From which length on characters can be too common, and beyond which share (one of so many, and one more).
LONG, COMMON = 200, 100
#: Equal pairs of places that are compared at once; more are gone through place by place.
PAIRS = 1_000_000


class Matcher:
    """The places of one pair of texts."""

    def __init__(self, left: str, right: str) -> None:
        self.a, self.b = (np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) for t in (left, right))
        chars, at, n = np.unique(self.b, return_inverse=True, return_counts=True)
        few = n <= len(self.b) // COMMON + 1 if len(self.b) >= LONG else np.ones(len(chars), bool)
        own = np.minimum(np.searchsorted(chars, self.a), max(0, len(chars) - 1))
        self.usable = (chars[own] == self.a) & few[own] if len(chars) else np.zeros(len(self.a), bool)
        #: the right text's places by character, as one sorted key of both
        self.keys = np.sort((self.b << 32) + np.arange(len(self.b)))
        self.runs = np.zeros(len(self.b) + 1, np.int64)

    def longest(self, a0: int, a1: int, b0: int, b1: int) -> tuple[int, int, int]:
        """(place left, place right, size) of the longest block within the ranges."""
        at = a0 + np.flatnonzero(self.usable[a0:a1])
        lo, hi = (np.searchsorted(self.keys, (self.a[at] << 32) + end) for end in (b0, b1))
        n = hi - lo
        at, lo, n = at[n > 0], lo[n > 0], n[n > 0]
        i, j, size = a0, b0, 0  # with common characters only, what the ranges begin with
        if len(at):
            i, j, size = (self._at_once if n.sum() <= PAIRS else self._by_place)(at, lo, n)
        # common characters on both sides belong to it
        back = np.flatnonzero(self.a[a0:i][::-1][: j - b0] != self.b[b0:j][::-1][: i - a0])
        back = int(back[0]) if len(back) else min(i - a0, j - b0)
        i, j, size = i - back, j - back, size + back
        left, right = self.a[i + size : a1], self.b[j + size : b1]
        most = min(len(left), len(right))
        on = np.flatnonzero(left[:most] != right[:most])
        return i, j, size + (int(on[0]) if len(on) else most)

    def _at_once(self, at: np.ndarray, lo: np.ndarray, n: np.ndarray) -> tuple[int, int, int]:
        i = np.repeat(at, n)
        j = self.keys[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(len(i))] & 0xFFFFFFFF
        order = np.lexsort((i, j - i))
        i, j = i[order], j[order]
        first = np.flatnonzero(np.r_[True, (np.diff(i) != 1) | (np.diff(j) != 1)])
        size = np.diff(np.r_[first, len(i)])
        best = first[size == size.max()]
        k = best[np.lexsort((j[best], i[best]))[0]]
        return int(i[k]), int(j[k]), int(size.max())

    def _by_place(self, at: np.ndarray, lo: np.ndarray, n: np.ndarray) -> tuple[int, int, int]:
        """The same, holding for one place of the left text the sizes of the runs that end there."""
        best, runs, before, last = (0, 0, 0), self.runs, np.zeros(0, np.int64), -2
        for i, start, count in zip(at.tolist(), lo.tolist(), n.tolist(), strict=True):
            j = self.keys[start : start + count] & 0xFFFFFFFF
            size = runs[j] + 1 if i == last + 1 else np.ones(count, np.int64)
            runs[before + 1] = 0
            runs[j + 1] = size
            k = int(size.argmax())
            if size[k] > best[2]:
                best = i - int(size[k]) + 1, int(j[k]) - int(size[k]) + 1, int(size[k])
            before, last = j, i
        runs[before + 1] = 0
        return best

    def blocks(self) -> list[tuple[int, int, int]]:
        """All blocks in order; those that touch on both sides are one."""
        found, todo = [], [(0, len(self.a), 0, len(self.b))]
        while todo:
            a0, a1, b0, b1 = todo.pop()
            i, j, size = self.longest(a0, a1, b0, b1)
            if size:
                found.append((i, j, size))
                todo += [r for r in ((a0, i, b0, j), (i + size, a1, j + size, b1)) if r[0] < r[1] and r[2] < r[3]]
        out: list[tuple[int, int, int]] = []
        for i, j, size in sorted(found):
            if out and out[-1][0] + out[-1][2] == i and out[-1][1] + out[-1][2] == j:
                out[-1] = (*out[-1][:2], out[-1][2] + size)
            else:
                out.append((i, j, size))
        return out


def _shared(left: str, right: str) -> int:
    """How many characters both begin with."""
    low, high = 0, min(len(left), len(right))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if left[low:mid] == right[low:mid] else (low, mid - 1)
    return low


def at_one_end(left: str, right: str) -> list[tuple[int, int, int]] | None:
    """The blocks of texts that differ at their beginnings only, or at their ends only, in characters that the other lacks; else None.

    No block can hold those characters.  A run of usable characters that both texts have
    lies in what they share; the same run with itself is as long and comes first, and it
    grows to all that is shared.  With common characters only, just a shared beginning is a block.
    """
    apart = lambda a, b: set(a).isdisjoint(right) and set(b).isdisjoint(left)
    n = _shared(left, right)
    if apart(left[n:], right[n:]):
        return [(0, 0, n)] if n else []
    n = _shared(left[::-1], right[::-1])
    i, j = len(left) - n, len(right) - n
    if not apart(left[:i], right[:j]):
        return None
    usable = len(right) < LONG or any(right.count(c) <= len(right) // COMMON + 1 for c in set(right[j:]))
    return [(i, j, n)] if n and usable else []


def edits(left: str, right: str) -> list[tuple[str, int, int, int, int]]:
    """(tag, i1, i2, j1, j2) of what lies between the blocks: replace, delete or insert."""
    out, i, j = [], 0, 0
    blocks = at_one_end(left, right)
    for a, b, size in [*(Matcher(left, right).blocks() if blocks is None else blocks), (len(left), len(right), 0)]:
        if i < a or j < b:
            out.append(("replace" if i < a and j < b else "delete" if i < a else "insert", i, a, j, b))
        i, j = a + size, b + size
    return out
