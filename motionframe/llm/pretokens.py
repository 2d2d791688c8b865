"""Cutting texts into pre-tokens, and giving ids to each distinct pre-token once.

The pattern of the public byte-level vocabularies is applied with array
operations over code points: runs of letters, of numbers and of other signs,
each with at most one space before it, the English contractions, and white
space.  Pre-tokens repeat a lot, so a batch is encoded by encoding its distinct
pre-tokens and gathering their ids.  Equal ones are found by a hash and then
compared.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable

import numpy as np

from .words import U, mix, powers

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 4
#: Characters handled at once; a longer text is handled alone.
CHUNK = 1 << 19
#: Distinct pre-tokens of a generation; a worker remembers two.
REMEMBERED = 300_000
# The white space of the Unicode standard (property White_Space).
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

_classes: np.ndarray | None = None


def classes() -> np.ndarray:
    """The class of every code point."""
    global _classes
    if _classes is None:
        kinds = {"L": LETTER, "N": NUMBER}
        table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)), np.uint8, sys.maxunicode + 1)
        table[WHITE_SPACE] = SPACE
        _classes = table
    return _classes


def cut(points: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Where pre-tokens start.  texts: where texts start in points (empty ones may be left out)."""
    n = len(points)
    kind = classes()[points]
    opens = np.zeros(n + 1, bool)  # a text starts here
    opens[texts] = True
    opens[n] = True
    begin = opens[:n].copy()  # a run starts here
    begin[1:] |= kind[1:] != kind[:-1]
    white = kind == SPACE
    ends_run = np.append(begin[1:], True)
    # the last character of white space that another run of the same text follows stands alone ...
    tail = white & ends_run & ~opens[1:]
    start = begin.copy()
    start[tail] = True
    # ... and a blank joins that run
    after = np.flatnonzero(tail & (points == 0x20)) + 1
    start[after] = False
    # contractions: one apostrophe alone, with no blank before it, and then letters
    solo = np.flatnonzero((points == 0x27) & begin & ends_run & start)
    solo = solo[solo + 1 < n]
    solo = solo[(kind[solo + 1] == LETTER) & ~opens[solo + 1]]
    if len(solo):
        first = points[solo + 1]
        second = np.where((solo + 2 < n) & ~opens[np.minimum(solo + 2, n)], points[np.minimum(solo + 2, n - 1)], 0)
        one = np.isin(first, [ord(c) for c in "stmd"])
        two = np.zeros(len(solo), bool)
        for pair in ("re", "ve", "ll"):
            two |= (first == ord(pair[0])) & (second == ord(pair[1]))
        size = np.where(one, 1, np.where(two, 2, 0))
        hit, size = solo[size > 0], size[size > 0]
        start[hit + 1] = False
        rest = hit + 1 + size
        inside = rest < n
        rest = rest[inside]
        # what is left of the letters is a pre-token; where none is left, a run starts there anyway, unless a blank's owner
        more = (kind[rest] == LETTER) & ~begin[rest]
        start[rest[more]] = True
    return np.flatnonzero(start)


class Encoder:
    """ids of whole texts, from a function that gives the ids of distinct pre-tokens."""

    def __init__(self, encode: Callable[[list[str]], list]):
        self.encode, self.known, self.older = encode, {}, {}
        self.power, self.inverse = powers(BASE, CHUNK + 1), powers(INVERSE, CHUNK + 1)

    def _tables(self, n: int):
        if n < len(self.power):
            return self.power, self.inverse
        return powers(BASE, n + 1), powers(INVERSE, n + 1)

    def _ids(self, words: list[str]) -> list[bytes]:
        known = self.known
        if missing := [w for w in words if w not in known]:
            if len(known) + len(missing) > REMEMBERED:  # what is still met comes over from the older generation, the rest goes with it
                self.older, self.known = known, {}
                known, missing = self.known, words
            older = self.older
            known.update({w: older[w] for w in missing if w in older})
            fresh = [w for w in missing if w not in older]
            for w, ids in zip(fresh, self.encode(fresh) if fresh else [], strict=True):
                known[w] = np.asarray(ids, np.uint32).tobytes()
        return [known[w] for w in words]

    def _chunk(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        joined = "".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        firsts = np.cumsum(sizes) - sizes
        if not len(points):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        start = cut(points, np.unique(firsts[sizes > 0]))
        end = np.append(start[1:], len(points))
        power, inverse = self._tables(len(points))
        sums = np.zeros(len(points) + 1, U)
        np.cumsum((points.astype(U) + U(1)) * power[: len(points)], out=sums[1:])
        _, first, which = np.unique(mix((sums[end] - sums[start]) * inverse[start]), return_index=True, return_inverse=True)
        words = [joined[a:b] for a, b in zip(start[first].tolist(), end[first].tolist(), strict=True)]
        # a pre-token that has another's hash, but not its characters, is a word of its own
        length = end - start
        like = points[np.minimum(np.arange(len(points)) + np.repeat(start[first][which] - start, length), len(points) - 1)]
        odd = np.flatnonzero(np.logical_or.reduceat(points != like, start) | (length != length[first][which]))
        if len(odd):
            which[odd] = np.arange(len(odd)) + len(words)
            words += [joined[start[i] : end[i]] for i in odd.tolist()]
        ids = self._ids(words)
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        base = np.cumsum(size) - size
        flat = np.frombuffer(b"".join(ids), np.uint32)
        each = size[which]
        upto = np.cumsum(each)
        at = np.arange(upto[-1]) + np.repeat(base[which] - (upto - each), each)
        bounds = np.append(0, upto)[np.searchsorted(start, np.append(firsts, len(points)))]
        return flat[at], np.diff(bounds)

    def batch(self, texts: list[str]) -> list[np.ndarray]:
        """ids of each text, as unsigned 32-bit integers."""
        out, at = [], 0
        while at < len(texts):
            to, n = at, 0
            while to < len(texts) and (to == at or n + len(texts[to]) <= CHUNK):
                n += len(texts[to])
                to += 1
            ids, sizes = self._chunk(texts[at:to])
            out += np.split(ids, np.cumsum(sizes)[:-1])
            at = to
        return out
