"""Hashes of words and of runs of words, computed for a whole Arrow batch at once.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D, so UTF-8 texts
can be cut bytewise.  Hashes of short words are polynomial over their bytes, taken
from prefix sums modulo 2**64 and then mixed; long words could be built so that
such hashes agree whatever the base, so theirs is a digest's.  There are two
families, which together know a run of words by 128 bits.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

U = np.uint64
_BASE = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
SPACE_BYTES = np.zeros(256, bool)
SPACE_BYTES[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes hashed in one go; a longer text gets its own, larger tables.
CHUNK = 1 << 18
#: Bytes from which on a word has a digest.
LONG = 64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64: n of them."""
    out = np.full(n, base, U)
    out[0] = 1
    return np.multiply.accumulate(out)


class Hasher:
    """Word hashes of texts, with power tables that are kept between batches."""

    def __init__(self, lower: bool = False, family: int = 0):
        self.base, self.lower, self.family = _BASE[family], lower, bytes([family])
        self.inverse = pow(self.base, -1, 1 << 64)
        self.tables = None

    def _table(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if self.tables is None or len(self.tables[0]) < n:
            made = powers(self.base, max(n, CHUNK + 1)), powers(self.inverse, max(n, CHUNK + 1))
            if n > 8 * CHUNK:
                return made
            self.tables = made
        return self.tables

    def _chunk(self, data: np.ndarray, starts_of_texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, start and end of each word; texts are cut at starts_of_texts."""
        inside = ~SPACE_BYTES[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        cut = starts_of_texts[(starts_of_texts > 0) & (starts_of_texts < len(data))]
        first[cut] = inside[cut]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        last[cut - 1] = inside[cut - 1]
        begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        power, inverse = self._table(len(data) + 1)
        sums = np.zeros(len(data) + 1, U)
        data = _LOWER[data] if self.lower else data
        np.cumsum(data.astype(U) * power[: len(data)] + power[: len(data)], out=sums[1:])
        out = mix((sums[end] - sums[begin]) * inverse[begin])
        for i in np.flatnonzero(end - begin >= LONG).tolist():
            out[i] = int.from_bytes(hashlib.blake2b(data[begin[i] : end[i]].tobytes(), digest_size=8, key=self.family).digest(), "little")
        return out, begin, end

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hash, begin, end of each word; first word of each text, with the total at the end; bytes).

        begin and end are places in the returned bytes.  A null text has no words.
        """
        texts = texts.cast(pa.large_binary())
        n = len(texts)
        if n == 0:
            return np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(0, np.uint8)
        if texts.null_count:
            texts = texts.fill_null(b"")
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1]
        data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        out, at = [], 0
        while at < n:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK, "right")) - 1)
            lo, hi = int(offsets[at]), int(offsets[to])
            if hi > lo:
                h, b, e = self._chunk(data[lo:hi], offsets[at:to] - lo)
                out.append((h, b + lo, e + lo))
            at = to
        h, b, e = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64))
        return h, b, e, np.searchsorted(b, offsets), data


def runs(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of words[i : i + k] for every i; the last k - 1 places are left out."""
    n = max(0, len(words) - k + 1)
    out = np.zeros(n, U)
    factor = 0xD6E8FEB86659FD93
    for j in range(k):
        out *= U(factor)
        out += words[j : j + n]
    return mix(out)


def starts_inside(firsts: np.ndarray, k: int) -> np.ndarray:
    """Mask over runs(): those that do not cross from one text into the next."""
    total = int(firsts[-1])
    keep = np.ones(max(0, total - k + 1), bool)
    for j in range(1, k):
        at = firsts[1:-1] - j
        keep[at[(at >= 0) & (at < len(keep))]] = False
    # a text shorter than k words also spoils places before its predecessor's end, which the loop has marked
    return keep
