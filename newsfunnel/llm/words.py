"""Words, word hashes and shingles of text batches in numpy.

Every function works on the flat UTF-8 bytes of a slice of rows, so a row
costs a few array operations and no Python loop over words.

A span's hash is the sum of its 8-byte pieces, each mixed (all bits, not linearly) with a key
of its place, and mixed once more with the span's length.  So no arithmetic relation
between bytes carries over to hashes, as it does for polynomials modulo 2**64, under which
the Thue-Morse words of 1,024 letters are equal.  Two different words or shingles share a hash with
probability about 2**-64.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Avalanche of 64-bit values (the finaliser of splitmix64)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BASE = 0x9E3779B97F4A7C55 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_PLACE = _U(0x9E3779B97F4A7C15)
_LENGTH = _U(0x2545F4914F6CDD1D)
_HEAD = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)  # the first n bytes of a piece


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    np.multiply.accumulate(out, out=out)
    return out


_cache: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_cache.get("p", ())) < n:
        size = max(n, 1 << 16)
        _cache["p"], _cache["i"] = _powers(_BASE, size), _powers(_BASE_INV, size)
    return _cache["p"][:n], _cache["i"][:n]


def separators(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[np.frombuffer(chars, np.uint8)] = True
    return t


BLANKS = separators(bytes([0x20, *range(0x09, 0x0E)]))


class Words:
    """Word spans of a slice: byte ``start``/``end``, ``row`` of each word, ``first`` word of each row."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, sep: np.ndarray = BLANKS, lower: bool = True):
        self.data = LOWER[data] if lower else data
        inside = ~sep[data]
        n = len(data)
        edge = np.zeros(n + 1, bool)
        edge[offs] = True
        prev = np.empty(n, bool)
        nxt = np.empty(n, bool)
        if n:
            prev[0], nxt[-1] = False, False
            prev[1:], nxt[:-1] = inside[:-1], inside[1:]
        prev &= ~edge[:n]
        nxt &= ~edge[1:]
        self.start = np.flatnonzero(inside & ~prev)
        self.end = np.flatnonzero(inside & ~nxt) + 1
        self.first = np.searchsorted(self.start, offs)  # words of row r: first[r] .. first[r + 1]
        self.count = np.diff(self.first)
        self.row = np.repeat(np.arange(len(offs) - 1), self.count)
        self._pieces: np.ndarray | None = None

    def raw_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of byte spans of one byte or more."""
        if self._pieces is None:
            padded = np.zeros(len(self.data) + 8, np.uint8)
            padded[:len(self.data)] = self.data
            self._pieces = np.ndarray((len(self.data) + 1,), "<u8", padded, strides=(1,))  # the eight bytes from each place on
        if not len(start):
            return np.zeros(0, np.uint64)
        size = end - start
        count = (size + 7) >> 3
        first = np.cumsum(count) - count
        nth = np.arange(first[-1] + count[-1]) - np.repeat(first, count)
        at = np.repeat(start, count) + 8 * nth
        piece = self._pieces[at] & _HEAD[np.minimum(np.repeat(end, count) - at, 8)]
        keys = mix(np.arange(1, int(count.max()) + 1, dtype=np.uint64) * _PLACE)
        return mix(np.add.reduceat(mix(piece ^ keys[nth]), first) + size.astype(np.uint64) * _LENGTH)

    def hashes(self) -> np.ndarray:
        return self.raw_hash(self.start, self.end)


_ORDER = [_U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9), _U(0xD6E8FEB86659FD93),
          _U(0xA0761D6478BD642F), _U(0xE7037ED1A0B428DB), _U(0x8EBC6AF09C88C6E3), _U(0x589965CC75374CC3)]


def ngrams(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` word hashes, row borders ignored."""
    full = np.zeros(max(len(h) - k + 1, 0), np.uint64)
    for j in range(k):
        full += h[j:len(h) - k + 1 + j] * _ORDER[j]
    return mix(full)


def shingles(words: Words, k: int, hashes: np.ndarray | None = None, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words of each row and how many each row has.

    With ``short`` a row of 1 to k - 1 words has its whole sequence as its one shingle.
    """
    h = words.hashes() if hashes is None else hashes
    run = np.maximum(words.count - k + 1, 0)
    full = ngrams(h, k)
    keep = np.zeros(len(full), bool)
    if len(full):
        keep = words.row[:len(full)] == words.row[k - 1:]
    got, counts = full[keep], run.copy()
    if short:
        few = np.flatnonzero((words.count > 0) & (words.count < k))
        if len(few):
            add = np.zeros(len(few), np.uint64)
            for j in range(k - 1):
                has = words.count[few] > j
                add[has] += h[words.first[few[has]] + j] * _ORDER[j]
            add = mix(add + words.count[few].astype(np.uint64) * _U(0x2545F4914F6CDD1D))
            counts[few] = 1
            at = np.concatenate([[0], np.cumsum(run)])[few]
            got = np.insert(got, at, add)
    return got, counts
