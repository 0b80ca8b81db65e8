"""Near-duplicate title resolution (D4-D6), exact and distributed.

Reference semantics (per language, in ``ord`` order): compare the new title
with the kept list in order; the first kept title with similarity >= t is the
match; a strictly better quality takes over that slot, otherwise the new row
is dropped; unmatched rows append a slot.  Similarity is Ratcliff/Obershelp
(``difflib.SequenceMatcher(None, new, existing).ratio()``) on the lower-cased,
stripped title without its source suffix.

Distributed plan (exact):

1. normalise titles; collapse identical (language, title) pairs into
   representatives (one partial aggregate);
2. representatives are dealt into blocks of one language and a band of lengths; two
   blocks meet where ``min/max >= t/(2-t)`` is possible (lossless: 2M/T <= 2 min/T);
3. in a group of two blocks, on arrays: the character-multiset bound
   ``2*overlap/T >= t`` as a matrix product, the bigrams (from 200 characters on also 5-grams) that so many
   common characters leave in common (counts as bits, so a pair costs a few words), then a bit-parallel LCS of thousands of
   pairs at once (lossless: matching blocks are a common subsequence); for pairs that pass all, difflib's ratio in both directions;
4. connected components of the ``ratio >= t`` graph (smallest label and pointer
   jumping, until nothing changes; each round is a written table);
5. a greedy decision only involves pairs inside one component, so components
   replay the loop independently: single-title components natively (max_by);
   multi-title components stream, range-partitioned and sorted by (component,
   ord), through a ``mapInPandas`` replay whose state is the component's slots
   only (bounded memory however many rows);
6. survivors join back to the full rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsfunnel.functions.components import components
from newsfunnel.functions.lineage import materialize
from newsfunnel.functions.text import pystrip
from newsfunnel.functions.workers import ship_by_value
from newsfunnel.operators.urldedup import quality_score

THRESHOLD = 0.85
BAND = 8  # lengths of a band up to EVEN characters; bands of longer titles grow by STEP
EVEN, STEP = 160, 1.05
BLOCK_TITLES = 8192  # titles of a block; a group holds two
BLOCK_CHARS = 4 << 20  # characters of a block, about
TILE, ACROSS = 256, 8192  # titles of the two sides that are compared at once
FOLD = 64  # counters of a title's characters
GRAMS = 1024  # counters of a long title's bigrams
MOST_BITS = 64 * 48  # levels of counts that are compared as bits
DIMS = 64  # levels of characters that are multiplied, for longer titles two a character, up to six times as many
COUNTS_AT_ONCE = 4 << 20
AUTOJUNK = 200  # difflib leaves popular characters out from this length on
SEED_GRAM = 5
CODES = 128  # codes of characters in common subsequences
LCS_CHARS = 1024  # titles up to this length are compared many at once
PAIRS_AT_ONCE = 16384
PAIRS_TOGETHER = 1 << 18  # pairs that wait for their common subsequences


def strip_source_suffix(col: Column | str) -> Column:
    """Cut at the last ' - ' when the rest has at most 40 characters."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(c, r"(?s)^(.*) - .{0,40}\z", "$1")


def title_key(col: Column | str) -> Column:
    return F.lower(pystrip(strip_source_suffix(col)))


def lcs_length(a: str, b: str, least: int = 0) -> int:
    """Longest common subsequence length, bit-parallel over ``b`` (Hyyro 2004); with ``least``,
    0 as soon as it is known to be below."""
    if not a or not b:
        return 0
    pm: dict[str, int] = {}
    for j, ch in enumerate(b):
        pm[ch] = pm.get(ch, 0) | (1 << j)
    mask = (1 << len(b)) - 1
    v = mask
    for k, ch in enumerate(a):
        if k % 64 == 63 and len(b) - v.bit_count() < k - (len(a) - least):
            return 0  # more characters of ``a`` than that have no partner
        u = v & pm.get(ch, 0)
        v = ((v + u) | (v - u)) & mask
    return len(b) - v.bit_count()


def representatives(df: DataFrame, lang: str = "language", title: str = "title", order: str = "ord") -> DataFrame:
    """One row per distinct (language, normalised title) with a stable id."""
    keyed = df.select(F.coalesce(F.col(lang), F.lit("")).alias("lang"), title_key(title).alias("tkey"), F.col(order).alias("ord"))
    return keyed.groupBy("lang", "tkey").agg(F.min("ord").alias("rep_id"))


def _points(titles: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Characters of all titles one after the other, and the title of each."""
    points = np.frombuffer("".join(titles).encode("utf-32-le", "surrogatepass"), np.uint32)
    return points, np.repeat(np.arange(len(titles)), np.fromiter(map(len, titles), np.int64, len(titles)))


def _counts(titles: list[str], q: int, width: int) -> np.ndarray:
    """Folded counts of the q-grams of each title."""
    most = max(map(len, titles), default=0)
    out = np.zeros((len(titles), width), np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.int32)
    some = max(1, COUNTS_AT_ONCE // width)
    for at in range(0, len(titles), some):
        part = titles[at:at + some]
        points, row = _points(part)
        points = points.astype(np.uint64)
        n = max(0, len(points) - q + 1)
        grams = np.zeros(n, np.uint64)
        for k in range(q):
            grams = grams * np.uint64(31 if q == 2 else 1000003) + points[k:k + n]
        inside = row[:n] == row[q - 1:]
        cell = row[:n][inside] * width + (grams[inside] % np.uint64(width)).astype(np.int64)
        out[at:at + some] = np.bincount(cell, minlength=len(part) * width).reshape(len(part), width)
    return out


def _levels(top: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counter and level of each bit: one for each level of each counter up to ``top``."""
    at = np.repeat(np.arange(len(top)), top)
    return at, np.arange(len(at)) - np.repeat(np.cumsum(top) - top, top) + 1


def _words(c: np.ndarray, at: np.ndarray, level: np.ndarray) -> np.ndarray:
    """The bits of counts in 64-bit words, a row a word."""
    out = np.zeros((len(c), max(1, -(-len(at) // 64)) * 8), np.uint8)
    for k in range(0, len(c), TILE):
        packed = np.packbits(c[k:k + TILE, at] >= level, axis=1)
        out[k:k + TILE, :packed.shape[1]] = packed
    return np.ascontiguousarray(out.view(np.uint64).T)


class _Overlap:
    """Most q-grams that pairs of titles have in common.  They are folded into counters, which only raises the number.

    Counts are compared as bits, one for each level that titles on both sides reach; two titles have as many bits in common
    as their counts overlap.  Beyond ``MOST_BITS`` the highest levels are left out: of those a pair has in common what
    the title with fewer has, at most; pairs that may then reach ``need`` are counted out."""

    def __init__(self, a: list[str], b: list[str], q: int, width: int):
        self.x = _counts(a, q, width)
        self.y = self.x if a is b else _counts(b, q, width)
        top = np.minimum(self.x.max(axis=0, initial=0), self.y.max(axis=0, initial=0)).astype(np.int64)
        most = 1 if q > 2 else int(top.max(initial=0))
        while most > 1 and np.minimum(top, most).sum() > MOST_BITS:
            most = most * 3 // 4
        low = np.minimum(top, most)
        levels = _levels(low)
        self.words = [_words(c, *levels) for c in ([self.x] if a is b else [self.x, self.y])]
        total, kept = top.astype(self.x.dtype), low.astype(self.x.dtype)
        self.above = [np.minimum(c, total).sum(axis=1, dtype=np.int64) - np.minimum(c, kept).sum(axis=1, dtype=np.int64) for c in (self.x, self.y)]
        self.cost = len(self.words[0])

    def __call__(self, i: np.ndarray, j: np.ndarray, need: np.ndarray) -> np.ndarray:
        out = np.empty(len(i), bool)
        for at in range(0, len(i), PAIRS_AT_ONCE):
            some, other = i[at:at + PAIRS_AT_ONCE], j[at:at + PAIRS_AT_ONCE]
            both = np.minimum(self.above[0][some], self.above[1][other])
            for p, q in zip(self.words[0], self.words[-1]):
                both += np.bitwise_count(p[some] & q[other])
            out[at:at + PAIRS_AT_ONCE] = both >= need[at:at + PAIRS_AT_ONCE]
        unsure = np.flatnonzero(out & (self.above[0][i] > 0) & (self.above[1][j] > 0))
        step = max(1, COUNTS_AT_ONCE // 4 // self.x.shape[1])
        for at in range(0, len(unsure), step):
            some = unsure[at:at + step]
            out[some] = np.minimum(self.x[i[some]], self.y[j[some]]).sum(axis=1, dtype=np.int64) >= need[some]
        return out


class _Reaching:
    """Pairs of two tiles whose character counts overlap enough, as one product of two matrices.

    Counts are bits as above, so their overlap is a scalar product.  Only the bits that tell most are
    multiplied; of the others a pair has in common at most half of what its titles have together, which is a number
    of each title.  So a product is never less than the overlap."""

    def __init__(self, a: list[str], b: list[str], na: np.ndarray, nb: np.ndarray, threshold: float):
        x = _counts(a, 1, FOLD)
        y = x if a is b else _counts(b, 1, FOLD)
        top = np.minimum(x.max(axis=0, initial=0), y.max(axis=0, initial=0)).astype(np.int64)
        at, level = _levels(top)
        # share of the titles that reach each level
        share = [np.concatenate([np.cumsum(np.bincount(np.minimum(c[:, k], t), minlength=t + 1)[::-1])[::-1][1:] for k, t in enumerate(top)]) / len(c)
                 for c in (x, y)]
        telling = np.argsort(share[0] * share[1] - (share[0] + share[1]) / 2, kind="stable")
        kept = np.sort(telling[:max(DIMS, min(6 * DIMS, 2 * int(max(na[-1], nb[-1]))))])
        sides = []
        for c, n in ((x, na), (y, nb)):
            bits = (c[:, at[kept]] >= level[kept]).astype(np.float32)
            rest = np.minimum(c, top).sum(axis=1, dtype=np.int64) - bits.sum(axis=1, dtype=np.float64)
            sides.append((bits, ((rest - threshold * n) / 2.0).astype(np.float32)))
        (p, s), (q, t) = sides
        self.p = np.column_stack([p, s, np.ones(len(p), np.float32)])
        self.q = np.ascontiguousarray(np.column_stack([q, np.ones(len(q), np.float32), t]).T)
        self.slack = np.float32(0.05 + 3e-5 * max(na[-1], nb[-1]))  # rounding of products

    def __call__(self, rows: slice, cols: slice) -> tuple[np.ndarray, np.ndarray]:
        reach = self.p[rows] @ self.q[:, cols]
        i, j = np.nonzero(reach >= -self.slack)
        return i + rows.start, j + cols.start


def _seeds(titles: list[str]) -> np.ndarray:
    """Characters at which ``difflib`` starts a matching block if a title is its second string: those that
    are not popular, from ``AUTOJUNK`` characters on."""
    out, some = np.zeros(len(titles), np.int64), 512
    for at in range(0, len(titles), some):
        part = titles[at:at + some]
        points, row = _points(part)
        often = np.bincount(points)
        kinds = np.count_nonzero(often)
        code = np.cumsum(often > 0) - 1
        counts = np.bincount(row * kinds + code[points], minlength=len(part) * kinds).reshape(len(part), kinds)
        most = np.fromiter((len(t) // 100 + 1 for t in part), np.int64, len(part))[:, None]
        out[at:at + some] = np.where(counts <= most, counts, 0).sum(axis=1)
    return out


def _coded(titles: list[str], codes: np.ndarray) -> np.ndarray:
    """``codes`` of the titles' characters, a row a title, 0 behind its end."""
    points, _ = _points(titles)
    lens = np.fromiter(map(len, titles), np.int64, len(titles))
    out = np.zeros((len(titles), int(lens.max(initial=0))), np.uint8)
    out[np.arange(out.shape[1]) < lens[:, None]] = codes[points]
    return out


def _can_reach(v: np.ndarray, done: int, na: np.ndarray, nb: np.ndarray, back: int, ahead: int) -> np.ndarray:
    """The longest that common subsequences can become after ``done`` characters of the first titles; ``v`` has a 0 at each
    place of the second one where the common subsequence with them grows."""
    step = max(8, (back + ahead) // 8)
    most, left = np.zeros(len(na), np.int64), np.maximum(na - done, 0)
    below, word = np.zeros(len(na), np.int64), 0  # zeros in the words before ``word``
    for start in range(max(0, done - back), max(0, done + ahead) + 1, step):
        end = min(start + step, 64 * len(v))
        while word < end >> 6:
            below += 64 - np.bitwise_count(v[word]).astype(np.int64)
            word += 1
        common = below
        if end & 63:
            common = below + np.bitwise_count(~v[word] & np.uint64((1 << (end & 63)) - 1))
        np.maximum(most, common + np.minimum(left, np.maximum(nb - start, 0)), out=most)
    return most


class _Subsequences:
    """Longest common subsequences of titles of ``a`` and ``b``, of many pairs at once on arrays of 64-bit words.  More than
    ``CODES`` characters share codes, which only raises a length.

    So many characters in common leave few without a partner: a character's partner is that many places
    off at most, so only the words around the diagonal are looked at, and a pair goes as soon as what its beginnings
    have in common, wherever that of ``b`` ends, and all the rest together are too few."""

    def __init__(self, a: list[str], b: list[str]):
        often = np.bincount(_points(a if a is b else a + b)[0])
        # codes 1 to ``CODES`` - 1 for the most frequent characters; the others share them
        codes = np.arange(len(often)) % (CODES - 1) + 1
        kinds = np.argsort(-often, kind="stable")[:min(CODES - 1, np.count_nonzero(often))]
        codes[kinds] = np.arange(len(kinds)) + 1
        n_codes = CODES if np.count_nonzero(often) > len(kinds) else len(kinds) + 1
        codes = codes.astype(np.uint8)
        x = _coded(a, codes)
        y = x if a is b else _coded(b, codes)
        self.na, self.nb = np.count_nonzero(x, axis=1), np.count_nonzero(y, axis=1)
        self.x = x.T.astype(np.int64) * len(b)  # place, title -> where the masks of the code begin
        self.words = max(1, -(-y.shape[1] // 64))
        # word, code and title -> where the title has the code
        self.masks = np.zeros((self.words, n_codes, len(b)), np.uint64)
        row, col = np.nonzero(y)
        self.masks = self.masks.reshape(self.words, -1)
        np.add.at(self.masks.reshape(-1), ((col >> 6) * n_codes + y[row, col]) * len(b) + row, np.uint64(1) << (col & 63).astype(np.uint64))

    def lengths(self, i: np.ndarray, j: np.ndarray, least: np.ndarray) -> np.ndarray:
        """``lcs_length`` of each pair; 0 or less than it where it is below ``least``."""
        out = np.zeros(len(i), np.int64)
        late = [self._run(np.arange(at, min(at + PAIRS_AT_ONCE, len(i))), i, j, least, out, False) for at in range(0, len(i), PAIRS_AT_ONCE)]
        late = np.concatenate([*late, np.zeros(0, np.int64)])
        for at in range(0, len(late), PAIRS_AT_ONCE):
            self._run(late[at:at + PAIRS_AT_ONCE], i, j, least, out, True)
        return out

    def _run(self, some: np.ndarray, i: np.ndarray, j: np.ndarray, least: np.ndarray, out: np.ndarray, last: bool) -> np.ndarray:
        """Lengths of some pairs.  Returns those that are left for later when few go on, unless ``last``."""
        words, few = self.words, len(some) >> 4
        p, q = i[some], j[some]
        na, nb, need = self.na[p], self.nb[q], least[some]
        # characters of a title that may have no partner
        back, ahead = int((na - need).max()), int((nb - need).max())
        v = np.full((words, len(some)), ~np.uint64(0), np.uint64)
        for k in range(int(na.max())):
            at = self.x[k][p]
            at += q
            carry, top = None, min(words, ((k + ahead) >> 6) + 1)
            for w in range(max(0, k - back) >> 6, top):
                own, u = v[w], self.masks[w].take(at)
                u &= own
                if w + 1 == top and (k + ahead) >> 6 == w and (k + ahead) & 63 < 63:
                    u &= np.uint64((2 << ((k + ahead) & 63)) - 1)
                s = own + u
                if w + 1 < top:
                    over = s < own
                if carry is not None:
                    s += carry
                    if w + 1 < top:
                        over |= s < carry
                if w + 1 < top:
                    carry = over.astype(np.uint64)
                own ^= u
                own |= s
            if k % 8 == 7 and k >= back + ahead:
                go_on = _can_reach(v, k + 1, na, nb, back, ahead) >= need
                n = np.count_nonzero(go_on)
                if not last and n <= few:
                    return some[go_on]
                if 4 * n < 3 * len(some):
                    some, p, q, na, nb, need = (z[go_on] for z in (some, p, q, na, nb, need))
                    if not len(some):
                        return some
                    v = np.ascontiguousarray(v[:, go_on])
        out[some] = 64 * words - np.bitwise_count(v).sum(axis=0, dtype=np.int64)
        return some[:0]


def lcs_lengths(a: list[str], b: list[str], i: np.ndarray, j: np.ndarray, least: np.ndarray) -> np.ndarray:
    """``lcs_length`` of ``a[i]`` and ``b[j]`` for all pairs at once; 0 or less than it where it is below ``least``."""
    return _Subsequences(a, b).lengths(i, j, least)


def _block_pairs(ids_a, a: list[str], ids_b, b: list[str], same: bool, threshold: float):
    """(a, b, r_ab, r_ba) of the pairs of two blocks that reach the threshold either way, a < b."""
    order = sorted(range(len(a)), key=lambda k: len(a[k]))
    ids_a, a = [ids_a[k] for k in order], [a[k] for k in order]
    if same:
        ids_b, b = ids_a, a
    else:
        order = sorted(range(len(b)), key=lambda k: len(b[k]))
        ids_b, b = [ids_b[k] for k in order], [b[k] for k in order]
    if not a or not b:
        return
    na, nb = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b))
    reaching, bounds, decide = _Reaching(a, b, na, nb, threshold), _Bounds(a, b, na, nb, threshold), _Decide(ids_a, a, ids_b, b, na, nb, threshold)
    waiting, n = [], 0
    part = threshold / (2.0 - threshold)  # of a title's length that the shortest partner has
    for s in range(0, len(a), TILE):
        rows = slice(s, min(s + TILE, len(a)))
        first, end = np.searchsorted(nb, [np.floor(na[s] * part) - 1, np.ceil(na[rows][-1] / max(part, 1e-9)) + 2])
        for t in range(max(first, s) if same else first, end, ACROSS):
            i, j = reaching(rows, slice(t, min(t + ACROSS, end)))
            if same and t < rows.stop:
                i, j = i[i < j], j[i < j]
            i, j = bounds(i, j)
            waiting.append((i, j))
            n += len(i)
            if n >= PAIRS_TOGETHER:
                yield from decide(waiting)
                waiting, n = [], 0
    yield from decide(waiting)


def matching_ratio(a: str, b: str) -> float:
    """``SequenceMatcher(None, a, b).ratio()``.  Below ``AUTOJUNK`` characters of ``b`` the matches of all places are the bits of
    one integer, a row a character of ``a``: shifted onto itself by a row and a column it keeps the runs."""
    if len(b) >= AUTOJUNK or not a or not b:
        from difflib import SequenceMatcher

        return SequenceMatcher(None, a, b).ratio()
    size = len(b) // 8 + 1  # a column at least stays empty, so no run goes on in the next row
    stride = 8 * size
    at: dict[str, int] = {}
    for j, ch in enumerate(b):
        at[ch] = at.get(ch, 0) | 1 << j
    rows = {ch: bits.to_bytes(size, "little") for ch, bits in at.items()}
    none = bytes(size)
    every = int.from_bytes(b"".join([rows.get(ch, none) for ch in a]), "little")
    ones = int.from_bytes((b"\1" + bytes(size - 1)) * len(a), "little")
    found, regions = 0, [(0, len(a), 0, len(b))]
    while regions:
        alo, ahi, blo, bhi = regions.pop()
        runs = [(every >> alo * stride + blo) & ((ones & (1 << (ahi - alo) * stride) - 1) * ((1 << bhi - blo) - 1))]
        if not runs[0]:
            continue
        n = 1
        while longer := runs[-1] & runs[-1] >> n * (stride + 1):
            runs.append(longer)
            n *= 2
        best = runs.pop()
        for k in range(len(runs) - 1, -1, -1):
            if longer := best & runs[k] >> n * (stride + 1):
                best = longer
                n += 1 << k
        i, j = divmod((best & -best).bit_length() - 1, stride)  # the first in ``a``, then in ``b``
        i, j = i + alo, j + blo
        found += n
        if alo < i and blo < j:
            regions.append((alo, i, blo, j))
        if i + n < ahi and j + n < bhi:
            regions.append((i + n, ahi, j + n, bhi))
    return 2.0 * found / (len(a) + len(b))


class _Bounds:
    """Keeps the pairs with so many q-grams in common as the threshold leaves them.

    L matching characters in k blocks have L - (q - 1) k q-grams in common.  The n + m - 2 L others part at most that many
    blocks and one more.  If both titles have 200 characters or more, ``difflib`` starts a block at a character
    that is not popular in its second string, or at the beginnings of both."""

    def __init__(self, a: list[str], b: list[str], na: np.ndarray, nb: np.ndarray, threshold: float):
        self.a, self.b, self.na, self.nb, self.threshold, self.made = a, b, na, nb, threshold, {}

    def overlap(self, q: int) -> _Overlap:
        if q not in self.made:
            longest = int(max(self.na[-1], self.nb[-1]))
            width = 4 * FOLD if q == 2 and longest <= 2 * FOLD else max(GRAMS, 1 << min(16, (2 * longest).bit_length()) if q > 2 else 0)
            self.made[q] = _Overlap(self.a, self.b, q, width)
        return self.made[q]

    def seeds(self) -> tuple[np.ndarray, np.ndarray]:
        if 0 not in self.made:
            x = _seeds(self.a)
            self.made[0] = x, x if self.a is self.b else _seeds(self.b)
        return self.made[0]

    def enough(self, i: np.ndarray, j: np.ndarray, q: int) -> np.ndarray:
        t = self.na[i] + self.nb[j]
        least = np.ceil(self.threshold * t / 2.0 - 1e-9).astype(np.int64)
        blocks = t - 2 * least + 1
        if q > 2:
            x, y = self.seeds()
            blocks = np.minimum(blocks, np.maximum(x[i], y[j]) + 1)
        need = least - (q - 1) * blocks
        out = np.flatnonzero(need <= 0)
        asked = np.flatnonzero(need > 0)
        return np.sort(np.concatenate([out, asked[self.overlap(q)(i[asked], j[asked], need[asked])]]))

    def __call__(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(i):
            return i, j
        junk = (self.na[i] >= AUTOJUNK) & (self.nb[j] >= AUTOJUNK)
        if junk.any():
            long = np.flatnonzero(junk)
            long = long[self.enough(i[long], j[long], SEED_GRAM)]
            keep = np.sort(np.concatenate([np.flatnonzero(~junk), long]))
            i, j = i[keep], j[keep]
        # where bigrams leave most pairs, the common subsequences of all take less time
        few = slice(None, None, max(1, len(i) // 2048))
        if len(i) > 8192 and self.overlap(2).cost * len(i[few]) > self.na[-1] * (len(i[few]) - len(self.enough(i[few], j[few], 2))):
            return i, j
        keep = self.enough(i, j, 2)
        return i[keep], j[keep]


class _Decide:
    """The pairs that reach the threshold: common subsequences of all first, then ``difflib``."""

    def __init__(self, ids_a, a: list[str], ids_b, b: list[str], na: np.ndarray, nb: np.ndarray, threshold: float):
        self.ids_a, self.a, self.ids_b, self.b, self.na, self.nb, self.threshold, self.common = ids_a, a, ids_b, b, na, nb, threshold, None

    def __call__(self, pairs: list):
        i, j = (np.concatenate([*x, np.zeros(0, np.int64)]) for x in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 2
        if not len(i):
            return
        ids_a, a, ids_b, b, threshold = self.ids_a, self.a, self.ids_b, self.b, self.threshold
        least = np.ceil(threshold * (self.na[i] + self.nb[j]) / 2.0 - 1e-9).astype(np.int64)
        # few words: all pairs at once; long titles one by one, where Python's own integers are as fast
        few = (self.na[i] <= LCS_CHARS) & (self.nb[j] <= LCS_CHARS)
        common = np.full(len(i), -1, np.int64)
        if few.any():
            if self.common is None:
                short_a = [x if len(x) <= LCS_CHARS else "" for x in a]
                self.common = _Subsequences(short_a, short_a if a is b else [x if len(x) <= LCS_CHARS else "" for x in b])
            common[few] = self.common.lengths(i[few], j[few], least[few])
        go_on = ~few | (common >= least)
        for p, q, one_by_one, need in zip(i[go_on].tolist(), j[go_on].tolist(), (~few)[go_on].tolist(), least[go_on].tolist()):
            x, y, m, n = a[p], b[q], ids_a[p], ids_b[q]
            if m > n:
                x, y, m, n = y, x, n, m
            t = len(x) + len(y)
            if one_by_one and t and 2.0 * lcs_length(x, y, need) / t < threshold:
                continue
            r_ab, r_ba = matching_ratio(x, y), matching_ratio(y, x)
            if r_ab >= threshold or r_ba >= threshold:
                yield m, n, r_ab, r_ba


_PAIR_SCHEMA = "lang string, a long, b long, r_ab double, r_ba double"


def _make_compare(threshold: float):
    def compare(block: pa.Table) -> pa.Table:
        side = np.asarray(block.column("side").to_numpy())
        ids, keys = block.column("rep_id").to_pylist(), block.column("tkey").to_pylist()
        first, second = np.nonzero(side != 2)[0].tolist(), np.nonzero(side != 1)[0].tolist()
        same = bool(len(side)) and side[0] == 0
        rows = list(_block_pairs([ids[k] for k in first], [keys[k] for k in first], [ids[k] for k in second], [keys[k] for k in second], same, threshold))
        lang = block.column("lang")[0].as_py()
        cols = list(zip(*rows)) or [[], [], [], []]
        return pa.table({"lang": pa.array([lang] * len(rows), pa.string()), "a": pa.array(cols[0], pa.int64()), "b": pa.array(cols[1], pa.int64()),
                         "r_ab": pa.array(cols[2], pa.float64()), "r_ba": pa.array(cols[3], pa.float64())})

    return compare


def _band(n: str) -> Column:
    """Band of a length: ``BAND`` lengths each, then bands that grow by ``STEP``."""
    grown = F.floor(F.log(F.col(n) / F.lit(EVEN)) / F.log(F.lit(STEP))) + EVEN // BAND
    return F.when(F.col(n) < EVEN, F.floor(F.col(n) / BAND)).otherwise(grown).cast("int")


def similar_pairs(reps: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs (a < b by rep_id) of distinct titles in a language with
    ``max(ratio(a,b), ratio(b,a)) >= threshold`` and both directed ratios.

    Titles are dealt into blocks of one language, a band of lengths and at most about
    ``BLOCK_TITLES`` titles and ``BLOCK_CHARS`` characters; a hot band is many blocks.  Two blocks meet
    in one group when some of their lengths can reach the threshold, so a group holds two blocks at most and
    each pair meets once.  Within a group character counts, then bigram counts, then the
    longest common subsequence bound the ratio from above, many pairs at once; ``difflib`` decides the rest.
    """
    spark = reps.sparkSession
    n_parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism * 8)
    r = reps.select("lang", "tkey", "rep_id", F.length("tkey").alias("n")).withColumn("band", _band("n"))
    cells = materialize(r.groupBy("lang", "band").agg(
        F.ceil(F.greatest(F.lit(1), F.count("*") / F.lit(BLOCK_TITLES), F.sum("n") / F.lit(BLOCK_CHARS))).cast("int").alias("salts"),
        F.min("n").alias("shortest"), F.max("n").alias("longest")), "title-cells")
    # the shortest partner of a band's shortest title, one character less for the rounding
    least = F.floor(F.col("shortest") * F.lit(threshold / (2.0 - threshold))) - 1
    others = cells.select("lang", F.col("band").alias("band2"), F.col("salts").alias("salts2"), F.col("longest").alias("longest2"))
    met = (cells.join(others, "lang").where((F.col("band2") <= F.col("band")) & (F.col("longest2") >= least))
           .select("lang", "band", "band2", "salts2", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
           .select("lang", "band", "band2", "salt", F.explode(F.sequence(F.lit(0), F.col("salts2") - 1)).alias("salt2"))
           .where((F.col("band2") < F.col("band")) | (F.col("salt") <= F.col("salt2"))))
    met = materialize(met.withColumn("pair", F.monotonically_increasing_id()), "title-blocks")
    dealt = r.join(cells, ["lang", "band"]).select("lang", "tkey", "rep_id", "band", F.pmod(F.xxhash64("rep_id"), F.col("salts")).cast("int").alias("salt"))
    own = (F.col("band") == F.col("band2")) & (F.col("salt") == F.col("salt2"))
    first = met.select("lang", "band", "salt", "pair", F.when(own, 0).otherwise(1).alias("side"))
    second = met.where(~own).select("lang", F.col("band2").alias("band"), F.col("salt2").alias("salt"), "pair", F.lit(2).alias("side"))
    sent = dealt.join(first.unionByName(second), ["lang", "band", "salt"]).select("pair", "side", "lang", "rep_id", "tkey")
    # by number: AQE must not coalesce CPU-bound groups that are small in bytes
    return sent.repartition(n_parts, "pair").groupBy("pair").applyInArrow(_make_compare(threshold), _PAIR_SCHEMA)


_REPLAY_SCHEMA = "comp long, ord long, keep_ord long"


def replay(batches):
    """Greedy loop over components arriving sorted by (comp, ord).

    Each row carries the titles that it would match (``near``, its own among
    them).  State is the current slots and, for each title that holds slots,
    their places: a row costs its own neighbours, never a scan of all slots.
    """
    cur, slots, holds = None, [], {}  # slots: [founder ord, title, quality, ord]

    def emit(comp, sl):
        return pd.DataFrame({"comp": [comp] * len(sl), "ord": [x[0] for x in sl], "keep_ord": [x[3] for x in sl]})

    for pdf in batches:
        done = []
        for comp, o, rep, q, near in pdf[["comp", "ord", "rep_id", "quality", "near"]].itertuples(index=False):
            if comp != cur:
                if cur is not None:
                    done.append(emit(cur, slots))
                cur, slots, holds = comp, [], {}
            places = [holds[x][0] for x in near if holds.get(x)]
            if not places:
                heapq.heappush(holds.setdefault(rep, []), len(slots))
                slots.append([o, rep, q, o])
                continue
            slot = slots[min(places)]
            if q > slot[2]:
                if slot[1] != rep:
                    heapq.heappop(holds[slot[1]])  # the lowest slot of its title: it was the match
                    heapq.heappush(holds.setdefault(rep, []), min(places))
                slot[1], slot[2], slot[3] = rep, q, o
        if done:
            yield pd.concat(done, ignore_index=True)
    if cur is not None:
        yield emit(cur, slots)


def dedup_by_title(df: DataFrame, threshold: float = THRESHOLD, lang: str = "language", title: str = "title",
                   order: str = "ord") -> DataFrame:
    """Exact near-duplicate title dedup; survivors keep their columns and take
    the slot position (the founder's ``order``)."""
    base = materialize(df.select(
        F.col(order).alias("ord"), F.coalesce(F.col(lang), F.lit("")).alias("lang"), title_key(title).alias("tkey"),
        quality_score().alias("quality"),
    ), "title-base")
    reps = materialize(base.groupBy("lang", "tkey").agg(F.min("ord").alias("rep_id")), "title-reps")
    edges = materialize(similar_pairs(reps, threshold), "title-edges")
    linked = components(edges.select("a", "b")).select(F.col("node").alias("rep_id"), "comp")
    comp = materialize(reps.select("rep_id").join(linked, "rep_id", "left").select(
        "rep_id", F.coalesce("comp", "rep_id").alias("comp")), "title-components")
    arts = base.join(reps, ["lang", "tkey"]).join(comp, "rep_id")
    multi = comp.groupBy("comp").count().where(F.col("count") > 1).select("comp")
    # single-title components: identical titles only -> best quality, earliest on ties
    single = (
        arts.join(multi, "comp", "left_anti")
        .groupBy("comp")
        .agg(F.min("ord").alias("ord"),
             F.max_by(F.col("ord"), F.struct(F.col("quality"), -F.col("ord"))).alias("keep_ord"))
        .select("comp", "ord", "keep_ord")
    )
    # what each title matches: edges whose ratio reaches the threshold in that direction, and itself
    near = (edges.where(F.col("r_ab") >= threshold).select(F.col("a").alias("rep_id"), F.col("b").alias("x"))
            .unionByName(edges.where(F.col("r_ba") >= threshold).select(F.col("b").alias("rep_id"), F.col("a").alias("x")))
            .groupBy("rep_id").agg(F.collect_set("x").alias("near")))
    rows = (arts.join(multi, "comp").join(near, "rep_id", "left")
            .select("comp", "ord", "rep_id", "quality",
                    F.concat(F.array("rep_id"), F.coalesce("near", F.array().cast("array<bigint>"))).alias("near")))
    # components stay whole inside one range partition; rows stream in (comp, ord) order
    n_parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    replayed = rows.repartitionByRange(n_parts, "comp").sortWithinPartitions("comp", "ord").mapInPandas(replay, _REPLAY_SCHEMA)
    winners = single.unionByName(replayed).select(F.col("ord").alias("_slot"), F.col("keep_ord").alias("_keep"))
    out = df.join(winners, df[order] == winners["_keep"]).drop("_keep")
    return out.withColumn(order, F.col("_slot")).drop("_slot")


ship_by_value(__name__)
