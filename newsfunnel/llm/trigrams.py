"""Boolean trigram queries derived from regular expressions, and trigram postings of text slices.

The query of a regex holds for every text that the regex matches: literal runs
must occur, so their trigrams must; alternatives are joined by OR.  Trigrams are
taken over bytes with A-Z lower-cased, on both sides.  A regex without a
literal run of three bytes in every alternative has the query ``None``: it says nothing.
"""

from __future__ import annotations

import re
from re import _constants as C
from re import _parser

import numpy as np

from newsfunnel.llm.words import LOWER

MANY = 64  # sets of exact strings beyond this are cut into trigrams


def _lower(s: bytes) -> bytes:
    return s.lower()


def _all_of(parts):
    flat = []
    for p in parts:
        if p is None:
            continue
        flat.extend(p[1] if p[0] == "and" else [p])
    return None if not flat else flat[0] if len(flat) == 1 else ("and", flat)


def _any_of(parts):
    parts = list(parts)
    if any(p is None for p in parts):
        return None
    return parts[0] if len(parts) == 1 else ("or", parts)


def _query_of_strings(strings: set[bytes]):
    """Any of these strings occurs."""
    return _any_of(_all_of(("tri", s[i:i + 3]) for i in range(len(s) - 2)) for s in sorted(strings))


def _walk(nodes, folds: bool):
    """(exact strings or None, query) of a sequence of parsed nodes."""
    exact: set[bytes] | None = {b""}
    whole, parts = True, []

    def flush():
        if exact and exact != {b""}:
            parts.append(_query_of_strings(exact))

    for op, arg in nodes:
        got, query = _node(op, arg, folds)
        if got is not None and exact is not None and len(exact) * len(got) <= MANY:
            exact = {a + b for a in exact for b in got}
            continue
        flush()
        whole = False
        if got is not None:
            exact = got
        else:
            parts.append(query)
            exact = {b""}
    flush()
    return (exact if whole else None), _all_of(parts)


def _node(op, arg, folds: bool):
    if op is C.LITERAL:
        ch = chr(arg)
        # with case folding beyond ASCII a character may match others; say nothing about it
        return (None, None) if folds and not ch.isascii() else ({_lower(ch.encode())}, None)
    if op is C.AT:
        return {b""}, None
    if op is C.IN:
        if all(o is C.LITERAL and chr(a).isascii() for o, a in arg) and len(arg) <= 8:
            return {_lower(chr(a).encode()) for _, a in arg}, None
        return None, None
    if op is C.BRANCH:
        got = [_walk(b, folds) for b in arg[1]]
        if all(e is not None for e, _ in got):
            union = set().union(*(e for e, _ in got))
            if len(union) <= MANY:
                return union, None
        return None, _any_of(q if e is None else _query_of_strings(e) for e, q in got)
    if op is C.SUBPATTERN:
        return _walk(arg[3], folds)
    if op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT):
        low, high, sub = arg
        got, query = _walk(sub, folds)
        if got is not None and low <= 1 and high == 1:
            return (got if low else got | {b""}), None
        if low == 0:
            return None, None
        return None, query if got is None else _query_of_strings(got)
    return None, None


def trigram_query(pattern: str, flags: int = 0):
    """Nested ("and" | "or", [...]) over ("tri", bytes), or None."""
    tree = _parser.parse(pattern, flags)
    folds = bool(tree.state.flags & re.IGNORECASE) and not tree.state.flags & re.ASCII
    exact, query = _walk(tree, folds)
    return query if exact is None else _query_of_strings(exact)


def trigrams_of(query) -> set[bytes]:
    if query is None:
        return set()
    return {query[1]} if query[0] == "tri" else set().union(*map(trigrams_of, query[1]))


class Postings:
    """Inverted index of a slice of texts over the trigrams that some query uses."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, wanted: set[bytes]):
        self.rows = len(offs) - 1
        self.lists: dict[bytes, np.ndarray] = {t: np.zeros(0, np.int64) for t in wanted}
        if not wanted or len(data) < 3:
            return
        d = LOWER[data].astype(np.uint32)
        codes = d[:-2] << 16 | d[1:-1] << 8 | d[2:]
        table = _mark(frozenset(wanted))
        hit = np.flatnonzero(table[codes])
        row = np.searchsorted(offs, hit, "right") - 1
        inside = hit + 3 <= offs[row + 1]
        hit, row = hit[inside], row[inside]
        pairs = np.unique(codes[hit].astype(np.int64) << 32 | row)
        code, row = pairs >> 32, pairs & 0xFFFFFFFF
        for t in wanted:
            c = t[0] << 16 | t[1] << 8 | t[2]
            lo, hi = np.searchsorted(code, [c, c + 1])
            self.lists[t] = row[lo:hi]

    def matching(self, query) -> np.ndarray:
        """Rows whose trigrams satisfy the query: intersections and unions of posting lists."""
        if query is None:
            return np.arange(self.rows)
        kind, arg = query
        if kind == "tri":
            return self.lists[arg]
        lists = [self.matching(q) for q in arg]
        if kind == "or":
            return np.unique(np.concatenate(lists))
        lists.sort(key=len)  # shortest list first
        out = lists[0]
        for x in lists[1:]:
            out = np.intersect1d(out, x, assume_unique=True)
        return out


_marks: dict[frozenset, np.ndarray] = {}


def _mark(wanted: frozenset) -> np.ndarray:
    if wanted not in _marks:
        _marks.clear()
        t = np.zeros(1 << 24, bool)
        t[[w[0] << 16 | w[1] << 8 | w[2] for w in wanted]] = True
        _marks[wanted] = t
    return _marks[wanted]
