"""Byte-pair encoding by a dynamic program over byte prefixes.

For each byte prefix of a pre-token there is exactly one token that a valid
encoding of that prefix can end with.  The table of these last tokens holds
the encodings of all prefixes at once: walking back from any position by token
lengths spells the encoding of the text up to there, appending bytes only adds
entries, and an edit changes nothing before its pre-token.

Token numbers inside this module are merge ranks (bytes first, then merged
tokens in the order they are made), so "newer" means a larger number.
"""

from __future__ import annotations

import base64
import json
from array import array

import numpy as np
import regex

BORDER_ENTRIES = 80_000  # default bound of the table of known token borders


def read_ranks(path: str) -> tuple[list[bytes], list[int], dict[str, int]]:
    """Tokens by rank, their public ids, and the special strings of a vocabulary file."""
    if path.endswith(".tiktoken"):
        with open(path, "rb") as f:
            rows = sorted((int(r), base64.b64decode(t)) for t, r in (ln.split() for ln in f if ln.strip()))
        return [t for _, t in rows], [r for r, _ in rows], {}
    with open(path, encoding="utf-8") as f:
        d = json.load(f)
    # byte-level vocabularies spell each byte as a printable character: printable
    # latin-1 bytes stand for themselves, the others follow from U+0100 on
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain}
    byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}

    def raw(s: str) -> bytes:
        return bytes(byte_of[c] for c in s)

    vocab = d["model"]["vocab"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in d["model"]["merges"]]
    made = [a + b for a, b in merges]
    singles = sorted((t for t in vocab if len(t) == 1), key=vocab.get)
    order = singles + made
    return [raw(t) for t in order], [vocab[t] for t in order], {
        t["content"]: t["id"] for t in d.get("added_tokens", [])}


class PrefixBPE:
    """Prefix tables for one vocabulary.

    ``tokens`` are the byte strings by rank, ``ids`` their public ids,
    ``pattern`` splits a text into the pre-tokens that are encoded separately,
    ``special`` maps strings to ids that are cut out before splitting.
    """

    def __init__(self, tokens: list[bytes], ids: list[int], pattern: str, special: dict[str, int] | None = None):
        self.tokens, self.ids, self.special = tokens, ids, special or {}
        self.rank = {t: r for r, t in enumerate(tokens)}
        self.pattern = regex.compile(pattern)
        self.special_re = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.atoms = sum(1 for t in tokens if len(t) == 1)
        self._ok: dict[int, bool] = {}
        self.border_entries = BORDER_ENTRIES
        self.parts: list[tuple[int, int]] = []
        self.join: dict[int, int] = {}
        for r, t in enumerate(tokens):
            self.parts.append(self._parts_of(t, r) if len(t) > 1 else (r, r))
            if len(t) > 1:
                a, b = self.parts[r]
                self.join[a << 32 | b] = r
        #: every ending of a token -> its rank if it is a token itself, else -1
        self.suffixes: dict[bytes, int] = {}
        for t in tokens:
            for k in range(1, len(t)):
                self.suffixes.setdefault(t[k:], -1)
        self.suffixes.update(self.rank)

    def _parts_of(self, t: bytes, r: int) -> tuple[int, int]:
        """The two tokens whose merge makes ``t``: the only split that is stable under older merges."""
        for k in range(1, len(t)):
            a, b = self.rank.get(t[:k], r), self.rank.get(t[k:], r)
            if a < r and b < r and self._stable(a, b):
                return a, b
        raise ValueError(f"token {r} cannot be made by merges")

    def _stable(self, a: int, b: int) -> bool:
        """Do ``a`` and ``b`` stay two tokens when their bytes are encoded together?

        Undo the merges behind both, newest first.  If two tokens that meet at
        the border would join before the merge undone last, the border is lost.
        """
        due, atoms, join, parts = 1 << 62, self.atoms, self.join, self.parts
        while True:
            if join.get(a << 32 | b, due) < due:
                return False
            if a < atoms and b < atoms:
                return True
            if a > b:
                due, a = a, parts[a][1]
            else:  # of equal merges the left one comes first
                due, b = b + 1, parts[b][0]

    def table(self, piece: bytes, last: list[int] | None = None) -> list[int]:
        """Last token of every byte prefix of a pre-token, going on from ``last``."""
        last = [] if last is None else last
        suffixes, known = self.suffixes, self._ok
        for end in range(len(last) + 1, len(piece) + 1):
            found = []  # tokens that end here, shortest first; no longer one where no token ends in these bytes
            start = end - 1
            while start >= 0:
                t = suffixes.get(piece[start:end])
                if t is None:
                    break
                if t >= 0:
                    found.append((start, t))
                start -= 1
            for start, t in reversed(found):
                if start:
                    key = last[start - 1] << 32 | t
                    ok = known.get(key)
                    if ok is None:
                        if len(known) >= self.border_entries:
                            known.clear()
                        ok = known[key] = self._stable(last[start - 1], t)
                    if not ok:
                        continue
                last.append(t)
                break
        return last

    def walk(self, last: list[int], end: int | None = None) -> list[int]:
        """Tokens (ranks) of the prefix of ``end`` bytes, from its table."""
        out, pos, tokens = [], len(last) if end is None else end, self.tokens
        while pos > 0:
            t = last[pos - 1]
            out.append(t)
            pos -= len(tokens[t])
        out.reverse()
        return out

    def counts(self, last: list[int]) -> list[int]:
        """Number of tokens of every byte prefix of a pre-token."""
        n: list[int] = []
        for i, t in enumerate(last):
            before = i - len(self.tokens[t])
            n.append(1 + (n[before] if before >= 0 else 0))
        return n

    def piece_ids(self, piece: str) -> list[int]:
        ids = self.ids
        return [ids[t] for t in self.walk(self.table(piece.encode()))]

    def tables(self, pieces):
        """(piece, bytes shared with the one before, last tokens of its byte prefixes) of distinct
        pre-tokens in byte order: each goes on from the table of the prefix that it shares.  A table
        holds until the next one is asked for."""
        before, last = b"", []
        for raw, piece in sorted([(p.encode(), p) for p in pieces]):
            n = 0
            for x, y in zip(before, raw):
                if x != y:
                    break
                n += 1
            del last[n:]
            yield piece, n, self.table(raw, last)
            before = raw

    def encode_pieces(self, pieces) -> dict[str, list[int]]:
        """Ids of distinct pre-tokens."""
        ids, tokens, out = self.ids, self.tokens, {}
        for piece, _, last in self.tables(pieces):
            got, pos = [], len(last)
            while pos:
                t = last[pos - 1]
                got.append(ids[t])
                pos -= len(tokens[t])
            got.reverse()
            out[piece] = got
        return out

    def count_pieces(self, pieces) -> dict[str, list[int]]:
        """Token counts of all prefixes (of 1, 2, ... characters) of distinct pre-tokens."""
        tokens, out, n = self.tokens, {}, []
        for piece, shared, last in self.tables(pieces):
            del n[shared:]
            for i in range(shared, len(last)):
                before = i - len(tokens[last[i]])
                n.append(1 + (n[before] if before >= 0 else 0))
            out[piece] = n[:] if len(n) == len(piece) else [n[e - 1] for e in _ends(piece, piece.encode())]
        return out

    def sections(self, text: str):
        """(start, end, special id or None): the text cut at special strings."""
        pos = 0
        if self.special_re is not None:
            for m in self.special_re.finditer(text):
                if m.start() > pos:
                    yield pos, m.start(), None
                yield m.start(), m.end(), self.special[m.group()]
                pos = m.end()
        if pos < len(text):
            yield pos, len(text), None

    def encode(self, text: str) -> list[int]:
        """Public ids of a text."""
        out: list[int] = []
        for s, e, sid in self.sections(text):
            if sid is not None:
                out.append(sid)
            else:
                for p in self.pattern.findall(text if e - s == len(text) else text[s:e]):
                    out.extend(self.piece_ids(p))
        return out

    # -- prefix tables of whole texts ---------------------------------------------------

    def text_table(self, text: str) -> list[int]:
        """Last token of every byte prefix of a text without special strings, each
        pre-token on its own (a walk back from any pre-token border stays exact)."""
        out: list[int] = []
        for p in self.pattern.findall(text):
            out.extend(self.table(p.encode()))
        return out

    def replace(self, text: str, last: list[int], start: int, stop: int, new: str) -> tuple[str, list[int]]:
        """Text and table after ``text[start:stop]`` became ``new`` (an append is
        start = stop = len(text)); only pre-tokens near the edit are made anew.

        A pre-token depends on its own characters and on two after it (white
        space gives back its last character; a contraction takes three).  Pre-tokens that end earlier are
        kept; after the edit both splits run on until they share a border.
        """
        after = text[:start] + new + text[stop:]
        shift = len(after) - len(text)
        old_at = new_at = keep = 0
        if start:
            for m in self.pattern.finditer(text):
                if max(m.end() + 2, m.start() + 3) > start:
                    break
                keep = m.end()
        old_at = new_at = keep
        out = last[:len(text[:keep].encode())]
        old_it, new_it = self.pattern.finditer(text, keep), self.pattern.finditer(after, keep)
        while new_at < len(after):
            while old_at + shift < new_at and old_at < len(text):
                old_at = next(old_it).end()
            if old_at >= stop and old_at + shift == new_at and new_at >= start + len(new) and old_at < len(text):
                return after, out + last[len(text[:old_at].encode()):]
            m = next(new_it)
            out.extend(self.table(m.group().encode()))
            new_at = m.end()
        return after, out


def _ends(text: str, raw: bytes) -> list[int]:
    """Byte end of every character."""
    if len(raw) == len(text):
        return list(range(1, len(raw) + 1))
    out, at = [], 0
    for c in text:
        p = ord(c)
        at += 1 if p < 0x80 else 2 if p < 0x800 else 3 if p < 0x10000 else 4
        out.append(at)
    return out


def exact_counts(bpe: PrefixBPE, text: str, known: dict[str, list[int]] | None = None) -> array:
    """Token count of every prefix ``text[:1]``, ``text[:2]``, ... of a text without special strings.

    Inside a pre-token the count is read from its prefix table, ``n[end] = 1 + n[end - len(last
    token)]``, since a prefix of a run of letters, digits or signs is a pre-token of its own.  Two
    kinds of places differ when the text is cut there: white space at the end is one
    pre-token, whatever it was split into (its table is continued over the whole run), and a
    contraction that is not complete falls into its characters.  ``known``: tables made before.
    """
    out, base, at = array("I"), 0, 0
    run_base, run_raw, run_last = 0, b"", []  # the white space that ends at ``at``
    for piece in bpe.pattern.findall(text):
        raw = piece.encode()
        last = known.get(piece) if known else None
        last = bpe.table(raw) if last is None else last
        n, ends = bpe.counts(last), _ends(piece, raw)
        if piece.isspace():
            if run_raw:
                run_raw += raw
                bpe.table(run_raw, run_last)
                whole, shift = bpe.counts(run_last), len(run_raw) - len(raw)
                out.extend(run_base + whole[shift + e - 1] for e in ends)
            else:
                run_base, run_raw, run_last = base, raw, list(last)
                out.extend(base + n[e - 1] for e in ends)
        else:
            values = [base + n[e - 1] for e in ends]
            if piece[0].isspace() and run_raw:
                run_raw += piece[0].encode()
                values[0] = run_base + len(bpe.walk(bpe.table(run_raw, run_last)))
            elif piece[0] == "'" and 1 < len(piece) <= 3:
                for j in range(1, len(piece)):
                    values[j - 1] = base + len(bpe.encode(piece[:j]))
            out.extend(values)
            run_raw = b""
        base += n[-1]
        at += len(piece)
    return out


class PrefixCounts:
    """Exact token count of every prefix of one text, stored at every place; all
    questions are look-ups.

    A special string that is cut is plain text and can join the text before it, so a
    stretch of text is counted together with all but the last character of the special
    string after it.
    """

    def __init__(self, bpe: PrefixBPE, text: str):
        self.upto = array("I", [0])  # by number of characters
        sections = list(bpe.sections(text))
        base, k = 0, 0
        while k < len(sections):
            s, e, sid = sections[k]
            stop = s if sid is not None else e
            after = sections[k] if sid is not None else sections[k + 1] if k + 1 < len(sections) else None
            cut = after[1] - 1 if after else stop
            n = exact_counts(bpe, text[s:cut])
            self.upto.extend(base + x for x in n)
            base += n[stop - s - 1] if stop > s else 0
            if after:
                base += 1
                self.upto.append(base)
            k += 1 if sid is not None or not after else 2
        self.total = base

    def count(self, end: int) -> int:
        """Tokens of ``text[:end]``."""
        return self.upto[max(0, min(end, len(self.upto) - 1))]

    def cut(self, limit: int) -> int:
        """Length of the longest prefix of at most ``limit`` tokens."""
        fit = np.flatnonzero(np.frombuffer(self.upto, np.uint32) <= limit)
        return int(fit[-1]) if len(fit) else 0
