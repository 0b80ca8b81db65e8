"""Byte-level BPE encoding, decoding, re-encoding near edits and prefix token counts.

All functions are DataFrame -> DataFrame and narrow: one Arrow pass over the
rows, no shuffle; the vocabulary (bounded by its file) travels as a broadcast
variable and each Python worker builds its tables once.  The method is the
prefix table of ``prefix_bpe``.

Defined results: a null text counts as ''; '' has no tokens; a null doc_id or
other null columns pass through; repeated rows are encoded each on its own;
an empty table gives an empty table; an existing column of an added column's
name is replaced (the ``*_col`` parameters choose other names).
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from newsfunnel.llm.common import held, int_lists, map_batches, ship, slices, without
from newsfunnel.llm.prefix_bpe import BORDER_ENTRIES, PrefixBPE, PrefixCounts, exact_counts, read_ranks

SLICE = 3 << 20  # bytes of text that are encoded together
COUNT_SLICE = 6 << 20  # bytes of text that are counted together: no ids are held
MEMO = 80_000  # default bound of the chunks that a worker remembers, about 200 bytes each
_OWNER = "bpe"  # of the tables by vocabulary that a worker holds
_ODD_SPACE = re.compile(r" \s|[ ]\Z")
_JOINED = re.compile(r"\s\s|'")  # where counts of prefixes can differ from those inside the pre-tokens


def vocabulary(spark: SparkSession, path: str, pattern: str) -> Broadcast:
    """Read a ``.tiktoken`` or ``.json`` byte-level vocabulary once and broadcast it."""
    ship(spark)
    tokens, ids, special = read_ranks(path)
    return spark.sparkContext.broadcast((path, pattern, tokens, ids, special))


class _Ids(dict):
    """Space-led chunk -> its ids as int32 bytes; bounded, filled slice by slice."""

    def __init__(self, bpe: PrefixBPE):
        self.bpe, self.entries = bpe, MEMO

    def value(self, ids: list[int]):
        return array("i", ids).tobytes()

    def of(self, text: str):
        return self.value(self.bpe.encode(text))

    def prepare(self, texts: list[list[str] | None], entries: int) -> None:
        """Encode all new chunks of a slice together, in byte order of their pre-tokens."""
        findall, seen = self.bpe.pattern.findall, set()
        self.entries, self.bpe.border_entries = entries, max(min(BORDER_ENTRIES, entries), entries // 2)
        for chunks in texts:
            if chunks:
                seen.update(chunks[1:])
        if len(self) + len(seen) > self.entries:  # keep what this slice uses again
            kept = {c: self[c] for c in seen if c in self}
            self.clear()
            self.update(kept)
        # plain letters are one pre-token; the pattern splits the rest
        split = [(c, [" " + c] if c.isascii() and c.isalpha() else findall(" " + c)) for c in seen if c not in self]
        ids = self.bpe.encode_pieces({p for _, ps in split for p in ps})
        for c, ps in split:
            self[c] = self.value(ids[ps[0]] if len(ps) == 1 else [i for p in ps for i in ids[p]])


class _Counts(_Ids):
    """Space-led chunk -> the token counts of all its prefixes (of 1, 2, ... characters), as bytes
    where they are small, else as an array; the last is the chunk's own."""

    def value(self, counts):
        return bytes(list(counts)) if len(counts) < 256 else array("I", counts)

    def of(self, text: str):
        return self.value(exact_counts(self.bpe, text)) if text else b"\0"

    def prepare(self, texts: list[list[str] | None], entries: int) -> None:
        """Count all new chunks of a slice together, each distinct pre-token once."""
        findall, seen = self.bpe.pattern.findall, set()
        self.entries, self.bpe.border_entries = entries, max(min(BORDER_ENTRIES, entries), entries // 2)
        for chunks in texts:
            if chunks:
                seen.update(chunks[1:])
        if len(self) + len(seen) > self.entries:
            kept = {c: self[c] for c in seen if c in self}
            self.clear()
            self.update(kept)
        split = []
        for c in seen:
            if c in self:
                continue
            if _JOINED.search(c):
                self[c] = self.of(" " + c)
            else:  # plain letters are one pre-token; the pattern splits the rest
                split.append((c, [" " + c] if c.isascii() and c.isalpha() else findall(" " + c)))
        # what a chunk of one pre-token was counted for serves the others that begin with it
        known = {p: self[p[1:]] for _, ps in split for p in ps if p[0] == " " and p[1:] in self}
        known |= self.bpe.count_pieces({p for _, ps in split for p in ps if p not in known})
        for c, ps in split:
            counts = known[ps[0]]
            if len(ps) > 1:
                counts = list(counts)
                for p in ps[1:]:
                    base = counts[-1]
                    counts += [base + n for n in known[p]]
            self[c] = self.value(counts)


def _tables(vocab: Broadcast) -> tuple[PrefixBPE, _Ids, _Counts]:
    path, pattern, tokens, ids, special = vocab.value
    key = (path, pattern, len(tokens))
    tables = held(_OWNER)
    if key not in tables:
        bpe = PrefixBPE(tokens, ids, pattern, special)
        tables[key] = bpe, _Ids(bpe), _Counts(bpe)
    return tables[key]


def _chunks(bpe: PrefixBPE, text: str) -> list[str] | None:
    """The text cut before each single space; None if white space or special strings make that unsafe.

    A space before a non-space character always begins a pre-token, whatever
    stands before it, so the chunks can be encoded (and remembered) alone.
    """
    if _ODD_SPACE.search(text) or bpe.special_re is not None and bpe.special_re.search(text):
        return None
    return text.split(" ")


def _added(df: DataFrame, *cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([*df.schema.fields, *(T.StructField(n, t) for n, t in cols)])


def _with(batch: pa.RecordBatch, *arrays: pa.Array) -> list[pa.Array]:
    return [*batch.columns, *arrays]


def _encoder(vocab: Broadcast, text_col: str, table: bool, names: list[str], keep: list[str], memo: int, part_bytes: int = SLICE):
    """Batch function: the columns ``keep`` with the ids (and the table) of ``text_col``."""

    def run(batch):
        bpe, cache, _ = _tables(vocab)
        for part in slices(batch, text_col, part_bytes):
            flats, counts, tabs = [], [], []
            texts = [t or "" for t in part.column(text_col).to_pylist()]
            split = [_chunks(bpe, t) for t in texts]
            cache.prepare(split, memo)
            for text, chunks in zip(texts, split):
                if chunks is None:
                    raw = cache.of(text)
                else:
                    raw = cache.of(chunks[0]) + b"".join(map(cache.__getitem__, chunks[1:]))
                flats.append(raw)
                counts.append(len(raw) // 4)
                if table:
                    tabs.append(bpe.text_table(text))
            out = [int_lists(np.frombuffer(b"".join(flats), np.int32), np.array(counts))]
            if table:
                out.append(pa.array(tabs, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *out], names=names)

    return run


def _byte_table(vocab: Broadcast) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all ids in a row, start, length) by id."""
    path, _, tokens, ids, special = vocab.value
    key = ("bytes", path, len(tokens))
    tables = held(_OWNER)
    if key not in tables:
        by_id = dict(zip(ids, tokens)) | {i: s.encode() for s, i in special.items()}
        top = max(by_id) + 1
        size = np.array([len(by_id.get(i, b"")) for i in range(top)], np.int64)
        tables[key] = (np.frombuffer(b"".join(by_id.get(i, b"") for i in range(top)), np.uint8),
                       np.concatenate([[0], np.cumsum(size)[:-1]]), size)
    return tables[key]


def _decoder(vocab: Broadcast, ids_col: str, names: list[str]):
    """Batch function: all columns with the bytes of ``ids_col``."""

    def run(batch):
        blob, at, length = _byte_table(vocab)
        step = 256
        for k in range(0, batch.num_rows, step):
            part = batch.slice(k, step)
            lists = part.column(ids_col)
            lens = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            if len(ids) and (ids.min() < 0 or ids.max() >= len(length) or not length[ids].all()):
                raise ValueError("an id is not in the vocabulary")
            size = length[ids]
            ends = np.cumsum(size)
            total = int(ends[-1]) if len(ends) else 0
            data = blob[np.arange(total) + np.repeat(at[ids] - (ends - size), size)]
            byte_ends = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(lens)])]
            arr = pa.Array.from_buffers(pa.binary(), len(lens), [None, pa.py_buffer(byte_ends.astype(np.int32).tobytes()),
                                                                 pa.py_buffer(data.tobytes())])
            yield pa.RecordBatch.from_arrays(_with(part, arr), names=names)

    return run


_INTS = T.ArrayType(T.IntegerType(), False)


def encode(df: DataFrame, vocab: Broadcast, text_col: str = "text", ids_col: str = "ids",
           table_col: str | None = None, memo: int = MEMO) -> DataFrame:
    """Add the token ids of each whole text; with ``table_col`` also the last
    token (merge rank) of every byte prefix, for ``reencode`` (texts without
    special strings)."""
    df = without(df, ids_col, table_col)
    schema = _added(df, (ids_col, _INTS), *([(table_col, _INTS)] if table_col else []))
    return map_batches(df, _encoder(vocab, text_col, bool(table_col), schema.names, df.columns, memo), schema, _OWNER)


def decode(df: DataFrame, vocab: Broadcast, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """Add the bytes that each id list stands for; a null list gives no bytes.
    An id outside the vocabulary raises ``ValueError``."""
    df = without(df, bytes_col)
    schema = _added(df, (bytes_col, T.BinaryType()))
    return map_batches(df, _decoder(vocab, ids_col, schema.names), schema, _OWNER)


def encode_decode(df: DataFrame, vocab: Broadcast, text_col: str = "text", ids_col: str = "ids",
                  bytes_col: str = "decoded", memo: int = MEMO, part_bytes: int = SLICE) -> DataFrame:
    """Replace the text by its token ids and the bytes that these decode to, in one pass."""
    df = without(df, ids_col, bytes_col)
    fields = [f for f in df.schema.fields if f.name != text_col]
    keep = [f.name for f in fields]
    schema = T.StructType([*fields, T.StructField(ids_col, _INTS), T.StructField(bytes_col, T.BinaryType())])
    code, back = _encoder(vocab, text_col, False, [*keep, ids_col], keep, memo, part_bytes), _decoder(vocab, ids_col, schema.names)

    def run(batch):
        for coded in code(batch):
            yield from back(coded)

    return map_batches(df, run, schema, _OWNER)


def reencode(df: DataFrame, vocab: Broadcast, text_col: str, table_col: str, start_col: str, stop_col: str, new_col: str,
             out_text: str = "new_text", out_ids: str = "new_ids", out_table: str = "new_table") -> DataFrame:
    """Replace ``text[start:stop]`` (code points) by ``new`` and bring ids and table
    up to date from the stored prefix table; an append has start = stop = length.
    Null positions mean the end of the text, a null replacement means ''."""
    df = without(df, out_text, out_ids, out_table)
    schema = _added(df, (out_text, T.StringType()), (out_ids, T.ArrayType(T.IntegerType(), False)),
                    (out_table, T.ArrayType(T.IntegerType(), False)))
    names = schema.names

    def run(batch):
        bpe, _, _ = _tables(vocab)
        texts, ids, tabs = [], [], []
        for text, last, s, e, new in zip(*(batch.column(c).to_pylist() for c in (text_col, table_col, start_col, stop_col, new_col))):
            text = text or ""
            s = len(text) if s is None else min(s, len(text))
            e = len(text) if e is None else min(max(e, s), len(text))
            text, last = bpe.replace(text, last or [], s, e, new or "")
            texts.append(text)
            tabs.append(last)
            ids.append([bpe.ids[t] for t in bpe.walk(last)])
        ints = pa.list_(pa.int32())
        return pa.RecordBatch.from_arrays(_with(batch, pa.array(texts, pa.string()), pa.array(ids, ints), pa.array(tabs, ints)), names=names)

    return map_batches(df, run, schema, _OWNER)


def _fit(bpe: PrefixBPE, chunks: list[str], counts: list, limit: int) -> int:
    """Longest prefix (code points) of at most ``limit`` tokens, from the counts stored for each chunk's prefixes."""
    ends = np.cumsum([c[-1] for c in counts])
    k = int(np.searchsorted(ends, limit, "right"))  # the first chunk that goes beyond; no place in a later chunk is within
    start = sum(map(len, chunks[:k])) + max(0, k - 1)  # where chunk k starts, its space included
    base = int(ends[k - 1]) if k else 0

    def with_space(i: int) -> int | None:
        """Tokens up to the space after chunk i, where white space before joins it."""
        c = chunks[i]
        if not c or not c[-1].isspace():
            return None
        text = c.rstrip() if c.strip() else ""
        led, text = ("", text) if i == 0 else (" ", text)
        shown = len(led + text)
        head = counts[i][shown - 1] if shown else 0
        return (int(ends[i - 1]) if i else 0) + head + len(bpe.encode(c[len(text):] + " "))

    if k + 1 < len(chunks):
        joined = with_space(k)
        if joined is not None and joined <= limit:
            return start + len(chunks[k]) + (k > 0) + 1
    inner = np.frombuffer(counts[k], np.uint8 if isinstance(counts[k], bytes) else np.uint32).astype(np.int64) + base
    if not chunks[k]:
        inner = inner[:0]
    if k and len(inner):
        joined = with_space(k - 1)
        inner[0] = inner[0] if joined is None else joined
    fit = np.flatnonzero(inner <= limit)
    return start + (int(fit[-1]) + 1 if len(fit) else 0)


def token_counts(df: DataFrame, vocab: Broadcast, limit: int, text_col: str = "text", bytes_col: str = "n_bytes",
                 tokens_col: str = "n_tokens", over_col: str = "over_limit", fit_col: str = "fit_chars",
                 memo: int = MEMO) -> DataFrame:
    """Add the UTF-8 length, the token count, whether it is over ``limit``, and the
    length in code points of the longest prefix within the limit.

    All three come from stored counts of prefixes: those of each space-led chunk (remembered
    by the worker) and, for texts with wide white space or special strings, of the whole text."""
    df = without(df, bytes_col, tokens_col, over_col, fit_col)
    schema = _added(df, (bytes_col, T.LongType()), (tokens_col, T.LongType()), (over_col, T.BooleanType()), (fit_col, T.LongType()))
    names = schema.names

    def run(batch):
        bpe, _, cache = _tables(vocab)
        for part in slices(batch, text_col, COUNT_SLICE):
            size, total, fit = [], [], []
            texts = [t or "" for t in part.column(text_col).to_pylist()]
            split = [_chunks(bpe, t) for t in texts]
            cache.prepare(split, memo)
            for text, chunks in zip(texts, split):
                if chunks is None:
                    whole = PrefixCounts(bpe, text)
                    n = whole.total
                    fits = whole.cut(limit)
                else:
                    counts = [cache.of(chunks[0]), *map(cache.__getitem__, chunks[1:])]
                    n = sum([c[-1] for c in counts])
                    fits = len(text) if n <= limit else _fit(bpe, chunks, counts, limit)
                size.append(len(text.encode()))
                total.append(n)
                fit.append(fits)
            arrs = (pa.array(size, pa.int64()), pa.array(total, pa.int64()), pa.array([n > limit for n in total], pa.bool_()),
                    pa.array(fit, pa.int64()))
            yield pa.RecordBatch.from_arrays(_with(part, *arrs), names=names)

    return map_batches(df, run, schema, _OWNER)


def prefix_counts(df: DataFrame, vocab: Broadcast, ends_col: str, text_col: str = "text", counts_col: str = "counts") -> DataFrame:
    """Token counts of the prefixes that end at the listed positions (code points);
    a null list gives an empty one, positions beyond the text mean its end."""
    df = without(df, counts_col)
    schema = _added(df, (counts_col, T.ArrayType(T.LongType(), False)))
    names = schema.names

    def run(batch):
        bpe, _, _ = _tables(vocab)
        out = []
        for text, ends in zip(batch.column(text_col).to_pylist(), batch.column(ends_col).to_pylist()):
            pc = PrefixCounts(bpe, text or "")
            out.append([pc.count(e) for e in ends or []])
        return pa.RecordBatch.from_arrays(_with(batch, pa.array(out, pa.list_(pa.int64()))), names=names)

    return map_batches(df, run, schema, _OWNER)
