"""Line dedup by content-defined chunks of lines.

A rolling hash over the hashes of the last ``WINDOW`` lines closes a chunk
wherever it falls into one residue class, so boundaries depend on the lines
around them only and shift with them: a passage inserted into another text is
cut the same way after its first window.  A line of many words is a chunk of
its own.  Chunks of several lines (or one such long line) that occur more than
once anywhere are compared byte by byte; every occurrence but the first (by
doc_id, then place) is removed from its text.

Boundaries lie where the hashes put them, so a short passage between foreign
lines may share no chunk with its copies.  So runs are joined besides: from each
line the fewest lines forward, and the fewest backward, that reach
``LONG_LINE`` words, keyed by their own lines only.  Together they cover every
line of every repeated passage of so many words, to its true ends, and nothing
else.  Runs are equal if the SHA-256 of their bytes are.  An occurrence that
overlaps the first one stays.

Hashes that repeat are marked in a bitmap of fixed size, which picks the chunks
whose text is compared before any text is shuffled.  Shuffled are the texts of
repeated chunks, the digests of repeated runs and, once, the documents.

Defined results: a null text has no chunks and stays null; '' stays ''; rows
equal in doc_id and text count as one document and get the same result; null
ids come last in the order; an empty table gives an empty table; other columns
pass through, one named like the count is replaced.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsfunnel.functions.lineage import materialize
from newsfunnel.llm.common import bit_marks, free_name, map_batches, marked, slices, text_arrays, without
from newsfunnel.llm.words import mix, powers, separators

WINDOW = 2  # lines that a boundary depends on
DIVISOR = 2  # a line in so many ends a chunk, on average
LONG_LINE = 50  # words from which a line is a chunk of its own
MOST_LINES = 64  # a chunk is closed here at the latest
MARK_BITS = 1 << 25  # 4 MB, whatever the input; more repeated chunks only let more single ones be looked at


def line_hashes(lines: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, lines), np.uint64, len(lines))


_BLANK = separators(bytes([*range(0x09, 0x0E), *range(0x1C, 0x21)]))
_WIDE_LEAD = separators(b"\xc2\xe1\xe2\xe3")
_WIDE = np.array([0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])


def blank_bytes(data: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 belong to white space, as ``str.split`` sees it."""
    out = _BLANK[data]
    at = np.flatnonzero(_WIDE_LEAD[data])
    if len(at):
        lead, second, third = (data[np.minimum(at + k, len(data) - 1)].astype(np.int64) for k in range(3))
        two = lead == 0xC2
        wide = np.isin(np.where(two, second, (lead & 15) << 12 | (second & 63) << 6 | third & 63), _WIDE)
        at, two = at[wide], two[wide]
        out[at] = out[at + 1] = True
        out[at[~two] + 2] = True
    return out


class Lines:
    """The lines of several texts, numbered throughout: ``first`` line of each text, byte ``start``
    and ``end``, hash and number of words of each line; read once for chunks and runs."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        self.data = data.tobytes()
        breaks = np.flatnonzero(data == 10)
        self.first = np.concatenate([[0], np.cumsum(1 + np.diff(np.searchsorted(breaks, offs)))])
        n = int(self.first[-1])
        self.opens = np.zeros(n, bool)  # first line of its text
        self.opens[self.first[:-1]] = True
        self.ends = np.zeros(n, bool)
        self.ends[self.first[1:] - 1] = True
        self.start, self.end = np.empty(n, np.int64), np.empty(n, np.int64)
        self.start[self.opens], self.start[~self.opens] = offs[:-1], breaks + 1
        self.end[self.ends], self.end[~self.ends] = offs[1:], breaks
        blank = blank_bytes(data)
        before = np.ones(len(data), bool)
        before[1:] = blank[:-1]
        before[offs[:-1][offs[:-1] < len(data)]] = True
        words = np.flatnonzero(~blank & before)
        self.words = np.searchsorted(words, self.end) - np.searchsorted(words, self.start)
        self.upto = np.concatenate([[0], np.cumsum(self.words)])
        self.hashes = line_hashes([self.data[s:e] for s, e in zip(self.start.tolist(), self.end.tolist())])

    def body(self, at: int, end: int) -> bytes:
        """Bytes of the lines ``at`` to ``end`` - 1 of one text."""
        return self.data[self.start[at]:self.end[end - 1]]

    def row(self, at: np.ndarray) -> np.ndarray:
        """Text of each line."""
        return np.searchsorted(self.first, at, "right") - 1

    def boundaries(self) -> list[int]:
        """Line after the last one of each chunk."""
        n = len(self.hashes)
        long = self.words >= LONG_LINE
        alone = long.copy()
        alone[:-1] |= long[1:] & ~self.opens[1:]
        rolled, nth = self.hashes.copy(), np.arange(n) - np.repeat(self.first[:-1], np.diff(self.first))
        for j in range(1, min(WINDOW, n)):
            rolled[j:] += np.where(nth[j:] >= j, mix(self.hashes[:n - j] + np.uint64(j)), np.uint64(0))
        closes = (mix(rolled) % np.uint64(DIVISOR) == 0).tolist()
        long, alone, first = long.tolist(), alone.tolist(), self.first.tolist()
        out: list[int] = []
        for s, e in zip(first, first[1:]):
            size, before = 0, len(out)
            for i in range(s, e):
                size += 1
                # a window that reaches before the chunk's first line would depend on the chunk before
                if alone[i] or closes[i] and size >= WINDOW or size >= MOST_LINES:
                    out.append(i + 1)
                    size = 0
            if size == 1 and len(out) > before and not long[e - 1] and not long[out[-1] - 1]:
                out[-1] = e  # a single last line joins the chunk before it
            elif size:
                out.append(e)
        return out

    def chunks(self) -> tuple[np.ndarray, np.ndarray]:
        """First line and line after the last one of the chunks that may be removed."""
        end = np.array(self.boundaries(), np.int64)
        at = np.concatenate([np.zeros(min(1, len(end)), np.int64), end[:-1]])
        words = self.upto[end] - self.upto[at]
        keep = (words > 0) & ((end - at > 1) | (words >= LONG_LINE))
        return at[keep], end[keep]

    def chunk_hashes(self, at: np.ndarray, end: np.ndarray) -> np.ndarray:
        return np.array([xxhash.xxh3_64_intdigest(self.body(a, e)) - (1 << 63) for a, e in zip(at.tolist(), end.tolist())], np.int64)

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First line, line after the last one, and hash of the shortest runs of ``LONG_LINE``
        words: one from each line forward, one from each line backward, inside its text."""
        upto, n = self.upto, len(self.hashes)
        sizes = np.diff(self.first)
        ends = np.searchsorted(upto, upto[:n] + LONG_LINE)
        starts = np.searchsorted(upto, upto[1:] - LONG_LINE, "right") - 1
        fore = np.flatnonzero(ends <= np.repeat(self.first[1:], sizes))
        back = np.flatnonzero(starts >= np.repeat(self.first[:-1], sizes))
        both = np.unique(np.concatenate([fore * (n + 1) + ends[fore], starts[back] * (n + 1) + back + 1]))
        at, end = both // (n + 1), both % (n + 1)
        power, inverse = powers(n)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(self.hashes) * power)])
        h = mix((sums[end] - sums[at]) * inverse[at] + mix((end - at).astype(np.uint64)))
        return at, end, h.view(np.int64)


def lines_of(*texts: str) -> Lines:
    return Lines(*text_arrays(pa.array(texts, pa.large_string())))


def chunks(text: str) -> list[tuple[int, int, str]]:
    """(place of the first line, number of lines, bytes as text) of the chunks that may be removed."""
    lines = lines_of(text)
    return [(a, e - a, lines.body(a, e).decode()) for a, e in zip(*(x.tolist() for x in lines.chunks()))]


def runs(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The runs of one text, given by its lines."""
    return lines_of("\n".join(lines)).runs()


def run_digests(lines: list[str], spans: list[tuple[int, int]]) -> dict[tuple[int, int], bytes]:
    """SHA-256 of runs (first line, line after the last one).  Lines without words at a
    run's end are added one by one to the digest of the others: many of them would
    else be read once for each run."""
    raw = [x.encode() for x in lines]
    done: dict[tuple[int, int], bytes] = {}
    for at, end in sorted(spans, key=lambda s: (-s[0], s[1])):
        outer = []
        while (at, end) not in done:
            if not lines[at].strip():
                outer.append((at, end, b"<" + raw[at]))
                at += 1
            elif not lines[end - 1].strip():
                outer.append((at, end, b">" + raw[end - 1]))
                end -= 1
            else:
                done[at, end] = sha256(b"\n".join(raw[at:end])).digest()
        d = done[at, end]
        for at, end, line in reversed(outer):
            d = done[at, end] = sha256(d + line).digest()
    return done


def piece_hashes(*texts: str) -> np.ndarray:
    """Hashes of what may be removed, chunks and runs."""
    return _piece_hashes(lines_of(*texts))


def _piece_hashes(lines: Lines) -> np.ndarray:
    return np.concatenate([lines.chunk_hashes(*lines.chunks()), lines.runs()[2]])


def pieces(lines: Lines, wanted) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Text, place of the first line, number of lines, hash and identity of the chunks and runs whose
    hashes are ``wanted``; the identity is a chunk's bytes or the digest of a run's."""
    cut, end = lines.chunks()
    own = lines.chunk_hashes(cut, end)
    chosen = wanted(own)
    cut, end, own = cut[chosen], end[chosen], own[chosen]
    bodies = [b"=" + lines.body(a, e) for a, e in zip(cut.tolist(), end.tolist())]
    at, stop, hashes = lines.runs()
    chosen = wanted(hashes)
    at, stop, hashes = at[chosen], stop[chosen], hashes[chosen]
    rows = lines.row(at)  # in order, as runs are
    for r in np.unique(rows).tolist():
        s, e = lines.first[r:r + 2].tolist()
        k, m = np.searchsorted(rows, [r, r + 1]).tolist()
        spans = list(zip((at[k:m] - s).tolist(), (stop[k:m] - s).tolist()))
        digests = run_digests(lines.body(s, e).decode().split("\n"), spans)
        bodies += [b"#" + digests[x] for x in spans]
    first, size = np.concatenate([cut, at]), np.concatenate([end - cut, stop - at])
    rows = lines.row(first)
    return rows, first - lines.first[rows], size, np.concatenate([own, hashes]), bodies


def _bit(h: np.ndarray) -> np.ndarray:
    return h & (MARK_BITS - 1)


def _explode_chunks(df: DataFrame, repeated=None) -> DataFrame:
    """Hash h of every chunk and run; with ``repeated``, the marks of repeated hashes, (id, th,
    at, n, h, body) of the marked ones.  ``df`` has id, th and text."""
    if repeated is None:
        def hashes(batch):
            hs = [_piece_hashes(Lines(*text_arrays(part.column("text")))) for part in slices(batch, "text")]
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.int64), *hs]))], names=["h"])

        return map_batches(df.select("text"), hashes, "h long")
    shared = df.sparkSession.sparkContext.broadcast(repeated)

    def run(batch):
        marks = shared.value
        for part in slices(batch, "text"):
            rows, at, n, h, bodies = pieces(Lines(*text_arrays(part.column("text"))), lambda h: marked(marks, _bit(h)))
            cols = [part.column("id").take(pa.array(rows)), part.column("th").take(pa.array(rows)), pa.array(at, pa.int32()),
                    pa.array(n, pa.int32()), pa.array(h), pa.array(bodies, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=["id", "th", "at", "n", "h", "body"])

    return map_batches(df, run, "id long, th long, at int, n int, h long, body binary")


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """(id, th, at, n, first): occurrences of the chunks and runs that repeat, byte for byte,
    ``first`` also where one overlaps the first; ``docs`` has id (long), th (hash of the text) and text."""
    counts = _explode_chunks(docs).groupBy("h").agg(F.count("*").alias("c")).where(F.col("c") > 1)
    marks = bit_marks(counts.select(F.col("h").bitwiseAND(F.lit(MARK_BITS - 1)).alias("bit")), MARK_BITS)
    # both tables are written, so that the join deals plain rows and Spark can split a hot chunk
    found = materialize(_explode_chunks(docs, marks), "line-chunks")
    # equal bytes, not equal hashes, make a repetition; partial aggregation folds hot chunks before the shuffle
    place = F.struct(F.col("id").isNull().alias("z"), F.col("id").alias("i"), F.col("th").alias("t"), F.col("at").alias("a"))
    firsts = materialize(found.groupBy(F.col("h").alias("fh"), F.col("body").alias("fbody"))
                         .agg(F.min(place).alias("f"), F.count("*").alias("c")).where(F.col("c") > 1), "line-firsts")
    return found.join(firsts, (F.col("h") == F.col("fh")) & (F.col("body") == F.col("fbody"))).select(
        "id", "th", "at", "n",
        (F.col("id").eqNullSafe(F.col("f.i")) & (F.col("th") == F.col("f.t")) & (F.col("at") < F.col("f.a") + F.col("n"))).alias("first"))


def without_lines(text: str, cuts: list[tuple[int, int]]) -> str:
    lines = text.split("\n")
    keep, at = [], 0
    for start, n in sorted(cuts):
        keep += lines[at:start]
        at = max(at, start + n)
    return "\n".join(keep + lines[at:])


def lines_cut(cuts: list[tuple[int, int]]) -> int:
    """Number of lines that cuts, which may overlap, take away."""
    total, at = 0, 0
    for start, n in sorted(cuts):
        total += max(0, start + n - max(at, start))
        at = max(at, start + n)
    return total


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", removed_col: str = "removed_lines") -> DataFrame:
    """Texts without repeated chunks and runs; ``removed_col`` counts the lines that went."""
    df = without(df, removed_col)
    th, cid, cth, cuts = (free_name(df, x) for x in ("_th", "_cut_id", "_cut_th", "_cuts"))
    keyed = df.withColumn(th, F.xxhash64(text_col))
    docs = keyed.select(F.col(id_col).cast("long").alias("id"), F.col(th).alias("th"), F.col(text_col).alias("text"))
    # rows equal in id and text would otherwise find themselves repeated
    gone = (repeated_chunks(docs).where(~F.col("first")).distinct()
            .groupBy(F.col("id").alias(cid), F.col("th").alias(cth)).agg(F.collect_list(F.struct("at", "n")).alias(cuts)))
    joined = keyed.join(gone, F.col(id_col).cast("long").eqNullSafe(F.col(cid)) & (F.col(th) == F.col(cth)), "left").drop(th, cid, cth)
    schema = T.StructType([*df.schema.fields, T.StructField(removed_col, T.LongType())])
    width, at, names = len(df.columns), df.columns.index(text_col), schema.names

    def run(batch):
        cut = [[(x["at"], x["n"]) for x in c or ()] for c in batch.column(cuts).to_pylist()]
        out = [batch.column(i) for i in range(width)]
        if any(cut):
            texts = out[at].to_pylist()
            for i, c in enumerate(cut):
                if c:
                    texts[i] = without_lines(texts[i], c)
            out[at] = pa.array(texts, out[at].type)
        out.append(pa.array([lines_cut(c) for c in cut], pa.int64()))
        return pa.RecordBatch.from_arrays(out, names=names)

    return map_batches(joined.select(*df.columns, cuts), run, schema)
