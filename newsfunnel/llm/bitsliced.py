"""Exact top-k inner-product search by bit-sliced index arithmetic.

Vectors are integers (``floor(scale * x)``).  A block of rows keeps, for each
dimension, the top bits of its values as bitmaps over the rows (bit slices).
For a block of queries the slices are weighted by the query's integer
components and added with full adders on whole bitmaps, which gives the
bit-sliced sum of all rows at once.  The k-th largest sum is found from the
most significant slice downward; rows whose sum is within the quantisation
error of it are the boundary, and their inner products are computed exactly.

Blocks: rows are dealt into blocks of bounded size by a hash, each row once; the queries
travel, one copy to each block.  A block's rows come first in its task, its slices are built
once, and the queries stream past them in batches; each batch returns k rows per
query, and a window with a per-group limit keeps the best k.  No block grows with the data, and
a block of more rows makes fewer copies of the queries.

Blocks whose sums could pass 64 bits are compared by double products with an
error bound, and the rows that can be among the best again in Python's integers.

Defined results: vectors that are null, hold a null or non-finite component, or
have a null id take no part; a score beyond 64 bits among the results is an
error, as in SQL; a
shorter vector counts as padded with zeros; repeated rows count as often as they
stand, as candidates and as queries (the k best pairs of a query id are returned); a query is not compared with rows of its own id; equal scores are
ordered by the smaller id; fewer candidates than k give fewer rows; an empty
table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - pa.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsfunnel.llm.common import ship

LEAST_BLOCK, MOST_BLOCK = 4096, 1 << 16  # rows of a block
BLOCK_CELLS = 1 << 23  # components of a block, at most
QUERY_BATCH = 256
BITS = 6  # bits of each component kept as slices; only speed depends on it
ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def quantised(df: DataFrame, scale: int, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v): the rows that take part, as vectors of whole numbers."""
    def whole(x):
        y = F.lit(float(scale)) * x.cast("double")
        return F.when(F.abs(y) < float(1 << 52), F.floor(y).cast("double")).otherwise(y)  # larger doubles are whole

    ok = F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & F.forall(
        vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return df.where(F.coalesce(ok, F.lit(False))).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.transform(vec_col, whole).alias("v"))


def _matrix(col: pa.ChunkedArray, dims: int) -> np.ndarray:
    """Lists of whole numbers as a matrix of ``dims`` columns, padded with zeros; what lies beyond meets nothing."""
    arr = col.combine_chunks()
    lens = arr.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = arr.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lens), dims))
    row = np.repeat(np.arange(len(lens)), lens)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)
    inside = place < dims
    out[row[inside], place[inside]] = flat[inside]
    return out


def _bitmap(bits: np.ndarray) -> np.ndarray:
    """Boolean (..., rows) packed into 64-bit words."""
    packed = np.packbits(bits, axis=-1, bitorder="little")
    pad = -packed.shape[-1] % 8
    if pad:
        packed = np.concatenate([packed, np.zeros((*packed.shape[:-1], pad), np.uint8)], -1)
    return packed.view(np.uint64)


def slice_rows(x: np.ndarray, bits: int) -> tuple[list[list[np.ndarray]], np.ndarray, int]:
    """Slices[dim][bit], the least value of each dimension and the dropped low bits."""
    low = x.min(0)
    drop = max(0, int(x.max(initial=0) - x.min(initial=0)).bit_length() - bits)
    top = (x - low) >> drop
    return [[_bitmap((top[:, d] >> b & 1).astype(bool)) for b in range(bits)] for d in range(x.shape[1])], low, drop


def add_weighted(slices: list[list[np.ndarray]], q: np.ndarray) -> list[np.ndarray]:
    """Bit slices, (queries, words) each, of sum_d |q_d| * t_d over all rows, t_d the
    value of dimension d where q_d >= 0 and its complement where q_d < 0.

    Partial bitmaps of equal weight are added three at a time by full adders:
    the sum bit stays, the carry goes one place up.
    """
    weight = np.abs(q)
    flip = np.where(q < 0, ONES, np.uint64(0)).astype(np.uint64)
    places: list[list[np.ndarray]] = []

    def put(p: int, bm: np.ndarray) -> None:
        while len(places) <= p:
            places.append([])
        column = places[p]
        column.append(bm)
        if len(column) == 3:
            a, b, c = column
            ab = a ^ b
            column[:] = [ab ^ c]
            put(p + 1, (a & b) | (ab & c))

    for d, dim in enumerate(slices):
        top = int(weight[:, d].max(initial=0)).bit_length()
        masks = [np.where(weight[:, d] >> t & 1, ONES, np.uint64(0)).astype(np.uint64)[:, None] for t in range(top)]
        for s, bm in enumerate(dim):
            signed = bm[None, :] ^ flip[:, d][:, None]
            for t, m in enumerate(masks):
                put(s + t, signed & m)
    out: list[np.ndarray] = []
    p = 0
    while p < len(places):
        column = places[p]
        if len(column) == 2:  # half adder
            a, b = column
            column[:] = [a ^ b]
            put(p + 1, a & b)
        out.append(column[0] if column else None)
        p += 1
    return out


def kth_largest(total: list[np.ndarray], take: np.ndarray, k: int) -> np.ndarray:
    """Per query the k-th largest sum among the rows of ``take``, from the top slice
    down; the least sum where there are fewer."""
    higher = np.zeros_like(take)
    equal = take.copy()
    value = np.zeros(len(take), np.int64)
    for p in range(len(total) - 1, -1, -1):
        bm = total[p] if total[p] is not None else np.zeros_like(take)
        ones = equal & bm
        enough = np.bitwise_count(higher).sum(1) + np.bitwise_count(ones).sum(1) >= k
        value = value << 1 | enough
        e = enough[:, None]
        higher = np.where(e, higher, higher | ones)
        equal = np.where(e, ones, equal & ~bm)
    return value


def at_least(total: list[np.ndarray], take: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Bitmap per query of the rows of ``take`` whose sum is ``least`` or more."""
    higher = np.zeros_like(take)
    equal = take.copy()
    for p in range(len(total) - 1, -1, -1):
        bm = total[p] if total[p] is not None else np.zeros_like(take)
        bit = (least >> p & 1).astype(bool)[:, None]
        higher = np.where(bit, higher, higher | (equal & bm))
        equal = np.where(bit, equal & bm, equal & ~bm)
    return higher | equal


def top_of_block(qid: np.ndarray, q: np.ndarray, rid: np.ndarray, x: np.ndarray, k: int, bits: int = BITS, built=None):
    """The k best rows of a block for each query: arrays (query_id, vec_id, score).  ``built``: the block's ``slice_rows``."""
    slices, _, drop = built or slice_rows(x, bits)
    own = qid[:, None] == rid[None, :]
    take = _bitmap(~own)
    total = add_weighted(slices, q)
    out_q, out_r, out_s = [], [], []
    if total:
        kth = kth_largest(total, take, k)
        # a value is low + (top << drop) + rest, 0 <= rest < 2**drop: two sums further apart
        # than the rests can make good keep their order
        slack = (np.abs(q).sum(1) * ((1 << drop) - 1) + (1 << drop) - 1) >> drop
        near = at_least(total, take, np.maximum(kth - slack, 0))
    else:
        near = take  # all weights are zero
    near = np.unpackbits(near.view(np.uint8), axis=-1, bitorder="little")[:, :len(rid)].astype(bool)
    for i in range(len(qid)):
        rows = np.flatnonzero(near[i])
        score = x[rows] @ q[i]
        if len(rows) > 4 * k:
            edge = np.partition(score, len(score) - k)[len(score) - k]
            rows, score = rows[score >= edge], score[score >= edge]
        best = np.lexsort((rid[rows], -score))[:k]
        out_q.append(np.full(len(best), qid[i]))
        out_r.append(rid[rows[best]])
        out_s.append(score[best])
    return np.concatenate(out_q), np.concatenate(out_r), np.concatenate(out_s)


def fits(q: np.ndarray, most_x: float, dims: int) -> bool:
    """Whether no sum of ``top_of_block`` can pass 64 bits."""
    return dims * max(1.0, float(np.abs(q).max(initial=0))) * max(float(1 << BITS), most_x) < float(1 << 60)


def top_of_wide_block(qid: np.ndarray, q: np.ndarray, rid: np.ndarray, x: np.ndarray, k: int):
    """``top_of_block`` for doubles of any size that are whole numbers; scores are Python integers."""
    def unit(m: np.ndarray) -> np.ndarray:  # a power of two keeps the digits
        return np.ldexp(m, -int(np.frexp(np.abs(m).max(initial=0))[1]))

    sx, sq = unit(x), unit(q)
    near = sq @ sx.T
    error = (x.shape[1] + 2) * 2.0 ** -51 * (np.abs(sq) @ np.abs(sx).T) + 2.0 ** -1000
    own = qid[:, None] == rid[None, :]
    least = np.where(own, -np.inf, near - error)
    edge = np.partition(least, -k, axis=1)[:, [-k]] if len(rid) > k else np.full((len(qid), 1), -np.inf)
    out_q, out_r, out_s = [], [], []
    exact: dict[int, list[int]] = {}
    for i in range(len(qid)):
        weights = [int(v) for v in q[i]]
        found = []
        for j in np.flatnonzero((near[i] + error[i] >= edge[i]) & ~own[i]).tolist():
            row = exact.get(j)
            if row is None:
                row = exact[j] = [int(v) for v in x[j]]
            found.append((-sum(a * b for a, b in zip(weights, row)), int(rid[j])))
        for s, r in sorted(found)[:k]:
            out_q.append(int(qid[i]))
            out_r.append(r)
            out_s.append(-s)
    return out_q, out_r, out_s


class _Block:
    """The rows of one block, as integers and slices once a query needs them."""

    def __init__(self, parts: list[pa.RecordBatch]):
        t = pa.Table.from_batches(parts)
        self.ids = t.column("vec_id").to_numpy()
        vectors = t.column("v")
        self.dims = max(1, pa.compute.max(pa.compute.list_value_length(vectors)).as_py() or 0)
        self.x = _matrix(vectors, self.dims)
        self.most = float(np.abs(self.x).max(initial=0))
        self.whole = self.built = None

    def meet(self, batch: pa.RecordBatch, k: int) -> pa.RecordBatch:
        qid, q = batch.column("vec_id").to_numpy(), _matrix(pa.chunked_array([batch.column("v")]), self.dims)
        if fits(q, self.most, self.dims):
            if self.whole is None:
                self.whole = self.x.astype(np.int64)
                self.built = slice_rows(self.whole, BITS)
            got = top_of_block(qid, q.astype(np.int64), self.ids, self.whole, k, built=self.built)
            return pa.RecordBatch.from_arrays([*(pa.array(a) for a in got), pa.array(np.zeros(len(got[0]), np.int32))], schema=_FOUND)
        qids, rids, scores = top_of_wide_block(qid, q, self.ids, self.x, k)
        beyond = [(s >= 1 << 63) - (s < -(1 << 63)) for s in scores]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((qids, rids, [0 if b else s for s, b in zip(scores, beyond)], beyond), _FOUND)], schema=_FOUND)


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("beyond", pa.int32())])


def top_k(df: DataFrame, queries: DataFrame, k: int, scale: int = 1024, id_col: str = "vec_id", vec_col: str = "embedding",
          row_block: int | None = None, query_block: int = QUERY_BATCH) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of ``df`` with the largest inner
    product for each row of ``queries``."""
    ship(df.sparkSession)
    rows, qs = quantised(df, scale, id_col, vec_col), quantised(queries, scale, id_col, vec_col)
    n, dims = rows.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(1))).first()
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    most = max(1, min(MOST_BLOCK, BLOCK_CELLS // max(1, dims)))
    # as few blocks as their size allows, but enough to keep the tasks busy while blocks are not small
    blocks = max(1, -(-n // (row_block or most)), 0 if row_block else min(parts, n // LEAST_BLOCK))

    own = rows.select(F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).alias("rb"), F.lit(0).alias("kind"), "vec_id", "v")
    sent = qs.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("rb"), F.lit(1).alias("kind"), "vec_id", "v")

    def run(batches):
        at, held, block = None, [], None
        for b in batches:
            rb, kind = b.column("rb").to_numpy(), b.column("kind").to_numpy()
            cuts = [0, *(np.flatnonzero((rb[1:] != rb[:-1]) | (kind[1:] != kind[:-1])) + 1).tolist(), b.num_rows]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if lo == hi:
                    continue
                if rb[lo] != at:
                    at, held, block = rb[lo], [], None
                if kind[lo] == 0:
                    held.append(b.slice(lo, hi - lo))
                elif held or block:
                    if block is None:
                        block, held = _Block(held), []
                    for a in range(lo, hi, query_block):
                        yield block.meet(b.slice(a, min(query_block, hi - a)), k)

    best = (own.unionByName(sent).repartition(min(parts, blocks) if blocks < parts else parts, "rb").sortWithinPartitions("rb", "kind")
            .mapInArrow(run, "query_id long, vec_id long, score long, beyond int"))
    w = Window.partitionBy("query_id").orderBy(F.col("beyond").desc(), F.col("score").desc(), F.col("vec_id"))
    score = F.when(F.col("beyond") == 0, F.col("score")).otherwise(F.raise_error(F.lit("a score does not fit into 64 bits")).cast("long"))
    return best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", score.alias("score"))
