"""Toxicity scores from a factorization machine over hashed terms.

Terms of a document are its distinct lower-cased words and word beginnings of
4, 5 and 6 bytes, hashed into a fixed number of buckets.  The machine gives
each bucket a weight and a short vector; the score is
``sigmoid(w0 + sum w_i + sum_{i<j} <v_i, v_j>)``, so a pair of terms (an insult
and whom it is aimed at) can count for more than both alone.

Fitting uses a bounded sample of labelled rows (``Bounds``): the labels with
the smallest hashes of their ids, of each kind.  The sample's ids (a bounded
table) are broadcast to the scan, so no text is shuffled.  The machine first
learns the buckets that tell the kinds apart alone.  What it leaves unexplained
is then tested against every pair of buckets at once (``telling_pairs``: signed
random groups of all buckets, whose products are bounded in size whatever the
texts are); buckets of telling pairs join, and the machine is learned again.  Scoring is one
narrow pass over all rows with the model (bounded by its buckets) broadcast.

Defined results: a null or empty text has no terms and scores the bias alone;
repeated label rows count once, as toxic if any of them is; null labels and
null ids are not learned from; without labels of both kinds every score is
the share of toxic labels (0 if there are none); other columns pass through, one
named like the score is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsfunnel.functions.lineage import materialize
from newsfunnel.llm.common import int_lists, map_batches, ship, slices, text_arrays, without
from newsfunnel.llm.words import Words, mix

THRESHOLD = 0.7
# everything of ASCII that is not a letter or digit separates words
_SEP = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])
_BEGINNINGS = (4, 5, 6)
DIVISIONS = 3


@dataclass(frozen=True)
class Bounds:
    """Sizes that do not depend on the data."""

    toxic_rows: int = 8_000  # labelled rows to learn from, at most
    other_rows: int = 16_000
    buckets: int = 1 << 18
    terms: int = 1_024  # buckets that the model keeps: those that tell the kinds apart best
    least_rows: int = 3  # rows of the sample that must hold a kept bucket
    least_chi: float = 11.0  # chi-square of bucket against label that a kept bucket must reach
    pair_terms: int = 1_024  # further buckets that the model keeps, neutral alone: those of the most telling pairs
    groups: int = 2_048  # signed random groups of buckets whose products are tested, in each of three divisions
    least_z: float = 6.5  # deviations from no effect that a pair must show in every division
    factors: int = 6
    steps: int = 200


@dataclass
class Model:
    """``slot`` of each bucket (-1: not kept), bias, weights and vectors of the slots."""

    bounds: Bounds
    slot: np.ndarray
    bias: float
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0))
    vector: np.ndarray = field(default_factory=lambda: np.zeros((0, 1)))


def held_out(id_col: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def row_terms(data: np.ndarray, offs: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of the distinct terms of each row, by row."""
    w = Words(data, offs, _SEP)
    size = w.end - w.start
    rows, terms = [w.row], [w.hashes()]
    for n in _BEGINNINGS:
        long = np.flatnonzero(size > n)
        s = w.start[long]
        rows.append(w.row[long])
        terms.append(mix(w.raw_hash(s, s + n) + np.uint64(n)))
    row, term = np.concatenate(rows), np.concatenate(terms)
    pairs = np.unique(row.astype(np.uint64) << np.uint64(32) | term % np.uint64(buckets))
    return (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int32)


def terms(df: DataFrame, buckets: int, text_col: str = "text", out_col: str = "terms") -> DataFrame:
    """Replace the text by the list of its distinct hashed terms."""
    fields = [f for f in df.schema.fields if f.name != text_col]
    schema = T.StructType([*fields, T.StructField(out_col, T.ArrayType(T.IntegerType(), False))])
    keep = [f.name for f in fields]

    def run(batch):
        for part in slices(batch, text_col):
            row, bucket = row_terms(*text_arrays(part.column(text_col)), buckets)
            arr = int_lists(bucket, np.bincount(row, minlength=part.num_rows))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), arr], names=schema.names)

    return map_batches(df, run, schema)


def sample_labels(labels: DataFrame, bounds: Bounds) -> DataFrame:
    """(doc_id, toxic): a bounded sample of the labels that may be learned from."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
             .select("doc_id", (F.col("toxic") > 0).cast("int").alias("toxic"), F.xxhash64("doc_id").alias("h")))

    def some(kind: int, n: int) -> DataFrame:
        return known.where(F.col("toxic") == kind).orderBy("h", "doc_id").limit(n).drop("h")

    return some(1, bounds.toxic_rows).unionByName(some(0, bounds.other_rows))


def fit(docs: DataFrame, labels: DataFrame, bounds: Bounds = Bounds()) -> Model:
    """Learn from the labelled documents that are not held out."""
    ship(docs.sparkSession)
    # bounded: at most toxic_rows + other_rows pairs of numbers
    sample = F.broadcast(sample_labels(labels, bounds))
    rows = materialize(terms(docs.select("doc_id", "text").join(sample, "doc_id").select("toxic", "text"), bounds.buckets), "toxicity-terms")
    total, toxic = rows.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    slot = np.full(bounds.buckets, -1, np.int32)
    if toxic in (0, total):
        return Model(bounds, slot, np.inf if toxic else -np.inf)
    best = telling_buckets(rows, total, toxic, bounds)
    model = learned(rows, best, bounds)
    more = np.setdiff1d(telling_pairs([group_sums(rows, model, d) for d in range(DIVISIONS)], bounds), best)
    return learned(rows, np.concatenate([best, more]), bounds) if len(more) else model


def learned(rows: DataFrame, kept: np.ndarray, bounds: Bounds) -> Model:
    """The machine of the kept buckets."""
    slot = np.full(bounds.buckets, -1, np.int32)
    slot[kept] = np.arange(len(kept))
    got = kept_slots(rows, slot).toArrow()  # bounded: a few slots of each row of the sample
    lists = got.column("slots").combine_chunks()
    row = np.repeat(np.arange(got.num_rows), lists.value_lengths().to_numpy())
    return Model(bounds, slot, *train(row, lists.flatten().to_numpy(), got.column("toxic").to_numpy().astype(float), len(kept), bounds))


def division(bucket: np.ndarray, d: int, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Group and sign of each bucket in the ``d``-th random division of all buckets."""
    h = mix(bucket.astype(np.uint64) * np.uint64(DIVISIONS) + np.uint64(d + 1))
    return (h % np.uint64(groups)).astype(np.int64), np.where(h >> np.uint64(63), 1.0, -1.0)


def group_sums(rows: DataFrame, model: Model, d: int) -> pa.Table:
    """(error, chance, sums): what the model leaves of each row's label, and the signed count of each group.

    Bounded: ``groups`` bytes a row of the sample, however long its text.
    """
    shared, groups = rows.sparkSession.sparkContext.broadcast(model), model.bounds.groups

    def run(batch):
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            lists, n = part.column("terms"), part.num_rows
            row, bucket = np.repeat(np.arange(n), lists.value_lengths().to_numpy()), lists.flatten().to_numpy()
            chance = sigmoid(logits_of(shared.value, row, bucket, n))
            group, sign = division(bucket, d, groups)
            sums = np.bincount(row * groups + group, weights=sign, minlength=n * groups).clip(-127, 127).astype(np.int8)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.column("toxic").to_numpy() - chance), pa.array(chance), pa.array([r.tobytes() for r in sums.reshape(n, groups)], pa.binary())],
                names=["error", "chance", "sums"])

    return map_batches(rows.select("toxic", "terms"), run, "error double, chance double, sums binary").toArrow()


def group_scores(table: pa.Table, groups: int) -> np.ndarray:
    """Score test of each pair of groups: the errors' sum over the product of their counts, in standard deviations."""
    n = table.num_rows
    error, chance = (table.column(c).to_numpy() for c in ("error", "chance"))
    error = error - error.mean()
    prod, var = np.zeros((groups, groups), np.float32), np.zeros((groups, groups), np.float32)
    pull, mean = np.zeros(groups), np.zeros(groups)
    sums = table.column("sums")
    for at in range(0, n, 2048):
        x = np.frombuffer(b"".join(sums.slice(at, 2048).to_pylist()), np.int8).reshape(-1, groups).astype(np.float32)
        e, c = error[at:at + 2048].astype(np.float32)[:, None], chance[at:at + 2048].astype(np.float32)[:, None]
        weighed = x * e
        prod += weighed.T @ x
        x2 = x * x
        var += (x2 * np.maximum(c * (1 - c), e * e)).T @ x2
        pull += weighed.sum(0)
        mean += x.sum(0) / n
    prod -= np.outer(mean, pull) + np.outer(pull, mean)
    return prod / np.sqrt(var + 1.0)


def telling_pairs(tables: list[pa.Table], bounds: Bounds) -> np.ndarray:
    """The buckets of pairs whose groups score ``least_z`` in every division, the strongest pairs first."""
    groups = bounds.groups
    scores = [np.abs(group_scores(t, groups)) for t in tables]
    buckets = np.arange(bounds.buckets)
    at = [division(buckets, d, groups)[0] for d in range(DIVISIONS)]
    members = np.split(np.argsort(at[0], kind="stable"), np.cumsum(np.bincount(at[0], minlength=groups))[:-1])
    g, h = np.nonzero(np.triu(scores[0] >= bounds.least_z, 1))
    found: dict[int, None] = {}
    for k in np.argsort(-scores[0][g, h], kind="stable"):
        a, b = members[g[k]][:, None], members[h[k]][None, :]
        least = np.minimum.reduce([scores[d][at[d][a], at[d][b]] * (at[d][a] != at[d][b]) for d in range(1, DIVISIONS)])
        for i, j in np.argwhere(least >= bounds.least_z):
            found.update({int(a[i, 0]): None, int(b[0, j]): None})
        if len(found) >= bounds.pair_terms:
            break
    return np.array(list(found)[:bounds.pair_terms], np.int64)


def telling_buckets(rows: DataFrame, total: int, toxic: int, bounds: Bounds) -> np.ndarray:
    """The buckets that tell the kinds apart best, by chi-square against the label."""
    counts = (rows.select("toxic", F.explode("terms").alias("bucket")).groupBy("bucket")
              .agg(F.count("*").alias("n"), F.sum("toxic").alias("pos")).where(F.col("n") >= bounds.least_rows))
    share = toxic / total
    expect = F.col("n") * share
    chi = F.pow(F.col("pos") - expect, F.lit(2)) / expect / (1 - share) / (1 - F.col("n") / (total + 1))
    best = (counts.withColumn("chi", chi).where(F.col("chi") >= bounds.least_chi)
            .orderBy(F.col("chi").desc(), "bucket").limit(bounds.terms).select("bucket"))
    return best.toArrow().column("bucket").to_numpy()


def kept_slots(rows: DataFrame, slot: np.ndarray) -> DataFrame:
    """(toxic, slots): the kept terms of each row of the sample."""
    shared = rows.sparkSession.sparkContext.broadcast(slot)

    def run(batch):
        lists = batch.column("terms")
        row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
        got = shared.value[lists.flatten().to_numpy()]
        hit = got >= 0
        return pa.RecordBatch.from_arrays([batch.column("toxic"), int_lists(got[hit], np.bincount(row[hit], minlength=batch.num_rows))],
                                          names=["toxic", "slots"])

    return map_batches(rows, run, "toxic int, slots array<int>")


def train(row: np.ndarray, feat: np.ndarray, y: np.ndarray, size: int, bounds: Bounds) -> tuple[float, np.ndarray, np.ndarray]:
    """Logistic loss by Adam over the whole sample; fixed start, so equal data give an equal model.

    ``row`` is sorted; a row's kept terms are ``feat``.
    """
    rng = np.random.default_rng(7)
    n = len(y)
    params = [np.array([np.log(y.mean() / (1 - y.mean()))]), np.zeros(size), rng.normal(0, 0.01, (size, bounds.factors))]
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    # both kinds get the same say, softened
    cost = np.where(y > 0, np.sqrt((1 - y.mean()) / y.mean()), 1.0)
    cost /= cost.sum()
    for step in range(1, bounds.steps + 1):
        bias, w, v = params
        own = v[feat]
        sums = np.stack([np.bincount(row, weights=own[:, f], minlength=n) for f in range(bounds.factors)], 1)
        squares = np.bincount(row, weights=(own ** 2).sum(1), minlength=n)
        logit = bias[0] + np.bincount(row, weights=w[feat], minlength=n) + 0.5 * ((sums ** 2).sum(1) - squares)
        err = cost * (sigmoid(logit) - y)
        at = err[row]
        pull = at[:, None] * (sums[row] - own)
        grads = [np.array([err.sum()]), np.bincount(feat, weights=at, minlength=size) + 2e-6 * w,
                 np.stack([np.bincount(feat, weights=pull[:, f], minlength=size) for f in range(bounds.factors)], 1) + 2e-5 * v]
        for p, g, a, b in zip(params, grads, first, second):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p -= 0.05 * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-8)
    return float(params[0][0]), params[1], params[2]


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def logits(model: Model, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    return logits_of(model, *row_terms(data, offs, model.bounds.buckets), len(offs) - 1)


def logits_of(model: Model, row: np.ndarray, bucket: np.ndarray, n: int) -> np.ndarray:
    """The logits of ``n`` rows from their terms (row, bucket)."""
    feat = model.slot[bucket]
    hit = feat >= 0
    row, feat = row[hit], feat[hit]
    own = model.vector[feat]
    out = np.full(n, model.bias)
    if len(feat):
        out += np.bincount(row, weights=model.weight[feat], minlength=n)
        for f in range(own.shape[1]):
            s = np.bincount(row, weights=own[:, f], minlength=n)
            out += 0.5 * (s * s - np.bincount(row, weights=own[:, f] ** 2, minlength=n))
    return out


def score(df: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """Add the score (0 to 1) of each whole text."""
    df = without(df, score_col)
    schema = T.StructType([*df.schema.fields, T.StructField(score_col, T.DoubleType())])
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batch):
        for part in slices(batch, text_col):
            s = logits(shared.value, *text_arrays(part.column(text_col)))
            s = np.where(np.isinf(s), (s > 0) * 1.0, sigmoid(s))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(s)], names=schema.names)

    return map_batches(df, run, schema)
