"""Benchmark decontamination: rare n-gram seeds and Smith-Waterman alignment.

An alignment that scores ``least`` of a whole copy can pay for ``budget = 2 L (1 - least)`` of
edits, L the item's words.  An inserted word costs 1 and breaks at most s - 1 of the item's
s-grams; a changed or dropped word costs 3 and breaks s, one cut from an end costs 2 and
breaks 1.  So at least ``L - s + 1 - (s - 1) budget`` s-grams of the item stay whole, each within
``L + budget`` words of the others.  Every item takes the longest s up to ``N`` for which that is 1 or
more, and any document whose hits reach that number within the span is aligned: no
item that the score accepts is missed, whatever was edited, and common n-grams cost joins,
never results.

1. A bitmap of fixed size marks the hashes of all seeds and is broadcast; one narrow pass
   over the documents keeps the places of marked n-grams.
2. Hits are joined to items by seed (a Spark join, whatever the number of items) and chained
   per document and item; chains of too few different seeds go.
3. Only documents with a chain are read again (by a bitmap of their keys); the words around each
   chain are cut out, as wide as its own item asks for, and aligned word by word.  The
   score is the alignment's share of the score of a whole copy.

Defined results: a null or empty text holds no item; items without words are
never found; an item of one or two words must stand whole; repeated rows give the same rows again (rows equal in id and text are
one document); an empty benchmark or table gives no rows; null ids are
reported as null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsfunnel.functions.lineage import materialize
from newsfunnel.llm.common import bit_marks, int_lists, map_batches, marked, ship, slices, text_arrays
from newsfunnel.llm.words import Words, ngrams

N = 3  # words of a seed, at most
SCORE = 0.8  # least share of a whole copy's alignment score
BITMAP_BITS = 1 << 24  # 2 MB, whatever the size of the benchmark
MATCH, MISMATCH, GAP = 2, -1, -1
# ASCII other than letters and digits separates words
_SEP = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def seed_rule(words: int, n: int = N, least: float = SCORE) -> tuple[int, int, int]:
    """(seed size, seeds that must be hit, span in words) of an item of ``words`` words."""
    budget = int(MATCH * words * (1 - least) + 1e-9)
    for s in range(min(n, words), 0, -1):
        need = words - s + 1 - (s - 1) * budget
        if need >= 1:
            return s, need, words + budget
    raise ValueError("an item has a word")


def item_seeds(items: DataFrame, n: int, least: float) -> DataFrame:
    """(item_id, words, size, need, span, seeds) of every item that has words."""

    def run(batch):
        w = Words(*text_arrays(batch.column("text")), _SEP)
        h = w.hashes()
        seeds, lens, rules = [], [], []
        for r in range(batch.num_rows):
            own = h[w.first[r]:w.first[r + 1]]
            rules.append(seed_rule(len(own), n, least) if len(own) else (1, 1, 1))
            seeds.append(ngrams(own, rules[-1][0]))
            lens.append(len(seeds[-1]))
        size, need, span = (pa.array(list(x), pa.int32()) for x in (zip(*rules) if rules else ((), (), ())))
        return pa.RecordBatch.from_arrays(
            [batch.column("item_id"), int_lists(_signed(h), w.count), size, need, span,
             int_lists(_signed(np.concatenate(seeds)) if seeds else np.zeros(0, np.int64), np.array(lens, np.int64))],
            names=["item_id", "words", "size", "need", "span", "seeds"])

    return map_batches(items.select("item_id", "text"), run,
                       "item_id long, words array<long>, size int, need int, span int, seeds array<long>").where(F.size("words") > 0)


def _bits(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of a seed in the bitmap."""
    h = h.astype(np.uint64)
    return (h & np.uint64(BITMAP_BITS - 1)).astype(np.int64), (h >> np.uint64(32) & np.uint64(BITMAP_BITS - 1)).astype(np.int64)


def seed_bitmap(seeds: DataFrame) -> np.ndarray:
    """Marks of all seeds, two bits each."""
    mask = F.lit(BITMAP_BITS - 1)
    return bit_marks(seeds.select(F.explode(F.array(F.col("seed").bitwiseAND(mask), F.shiftrightunsigned("seed", 32).bitwiseAND(mask))).alias("bit")),
                     BITMAP_BITS)


def _keyed(docs: DataFrame) -> DataFrame:
    """(key, doc_id, text): rows equal in id and text have one key."""
    return docs.select(F.xxhash64(F.col("doc_id").isNull(), "doc_id", "text").alias("key"), "doc_id", "text")


def hits(docs: DataFrame, bitmap, sizes: list[int]) -> DataFrame:
    """(key, at, seed): places (word numbers) of marked n-grams."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batch):
        marks = shared.value
        for part in slices(batch, "text"):
            w = Words(*text_arrays(part.column("text")), _SEP)
            h = w.hashes()
            keys, ats, seeds = [], [], []
            own = part.column("key").to_numpy()
            for k in sizes:
                grams = ngrams(h, k)
                one, two = _bits(grams)
                hit = np.flatnonzero(marked(marks, one))
                hit = hit[marked(marks, two[hit])]
                row = w.row[hit]
                inside = row == w.row[hit + k - 1]
                hit, row = hit[inside], row[inside]
                keys.append(own[row])
                ats.append(hit - w.first[row])
                seeds.append(_signed(grams[hit]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in (keys, ats, seeds)], names=["key", "at", "seed"])

    return map_batches(docs.select("key", "text"), run, "key long, at long, seed long")


def chains(found: DataFrame, table: DataFrame) -> DataFrame:
    """(key, item_id, low, high): stretches of a document where an item's seeds stand close enough and in
    the number that an accepted alignment leaves, widened to what it can cover."""
    seeds = table.select("item_id", "need", "span", F.explode("seeds").alias("seed")).groupBy("item_id", "need", "span", "seed").agg(F.count("*").alias("times"))
    place = Window.partitionBy("key", "item_id").orderBy("at")
    steps = found.join(seeds, "seed").withColumn("apart", F.col("at") - F.lag("at").over(place))
    linked = steps.withColumn("chain", F.sum((F.col("apart") > F.col("span")).cast("int")).over(place))
    # each seed counts as often as the item has it
    each = linked.groupBy("key", "item_id", "need", "span", F.coalesce("chain", F.lit(0)).alias("chain"), "seed").agg(
        F.first("times").alias("times"), F.min("at").alias("low"), F.max("at").alias("high"))
    whole = each.groupBy("key", "item_id", "need", "span", "chain").agg(F.sum("times").alias("hit"), F.min("low").alias("low"), F.max("high").alias("high"))
    return whole.where("hit >= need").select("key", "item_id", F.greatest(F.col("low") - F.col("span"), F.lit(0)).alias("low"),
                                             (F.col("high") + F.col("span") + N).alias("high"))


def passages(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, item_id, first, p_words): the words of each chain.  Only rows whose key's bit is set are split."""
    def bit(c):
        return F.pmod(F.col(c), F.lit(BITMAP_BITS)).alias("bit")

    shared = docs.sparkSession.sparkContext.broadcast(bit_marks(wanted.select(bit("key")), BITMAP_BITS))

    def held(batch):
        yield batch.filter(pa.array(marked(shared.value, batch.column("bit").to_numpy()))).select(["key", "doc_id", "text"])

    some = map_batches(docs.select("key", "doc_id", "text", bit("key")), held, "key long, doc_id long, text string")
    lists = wanted.groupBy("key").agg(F.collect_list(F.struct("item_id", "low", "high")).alias("want"))
    told = some.dropDuplicates(["key"]).join(lists, "key").select("doc_id", "text", "want.item_id", "want.low", "want.high")

    def run(batch):
        for part in slices(batch, "text"):
            w = Words(*text_arrays(part.column("text")), _SEP)
            h = _signed(w.hashes())
            for r in range(part.num_rows):
                own = h[w.first[r]:w.first[r + 1]]
                item, low, high = (part.column(c)[r].values for c in ("item_id", "low", "high"))
                for k in range(0, len(item), 256):
                    a, b = low.to_numpy()[k:k + 256], np.minimum(high.to_numpy()[k:k + 256], len(own))
                    words = np.concatenate([own[x:y] for x, y in zip(a, b)])
                    yield pa.RecordBatch.from_arrays([pa.array([part.column("doc_id")[r].as_py()] * len(a), pa.int64()), item.slice(k, 256), pa.array(a, pa.int64()),
                                                      int_lists(words, b - a)], names=["doc_id", "item_id", "first", "p_words"])

    return map_batches(told, run, "doc_id long, item_id long, first long, p_words array<long>")


def align(a: list[np.ndarray], b: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Smith-Waterman over words, many pairs at once: best local score and the place
    in ``a`` after which it ends.  Row by row over ``b``; gaps along ``a`` by a running maximum."""
    la, lb = max(map(len, a)), max(map(len, b))
    pa_, pb = np.zeros((len(a), la), np.int64), np.zeros((len(b), lb), np.int64)
    ma, mb = np.zeros((len(a), la), bool), np.zeros((len(b), lb), bool)
    for i, (x, y) in enumerate(zip(a, b)):
        pa_[i, :len(x)], ma[i, :len(x)] = x, True
        pb[i, :len(y)], mb[i, :len(y)] = y, True
    ramp = np.arange(la + 1) * -GAP
    prev = np.zeros((len(a), la + 1), np.int32)
    best, end = np.zeros(len(a), np.int32), np.zeros(len(a), np.int64)
    for j in range(lb):
        same = (pa_ == pb[:, j:j + 1]) & ma
        cur = np.zeros_like(prev)
        cur[:, 1:] = np.maximum(prev[:, :-1] + np.where(same, MATCH, MISMATCH), prev[:, 1:] + GAP)
        cur = np.maximum(cur, 0)
        cur = np.maximum.accumulate(cur + ramp, 1).astype(np.int32) - ramp.astype(np.int32)
        cur = np.where(mb[:, j:j + 1], cur, prev)
        top = cur.argmax(1)
        val = cur[np.arange(len(a)), top]
        better = (val > best) & mb[:, j]
        best, end = np.where(better, val, best), np.where(better, top, end)
        prev = cur
    return best, end


def aligned(pairs: DataFrame) -> DataFrame:
    """(doc_id, item_id, score, end_word) of pairs with p_words, i_words and first."""

    def run(batch):
        a = [np.asarray(x.values) for x in batch.column("p_words")]
        b = [np.asarray(x.values) for x in batch.column("i_words")]
        first = batch.column("first").to_numpy()
        score, end = np.zeros(len(a)), np.zeros(len(a), np.int64)
        order = np.argsort([len(x) for x in a], kind="stable")
        at = 0
        while at < len(order):  # pairs of similar length together, in bounded space
            k, cells = at, 0
            while k < len(order) and (k == at or (k - at + 1) * len(a[order[k]]) <= 1 << 17):
                k += 1
            some = order[at:k]
            best, stop = align([a[i] for i in some], [b[i] for i in some])
            score[some] = best / (MATCH * np.array([len(b[i]) for i in some]))
            end[some] = stop + first[some]
            at = k
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("item_id"), pa.array(score), pa.array(end)],
                                          names=["doc_id", "item_id", "score", "end_word"])

    return map_batches(pairs.select("doc_id", "item_id", "first", "p_words", "i_words"), run,
                       "doc_id long, item_id long, score double, end_word long")


def contaminated(docs: DataFrame, items: DataFrame, n: int = N, least: float = SCORE) -> DataFrame:
    """(doc_id, item_id, score, end_word): documents that hold an item whole, edited or
    paraphrased, with the best alignment and the word after which it ends."""
    ship(docs.sparkSession)
    table = materialize(item_seeds(items, n, least), "bench-items")
    sizes = sorted(r[0] for r in table.select("size").distinct().collect()) or [n]  # n numbers at most
    keyed = _keyed(docs)
    found = materialize(hits(keyed, seed_bitmap(table.select(F.explode("seeds").alias("seed"))), sizes), "bench-hits")
    wanted = materialize(chains(found, table), "bench-chains")
    pairs = passages(keyed, wanted).join(table.select("item_id", F.col("words").alias("i_words")), "item_id")
    return (aligned(pairs).where(F.col("score") >= least).groupBy("doc_id", "item_id")
            .agg(F.max("score").alias("score"), F.max_by("end_word", F.struct("score", F.col("end_word"))).alias("end_word")))
