"""Filter interaction audit: what each filter removes in every order of the filters.

Method: every filter has one stored table of failing ids (a folder of one partitioned
table).  For a set S of filters that ran before, the survivors are the ids left after
left-anti joins with the tables of S; a left-semi join with the next filter's table gives
what it removes there.  There are 2**f sets, not f! orders: an order's step depends on the
set before it alone, and the orders are read off the set's figures at the end.

The joins run level by level (sets of 0, 1, 2, ... filters), all sets of a level in one
semi and one anti join keyed by (id, next filter).  Only documents that fail two or more
filters go through them.  A document that fails none is in every prefix's survivors, and
one that fails a single filter is removed by it in whatever order; both are counted once
(the latter found by an anti join with the former kind).  So the joined rows are a
fraction of the ids and carry no text.

Equal texts: E needs the smallest id of each text; texts are grouped by SHA-256 with
partial aggregates.  Digests that a thousandth or more of all rows share (at most 1,000
of them) are joined by broadcast, the others by a shuffle, so a text that a third of the rows
hold stays where it is.

Defined results: null text counts as '', null lang as ''.  A null doc_id has no smaller
one and no label; it never fails E.  Rows are counted as they stand, so equal rows count
twice; rows with the same doc_id and text do not fail E by one another.  Where a doc_id
has several label rows, a label holds if any row says so.  An empty table gives no rows.
Further columns are ignored.
"""

from __future__ import annotations

from itertools import combinations, permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsfunnel.functions.lineage import materialize
from newsfunnel.llm.common import literal_rows

HOT_SHARE = 1000  # a digest of more than 1/1000 of all rows is hot; so there are fewer than 1,000 of them
_SPACES = r"[\x20\x09-\x0D]+"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ATTRS = ["part", "good", "toxic"]


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions of the filters that look at one text."""
    words = F.array_remove(F.split(text, _SPACES), "")
    return {"words": words,
            "A": lambda w: F.size(w) < 100,
            "B": lambda w: 100 * F.size(F.array_distinct(w)) < 80 * F.size(w),
            "C": lambda w: 100 * (F.length(text) - F.length(F.translate(text, _CAPITALS, ""))) > 10 * F.length(text),
            "D": lambda w: text.rlike(r"[#$%&*|]")}


def _facts(docs: DataFrame) -> DataFrame:
    """Narrow rows of all documents, written once: a row id, the part, the text's digest and the text filters' verdicts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    fs = text_filters(F.col("text"))
    # the words are a generator's output: split once a row, however many filters use them
    split = base.select("*", F.inline(F.array(F.struct(fs.pop("words").alias("words")))))
    return materialize(split.select(
        F.monotonically_increasing_id().alias("id"), "doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"),
        *[f(F.col("words")).alias(k) for k, f in fs.items()]), "audit-facts")


def _copies(facts: DataFrame) -> DataFrame:
    """Rows whose text a smaller doc_id has."""
    known = facts.where(F.col("doc_id").isNotNull())
    firsts = materialize(known.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("n"))
                         .where("last > first").select("digest", "first", "n"), "audit-firsts")
    total = facts.count()
    hot = F.col("n") * HOT_SHARE > total
    rows = known.select("id", "doc_id", "part", "digest")
    often = F.broadcast(firsts.where(hot).select("digest", "first"))  # fewer than HOT_SHARE rows, by their share
    by_broadcast = rows.join(often, "digest")
    by_shuffle = rows.join(often, "digest", "left_anti").join(firsts.where(~hot).select("digest", "first"), "digest")
    return by_broadcast.unionByName(by_shuffle).where("doc_id > first").select("id", "doc_id", "part")


def failing_ids(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(failing, facts): the failing-id relations, one folder a filter, as rows (filter, id, part, good, toxic)."""
    facts = _facts(docs)
    narrow = ["id", "doc_id", "part"]
    failing = None
    for f in "ABCD":
        one = facts.where(F.col(f)).select(*narrow, F.lit(f).alias("filter"))
        failing = one if failing is None else failing.unionByName(one)
    failing = failing.unionByName(_copies(facts).select(*narrow, F.lit("E").alias("filter")))
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic"))
    none = F.lit(0).cast("long")
    labelled = failing.where(F.col("doc_id").isNotNull()).join(marks, "doc_id", "left").select(
        "filter", "id", "part", F.coalesce("good", none).alias("good"), F.coalesce("toxic", none).alias("toxic"))
    unlabelled = failing.where(F.col("doc_id").isNull()).select("filter", "id", "part", none.alias("good"), none.alias("toxic"))
    path = materialize(labelled.unionByName(unlabelled), "audit-failing", partition_by=["filter"])
    return path, facts


def _counted(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy("part", *by).agg(F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))


def prefix_removals(failing: DataFrame, filters: str) -> DataFrame:
    """(part, before, filter, n, good, toxic): what ``filter`` removes from the survivors of the set ``before``
    (its letters in ascending order); no row where it is nothing."""
    ids = failing.select("id", *_ATTRS, "filter")
    several = materialize(ids.groupBy("id", *_ATTRS).count().where("count > 1").drop("count"), "audit-several")
    alone = _counted(ids.join(several, "id", "left_anti"), "filter")
    others = {f: [g for g in filters if g != f] for f in filters}
    before = F.create_map(*[x for f in filters for x in (F.lit(f), F.array(*[
        F.lit("".join(s)) for k in range(len(filters)) for s in combinations(others[f], k)]))])
    found = alone.select("part", F.explode(before[F.col("filter")]).alias("before"), "filter", "n", "good", "toxic")
    table = ids.select("id", F.col("filter").alias("next")).join(several, "id", "left_semi")
    survivors = several.withColumn("before", F.lit(""))
    every = F.array(*[F.lit(f) for f in filters])
    for level in range(len(filters)):
        steps = survivors.select("*", F.explode(F.filter(every, lambda f: ~F.col("before").contains(f))).alias("next"))
        found = found.unionByName(_counted(steps.join(table, ["id", "next"], "left_semi").withColumnRenamed("next", "filter"), "before", "filter")
                                  .select(*found.columns))
        # a set is reached once, by its letters in ascending order
        rising = steps.where(F.substring("before", -1, 1) < F.col("next"))
        left = rising.join(table, ["id", "next"], "left_anti").select("id", *_ATTRS, F.concat("before", "next").alias("before"))
        survivors = materialize(left, f"audit-survivors-{level + 1}") if level + 1 < len(filters) else left
    return materialize(found.groupBy("part", "before", "filter").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")]), "audit-removals")


def interaction_audit(docs: DataFrame, labels: DataFrame, filters: str = "ABCDE") -> DataFrame:
    """One row per part, order of the filters and step."""
    failing, facts = failing_ids(docs, labels)
    removed = prefix_removals(failing, filters)
    spark = docs.sparkSession
    # the orders are the filters' own: f! rows of f steps, whatever the data
    orders = [("".join(o), k + 1, f, "".join(sorted(o[:k]))) for o in permutations(filters) for k, f in enumerate(o)]
    steps = F.broadcast(literal_rows(spark, orders, "filter_order string, step int, filter string, before string"))
    sets = [(s, f) for k in range(len(filters)) for s in map("".join, combinations(filters, k)) for f in filters if f not in s]
    weight = {s: factorial(len(s)) * factorial(len(filters) - 1 - len(s)) for s, _ in sets}
    parts = facts.groupBy("part").agg(F.count("*").alias("total"))
    grid = parts.select("part", "total", F.inline(F.array(*[
        F.struct(F.lit(s).alias("before"), F.lit(f).alias("filter"), F.lit(weight[s]).cast("long").alias("orders")) for s, f in sets])))
    none = F.lit(0).cast("long")
    cells = grid.join(removed, ["part", "before", "filter"], "left").select(
        "part", "total", "before", "filter", "orders", *[F.coalesce(c, none).alias(c) for c in ("n", "good", "toxic")])
    cells = materialize(cells, "audit-cells")
    # of one filter: what it fails alone and first, and its sum over all orders
    rest = F.create_map(*[x for f in filters for x in (F.lit(f), F.lit(filters.replace(f, "")))])
    whole = cells.groupBy("part", "filter").agg(
        F.sum(F.when(F.col("before") == "", F.col("n")).otherwise(none)).alias("fails"),
        F.sum(F.when(F.col("before") == rest[F.col("filter")], F.col("n")).otherwise(none)).alias("unique_fails"),
        F.sum(F.col("n") * F.col("orders")).alias("shapley"))
    # survivors of a set: what its letters remove one after the other in ascending order
    path = {s: [(s[:k], s[k]) for k in range(len(s))] for s in {"".join(sorted(s + f)) for s, f in sets}}
    hops = F.broadcast(literal_rows(spark, [(t, b, f) for t, hop in path.items() for b, f in hop], "after string, before string, filter string"))
    gone = cells.join(hops, ["before", "filter"]).groupBy("part", "after").agg(F.sum("n").alias("gone"))
    row = cells.join(steps, ["before", "filter"]).withColumn("after", F.array_join(F.array_sort(F.split(F.concat("before", "filter"), "")), ""))
    return (row.join(whole, ["part", "filter"]).join(gone, ["part", "after"])
            .select("part", "filter_order", "step", (F.col("total") - F.col("gone")).alias("kept"), F.col("n").alias("removed"),
                    (F.col("fails") - F.col("n")).alias("redundant"), "unique_fails", F.col("good").alias("good_lost"),
                    F.col("toxic").alias("toxic_lost"), "shapley"))
