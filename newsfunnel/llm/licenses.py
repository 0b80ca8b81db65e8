"""License scan by diagonal voting, in DataFrame operations only.

All rolling word k-grams of every text are joined, by hash and then by their
words, to the k-gram positions of license templates (a fixed small table, so
its broadcast has a proven bound).  A hit votes for the diagonal
``document position - template position``: an unbroken copy puts all its votes
on one diagonal, an edited one on neighbouring diagonals.  Diagonals no more
than ``drift`` apart are merged, and a merged group counts as a license when
its votes cover enough of the template.  Base phrases must stand word for
word: all votes of one diagonal.

Nothing but the hits, one row per document and the votes is shuffled.

Defined results: a null text counts as ''; '' and texts of fewer words than k
have no votes; repeated rows are scanned each on its own (rows get a row
number first); an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsfunnel.functions.lineage import with_columns_once
from newsfunnel.llm.common import free_name

K = 2  # the shortest phrases have two words
DRIFT = 3  # words that an edit may shift a copy by and still join its diagonals
COVER = 0.7  # share of a template's k-grams that a merged group must hold


@dataclass(frozen=True)
class Template:
    label: str
    words: str
    exact: bool = False  # counted as a base phrase: its words must stand consecutively


# The base phrases and their labels.
BASE = (
    Template("gpl", "gnu general public license", True),
    Template("apache", "apache license", True),
    Template("cc-by", "cc by", True),
    Template("mit", "mit license", True),
)
# Wording of common public license notices.
NOTICES = (
    Template("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license"),
    Template("lgpl", "gnu lesser general public license"),
    Template("agpl", "gnu affero general public license"),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    Template("cc-by-nc", "cc by nc"),
    Template("cc-by-sa", "cc by sa"),
    Template("proprietary", "all rights reserved"),
)


def words(text: Column) -> Column:
    """Words of letters (A-Z lower-cased), digits and characters beyond ASCII.

    ``lower`` also folds letters beyond ASCII, which moves no word border: such
    a letter belongs to a word before and after.
    """
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def grams(w: Column, k: int) -> Column:
    """All runs of k words, joined by a space; null at the last k - 1 places."""
    out = w
    for j in range(1, k):
        out = F.zip_with(out, F.slice(w, j + 1, F.size(w)), lambda a, b: F.concat(a, F.lit(" "), b))
    return out


def template_grams(spark, templates, k: int) -> DataFrame:
    """(gram, template, t_pos): fixed rows, as many as the templates have words."""
    rows = []
    for n, t in enumerate(templates):
        w = t.words.split(" ")
        rows += [(" ".join(w[i:i + k]), n, i) for i in range(len(w) - k + 1)]
    return spark.createDataFrame(rows, "t_gram string, template int, t_pos int").select(
        F.xxhash64("t_gram").alias("t_hash"), "t_gram", "template", "t_pos")


def template_facts(templates, k: int) -> Column:
    """template -> (label, votes of a whole copy, exact)."""
    pairs = []
    for n, t in enumerate(templates):
        pairs += [F.lit(n), F.struct(F.lit(t.label).alias("label"), F.lit(len(t.words.split(" ")) - k + 1).alias("full"),
                                     F.lit(t.exact).alias("exact"))]
    return F.create_map(*pairs)


def scan(df: DataFrame, templates=BASE + NOTICES, k: int = K, drift: int = DRIFT, cover: float = COVER,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``n_words`` and ``spans``, an array of (label, start, end,
    cover, exact) in words, end exclusive."""
    row = free_name(df, "row")
    base = with_columns_once(df.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias(row), text_col),
                             {"w": words(F.col(text_col))})
    rolled = base.select(row, "doc_id", F.size("w").cast("long").alias("n_words"),
                         F.posexplode_outer(grams(F.col("w"), k)).alias("pos", "gram"))
    table = F.broadcast(template_grams(df.sparkSession, templates, k))
    hits = (rolled.withColumn("hash", F.xxhash64("gram"))
            .join(table, (F.col("hash") == F.col("t_hash")) & (F.col("gram") == F.col("t_gram")), "left")
            # the first place keeps a document without hits in the result
            .where(F.col("template").isNotNull() | (F.coalesce("pos", F.lit(0)) == 0)))
    votes = (hits.groupBy(row, "doc_id", "n_words", "template", (F.col("pos") - F.col("t_pos")).alias("diagonal"))
             .agg(F.collect_set("t_pos").alias("held"), F.min("pos").alias("start"), (F.max("pos") + k).alias("end")))
    fact = template_facts(templates, k)[F.col("template")]
    votes = votes.withColumn("fact", fact)
    along = Window.partitionBy(row, "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(along)
    joined = votes.withColumn("new", F.when(F.col("fact.exact") | apart.isNull() | (apart > drift), 1).otherwise(0))
    joined = joined.withColumn("group", F.sum("new").over(along))
    merged = (joined.groupBy(row, "doc_id", "n_words", "template", "group")
              .agg(F.array_distinct(F.flatten(F.collect_list("held"))).alias("held"), F.min("start").alias("start"), F.max("end").alias("end"), F.first("fact").alias("fact")))
    # a place of the template counts once, however often its words stand near
    share = F.size("held") / F.col("fact.full")
    good = F.when(F.col("fact.exact"), F.size("held") == F.col("fact.full")).otherwise(share >= cover)
    span = F.when(F.col("template").isNotNull() & good, F.struct(
        F.col("fact.label").alias("label"), F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"),
        share.alias("cover"), F.col("fact.exact").alias("exact")))
    return (merged.groupBy(row, "doc_id", "n_words").agg(F.array_sort(F.collect_list(span)).alias("spans"))
            .select("doc_id", "n_words", "spans"))


def digest(scanned: DataFrame) -> DataFrame:
    base = F.filter("spans", lambda s: s["exact"])
    label = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
    starts = F.transform(base, lambda s: s["start"])
    return scanned.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), label(base).alias("base_labels"), label(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["cover"])), F.lit(0.0)).alias("score"))
