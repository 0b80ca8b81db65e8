"""Cleaning patterns on very long runs, and agreement with re on small ones."""

import random
import re

from pyspark.sql import functions as F

from newsfunnel.operators.extract import BREADCRUMB_RE, RECOMMENDED_RE, clean_text

# The two patterns as Python writes them, the model for these tests.
CRUMB = re.compile(r"^(?:\s*-\s+.{1,50}\n){2,}", re.MULTILINE)
RELATED = re.compile(r"(?:^.*(?:recommended|related\s+(?:news|articles|stories)|संबंधित\s+खबरें|સંબંધિત\s+સમાચાર).*\n)(?:.+\n?){2,}$", re.MULTILINE | re.IGNORECASE)


def test_twenty_thousand_lines(spark):
    crumbs = "".join(f"- item {i}\n" for i in range(20_000)) + "body text"
    related = "intro\n\nRelated News\n" + "\n".join(f"headline {i}" for i in range(20_000))
    df = spark.createDataFrame([(1, crumbs), (2, related)], "i int, t string")
    got = {r.i: r.c for r in df.select("i", clean_text("t").alias("c")).collect()}
    assert got == {1: "body text", 2: "intro"}


def test_runs_agree_with_re(spark):
    rnd = random.Random(31)
    pieces = ["- a", "-  ", "-", " ", "\n", "\n\n", "x", "Related news", "recommended", "- " + "y" * 51, "\t- b", "\r", "ab"]
    texts = ["".join(rnd.choice(pieces) + rnd.choice(["\n", "\n", ""]) for _ in range(rnd.randint(0, 9))) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: (r.a, r.b) for r in df.select("i", F.regexp_replace("t", BREADCRUMB_RE, "").alias("a"),
                                              F.regexp_replace("t", RECOMMENDED_RE, "").alias("b")).collect()}
    for i, t in enumerate(texts):
        assert got[i][0] == CRUMB.sub("", t), repr(t)
        assert got[i][1] == RELATED.sub("", t), repr(t)
