"""Python patterns in Java syntax: agreement with re, construct by construct and at random."""

import random
import re

import pytest
from pyspark.sql import functions as F

from newsfunnel.functions.pyregex import alternation

PATTERNS = [r"[\d]+x", r"[^\W]z", r"a.b", r"(?P<word_one>ab)(?P=word_one)", r"[\s]q", r"[^\s\d]k", r"x{,2}y", r"\bab\B", r"a$", r"^b", r"[]a]c", r"[a\-z]m",
            r"[[a]b", r"(a|b)\1", r"(?i:AB)c", r"a(?=b)", r"(?<!a)b", r"(?#note)ab", r"a\Z", r"[\w&&]x", r"a++b", r"(?>a|ab)c", r"é+", r"\x41é", r"[^a]b",
            r"a|", r"(?:ab){2,3}?c", r"\v", r"[^\D]", r"a\\b", r"[é-ü]"]


def test_patterns_agree_with_re(spark):
    rnd = random.Random(21)
    pieces = ["a", "b", "ab", "x", "1", "２", " ", "\n", "\r", "\t", "z", "é", "ñ", "_", "-", "]", "[", "&", "^", "c", "A", "y", "q", "k", "m", "\x0b", "\\", " "]
    texts = ["".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 8))) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").cache()
    for p in PATTERNS:
        got = {r.i: r.m for r in df.select("i", F.col("t").rlike(alternation([p])).alias("m")).collect()}
        rx = re.compile(p, re.IGNORECASE)
        assert [got[i] for i in range(len(texts))] == [bool(rx.search(t)) for t in texts], p
    both = [r"(a)\1", r"(?P<q>b)(?P=q)", r"[\d]"]
    got = {r.i: r.m for r in df.select("i", F.col("t").rlike(alternation(both)).alias("m")).collect()}
    assert [got[i] for i in range(len(texts))] == [any(re.search(p, t, re.IGNORECASE) for p in both) for t in texts]


@pytest.mark.parametrize("bad", ["(", r"(a)?(?(1)b|c)", "(?a)x", "(?a:x)"])
def test_what_java_cannot_say_is_refused(bad):
    with pytest.raises(ValueError):
        alternation([bad])
