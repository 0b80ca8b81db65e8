"""Regex builders agree with Python's re on random text (word boundaries, tries)."""

import random
import re

from pyspark.sql import functions as F

from newsfunnel.operators.extract import OUT_OF_REGION_PLACES, out_of_region_regex
from newsfunnel.operators.filters import HEAT_SIGNALS, title_signal_regex


def _python_places(places):
    return re.compile(r"\b(?:" + "|".join(re.escape(p) for p in places) + r")\b", re.IGNORECASE)


def test_out_of_region_matches_python(spark):
    rnd = random.Random(13)
    places = ["u.s.", "u.s.a", "usa", "new york", "new jersey", "texas", "ble.", ".net"]
    pieces = ["u.s.", "a", "usa", "USA", "new ", "york", "jersey", "texas", "ble.", ".net", " ", ",", "x", "é", "_",
              "तापमान", "."]
    texts = ["".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 9))) for _ in range(600)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.m for r in df.select("i", F.col("t").rlike(out_of_region_regex(places)).alias("m")).collect()}
    rx = _python_places(places)
    assert [got[i] for i in range(len(texts))] == [bool(rx.search(t)) for t in texts]
    # the default list compiles and behaves on simple cases
    d = _python_places(OUT_OF_REGION_PLACES)
    for t in ["Heat in Texas", "Texan", "U.S. today", "in u.s.military", "Pakistan heat"]:
        r = spark.createDataFrame([(t,)], "t string").select(F.col("t").rlike(out_of_region_regex()).alias("m")).first().m
        assert r is bool(d.search(t)), t


def test_title_signals_match_python(spark):
    rnd = random.Random(17)
    rx = re.compile("|".join(re.escape(w) for w in HEAT_SIGNALS), re.IGNORECASE)
    pieces = ["heat", "HEAT", "wave", " ", "loo", "look", "hot", "गर्मी", "लू", "x", "stroke", "sun", "water ", "crisis"]
    texts = ["".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 6))) for _ in range(400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    pat = title_signal_regex()
    got = {r.i: r.m for r in df.select("i", F.col("t").rlike(pat).alias("m")).collect()}
    assert [got[i] for i in range(len(texts))] == [bool(rx.search(t)) for t in texts]
