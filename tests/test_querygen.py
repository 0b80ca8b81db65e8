"""Q1-Q9: query languages, broad budget, greedy district packing, keys."""

import hashlib
import random

from pyspark.sql import functions as F

from newsfunnel.operators import querygen as QG


def test_pack_districts_keeps_its_rules(spark):
    """Batches concatenate to the input, each fits the budget or holds one name, and
    none could have taken the next name as well."""
    rnd = random.Random(11)
    cases = []
    for i in range(150):
        ds = [rnd.choice(["Pune", "Navi Mumbai", "X", "Long District Name", "Ab", "Sri Ganganagar"]) + str(j)
              for j in range(rnd.randint(1, 25))]
        cases.append((i, ds, rnd.choice(["heatwave", "लू", "heat wave"]), rnd.choice([20, 40, 80, 200]),
                      rnd.choice(["Bihar", "", "Tamil Nadu"])))
    df = spark.createDataFrame(cases, "i int, ds array<string>, t string, lim int, st string")
    got = {}
    for lim in sorted({c[3] for c in cases}):
        sub = df.where(F.col("lim") == lim).select("i", QG.pack_districts(F.col("ds"), F.col("t"), F.col("st"), lim).alias("b"))
        got.update({r.i: [list(x) for x in r.b] for r in sub.collect()})
    for i, ds, t, lim, st in cases:
        batches, room = got[i], lim - len(t) - 3 - (len(st) + 1 if st else 0)

        def cost(names):
            return len(" OR ".join(f'"{n}"' if " " in n else n for n in names))

        assert sum(batches, []) == ds and all(batches)
        assert all(len(b) == 1 or cost(b) <= room for b in batches)
        assert all(cost(b + nxt[:1]) > room for b, nxt in zip(batches, batches[1:]))


def test_broad_query_budget(spark):
    df = spark.createDataFrame([(["heatwave", "heat stroke", "loo"], "Rajasthan")], "ts array<string>, loc string")
    assert df.select(QG.broad_query(F.col("ts"), F.col("loc"), 512).alias("q")).first().q == \
        '(heatwave OR "heat stroke" OR loo) Rajasthan'
    # budget 30 - 12 = 18: heatwave (8) + ' OR "heat stroke"' (17) overflows -> prefix stops
    assert df.select(QG.broad_query(F.col("ts"), F.col("loc"), 30).alias("q")).first().q == "(heatwave) Rajasthan"
    # nothing fits: first term unquoted, truncated to the budget (16 - 12 = 4), at least one char
    assert df.select(QG.broad_query(F.col("ts"), F.col("loc"), 16).alias("q")).first().q == "(heat) Rajasthan"
    assert df.select(QG.broad_query(F.col("ts"), F.col("loc"), 12).alias("q")).first().q == "(h) Rajasthan"


def test_query_key(spark):
    row = ("google", "bihar", "hi", "state", "(लू OR गर्मी) Bihar")
    df = spark.createDataFrame([row], "source_hint string, state_slug string, language string, level string, query_string string")
    expect = hashlib.sha256("|".join(row).encode()).hexdigest()[:16]
    assert df.select(QG.query_key().alias("k")).first().k == expect


def test_query_languages(spark):
    df = spark.createDataFrame([(0, "A", "a", ["en", "hi", "ur"]), (1, "B", "b", ["en"]), (2, "C", "c", ["ta"])],
                               "region_ord int, name string, slug string, languages array<string>")
    got = sorted((r.region_ord, r.lang_ord, r.lang) for r in QG.query_languages(df).collect())
    assert got == [(0, 0, "hi"), (0, 1, "en"), (1, 0, "en"), (2, 0, "ta"), (2, 1, "en")]
