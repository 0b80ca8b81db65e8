"""Dictionary relevance score and the exclusion rule."""

import datetime as dt

from newsfunnel.operators.scoring import filter_excluded, score_relevance

TERMS = [("en", "weather", 0, "heatwave", 0), ("en", "weather", 0, "heat wave", 1),
         ("en", "health", 1, "heatstroke", 0), ("en", "temperature", 2, "temperature", 0),
         ("hi", "weather", 0, "गर्मी", 0)]
SCHEMA = ("ord long, title string, url string, source string, date timestamp_ntz, language string, state string, "
          "district string, search_term string, full_text string")


def art(o, title, text, lang="en"):
    return (o, title, f"u{o}", "s", dt.datetime(2026, 2, 1), lang, "Bihar", None, "heat", text)


def scores(spark, rows, patterns=None):
    terms = spark.createDataFrame(TERMS, "lang string, category string, cat_ord int, term string, term_ord int")
    df = spark.createDataFrame(rows, SCHEMA)
    if patterns is None:
        out = score_relevance(df, terms)
    else:
        out = filter_excluded(df, terms, spark.createDataFrame([(p,) for p in patterns], "pattern string"))
    return {r.ord: r.relevance_score for r in out.collect()}


def test_score_lattice(spark):
    s = scores(spark, [
        art(1, "Cricket match report", "the team won"),
        art(2, "Heatwave grips Bihar", None),  # title hit, no text: floor 0.3 (raw 0.5166)
        art(3, "City news", "a heatwave is coming"),  # one term, one category
        art(4, "City news", "heatwave and heatstroke cases"),  # two categories
        art(5, "Heatwave alert", "heatwave, heat wave, heatstroke and temperature"),
        art(6, "City", "preheatwave heatwaves"),  # no word-boundary hit
        art(7, "गर्मी", "गर्मी से लोग परेशान", "hi"),
        art(8, "City", "गर्मीयों", "hi"),  # vowel sign after the term: no hit
    ])
    assert s[1] == 0.0 and s[6] == 0.0 and s[8] == 0.0
    assert abs(s[2] - (1 / 3 * 0.5 + 0.5 * 0.3 + 0.2)) < 1e-12
    assert abs(s[3] - (1 / 3 * 0.5 + 0.5 * 0.3)) < 1e-12
    assert abs(s[4] - (2 / 3 * 0.5 + 0.3)) < 1e-12
    assert s[5] == 1.0
    assert s[7] > 0.3


def test_exclusion_only_below_threshold(spark):
    pats = [r"\bcricket\b", "ipl"]
    s = scores(spark, [
        art(1, "Cricket match report", "IPL final tonight"),  # no topic term + sports: dropped
        art(2, "Weather report", "clouds"),  # borderline, no exclusion hit: kept
        art(3, "Cricket match called off", "heatwave stops play"),  # topic + sports: kept
    ], pats)
    assert sorted(s) == [2, 3]
    assert s[2] == 0.0 and s[3] > 0.3


def test_terms_against_a_loop(spark, monkeypatch):
    """Overlapping, nested and repeated terms, every language, against one search a term."""
    import random

    import regex

    from newsfunnel.operators import scoring

    rnd = random.Random(5)
    pieces = ["heat", "heat wave", "wave", "wave pool", "heat-wave", "red alert", "alert level", "c++", "u.s.", "गर्मी", "गर्मी लू", "été", "a", "a b", "b c", "ab"]
    terms = [(rnd.choice(["en", "en", "hi", "fr"]), f"c{rnd.randrange(6)}", 0, t.upper() if rnd.random() < 0.2 else t, k) for k, t in enumerate(pieces * 3)]
    rows = []
    for o in range(600):
        text = "".join(rnd.choice(pieces) + rnd.choice([" ", " ", "", "-", ".", "_", "\n"]) for _ in range(rnd.randint(0, 7)))
        rows.append(art(o, rnd.choice(["", "Heat", "alert LEVEL", "City", rnd.choice(pieces)]), rnd.choice([None, text, text.upper()]), rnd.choice(["en", "hi", "fr", "xx", ""])))
    want = {}
    for r in rows:
        o, title, lang, text = r[0], r[1], r[5], r[9]
        body = ((title + "\n" + text) if title and text is not None else title or text or "").lower()
        hits = [(t.lower(), c) for lng, c, _, t, _ in terms if lng in {lang or "en", "en"} and regex.search(rf"(?<![\p{{L}}\p{{N}}_]){regex.escape(t.lower())}(?![\p{{L}}\p{{N}}_])", body)]
        n, c, th = len({t for t, _ in hits}), len({c for _, c in hits}), any(t in title.lower() for t, _ in hits)
        raw = min(n / 3, 1) * 0.5 + min(c / 2, 1) * 0.3 + (0.2 if th else 0)
        want[o] = 0.0 if not n else min(max(raw, 0.3) if text is None and th else raw, 1.0)
    frame = spark.createDataFrame(terms, "lang string, category string, cat_ord int, term string, term_ord int")
    df = spark.createDataFrame(rows, SCHEMA)
    for size in (5000, 3):
        monkeypatch.setattr(scoring, "TRIE_TERMS", size)
        out = score_relevance(df, frame)
        got = {r.ord: r.relevance_score for r in out.collect()}
        assert all(abs(got[o] - want[o]) < 1e-12 for o in want), [(r, got[r[0]], want[r[0]]) for r in rows if abs(got[r[0]] - want[r[0]]) > 1e-12][:3]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "regexp_like" not in plan.lower() and "rlike" not in plan.lower()


def test_dictionaries_of_any_size(spark):
    terms = spark.range(30_000).selectExpr("'en' AS lang", "concat('c', id % 7) AS category", "0 AS cat_ord", "concat('term', id) AS term", "0 AS term_ord")
    rows = [art(1, "no", "term7 and term29999, not term30000"), art(2, "term5", None)]
    got = {r.ord: r.relevance_score for r in score_relevance(spark.createDataFrame(rows, SCHEMA), terms).collect()}
    assert abs(got[1] - (2 / 3 * 0.5 + 0.3)) < 1e-12 and abs(got[2] - (1 / 3 * 0.5 + 0.5 * 0.3 + 0.2)) < 1e-12
    out = filter_excluded(spark.createDataFrame([art(1, "word11999x", ""), art(2, "word 5", "")], SCHEMA), terms, [f"word{n}x" for n in range(12_000)])
    assert [r.ord for r in out.collect()] == [2]
