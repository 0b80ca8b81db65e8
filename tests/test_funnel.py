"""The composed funnel, stage by stage on a handful of articles."""

import datetime as dt
import glob
import os
import random

from helpers import greedy_title_dedup, py_normalize_url, quality

from newsfunnel.plans.pipeline import article_funnel

REFS = ("ord long, title string, url string, source string, date timestamp_ntz, language string, state string, "
        "district string, search_term string")
LONG = "The heatwave keeps people of Gaya indoors. " * 5


def test_article_funnel(spark, tmpdir_path):
    def ref(o, title, url, day=5, lang="en", district=None):
        return (o, title, url, "src", dt.datetime(2026, 7, day, 10), lang, "Bihar", district, "heat")

    refs = [
        ref(1, "Heatwave grips the state", "https://a/1"), ref(2, "Heatwave grips the state", "https://www.a/1/"),  # same URL
        ref(3, "Heatwave grips the state!", "https://a/3"),  # near title, longer text: takes the place of 1
        ref(4, "Old heatwave story", "https://a/4", day=1),  # out of range
        ref(5, "Voted down heatwave", "https://a/5"), ref(6, "No page for this heatwave", "https://a/6"),
        ref(7, "Cricket final tonight", "https://a/7"),  # no term, excluded
        ref(8, "Heatwave in Texas today", "https://a/8"),  # out of region
        ref(9, "Temperature and heatwave answers", "https://a/9"), ref(10, "Beyond the cap", "https://a/10"),
    ]
    text = {1: LONG, 2: LONG, 3: LONG + "More on the heatwave.", 4: LONG, 5: LONG, 7: "Cricket all night long. " * 9, 8: LONG,
            9: "The heatwave is everywhere in this land. " * 5, 10: LONG}
    pages = [(r[2], f"<body><article><p>{text[r[0]]}</p></article></body>") for r in refs if r[0] in text]
    terms = [("en", "weather", 0, "heatwave", 0), ("en", "temperature", 2, "temperature", 0)]
    gaz = [("Bihar", "Patna", 0), ("Bihar", "Gaya", 1)]
    got = article_funnel(
        spark.createDataFrame(refs, REFS), spark.createDataFrame(pages, "url string, html string"),
        spark.createDataFrame(terms, "lang string, category string, cat_ord int, term string, term_ord int"), [r"\bcricket\b"],
        spark.createDataFrame(gaz, "state string, district string, district_ord int"), start="2026-07-04", end="2026-07-06",
        verdicts=spark.createDataFrame([(5, "No"), (5, "no way"), (1, "yes"), (1, "yes")], "ref_id long, response string"),
        answers=spark.createDataFrame([(9, '"Patna"'), (9, '"Patna"')], "ref_id long, answer string"), max_articles=7, out=tmpdir_path)
    rows = sorted((r.ord, r.url, r.district) for r in got.collect())
    assert rows == [(1, "https://a/3", "Gaya"), (9, "https://a/9", "Patna")]
    assert len(glob.glob(os.path.join(tmpdir_path, "articles_csv", "state_slug=bihar", "*", "*", "*.csv"))) == 2


def test_more_refs_than_the_cap_take_every_step(spark):
    rnd = random.Random(4)
    when = dt.datetime(2026, 7, 5, 10)
    refs, text = [], {}
    for o in range(7000):
        lang = f"l{o % 500}"  # few titles a language, so that the brute force stays quick
        title = "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=24)) + (" cricket" if o % 11 == 0 else "")
        url = f"https://a/{o}"
        if o >= 500 and o % 13 == 0:
            title = refs[o - 500][1] + "!"  # near the one before it in its language
        if o % 17 == 0 and o:
            url = f"https://www.a/{o - 1}/"
        refs.append((o, title, url, "src", when, lang, "Bihar", None, "heat"))
        text[url] = ("Nothing but cricket all night. " if o % 11 == 0 else "The heatwave keeps people indoors. ") * rnd.randint(5, 9) + rnd.choice(("In Gaya.", "In town."))
    pages = [(u, f"<body><article><p>{t}</p></article></body>") for u, t in text.items()]
    terms = [("en", "weather", 0, "heatwave", 0)]
    got = article_funnel(
        spark.createDataFrame(refs, REFS), spark.createDataFrame(pages, "url string, html string"),
        spark.createDataFrame(terms, "lang string, category string, cat_ord int, term string, term_ord int"), [r"\bcricket\b"],
        spark.createDataFrame([("Bihar", "Patna", 0), ("Bihar", "Gaya", 1)], "state string, district string, district_ord int"),
        verdicts=spark.createDataFrame([(o, "No") for o in range(0, 7000, 10)], "ref_id long, response string"))
    by_url = {}
    for o, title, url, source, _, lang, *_ in refs:
        if o % 10:
            row = {"ord": o, "language": lang, "title": title, "full_text": text[url], "url": url, "source": source,
                   "district": "Gaya" if "Gaya" in text[url] else None}
            by_url.setdefault(py_normalize_url(url), []).append(row)
    kept = {}
    for rows in by_url.values():
        best = max(rows, key=lambda r: (quality(r["full_text"], r["district"], r["source"]), -r["ord"]))
        kept[rows[0]["ord"]] = best | {"ord": rows[0]["ord"]}
    want = []
    for place, o in greedy_title_dedup(list(kept.values())):
        r = kept[o]
        if "heatwave" in r["full_text"] or "cricket" not in r["title"] + r["full_text"]:
            want.append((place, r["url"], r["title"], r["district"]))
    assert len(want) > 5000
    assert sorted(tuple(r) for r in got.select("ord", "url", "title", "district").collect()) == sorted(want)
