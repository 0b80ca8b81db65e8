"""Partitioned JSON/CSV output and metadata."""

import csv
import datetime as dt
import glob
import io
import json
import os

from newsfunnel.sources import sinks as W

SCHEMA = ("ord long, title string, url string, source string, date timestamp_ntz, language string, state string, "
          "district string, search_term string, full_text string, relevance_score double")


def test_write_output_roundtrip(spark, tmpdir_path):
    rows = [
        (1, 'He said "hot", very', "https://a/1", "s", dt.datetime(2026, 7, 5, 10, 30), "en", "Tamil Nadu", None,
         "heat", "line1\nline2", 0.5166666666666666),
        (2, "Plain", "https://a/2", "s", dt.datetime(2026, 7, 5, 11, 0, 0, 1234), "en", "Tamil Nadu", "Salem & Co",
         "heat", None, 1.0),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    W.write_output(df, tmpdir_path)
    csvs = glob.glob(os.path.join(tmpdir_path, "articles_csv", "state_slug=tamil-nadu", "out_date=2026-07-05", "*", "*.csv"))
    assert csvs
    recs = []
    for f in csvs:
        raw = open(f, "rb").read().decode()
        assert raw.startswith(",".join(W.ARTICLE_FIELDS) + "\n")
        recs.extend(csv.DictReader(io.StringIO(raw, newline="")))
    by_title = {r["title"]: r for r in recs}
    assert by_title['He said "hot", very']["full_text"] == "line1\nline2"
    assert by_title["Plain"]["full_text"] == "" and by_title["Plain"]["district"] == "Salem & Co"
    assert by_title["Plain"]["date"] == "2026-07-05T11:00:00.001234+05:30"
    assert by_title['He said "hot", very']["date"] == "2026-07-05T10:30:00+05:30"
    dirs = sorted(os.path.basename(p) for p in glob.glob(os.path.join(
        tmpdir_path, "articles_json", "state_slug=tamil-nadu", "out_date=2026-07-05", "*")))
    assert dirs == ["district_slug=__HIVE_DEFAULT_PARTITION__", "district_slug=salem-and-co"]
    lines = [json.loads(x) for f in glob.glob(os.path.join(tmpdir_path, "articles_json", "*", "*", "*", "*.txt"))
             for x in open(f)]
    assert {x["title"] for x in lines} == {'He said "hot", very', "Plain"}
    assert [k for k in lines[0]] == W.ARTICLE_FIELDS
    groups = spark.read.json(os.path.join(tmpdir_path, "groups")).collect()
    assert sorted(g.article_count for g in groups) == [1, 1]


def test_one_header_a_file_in_a_large_group(spark, tmpdir_path):
    """1,000 rows of one group, with order keys as feeds build them, dealt over several files."""
    texts = ["plain", 'with "quotes"', " blanks ", "two\nlines", "cr\rlf\r\n", "", None, "a,b", "'", "\\", "#x"]
    rows = [(n * 65536, f"t{n}", f"https://a/{n}", "s", dt.datetime(2026, 7, 5), "en", "Bihar", "Gaya", "heat", texts[n % len(texts)], 0.5)
            for n in range(1000)]
    W.write_output(spark.createDataFrame(rows, SCHEMA), tmpdir_path, rows_per_file=100)
    files = glob.glob(os.path.join(tmpdir_path, "articles_csv", "state_slug=bihar", "*", "*", "*.csv"))
    recs = []
    for f in files:
        raw = open(f, newline="", encoding="utf-8").read()
        assert raw.startswith(",".join(W.ARTICLE_FIELDS) + "\n") and raw.count("title,url,source") == 1
        recs += list(csv.DictReader(io.StringIO(raw, newline="")))
    assert len(files) > 1 and len(recs) == 1000
    assert {r["title"]: r["full_text"] for r in recs} == {r[1]: r[9] or "" for r in rows}
    W.write_output(spark.createDataFrame(rows, SCHEMA), tmpdir_path, rows_per_file=100)  # a retry changes nothing
    again = glob.glob(os.path.join(tmpdir_path, "articles_csv", "state_slug=bihar", "*", "*", "*.csv"))
    assert sum(len(list(csv.DictReader(open(f, newline="", encoding="utf-8")))) for f in again) == 1000


def test_envelopes_are_the_json_documents(spark, tmpdir_path):
    """File by file against json.dumps; a second write replaces its own groups only."""
    when = dt.datetime(2026, 7, 5, 10, 30)
    texts = ['said "hot"', "two\nlines", None, "", "back\\slash / \t tab", "हिन्दी \U0001F600", "x" * 5000]
    rows = [(n, f"t{n}", f"https://a/{n}", "s", when + dt.timedelta(days=n % 2, microseconds=n % 3), "en", ["Tamil Nadu", "Bihar"][n % 2],
             [None, "", "Salem & Co"][n % 3], "heat", texts[n % len(texts)], 0.1 * n) for n in range(200)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    root = os.path.join(tmpdir_path, "env")
    W.write_envelopes(df, root)
    W.write_envelopes(df.where("state = 'Bihar'"), root)
    got = {(r.state_slug, r.out_date, r.district_slug): r.envelope for r in W.read_envelopes(spark, root).collect()}
    want = {}
    for r in rows:
        key = (r[6].lower().replace(" ", "-"), r[4].strftime("%Y-%m-%d"), "salem-and-co" if r[7] else None)
        want.setdefault(key, []).append(r)
    assert set(got) == set(want)
    for key, members in want.items():
        articles = []
        for r in members:
            a = dict(zip(["ord", *W.ARTICLE_FIELDS], r))
            del a["ord"]
            a["date"] = r[4].isoformat() + "+05:30"
            articles.append(a)
        doc = {"state": members[0][6], "district": members[0][7] or None, "date": key[1], "article_count": len(members), "articles": articles}
        assert got[key] == json.dumps(doc, indent=2, ensure_ascii=False), key
    assert len(glob.glob(os.path.join(root, "state_slug=*", "*", "*", "part-*"))) == len(want)
