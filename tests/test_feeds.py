"""Date forms of feeds, in any session zone."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from newsfunnel.sources import feeds as FD

IST = dt.timedelta(hours=5, minutes=30)
RFC = {
    "Tue, 10 Feb 2026 08:30:00 GMT": dt.datetime(2026, 2, 10, 8, 30), "10 Feb 2026 08:30 GMT": dt.datetime(2026, 2, 10, 8, 30),
    "Tue, 10 Feb 26 08:30:05 +0530": dt.datetime(2026, 2, 10, 3, 0, 5), "Mon, 1 Jan 96 00:00:00 EST": dt.datetime(1996, 1, 1, 5),
    "2026-02-10T08:30:00Z": dt.datetime(2026, 2, 10, 8, 30), "2026-02-10": dt.datetime(2026, 2, 10), "10 Feb 2026 08:30:00": dt.datetime(2026, 2, 10, 8, 30),
    "Tue Feb 10 08:30:00 2026": dt.datetime(2026, 2, 10, 8, 30), "Tue Feb  3 23:59:59 1998": dt.datetime(1998, 2, 3, 23, 59, 59),
    "Tue, 10 Feb 2026 08:30:00 ADT": dt.datetime(2026, 2, 10, 11, 30), "Tue, 10 Feb 2026 08:30:00 XYZ": dt.datetime(2026, 2, 10, 8, 30),
    "Tue, 10 February 2026 08:30:00 +05:30": dt.datetime(2026, 2, 10, 3), "20260210T083000Z": dt.datetime(2026, 2, 10, 8, 30),
    "2026-W07-2T08:30": dt.datetime(2026, 2, 10, 8, 30), "Tue, 10 Feb 2026 25:00:00 GMT": None, "10 Foo 2026 08:30:00": None, "Tue Feb 30 08:30:00 2026": None,
    "nonsense": None, "": None, "32 Feb 2026 08:30:00 GMT": None,
}
ISO = ["2026-03-08 02:30:00", "2026-03-08T02:30", "2026-03-08", "2026-03-08T02:30:00.123", "2026-03-08T02:30:00.123456+02:00", "2026-03-08 02:30:00Z",
       "20260308T023000Z", "20260308T0230", "20260308", "2026-W10-7", "2026W107", "2026-W10", "2026W10", "2026-W54-1", "2026-W53-1", "2020-W53-7", "2026-W00-1",
       "2026-W10-8", "2026-W10-7T02:30:00+05:30:15", "2026-03-08T02:30:00+05:30:15.25", "2026-03-08T02:30:00,5", "2026-03-08_02:30", "2026-03-08T02",
       "2026-03-08T02:30:00.1234567", "2026-03-08T02:30:00+0530", "2026-03-08T02:30:00-23:59:59", "2026-03-08T02:60", "0000-01-01", "2024-02-29T00:00Z", "2023-02-29",
       "20x6", "2026-02-30", "2026-03-08T25:00:00", "2026-03-08T02:30:00-0530"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_dates_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        rss = spark.createDataFrame([(k,) for k in RFC], "s string").select("s", FD.rss_date_to_ist(F.col("s")).alias("d")).collect()
        assert {r.s: r.d for r in rss} == {k: v and v + IST for k, v in RFC.items()}
        micros, aware = FD.iso_instant(F.col("s"))
        iso = spark.createDataFrame([(k,) for k in ISO], "s string").select("s", FD.epoch_micros_to_ntz(micros).alias("d"), aware.alias("a")).collect()
        for r in iso:
            try:
                want = dt.datetime.fromisoformat(r.s)
            except ValueError:
                want = None
            aware_want = want is not None and want.tzinfo is not None
            if aware_want:
                want = want.astimezone(dt.timezone.utc).replace(tzinfo=None)
            assert r.d == want and (want is None or r.a == aware_want), r
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_items_beyond_two_hundred_and_fifty_six(spark):
    import json

    payload = json.dumps({"status": "ok", "results": [{"title": f"t{i}", "link": f"https://a/{i}", "pubDate": "2026-02-10 08:30:00.5"} for i in range(600)]})
    feed = spark.createDataFrame([(0, "en", "Bihar", "heat", payload), (1, "en", "Bihar", "heat", payload)], "ord long, language string, state string, search_term string, payload string")
    got = FD.normalize_newsdata(feed).select("ord").distinct().count()
    assert got == 1200


def test_iso_dates_as_python_reads_them(spark):
    """Random well and badly formed dates against ``datetime.fromisoformat``."""
    import random

    rnd = random.Random(41)
    texts = set()
    for _ in range(3000):
        d = rnd.choice(["{:04d}-{:02d}-{:02d}".format(rnd.randint(1, 2100), rnd.randint(0, 13), rnd.randint(0, 32)),
                        "{:04d}{:02d}{:02d}".format(rnd.randint(1900, 2100), rnd.randint(1, 12), rnd.randint(1, 31)),
                        "{:04d}-W{:02d}-{}".format(rnd.randint(1990, 2040), rnd.randint(0, 54), rnd.randint(0, 8)),
                        "{:04d}W{:02d}{}".format(rnd.randint(1990, 2040), rnd.randint(1, 53), rnd.choice(["", 1, 7]))])
        h, m, s_ = rnd.randint(0, 23), rnd.randint(0, 61), rnd.randint(0, 61)
        t = rnd.choice(["", f"T{h:02d}", f" {h:02d}:{m:02d}", f"T{h:02d}:{m:02d}:{s_:02d}", f"T{h:02d}{m:02d}{s_:02d}.{rnd.randint(0, 10 ** 6)}", f"T{h:02d}:{m:02d}:{s_:02d},{rnd.randint(0, 999)}"])
        z = rnd.choice(["", "Z", "+05:30", "-0330", "+05", "-01:02:03", "+010203.5"]) if t else ""
        texts.add(d + t + z)
    micros, aware = FD.iso_instant(F.col("s"))
    df = spark.createDataFrame([(t,) for t in sorted(texts)], "s string")
    for r in df.select("s", FD.epoch_micros_to_ntz(micros).alias("d"), aware.alias("a")).collect():
        try:
            want = dt.datetime.fromisoformat(r.s)
            zone = want.tzinfo is not None
            want = want.astimezone(dt.timezone.utc).replace(tzinfo=None) if zone else want
        except (ValueError, OverflowError):
            want = None
        assert r.d == want and (want is None or r.a == zone), (r, want)


QUERY = "payload long, language string, state string, search_term string"


def _land(root, files):
    import os

    for n, name, text in files:
        os.makedirs(f"{root}/payload={n}", exist_ok=True)
        with open(f"{root}/payload={n}/{name}", "w", encoding="utf-8") as f:
            f.write(text)
    return root


def test_broken_rss_files(spark, tmpdir_path):
    from newsfunnel.sources import landed as L

    item = "<item><title>{t}</title><link>https://a/{t}</link><pubDate>Tue, 10 Feb 2026 08:30:00 GMT</pubDate></item>"
    root = _land(tmpdir_path + "/rss", [
        (1, "a.xml", "<?xml version='1.0'?><rss><channel><title>no item's title</title>" + "".join(item.format(t=f"t{i}") for i in range(300)) + "</channel></rss>"),
        (2, "a.xml", "<html>try later</html>"), (3, "a.xml", ""),
        (4, "a.xml", "<rss>" + item.format(t="good") + "<item><title>bad & worse</item>\n" + item.format(t="after") + "<item><title>cut"),
        (5, "a.xml", "<rss>" + item.format(t="nobody asked")),
        (6, "a.xml", "<rss>" + item.format(t="<![CDATA[x <b> & y]]>").replace("https://a/<![CDATA[x <b> & y]]>", "https://a/1")),
        (6, "b.xml", "<rss>" + item.format(t="second file"))])
    manifest = spark.createDataFrame([(n, "en", "Bihar", "heat") for n in (1, 2, 3, 4, 6, 7)] + [(1, "en", "Bihar", "heat")], QUERY)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")  # the large file is split
        refs, bad = L.rss_refs(spark, root, manifest)
        got = [(r.ord.payload, r.title) for r in refs.orderBy("ord").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == [(1, f"t{i}") for i in range(300)] + [(4, "good"), (4, "after"), (6, "x <b> & y"), (6, "second file")]
    assert sorted((r.payload, r.reason, r.title) for r in bad.collect()) == [
        (2, "no_items", None), (3, "nothing_landed", None), (4, "malformed", ""), (4, "malformed", ""),
        (5, "language_unsupported", "nobody asked"), (7, "nothing_landed", None)]
    numbered = [(r.ord, r.title) for r in FD.number_refs(refs).collect()]
    assert [t for _, t in sorted(numbered)] == [t for _, t in got] and len({o for o, _ in numbered}) == len(got)


def test_broken_json_files(spark, tmpdir_path):
    import json

    from newsfunnel.sources import landed as L

    ok = {"title": " t ", "link": "https://a/1", "pubDate": "2026-02-10 08:30:00", "source_id": "id"}
    root = _land(tmpdir_path + "/nd", [
        (1, "a.json", json.dumps({"status": "success", "results": [ok, {**ok, "title": None}, {**ok, "pubDate": 5}, {**ok, "link": " "}]}, indent=1)),
        (2, "a.json", "{\"results\": [{"), (3, "a.json", json.dumps({"status": "error", "results": {"message": "quota"}})), (4, "a.json", json.dumps({"status": "success"})),
        (5, "a.json", "[1, 2]"), (6, "a.json", "")])
    manifest = spark.createDataFrame([(n, "en", "Bihar", "heat") for n in range(1, 7)], QUERY)
    refs, bad = L.newsdata_refs(spark, root, manifest)
    assert [(r.ord.payload, r.ord.pos, r.title, r.source, r.date) for r in refs.collect()] == [(1, 0, "t", "id", dt.datetime(2026, 2, 10, 14))]
    got = sorted((r.payload, r.reason) for r in bad.collect())
    assert got[:3] == [(1, "date_missing"), (1, "title_empty"), (1, "url_empty")]
    assert [p for p, _ in got[3:]] == [2, 3, 4, 5, 6] and ("no_items" in dict(got[3:])[4]) and dict(got[3:])[2] == "malformed"


def test_any_number_of_payloads_and_items(spark):
    import json

    payload = json.dumps({"status": "ok", "results": [{"title": f"t{i}", "link": "https://a", "pubDate": "2026-02-10"} for i in range(70_000)]})
    feed = spark.createDataFrame([(1 << 60, "en", "Bihar", "heat", payload)], "ord long, language string, state string, search_term string, payload string")
    rows = FD.newsdata_rows(feed, order=FD.struct_ord)
    both = FD.source_union(rows.limit(0), rows, rows.limit(0)).where("reason is null")
    r = both.agg(F.count("*").alias("n"), F.max("ord").alias("m")).first()
    assert r.n == 70_000 and tuple(r.m) == (1, 1 << 60, 69_999)
