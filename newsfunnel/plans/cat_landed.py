"""Catalog entries: feeds read from landed files.

The files are written from the documents first: one a payload, 100 payloads a source, each
with the articles of one state and language; some files break off, hold an error page or an
error answer, some items are no XML or lack a field, and the dates take every form.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from newsfunnel.plans.catalog import register
from newsfunnel.plans.fixtures import _xml_escape, articles_v, sql_with
from newsfunnel.session import ensure_checkpoint_dir
from newsfunnel.sources import landed as L

# date forms of an article's instant by ord % 8, as (Spark pattern); the last two take whole days
_FORMS = ["EEE, dd MMM yyyy HH:mm:ss' GMT'", "dd MMM yy HH:mm:ss' +0000'", "EEE MMM d HH:mm:ss yyyy", "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyyMMdd'T'HHmmss'Z'",
          "yyyy-MM-dd HH:mm:ss'+00:00:00'", "yyyy-MM-dd", "dd MMM yyyy HH:mm:ss' UNKN'"]
_LANGS = ["en", "hi", "ta", "ml"]


def _base(spark, sf):
    """Articles with their payload, place in it, and date text."""
    a = articles_v(spark, sf)
    k = F.col("ord")
    lang = F.array_position(F.array(*[F.lit(x) for x in ("en", "fr", "de", "es")]), F.col("language")) - 1
    form = F.lit(None).cast("string")
    for i, f in enumerate(_FORMS):
        form = F.when(k % 8 == i, F.date_format("date", f)).otherwise(form)
    return a.select("ord", F.concat(F.lit("t"), k.cast("string"), F.lit(" & <b> "), F.coalesce("source", F.lit(""))).alias("title"), "url", "source", "date",
                    ((k % 25) * 4 + lang).alias("payload"), form.alias("said"))


def _manifest(spark, sf):
    a = articles_v(spark, sf)
    lang = F.array_position(F.array(*[F.lit(x) for x in ("en", "fr", "de", "es")]), F.col("language")) - 1
    named = F.element_at(F.array(*[F.lit(x) for x in _LANGS]), (lang + 1).cast("int"))
    m = a.select(((F.col("ord") % 25) * 4 + lang).alias("payload"), named.alias("language"), "state", "search_term").distinct()
    return m.where("payload % 13 <> 12")


def _files(spark, sf):
    """Writes the landed files of the three sources; returns their folders."""
    base = os.path.join(ensure_checkpoint_dir(spark), "landed", uuid.uuid4().hex)
    b, k = _base(spark, sf), F.col("ord")
    date = F.when(k % 9 == 2, F.lit("")).otherwise(F.concat(F.lit("<pubDate>"), F.col("said"), F.lit("</pubDate>")))
    item = F.when(k % 23 == 5, F.concat(F.lit("<item><title>x &nope; <u></title><link>l</link>"), F.lit("</item>"))).otherwise(
        F.concat(F.lit("<item>\n<title>"), F.when(k % 11 == 3, F.lit(" ")).otherwise(_xml_escape(F.col("title"))), F.lit("</title><link>"), _xml_escape(F.col("url")),
                 F.lit("</link>"), date, F.lit("<source url='u'>"), _xml_escape(F.when(k % 19 == 0, "FOX Weather").otherwise(F.col("source"))), F.lit("</source></item>")))
    together = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("ord", c.alias("i")))), lambda x: x["i"])
    p = F.col("payload")
    rss = b.groupBy("payload").agg(F.array_join(together(item), "\n").alias("items")).select("payload", F.when(
        p % 10 == 7, F.lit("<html>try later</html>")).otherwise(F.concat(F.lit("<?xml version='1.0'?><rss><channel><title>feed</title>"), "items", F.when(
            p % 10 == 4, F.lit("<item><title>cut of")).otherwise(F.lit("</channel></rss>")))).alias("value"))
    said = F.when(k % 9 == 2, F.lit("soon")).when(k % 8 < 3, F.date_format("date", "yyyy-MM-dd HH:mm:ss")).when(k % 8 == 7, F.lit(None)).otherwise(F.col("said"))
    result = F.struct(F.col("title"), F.when(k % 11 == 3, F.lit(None)).otherwise(F.col("url")).alias("link"), said.alias("pubDate"), F.col("source").alias("source_name"))
    nd = b.groupBy("payload").agg(together(result).alias("results")).select("payload", F.to_json(F.struct(
        F.when(p % 10 == 6, "error").otherwise("success").alias("status"), F.when(p % 10 != 5, F.col("results")).alias("results"))).alias("v"))
    nd = nd.select("payload", F.when(p % 10 == 4, F.expr("left(v, length(v) - 9)")).otherwise(F.col("v")).alias("value"))
    article = F.struct(F.col("title"), F.col("url"), said.alias("publishedAt"), F.struct(F.col("source").alias("name")).alias("source"))
    gn = b.groupBy("payload").agg(together(article).alias("articles")).select("payload", F.when(p % 10 == 3, F.lit("{}")).otherwise(
        F.to_json(F.struct("articles"))).alias("value"))
    roots = {}
    for name, rows in (("google", rss), ("newsdata", nd), ("gnews", gn)):
        roots[name] = os.path.join(base, name)
        rows.repartition("payload").write.partitionBy("payload").option("lineSep", " ").text(roots[name])
    return roots


# expected rows from the articles themselves, without files, XML, JSON or dates in text
_SQL = """b AS (
  SELECT ord, 't' || ord || ' & <b> ' || coalesce(source, '') AS title, url, source, date_trunc('second', date) AS whole_at,
         CASE WHEN ord % 8 = 6 THEN date_trunc('day', date) ELSE date_trunc('second', date) END AS said_at,
         (ord % 25) * 4 + list_position(['en', 'fr', 'de', 'es'], language) - 1 AS payload,
         ['en', 'hi', 'ta', 'ml'][list_position(['en', 'fr', 'de', 'es'], language)] AS language, state, search_term
  FROM articles_v),
x AS (
  SELECT 'google' AS feed, 0 AS rank, *, said_at + INTERVAL 330 MINUTE AS date, CASE WHEN ord % 19 = 0 THEN 'FOX Weather' ELSE source END AS src,
    CASE WHEN payload % 10 = 7 THEN 'file' WHEN ord % 23 = 5 THEN 'malformed' WHEN ord % 11 = 3 THEN 'title_empty'
         WHEN ord % 9 = 2 THEN 'date_missing' WHEN ord % 19 = 0 THEN 'publisher_excluded' WHEN payload % 13 = 12 THEN 'language_unsupported' END AS reason FROM b
  UNION ALL
  SELECT 'newsdata', 1, *, CASE WHEN ord % 8 < 3 THEN whole_at ELSE said_at END + INTERVAL 330 MINUTE, source,
    CASE WHEN payload % 10 IN (4, 5, 6) THEN 'file' WHEN ord % 11 = 3 THEN 'url_empty' WHEN ord % 9 = 2 OR ord % 8 = 7 THEN 'date_missing'
         WHEN payload % 13 = 12 THEN 'language_unsupported' END FROM b
  UNION ALL
  SELECT 'gnews', 2, *, CASE WHEN ord % 8 < 3 THEN whole_at WHEN ord % 8 = 6 THEN said_at ELSE said_at + INTERVAL 330 MINUTE END, source,
    CASE WHEN payload % 10 = 3 THEN 'file' WHEN ord % 9 = 2 OR ord % 8 = 7 THEN 'date_missing' WHEN payload % 13 = 12 THEN 'language_unsupported' END FROM b)"""


@register("landed_refs", sql_with("""
SELECT CAST(rank AS INTEGER) AS rank, payload, row_number() OVER (PARTITION BY rank, payload ORDER BY ord) AS nth, title, url, src AS source, date, language, state, search_term
FROM x WHERE reason IS NULL""", articles=True, ctes_after=_SQL))
def q_landed_refs(spark, sf):
    from pyspark.sql import Window

    refs, _ = L.landed_refs(spark, _files(spark, sf), _manifest(spark, sf))
    place = Window.partitionBy("ord.rank", "ord.payload").orderBy("ord")  # the items of one response
    return refs.select("ord.rank", "ord.payload", F.row_number().over(place).cast("long").alias("nth"), "title", "url", "source", "date", "language", "state", "search_term")


@register("landed_rejects", sql_with("""
SELECT feed, payload, reason, count(*) AS n FROM (
  SELECT feed, payload, reason FROM x WHERE reason <> 'file'
  UNION ALL SELECT DISTINCT feed, payload, CASE WHEN feed = 'google' OR feed = 'gnews' OR payload % 10 = 5 THEN 'no_items' WHEN payload % 10 = 6 THEN 'source_error' ELSE 'malformed' END
            FROM x WHERE reason = 'file'
  UNION ALL SELECT DISTINCT 'google', payload, 'malformed' FROM b WHERE payload % 10 = 4)
GROUP BY feed, payload, reason""", articles=True, ctes_after=_SQL))
def q_landed_rejects(spark, sf):
    _, rejects = L.landed_refs(spark, _files(spark, sf), _manifest(spark, sf))
    return rejects.groupBy("feed", "payload", "reason").agg(F.count("*").alias("n"))
