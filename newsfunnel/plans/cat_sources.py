"""Catalog entries: feed normalisation and dimension loading."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsfunnel.operators.querygen import ARTICLE_LANGUAGES
from newsfunnel.plans.catalog import register
from newsfunnel.plans.fixtures import (
    FEED_LANG_SQL, REGIONS_FX_SQL, TERMS_V_SQL, articles_v, gnews_feed_v, newsdata_feed_v, regions_fx,
    rss_feed_v, sql_with, terms_v,
)
from newsfunnel.plans.oracle_sql import d_strip
from newsfunnel.sources import dims as DM
from newsfunnel.sources import feeds as FD
from newsfunnel.sources.tables import read_table

_LANGS = "[" + ", ".join(f"'{x}'" for x in ARTICLE_LANGUAGES) + "]"
_DENY = "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in FD.EXCLUDED_PUBLISHERS) + "]"
_OUT = "ord, title, url, source, date, language, state, district, search_term"
_VALID = (f"length(title) BETWEEN 1 AND 500 AND length(url) >= 1 AND length(source) >= 1 AND date IS NOT NULL "
          f"AND list_contains({_LANGS}, language) AND length(state) >= 1 AND length(search_term) >= 1")
_IST = "INTERVAL 330 MINUTE"

_RSS = f"""
SELECT {_OUT} FROM (
  SELECT ord * 65536 AS ord, title2 AS title, url,
    CASE WHEN ord % 9 = 1 THEN coalesce(nullif(CASE WHEN contains(title2, ' - ')
           THEN {d_strip("regexp_extract(title2, '(?s)^.* - (.*)$', 1)")} END, ''), 'Unknown')
         ELSE coalesce(nullif(src, ''), 'Unknown') END AS source,
    CASE WHEN ord % 9 = 2 THEN NULL ELSE date_trunc('second', date) + {_IST} END AS date,
    {FEED_LANG_SQL} AS language, state, CAST(NULL AS VARCHAR) AS district, search_term
  FROM (SELECT *, CASE ord % 19 WHEN 0 THEN 'FOX Weather' WHEN 1 THEN 'fox weather' ELSE source END AS src,
               CASE WHEN ord % 9 = 3 THEN '' ELSE {d_strip('title')} END AS title2 FROM articles_v) x
  WHERE title2 <> '' )
WHERE NOT list_contains({_DENY}, source) AND {_VALID}"""


@register("rss_normalize", sql_with(_RSS, articles=True))
def q_rss(spark, sf):
    return FD.normalize_rss(rss_feed_v(spark, sf))


_ND = f"""
SELECT {_OUT} FROM (
  SELECT ord * 65536 AS ord, {d_strip("' ' || title || ' '")} AS title, url,
    coalesce(nullif(CASE WHEN ord % 5 = 1 THEN NULL WHEN ord % 5 = 2 THEN '' ELSE source END, ''),
             nullif(CASE WHEN ord % 5 = 2 THEN NULL ELSE 'id-' || source END, ''), 'Unknown') AS source,
    CASE WHEN ord % 13 = 5 THEN NULL ELSE date_trunc('second', date) + {_IST} END AS date,
    {FEED_LANG_SQL} AS language, state, CAST(NULL AS VARCHAR) AS district, search_term
  FROM articles_v WHERE ord % 17 <> 0
  UNION ALL
  SELECT ord * 65536 + 1, title || ' (b)', url || '&p=2', 'Unknown',
    CASE WHEN ord % 13 = 5 THEN NULL ELSE date_trunc('second', date) + {_IST} END,
    {FEED_LANG_SQL}, state, CAST(NULL AS VARCHAR), search_term
  FROM articles_v WHERE ord % 17 <> 0 AND ord % 2 = 1)
WHERE title <> '' AND {_VALID}"""


@register("newsdata_normalize", sql_with(_ND, articles=True))
def q_newsdata(spark, sf):
    return FD.normalize_newsdata(newsdata_feed_v(spark, sf))


_GN = f"""
SELECT {_OUT} FROM (
  SELECT ord * 65536 AS ord, {d_strip('title')} AS title, {d_strip('url')} AS url,
    CASE WHEN ord % 11 = 1 THEN 'Unknown' WHEN ord % 11 = 2 THEN '' ELSE source END AS source,
    CASE WHEN ord % 11 = 3 THEN NULL ELSE date_trunc('second', date) + {_IST} END AS date,
    {FEED_LANG_SQL} AS language, state, CAST(NULL AS VARCHAR) AS district, search_term
  FROM articles_v)
WHERE title <> '' AND {_VALID}"""


@register("gnews_normalize", sql_with(_GN, articles=True))
def q_gnews(spark, sf):
    return FD.normalize_gnews(gnews_feed_v(spark, sf))


@register("publisher_denylist", sql_with(
    f"SELECT ord, source FROM (SELECT ord, CASE ord % 19 WHEN 0 THEN 'FOX Weather' WHEN 1 THEN 'fox weather' "
    f"WHEN 2 THEN 'AccuWeather' ELSE source END AS source FROM articles_v) WHERE NOT list_contains({_DENY}, source)",
    articles=True))
def q_denylist(spark, sf):
    a = articles_v(spark, sf)
    k = F.col("ord")
    s = (F.when(k % 19 == 0, F.lit("FOX Weather")).when(k % 19 == 1, F.lit("fox weather"))
         .when(k % 19 == 2, F.lit("AccuWeather")).otherwise(F.col("source")))
    return FD.exclude_publishers(a.select("ord", s.alias("source")))


@register("ref_validate", sql_with(f"SELECT {_OUT} FROM articles_v WHERE {_VALID}", articles=True))
def q_ref_validate(spark, sf):
    return FD.validate_refs(articles_v(spark, sf).drop("full_text"))


@register("ref_reject_counts", sql_with(f"""
SELECT reason, count(*) AS n FROM (SELECT CASE WHEN title IS NULL OR length(title) < 1 THEN 'title_empty'
  WHEN length(title) > 500 THEN 'title_too_long' WHEN url IS NULL OR length(url) < 1 THEN 'url_empty'
  WHEN source IS NULL OR length(source) < 1 THEN 'source_empty' WHEN date IS NULL THEN 'date_missing'
  WHEN language IS NULL OR NOT list_contains({_LANGS}, language) THEN 'language_unsupported'
  WHEN state IS NULL OR length(state) < 1 THEN 'state_empty'
  WHEN search_term IS NULL OR length(search_term) < 1 THEN 'search_term_empty' END AS reason FROM articles_v)
GROUP BY reason""", articles=True))
def q_ref_reject_counts(spark, sf):
    a = articles_v(spark, sf).withColumn("reason", FD.ref_reject_reason())
    return a.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@register("ist_calendar_date", "SELECT event_id, CAST(ts AS DATE) AS ist_date, "
                               "CAST(ts + INTERVAL 330 MINUTE AS DATE) AS ist_date_from_utc FROM events")
def q_ist_date(spark, sf):
    e = read_table(spark, sf, "events", "event_id", "ts")
    return e.select("event_id", F.to_date("ts").alias("ist_date"),
                    F.to_date(FD.naive_utc_to_ist(F.col("ts"))).alias("ist_date_from_utc"))


@register("source_union", sql_with(f"""
SELECT {_OUT.replace('ord,', '(0::BIGINT << 56) + ord AS ord,', 1)} FROM ({_RSS})
UNION ALL SELECT {_OUT.replace('ord,', '(1::BIGINT << 56) + ord AS ord,', 1)} FROM ({_ND})
UNION ALL SELECT {_OUT.replace('ord,', '(2::BIGINT << 56) + ord AS ord,', 1)} FROM ({_GN})""", articles=True))
def q_source_union(spark, sf):
    return FD.source_union(FD.normalize_rss(rss_feed_v(spark, sf)), FD.normalize_newsdata(newsdata_feed_v(spark, sf)),
                           FD.normalize_gnews(gnews_feed_v(spark, sf)))


def _resolve_input(spark, sf):
    a = articles_v(spark, sf).select("ord", "url")
    k = F.col("ord")
    gurl = F.when(k % 5 == 0, F.concat(F.lit("https://news.google.com/rss/articles/"), k.cast("string"))).otherwise(F.col("url"))
    refs = a.select("ord", gurl.alias("url"), F.col("url").alias("orig"))
    res = refs.where(F.col("url").contains("news.google.com")).select(
        "url", F.when(k % 10 == 0, F.col("orig")).alias("resolved"))
    return refs.drop("orig"), res


@register("url_resolve_lookup", sql_with("""
SELECT ord, CASE WHEN ord % 5 = 0 THEN CASE WHEN ord % 10 = 0 THEN url ELSE 'https://news.google.com/rss/articles/' || ord END
  ELSE url END AS url FROM articles_v""", articles=True))
def q_url_resolve(spark, sf):
    refs, res = _resolve_input(spark, sf)
    return FD.resolve_urls(refs, res)


# ---------------------------------------------------------------- dimensions
def _geo_doc(spark, sf):
    """The nested geography document built from region x nation (one JSON text)."""
    r = regions_fx(spark, sf)
    n = read_table(spark, sf, "nation", "n_nationkey", "n_name", "n_regionkey")
    d = n.groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct(
        F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"), F.lower("n_name").alias("slug")))).alias("ds"))
    st = r.join(d, r.region_ord == d.n_regionkey).select("region_ord", F.struct(
        "name", "slug", "type", "languages",
        F.transform("ds", lambda x: F.struct(x["name"].alias("name"), x["slug"].alias("slug"))).alias("districts")
    ).alias("s"))
    return st.agg(F.to_json(F.struct(F.transform(F.array_sort(F.collect_list(F.struct("region_ord", "s"))),
                                                 lambda x: x["s"]).alias("states"))).alias("doc"))


@register("geo_explode", f"""WITH {REGIONS_FX_SQL}
SELECT r.name AS state, r.slug AS state_slug, n.n_name AS district, lower(n.n_name) AS district_slug,
       row_number() OVER (PARTITION BY r.region_ord ORDER BY n.n_nationkey) - 1 AS district_ord
FROM regions_fx r JOIN nation n ON n.n_regionkey = r.region_ord""")
def q_geo_explode(spark, sf):
    _, districts = DM.explode_geo(_geo_doc(spark, sf), "doc")
    return districts


@register("geo_regions_validate", f"""WITH {REGIONS_FX_SQL}
SELECT region_ord, name, slug, type, languages,
  (type IN ('state', 'ut') AND len(languages) > 0 AND list_bool_and(list_transform(languages, lambda x: list_contains({_LANGS}, x)))) AS valid
FROM regions_fx""")
def q_geo_regions(spark, sf):
    regions, _ = DM.explode_geo(_geo_doc(spark, sf), "doc")
    return regions


def _terms_doc(spark, sf):
    """The nested term document built from the words of the documents (one JSON text)."""
    t = terms_v(spark, sf)
    per_cat = t.groupBy("lang", "category", "cat_ord").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("term_ord", "term"))), lambda x: x["term"]).alias("ts"))
    per_lang = per_cat.groupBy("lang").agg(F.map_from_entries(F.transform(
        F.array_sort(F.collect_list(F.struct("cat_ord", "category", "ts"))),
        lambda x: F.struct(x["category"], x["ts"]))).alias("cats"))
    doc = per_lang.agg(F.map_from_entries(F.collect_list(F.struct(
        "lang", F.struct(F.upper("lang").alias("name"), F.col("cats").alias("categories"))))).alias("languages"))
    return doc.select(F.to_json(F.struct(F.lit("fx-1").alias("version"), "languages")).alias("doc"))


def _with_terms(body: str) -> str:
    return f"WITH {TERMS_V_SQL}\n{body}"


@register("terms_explode", _with_terms("SELECT lang, upper(lang) AS language_name, category, cat_ord, term, term_ord FROM terms_v"))
def q_terms_explode(spark, sf):
    return DM.explode_terms(_terms_doc(spark, sf), "doc")


@register("terms_validate", _with_terms("SELECT lang, count(DISTINCT category) AS n_categories, "
                                        "count(DISTINCT category) = 10 AS complete FROM terms_v GROUP BY lang"))
def q_terms_validate(spark, sf):
    return DM.validate_terms(DM.explode_terms(_terms_doc(spark, sf), "doc"))


_REQ = [(0, "asia"), (1, "atlantis"), (2, "europe")]


@register("region_lookup", f"""WITH {REGIONS_FX_SQL}, req(req_ord, slug) AS (VALUES {', '.join(f"({i}, '{s}')" for i, s in _REQ)}),
d AS (SELECT lower(replace(r.r_name, ' ', '-')) AS state_slug, list(n.n_name ORDER BY n.n_nationkey) AS districts
      FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey GROUP BY 1)
SELECT q.req_ord, q.slug, r.name, r.type, coalesce(r.languages, ['en']) AS languages,
       coalesce(d.districts, CAST([] AS VARCHAR[])) AS districts
FROM req q LEFT JOIN regions_fx r ON r.slug = q.slug LEFT JOIN d ON d.state_slug = r.slug""")
def q_region_lookup(spark, sf):
    regions, districts = DM.explode_geo(_geo_doc(spark, sf), "doc")
    req = spark.createDataFrame(_REQ, "req_ord int, slug string")
    return DM.region_lookup(regions.drop("valid"), districts, req)


@register("terms_by_category", _with_terms("""
SELECT lang, category, list(term ORDER BY term_ord) AS terms FROM terms_v GROUP BY lang, category
UNION ALL SELECT lang, NULL, list(term ORDER BY cat_ord, term_ord) FROM terms_v GROUP BY lang"""))
def q_terms_by_category(spark, sf):
    return DM.terms_by_category(terms_v(spark, sf))
