"""Catalog entries: relevance score, exclusion filter and row filters."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from newsfunnel.operators import filters as FL
from newsfunnel.operators.scoring import filter_excluded, score_relevance
from newsfunnel.plans.catalog import register
from newsfunnel.plans.fixtures import (
    ARTICLE_COLS, PATTERNS, REGIONS_FX_SQL, articles_v, fx_df, regions_fx, sql_with,
)
from newsfunnel.plans.oracle_sql import D_NOT_WORD, d_strip
from newsfunnel.sources.tables import read_table

_RE2_SPECIAL = re.compile(r"([.^$*+?(){}\[\]|\\])")


def re2_literal(s: str) -> str:
    return _RE2_SPECIAL.sub(r"\\\1", s)


def re2_from_py(p: str) -> str:
    """Oracle-side rewrite of a fixture pattern: edge ``\\b`` -> explicit class."""
    if p.startswith(r"\b"):
        p = f"(^|{D_NOT_WORD})" + p[2:]
    if p.endswith(r"\b"):
        p = p[:-2] + f"({D_NOT_WORD}|$)"
    return p


_A = "a AS (SELECT *, lower(CASE WHEN coalesce(title, '') <> '' AND full_text IS NOT NULL THEN title || chr(10) || full_text " \
     "WHEN coalesce(title, '') <> '' THEN title WHEN full_text IS NOT NULL THEN full_text ELSE '' END) AS txt FROM articles_v)"

_SCORE_SQL = _A + f""",
m AS (SELECT DISTINCT a.ord, lower(t.term) AS lt, t.category FROM a JOIN terms_fx t ON t.lang = 'en' OR t.lang = a.language
      WHERE regexp_matches(a.txt, '(^|{D_NOT_WORD})' || regexp_replace(lower(t.term), '([.^$*+?(){{}}\\[\\]|\\\\])', '\\\\\\1', 'g') || '({D_NOT_WORD}|$)')),
s AS (SELECT m.ord, count(DISTINCT m.lt) AS n, count(DISTINCT m.category) AS c,
             bool_or(contains(lower(a.title), m.lt)) AS th FROM m JOIN a ON a.ord = m.ord GROUP BY m.ord),
r AS (SELECT a.*, s.n, s.th, least(s.n::DOUBLE / 3.0::DOUBLE, 1.0::DOUBLE) * 0.5::DOUBLE
                 + least(s.c::DOUBLE / 2.0::DOUBLE, 1.0::DOUBLE) * 0.3::DOUBLE
                 + CASE WHEN s.th THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END AS raw
      FROM a LEFT JOIN s ON s.ord = a.ord),
scored AS (SELECT *, CASE WHEN n IS NULL THEN 0.0::DOUBLE
     ELSE least(CASE WHEN full_text IS NULL AND th THEN greatest(raw, 0.3::DOUBLE) ELSE raw END, 1.0::DOUBLE) END AS relevance_score FROM r)
"""


@register("relevance_score", sql_with("SELECT ord, relevance_score FROM scored", "terms_fx", articles=True,
                                      ctes_after=_SCORE_SQL))
def q_relevance_score(spark, sf):
    return score_relevance(articles_v(spark, sf), fx_df(spark, "terms_fx")).select("ord", "relevance_score")


_excl = " OR ".join(f"regexp_matches(txt, '(?i)' || '{re2_from_py(p)}')" for p in PATTERNS)


@register("exclusion_filter", sql_with(f"SELECT {', '.join(ARTICLE_COLS)}, relevance_score FROM scored "
                                       f"WHERE NOT (relevance_score < 0.05 AND ({_excl}))", "terms_fx", articles=True,
                                       ctes_after=_SCORE_SQL))
def q_exclusion_filter(spark, sf):
    return filter_excluded(articles_v(spark, sf), fx_df(spark, "terms_fx"), fx_df(spark, "patterns_fx"))


@register("drop_empty_text", sql_with(
    f"SELECT * FROM articles_v WHERE full_text IS NOT NULL AND length({d_strip('full_text')}) > 0", articles=True))
def q_drop_empty_text(spark, sf):
    return FL.drop_empty_text(articles_v(spark, sf))


@register("date_range_filter", "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' "
                               "AND ts <= TIMESTAMP '2024-01-12 23:59:59'")
def q_date_range(spark, sf):
    return FL.date_range(read_table(spark, sf, "events", "event_id", "ts"), "2024-01-10", "2024-01-12", col="ts")


@register("lookback_filter", "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-19 12:00:00'")
def q_lookback(spark, sf):
    return FL.lookback(read_table(spark, sf, "events", "event_id", "ts"), "2024-01-20 12:00:00", 24, col="ts")


_REQ = [(0, "asia"), (1, "atlantis"), (2, "africa"), (3, "middle-east")]


@register("state_selection", "WITH " + REGIONS_FX_SQL + ", req(req_ord, slug) AS (VALUES "
          + ", ".join(f"({i}, '{s}')" for i, s in _REQ) + ") "
          "SELECT q.slug, q.req_ord, r.region_ord, r.name, r.type, r.languages, r.region_ord IS NOT NULL AS known "
          "FROM req q LEFT JOIN regions_fx r ON r.slug = q.slug")
def q_state_selection(spark, sf):
    req = spark.createDataFrame(_REQ, "req_ord int, slug string")
    return FL.select_states(regions_fx(spark, sf), req)


_DSLUGS = ["nation_3", "nation_10", "nation_21", "nation_7", "nowhere"]


@register("district_filter", sql_with(
    "SELECT * FROM articles_v WHERE district IS NOT NULL AND replace(lower(district), ' ', '-') IN ("
    + ", ".join(f"'{s}'" for s in _DSLUGS) + ")", articles=True))
def q_district_filter(spark, sf):
    return FL.filter_districts(articles_v(spark, sf), _DSLUGS)


@register("title_signal_filter", sql_with(
    "SELECT ord, title FROM articles_v WHERE regexp_matches(title, '(?i)(" + "|".join(re2_literal(w) for w in FL.HEAT_SIGNALS)
    + ")')", articles=True))
def q_title_signal(spark, sf):
    return FL.filter_title_signal(articles_v(spark, sf)).select("ord", "title")


@register("title_signal_filter_fx", sql_with(
    "SELECT ord, title FROM articles_v WHERE regexp_matches(title, '(?i)(ther|ering|an )')", articles=True))
def q_title_signal_fx(spark, sf):
    return FL.filter_title_signal(articles_v(spark, sf), ["ther", "ering", "an "]).select("ord", "title")


@register("article_cap", sql_with("SELECT * FROM articles_v ORDER BY ord LIMIT 500", articles=True))
def q_article_cap(spark, sf):
    return FL.cap(articles_v(spark, sf), 500)


def _skip_urls(spark, sf):
    p = read_table(spark, sf, "pages", "page_id", "url")
    m = F.col("page_id") % 6
    pid = F.col("page_id").cast("string")
    url = (F.when(m == 0, F.concat(F.lit("https://www.msn.com/en-in/news/"), pid))
           .when(m == 1, F.concat(F.lit("http://notmsn.com/x/"), pid))
           .when(m == 2, F.concat(F.lit("https://News.MSN.com/a?"), pid))
           .when(m == 3, F.concat(F.lit("msn.com/"), pid))
           .otherwise(F.col("url")))
    return p.select("page_id", url.alias("url"))


_SKIP_SRC = """(SELECT page_id, CASE page_id % 6 WHEN 0 THEN 'https://www.msn.com/en-in/news/' || page_id
  WHEN 1 THEN 'http://notmsn.com/x/' || page_id WHEN 2 THEN 'https://News.MSN.com/a?' || page_id
  WHEN 3 THEN 'msn.com/' || page_id ELSE url END AS url FROM pages)"""


@register("skip_domain_flag", f"""
SELECT page_id, url, (h = 'msn.com' OR ends_with(h, '.msn.com')) AS skip FROM (
  SELECT page_id, url, CASE WHEN starts_with(lower(hh), 'www.') THEN substr(lower(hh), 5) ELSE lower(hh) END AS h FROM (
    SELECT page_id, url, regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\\-]*:)?//([^/?#]*)', 1) AS hh FROM {_SKIP_SRC}))""")
def q_skip_domain(spark, sf):
    return _skip_urls(spark, sf).withColumn("skip", FL.skip_domain("url"))
