"""Catalog entries: sinks, metadata, counts and log audits."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from newsfunnel.functions.text import slugify
from newsfunnel.operators.audit import failure_streaks, rolling_quota
from newsfunnel.plans.catalog import register
from newsfunnel.plans.fixtures import ARTICLE_COLS, articles_v, sql_with
from newsfunnel.plans.oracle_sql import d_strip
from newsfunnel.session import ensure_checkpoint_dir
from newsfunnel.sources import sinks as W
from newsfunnel.sources.tables import read_table


@register("slugify", """
SELECT n.n_nationkey, replace(replace(lower(n.n_name || ' & ' || r.r_name), ' ', '-'), '&', 'and') AS slug
FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey""")
def q_slugify(spark, sf):
    n = read_table(spark, sf, "nation", "n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf, "region", "r_regionkey", "r_name")
    j = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
    return j.select("n_nationkey", slugify(F.concat(F.col("n_name"), F.lit(" & "), F.col("r_name"))).alias("slug"))


_KEYS = """replace(replace(lower(state), ' ', '-'), '&', 'and') AS state_slug, strftime(date, '%Y-%m-%d') AS out_date,
  CASE WHEN district IS NOT NULL AND district <> '' THEN replace(replace(lower(district), ' ', '-'), '&', 'and') END AS district_slug"""


@register("output_groups", sql_with(f"""
SELECT state_slug, out_date, district_slug, arg_min(state, ord) AS state,
       arg_min(CASE WHEN district <> '' THEN district END, ord) AS district, count(*) AS article_count, min(ord) AS first_ord
FROM (SELECT *, {_KEYS} FROM articles_v) GROUP BY ALL""", articles=True))
def q_output_groups(spark, sf):
    return W.output_groups(articles_v(spark, sf))


_ISO_SQL = ("strftime(date, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond(date) % 1000000 <> 0 THEN '.' || "
            "lpad(CAST(microsecond(date) % 1000000 AS VARCHAR), 6, '0') ELSE '' END || '+05:30'")


def _d_field(c: str) -> str:
    value = {"date": f"CAST(to_json({_ISO_SQL}) AS VARCHAR)", "relevance_score": "'0.0'"}.get(c, f"coalesce(CAST(to_json({c}) AS VARCHAR), 'null')")
    return f"'      \"{c}\": ' || {value}"


_ARTICLE_SQL = "'    {' || chr(10) || " + " || ',' || chr(10) || ".join(_d_field(c) for c in W.ARTICLE_FIELDS) + " || chr(10) || '    }'"


@register("json_envelope", sql_with(f"""
SELECT state_slug, out_date, district_slug, '{{' || chr(10) || '  "state": ' || to_json(arg_min(state, ord)) || ',' || chr(10) || '  "district": '
    || coalesce(CAST(to_json(arg_min(CASE WHEN district <> '' THEN district END, ord)) AS VARCHAR), 'null') || ',' || chr(10) || '  "date": "' || out_date || '",' || chr(10)
    || '  "article_count": ' || count(*) || ',' || chr(10) || '  "articles": [' || chr(10)
    || string_agg(article, ',' || chr(10) ORDER BY ord) || chr(10) || '  ]' || chr(10) || '}}' AS envelope
FROM (SELECT *, {_KEYS}, {_ARTICLE_SQL} AS article FROM articles_v) GROUP BY state_slug, out_date, district_slug""", articles=True))
def q_json_envelope(spark, sf):
    """Written as files, one document a group, and read back."""
    root = os.path.join(ensure_checkpoint_dir(spark), "envelopes", uuid.uuid4().hex)
    W.write_envelopes(articles_v(spark, sf).withColumn("relevance_score", F.lit(0.0)), root)
    return W.read_envelopes(spark, root)


@register("article_json", sql_with(f"""
SELECT ord, {{}} AS json FROM articles_v""".replace("{}", "'{' || " + " || ',' || ".join(_d_field(c).replace("'      ", "'").replace('": ', '":') for c in W.ARTICLE_FIELDS) + " || '}'"), articles=True))
def q_article_json(spark, sf):
    a = articles_v(spark, sf).withColumn("relevance_score", F.lit(0.0))
    return a.select("ord", W.article_json(a).alias("json"))


@register("csv_lines", sql_with(f"""
SELECT ord, {' || \',\' || '.join(
    "CASE WHEN regexp_matches(v, '[,\"\\r\\n]') THEN '\"' || replace(v, '\"', '\"\"') || '\"' ELSE v END".replace('v', f'coalesce({c}, \'\')')
    if c != 'date' else "strftime(date, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond(date) % 1000000 <> 0 THEN '.' || lpad(CAST(microsecond(date) % 1000000 AS VARCHAR), 6, '0') ELSE '' END || '+05:30'"
    for c in ARTICLE_COLS[1:])} || ',0.0' || chr(13) AS line FROM articles_v""", articles=True))
def q_csv_lines(spark, sf):
    a = articles_v(spark, sf).withColumn("relevance_score", F.lit(0.0))
    return a.select("ord", W.csv_line(a).alias("line"))


@register("run_metadata", sql_with(f"""
SELECT '2026-07-05T12:00:00+05:30' AS collection_timestamp, ['google_news', 'newsdata', 'gnews'] AS sources_queried,
  (SELECT list_sort(list(DISTINCT search_term)) FROM articles_v) AS query_terms_used,
  (SELECT count(*) FROM articles_v) AS articles_found,
  (SELECT count(full_text) FROM articles_v) AS articles_extracted,
  (SELECT count(*) FROM articles_v WHERE full_text IS NOT NULL AND length({d_strip('full_text')}) > 0) AS articles_filtered""",
    articles=True))
def q_run_metadata(spark, sf):
    from newsfunnel.operators.filters import drop_empty_text

    a = articles_v(spark, sf)
    m = W.run_metadata(a.drop("full_text"), a, drop_empty_text(a), "2026-07-05T12:00:00+05:30")
    return m.select("collection_timestamp", "sources_queried", "query_terms_used",
                    *[F.col("counts")[k].alias(k) for k in ("articles_found", "articles_extracted", "articles_filtered")])


@register("funnel_counts", sql_with(f"""
SELECT count(*) AS articles_found, count(full_text) AS articles_extracted,
  count(*) FILTER (WHERE full_text IS NOT NULL AND length({d_strip('full_text')}) > 0) AS articles_with_text,
  count(district) AS articles_tagged, count(*) FILTER (WHERE source <> 'Unknown') AS articles_with_source
FROM articles_v""", articles=True))
def q_funnel_counts(spark, sf):
    return W.funnel_counts(articles_v(spark, sf))


def _request_log(spark, sf):
    e = read_table(spark, sf, "events", "event_id", "ts", "user_id", "event_type")
    return e.select("event_id", "ts", F.col("user_id").alias("source"), (F.col("event_type") != "error").alias("success"))


@register("failure_streaks", """
SELECT source, min(ts) AS run_start, max(ts) AS run_end, count(*) AS n_failures, count(*) >= 5 AS tripped
FROM (SELECT *, sum(CASE WHEN success THEN 1 ELSE 0 END) OVER (PARTITION BY source ORDER BY ts, event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
      FROM (SELECT event_id, ts, user_id AS source, event_type <> 'error' AS success FROM events))
WHERE NOT success GROUP BY source, run""")
def q_failure_streaks(spark, sf):
    return failure_streaks(_request_log(spark, sf), threshold=5)


@register("rolling_quota", """
SELECT event_id, ts, source, success, in_window, in_window >= 30 AS over_quota FROM (
  SELECT *, count(*) OVER (PARTITION BY source ORDER BY epoch_us(ts) RANGE BETWEEN 900000000 PRECEDING AND CURRENT ROW) AS in_window
  FROM (SELECT event_id, ts, user_id AS source, event_type <> 'error' AS success FROM events))""")
def q_rolling_quota(spark, sf):
    return rolling_quota(_request_log(spark, sf))
