"""Catalog entry: the streaming ingest, end to end (L3/L4)."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from newsfunnel.plans.catalog import register
from newsfunnel.plans.fixtures import ARTICLE_COLS, articles_v, sql_with
from newsfunnel.plans.oracle_sql import d_norm_url, d_quality
from newsfunnel.session import ensure_checkpoint_dir
from newsfunnel.streaming.ingest import rows_behind_watermark, start_best_quality_ingest, start_ingest

_LANGS = "['en', 'hi', 'ta', 'te', 'bn', 'mr', 'gu', 'kn', 'ml', 'or', 'pa', 'as', 'ur', 'ne']"


@register("stream_url_dedup", sql_with(
    f"SELECT DISTINCT norm_url FROM ({d_norm_url('(SELECT * FROM articles_v WHERE list_contains(' + _LANGS + ', language) AND length(title) BETWEEN 1 AND 500)')})",
    articles=True))
def q_stream_url_dedup(spark, sf):
    """Land the refs as files, run the dedup stream once (availableNow), read the sink."""
    base = os.path.join(ensure_checkpoint_dir(spark), "stream-runs", uuid.uuid4().hex)
    src, out = os.path.join(base, "landed"), os.path.join(base, "out")
    articles_v(spark, sf).write.mode("overwrite").parquet(src)
    start_ingest(spark, src, out, checkpoint=os.path.join(base, "checkpoint")).awaitTermination()
    return spark.read.parquet(out).select("norm_url")


_VALID = f"list_contains({_LANGS}, language) AND length(title) BETWEEN 1 AND 500"
_REST = ", ".join(c for c in ARTICLE_COLS if c != "ord")


@register("stream_best_quality", sql_with(f"""
SELECT first_ord AS ord, {_REST} FROM (
  SELECT *, row_number() OVER (PARTITION BY norm_url ORDER BY {d_quality()} DESC, ord) AS rn, min(ord) OVER (PARTITION BY norm_url) AS first_ord
  FROM ({d_norm_url(f'(SELECT * FROM articles_v WHERE {_VALID})')})) WHERE rn = 1""", articles=True))
def q_stream_best_quality(spark, sf):
    """Three landings, the stream stopped and started between them: first copies, then copies of the same URLs on
    other dates (some better, all older dates among them late), then the first landing once more."""
    base = os.path.join(ensure_checkpoint_dir(spark), "stream-runs", uuid.uuid4().hex)
    src, table, ck = (os.path.join(base, x) for x in ("landed", "table", "checkpoint"))
    a, k = articles_v(spark, sf), F.col("ord")
    for landing in (a.where(k % 3 == 0), a.where(k % 3 == 1).unionByName(a.where(k % 3 == 2)), a.where(k % 6 == 0)):
        landing.write.mode("append").parquet(src)
        start_best_quality_ingest(spark, src, table, checkpoint=ck).awaitTermination()  # a new query that resumes
    return spark.read.parquet(table).select(*ARTICLE_COLS)


_FIRST = "SELECT * FROM articles_v WHERE ord % 3 = 0 AND " + _VALID


@register("stream_late_rows", sql_with(f"""
SELECT (SELECT count(DISTINCT norm_url) FROM ({d_norm_url(f'({_FIRST})')})) AS first_urls,
  (SELECT count(*) FROM articles_v WHERE ord % 3 <> 0 AND {_VALID} AND date < (SELECT max(date) FROM ({_FIRST})) - INTERVAL 24 HOUR) AS late_rows""", articles=True))
def q_stream_late_rows(spark, sf):
    """The watermark stream over two landings: what the first gave, and how many rows of the second came too late."""
    base = os.path.join(ensure_checkpoint_dir(spark), "stream-runs", uuid.uuid4().hex)
    src, out, ck = (os.path.join(base, x) for x in ("landed", "out", "checkpoint"))
    a, k = articles_v(spark, sf), F.col("ord")
    a.where(k % 3 == 0).write.parquet(src)
    start_ingest(spark, src, out, checkpoint=ck).awaitTermination()
    first = spark.read.parquet(out).select("norm_url").distinct().count()
    a.where(k % 3 != 0).write.mode("append").parquet(src)
    again = start_ingest(spark, src, out, checkpoint=ck)
    again.awaitTermination()
    return spark.createDataFrame([(first, rows_behind_watermark(again))], "first_urls long, late_rows long")
