"""Catalog entries: URL normalisation and dedup."""

from __future__ import annotations

from newsfunnel.functions.urls import with_normalized_url
from newsfunnel.operators.urldedup import dedup_by_url, quality_score
from newsfunnel.plans.catalog import register
from newsfunnel.plans.fixtures import ARTICLE_COLS, articles_v, sql_with
from newsfunnel.plans.oracle_sql import d_norm_url, d_quality, d_strip
from newsfunnel.sources.tables import read_table


@register("url_normalize", d_norm_url("(SELECT page_id, url FROM pages)") )
def q_url_normalize(spark, sf):
    return with_normalized_url(read_table(spark, sf, "pages", "page_id", "url"))


@register("url_normalize_articles", sql_with(d_norm_url("(SELECT ord, url FROM articles_v)"), articles=True))
def q_url_normalize_articles(spark, sf):
    return with_normalized_url(articles_v(spark, sf).select("ord", "url"))


@register("quality_score", sql_with(f"SELECT ord, {d_quality()} AS quality FROM articles_v", articles=True))
def q_quality_score(spark, sf):
    return articles_v(spark, sf).select("ord", quality_score().alias("quality"))


_cols = ", ".join(c for c in ARTICLE_COLS if c != "ord")


@register("url_dedup", sql_with(f"""
SELECT first_ord AS ord, {_cols} FROM (
  SELECT *, row_number() OVER (PARTITION BY norm_url ORDER BY {d_quality()} DESC, ord) AS rn,
         min(ord) OVER (PARTITION BY norm_url) AS first_ord
  FROM ({d_norm_url('articles_v')}) ) WHERE rn = 1""", articles=True))
def q_url_dedup(spark, sf):
    return dedup_by_url(articles_v(spark, sf))


from newsfunnel.operators.titledup import dedup_by_title, representatives, similar_pairs, strip_source_suffix  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from newsfunnel.functions.lineage import materialize  # noqa: E402
from newsfunnel.plans.fixtures import answers_v, fx_df, votes_v  # noqa: E402
from newsfunnel.plans.pipeline import article_funnel, dedup_and_filter  # noqa: E402


@register("title_strip_suffix", sql_with("""
SELECT ord, CASE WHEN strpos(title, ' - ') > 0
                  AND length(title) - (length(title) - strpos(reverse(title), reverse(' - ')) - 2) - 3 <= 40
            THEN substr(title, 1, length(title) - strpos(reverse(title), reverse(' - ')) - 2) ELSE title END AS stripped
FROM articles_v""", articles=True))
def q_title_strip_suffix(spark, sf):
    return articles_v(spark, sf).select("ord", strip_source_suffix("title").alias("stripped"))


_STRIPPED = """CASE WHEN strpos(title, ' - ') > 0
                  AND length(title) - (length(title) - strpos(reverse(title), reverse(' - ')) - 2) - 3 <= 40
            THEN substr(title, 1, length(title) - strpos(reverse(title), reverse(' - ')) - 2) ELSE title END"""


def _exact_title_sql(src: str) -> str:
    """Threshold 1: equal titles of a language; the best quality takes the first one's place."""
    return f"""SELECT first_ord AS ord, {_cols} FROM (
  SELECT *, row_number() OVER (PARTITION BY language, tkey ORDER BY {d_quality()} DESC, ord) AS rn,
         min(ord) OVER (PARTITION BY language, tkey) AS first_ord
  FROM (SELECT *, lower({d_strip(_STRIPPED)}) AS tkey FROM {src})) WHERE rn = 1"""


@register("title_dedup_exact", sql_with(_exact_title_sql("articles_v"), articles=True))
def q_title_dedup_exact(spark, sf):
    return dedup_by_title(articles_v(spark, sf), threshold=1.0)


@register("title_similar_pairs")
def q_title_similar_pairs(spark, sf):
    return similar_pairs(materialize(representatives(articles_v(spark, sf)), "title-reps"))


@register("title_dedup")
def q_title_dedup(spark, sf):
    return dedup_by_title(articles_v(spark, sf))


@register("dedup_and_filter")
def q_dedup_and_filter(spark, sf):
    return dedup_and_filter(articles_v(spark, sf), fx_df(spark, "terms_fx"), fx_df(spark, "patterns_fx"))


def article_pages(a):
    """Each article's text as a landed page."""
    body = F.replace(F.replace(F.col("full_text"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    return a.select("url", F.concat(F.lit("<html><body><nav>Home</nav><article>"), F.replace(body, F.lit("\n"), F.lit("<br>")),
                                    F.lit("</article></body></html>")).alias("html")).where(F.col("html").isNotNull())


@register("article_funnel")
def q_article_funnel(spark, sf):
    """The batch chain over the article refs, each with its text as a landed page."""
    a = articles_v(spark, sf)
    one = votes_v(spark, sf).where(F.col("voter") == "v1")
    return article_funnel(a.drop("full_text"), article_pages(a), fx_df(spark, "terms_fx"), fx_df(spark, "patterns_fx"), fx_df(spark, "gazetteer_fx"),
                          verdicts=one, answers=answers_v(spark, sf), max_articles=None)
