"""Catalog entries: the composed funnels at threshold 1, where SQL can say them, their stage counts, and scorers."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsfunnel.operators import scorers as SC
from newsfunnel.operators.extract import OUT_OF_REGION_PLACES
from newsfunnel.plans.cat_dedup import _exact_title_sql, article_pages
from newsfunnel.plans.cat_extract import _BP, _d_oor, _sq, d_clean
from newsfunnel.plans.cat_filters import _SCORE_SQL, _excl
from newsfunnel.plans.cat_tagging import _ANS, _VERDICT
from newsfunnel.plans.catalog import register
from newsfunnel.plans.fixtures import (
    ANSWERS_V_SQL, ARTICLE_COLS, GZ_LISTS_SQL, VOTES_V_SQL, answers_v, articles_v, fx_df, refs_v, sql_with, votes_v,
)
from newsfunnel.plans.oracle_sql import d_norm_url, d_quality, d_strip
from newsfunnel.plans.pipeline import StageCounts, article_funnel, dedup_and_filter

_COLS = ", ".join(c for c in ARTICLE_COLS if c != "ord")
_LAST = f"SELECT {', '.join(ARTICLE_COLS)}, relevance_score FROM scored WHERE NOT (relevance_score < 0.05 AND ({_excl}))"


def _dedup_ctes(src: str) -> str:
    return f"""with_text AS (SELECT * FROM {src} WHERE full_text IS NOT NULL AND length({d_strip('full_text')}) > 0),
by_url AS (SELECT first_ord AS ord, {_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY norm_url ORDER BY {d_quality()} DESC, ord) AS rn, min(ord) OVER (PARTITION BY norm_url) AS first_ord
  FROM ({d_norm_url('with_text')})) WHERE rn = 1),
by_title AS ({_exact_title_sql('by_url')}),
{_SCORE_SQL.replace('FROM articles_v', 'FROM by_title')}"""


@register("dedup_and_filter_exact", sql_with(_LAST, "terms_fx", articles=True, ctes_after=_dedup_ctes("articles_v")))
def q_dedup_and_filter_exact(spark, sf):
    """The funnel's last part at threshold 1 (equal titles only)."""
    return dedup_and_filter(articles_v(spark, sf), fx_df(spark, "terms_fx"), fx_df(spark, "patterns_fx"), threshold=1.0)


# lines of the text as a page shows them: blanks folded, empty lines gone
_SHOWN = ("nullif(array_to_string(list_filter(list_transform(string_split(full_text, chr(10)), lambda x: trim(regexp_replace(x, "
          "'[ \\t\\x{0b}\\f\\r\\x{1c}-\\x{1f}\\x{85}\\p{Z}]+', ' ', 'g'))), lambda x: x <> ''), chr(10)), '')")
_OOR = _sq(_d_oor(OUT_OF_REGION_PLACES))

_FUNNEL = f"""
{GZ_LISTS_SQL}, {ANSWERS_V_SQL}, {VOTES_V_SQL},
relevant AS (SELECT a.* FROM articles_v a LEFT JOIN (SELECT * FROM votes_v WHERE voter = 'v1') v ON v.ref_id = a.ord WHERE {_VERDICT}),
cleaned AS (SELECT *, {d_clean('shown')} AS cl FROM (SELECT *, {_SHOWN} AS shown FROM relevant)),
checked AS (SELECT *, CASE WHEN length({d_strip('cl')}) >= 100 AND NOT (length({d_strip('cl')}) < 500 AND ({_BP.replace('raw', 'cl')})) THEN cl END AS ok FROM cleaned),
extracted AS (SELECT * REPLACE (CASE WHEN ok IS NOT NULL AND NOT regexp_matches(title || ' ' || substr(ok, 1, 1500), {_OOR}) THEN ok END AS full_text) FROM checked),
tagged AS (SELECT a.* REPLACE (CASE WHEN a.district IS NOT NULL THEN a.district
    ELSE list_filter(coalesce(g.ds, CAST([] AS VARCHAR[])), lambda d: contains(
      CASE WHEN a.full_text IS NOT NULL AND a.full_text <> '' THEN lower(a.title) || ' ' || lower(a.full_text) ELSE lower(a.title) END, lower(d)))[1] END AS district), g.ds
  FROM extracted a LEFT JOIN g ON g.state = a.state),
answered AS (SELECT * REPLACE (CASE WHEN district IS NOT NULL OR ds IS NULL OR len(ds) = 0 THEN district WHEN answer IS NULL OR lower(ans) = 'none' THEN NULL
    ELSE coalesce(list_filter(ds, lambda d: lower(d) = lower(ans))[1],
                  list_filter(ds, lambda d: contains(lower(ans), lower(d)) OR contains(lower(d), lower(ans)))[1]) END AS district)
  FROM (SELECT t.*, x.answer, {_ANS} AS ans FROM tagged t LEFT JOIN answers_v x ON x.ref_id = t.ord)),
{_dedup_ctes('answered')}"""


def _funnel(spark, sf, threshold, **how):
    a = articles_v(spark, sf)
    one = votes_v(spark, sf).where(F.col("voter") == "v1")
    return article_funnel(a.drop("full_text"), article_pages(a), fx_df(spark, "terms_fx"), fx_df(spark, "patterns_fx"), fx_df(spark, "gazetteer_fx"),
                          verdicts=one, answers=answers_v(spark, sf), threshold=threshold, **how)


@register("article_funnel_exact", sql_with(_LAST, "terms_fx", "gazetteer_fx", articles=True, ctes_after=_FUNNEL))
def q_article_funnel_exact(spark, sf):
    """The whole batch chain at title threshold 1."""
    return _funnel(spark, sf, 1.0)


def _stage(k: int, name: str, src: str) -> str:
    return f"SELECT {k} AS place, '{name}' AS stage, count(*) AS n_rows, count(full_text) AS with_text FROM {src}"


@register("funnel_stage_counts", sql_with(
    " UNION ALL ".join([*(_stage(k, n, s).replace("count(full_text)", "0") for k, n, s in ((0, "refs", "articles_v"), (1, "selected", "articles_v"), (2, "relevant", "relevant"))),
                        *(_stage(k, n, s) for k, n, s in ((3, "extracted", "extracted"), (4, "text", "with_text"), (5, "url", "by_url"), (6, "title", "by_title"))),
                        _stage(7, "kept", f"({_LAST})")]),
    "terms_fx", "gazetteer_fx", articles=True, ctes_after=_FUNNEL))
def q_funnel_stage_counts(spark, sf):
    """Rows of every stage of the funnel at threshold 1, observed while it runs."""
    counts = StageCounts()
    _funnel(spark, sf, 1.0, watch=counts).write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(counts.rows(), "place int, stage string, n_rows long, with_text long")


def _yes_scorer(system, prompts):
    """Stands for a model: refuses titles with an 'e' before the first 'a'."""
    titles = [p.split("Title: ", 1)[1].split("\n", 1)[0] for p in prompts]
    return ["No" if "e" in t.split("a", 1)[0] else " YES, it is" for t in titles]


@register("verdict_scorer", sql_with(
    "SELECT ord, title, state FROM articles_v WHERE NOT contains(string_split(string_split(title, chr(10))[1], 'a')[1], 'e')", articles=True))
def q_verdict_scorer(spark, sf):
    """R3 with a callable in place of a table of answers."""
    return SC.filter_refs(refs_v(spark, sf), _yes_scorer).select("ord", "title", "state")
