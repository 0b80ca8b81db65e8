"""Catalog entries: district tagging and verdicts."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsfunnel.operators import tagging as TG
from newsfunnel.operators import verdicts as VD
from newsfunnel.plans.catalog import register
from newsfunnel.plans.fixtures import (
    ANSWERS_V_SQL, GZ_LISTS_SQL, VOTES_V_SQL, answers_v, articles_v, fx_df, refs_v, sql_with, votes_v,
)
from newsfunnel.plans.oracle_sql import d_strip


def _batch_input(spark, sf):
    a = articles_v(spark, sf)
    a = TG.with_state_districts(a, fx_df(spark, "gazetteer_fx"), out="ds")
    k, ds = F.col("ord"), F.col("ds")
    batch = (F.when(k % 3 == 0, F.array().cast("array<string>"))
             .when(k % 3 == 1, F.array(F.element_at(ds, (1 + k % F.size(ds)).cast("int"))))
             .otherwise(ds))
    return a.withColumn("districts", batch)


@register("district_tag_batch", sql_with("""
SELECT ord, CASE WHEN batch IS NULL OR len(batch) = 0 THEN district WHEN len(batch) = 1 THEN batch[1]
  ELSE coalesce(list_filter(batch, lambda d: contains(lower(title), lower(d)))[1], district) END AS district
FROM (SELECT a.ord, a.title, a.district, CASE a.ord % 3 WHEN 0 THEN CAST([] AS VARCHAR[])
        WHEN 1 THEN [g.ds[1 + a.ord % len(g.ds)]] ELSE g.ds END AS batch
      FROM articles_v a LEFT JOIN g ON g.state = a.state)""", "gazetteer_fx", articles=True, ctes_after=GZ_LISTS_SQL))
def q_district_tag_batch(spark, sf):
    return TG.tag_from_batch(_batch_input(spark, sf)).select("ord", "district")


@register("district_tag_text", sql_with("""
SELECT a.ord, CASE WHEN a.district IS NOT NULL THEN a.district
  ELSE list_filter(coalesce(g.ds, CAST([] AS VARCHAR[])), lambda d: contains(
     CASE WHEN a.full_text IS NOT NULL AND a.full_text <> '' THEN lower(a.title) || ' ' || lower(a.full_text)
          ELSE lower(a.title) END, lower(d)))[1] END AS district
FROM articles_v a LEFT JOIN g ON g.state = a.state""", "gazetteer_fx", articles=True, ctes_after=GZ_LISTS_SQL))
def q_district_tag_text(spark, sf):
    return TG.tag_from_text(articles_v(spark, sf), fx_df(spark, "gazetteer_fx")).select("ord", "district")


_ANS = f"""regexp_replace(regexp_replace({d_strip('x.answer')}, '^"+|"+$', '', 'g'), '^''+|''+$', '', 'g')"""


@register("district_answer_resolve", sql_with(f"""
SELECT ord, CASE WHEN NOT eligible THEN district WHEN answer IS NULL OR lower(ans) = 'none' THEN NULL
  ELSE coalesce(list_filter(ds, lambda d: lower(d) = lower(ans))[1],
                list_filter(ds, lambda d: contains(lower(ans), lower(d)) OR contains(lower(d), lower(ans)))[1]) END AS district
FROM (SELECT a.ord, a.district, g.ds, x.answer, {_ANS} AS ans,
             (a.district IS NULL AND g.ds IS NOT NULL AND len(g.ds) > 0) AS eligible
      FROM articles_v a LEFT JOIN g ON g.state = a.state LEFT JOIN answers_v x ON x.ref_id = a.ord)""",
    "gazetteer_fx", articles=True, ctes_after=GZ_LISTS_SQL + ",\n" + ANSWERS_V_SQL))
def q_district_answer_resolve(spark, sf):
    return TG.tag_from_answers(articles_v(spark, sf), fx_df(spark, "gazetteer_fx"), answers_v(spark, sf)).select(
        "ord", "district")


@register("district_prompt", sql_with("""
SELECT a.ord, 'Which single district in ' || a.state || ' is this article PRIMARILY about?' || chr(10) || 'Districts: '
  || array_to_string(g.ds, ', ') || chr(10) || chr(10) || 'Title: ' || a.title || chr(10) || 'Text: '
  || substr(coalesce(a.full_text, ''), 1, 500) || chr(10) || chr(10) || 'Rules:' || chr(10)
  || '- Reply with ONLY the district name from the list above.' || chr(10)
  || '- If the article mentions multiple districts or is about the state as a whole, reply ONLY "None".' || chr(10)
  || '- If you cannot determine the district, reply ONLY "None".' AS prompt
FROM articles_v a JOIN g ON g.state = a.state WHERE a.district IS NULL""", "gazetteer_fx", articles=True,
    ctes_after=GZ_LISTS_SQL))
def q_district_prompt(spark, sf):
    a = TG.with_state_districts(articles_v(spark, sf), fx_df(spark, "gazetteer_fx"))
    return a.where(F.col("district").isNull() & F.col("state_districts").isNotNull()).select(
        "ord", TG.district_prompt().alias("prompt"))


def _d_prompt() -> str:
    t = "'" + VD.RELEVANCE_PROMPT.replace("'", "''") + "'"
    t = t.replace("\n", "' || chr(10) || '")
    for k, v in [("{state}", "coalesce(nullif(state, ''), '(unknown)')"),
                 ("{district}", "coalesce(nullif(district, ''), '(not specified)')"),
                 ("{title}", "title"),
                 ("{text_preview}", f"coalesce(nullif(CASE WHEN full_text IS NOT NULL AND full_text <> '' "
                                    f"THEN {d_strip('substr(full_text, 1, 500)')} ELSE '' END, ''), '(no text)')")]:
        t = f"replace({t}, '{k}', {v})"
    return t


@register("relevance_prompt", sql_with(f"SELECT ord, {_d_prompt()} AS prompt FROM articles_v", articles=True))
def q_relevance_prompt(spark, sf):
    return articles_v(spark, sf).select("ord", VD.relevance_prompt().alias("prompt"))


_VERDICT = f"coalesce(starts_with(lower({d_strip('response')}), 'yes'), true)"


@register("verdict_parse", sql_with(f"SELECT ref_id, voter, {_VERDICT} AS verdict FROM votes_v", articles=True,
                                    ctes_after=VOTES_V_SQL))
def q_verdict_parse(spark, sf):
    return votes_v(spark, sf).select("ref_id", "voter", VD.parse_verdict("response").alias("verdict"))


@register("verdict_filter", sql_with(f"""
SELECT r.ord, r.title, r.state FROM articles_v r LEFT JOIN (SELECT * FROM votes_v WHERE voter = 'v1') v ON v.ref_id = r.ord
WHERE {_VERDICT}""", articles=True, ctes_after=VOTES_V_SQL))
def q_verdict_filter(spark, sf):
    v = votes_v(spark, sf).where(F.col("voter") == "v1")
    return VD.filter_by_verdict(refs_v(spark, sf), v).select("ord", "title", "state")


@register("majority_vote", sql_with(f"""
SELECT r.ord, r.title, n.n AS n_voters, n.n - coalesce(x.no, 0) AS yes_votes
FROM articles_v r CROSS JOIN (SELECT count(*) AS n FROM voters_fx WHERE has_key) n
LEFT JOIN (SELECT v.ref_id, count(DISTINCT v.voter) AS no FROM votes_v v JOIN voters_fx k ON k.voter = v.voter AND k.has_key
           WHERE NOT {_VERDICT} GROUP BY v.ref_id) x ON x.ref_id = r.ord
WHERE (n.n - coalesce(x.no, 0)) > n.n / 2.0""", "voters_fx", articles=True, ctes_after=VOTES_V_SQL))
def q_majority_vote(spark, sf):
    return VD.majority_vote(refs_v(spark, sf), votes_v(spark, sf), fx_df(spark, "voters_fx")).select(
        "ord", "title", "n_voters", "yes_votes")
