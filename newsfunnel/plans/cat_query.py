"""Catalog entries: query-table generation (Q1-Q13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsfunnel.operators import querygen as QG
from newsfunnel.plans.catalog import register
from newsfunnel.plans.fixtures import ARTICLES_V_SQL, REGIONS_FX_SQL, fx_df, fx_sql, refs_v, regions_fx

_QCOLS = ", ".join(QG.QUERY_COLS)
_Q = "CASE WHEN contains(t, ' ') THEN '\"' || t || '\"' ELSE t END"
_CATS = ", ".join(f"('{c}', {i})" for i, c in enumerate(QG.QUERY_CATEGORIES))
_GN = "[" + ", ".join(f"'{x}'" for x in QG.GNEWS_LANGUAGES) + "]"

# Independent SQL for the whole query table (DuckDB).
QT_CTES = ",\n".join([
    REGIONS_FX_SQL,
    fx_sql("terms_fx"),
    fx_sql("gazetteer_fx"),
    f"cats(c, cat_ord) AS (VALUES {_CATS})",
    """ql AS (SELECT region_ord, name, slug, generate_subscripts(l, 1) - 1 AS lang_ord, unnest(l) AS lang FROM (
      SELECT *, list_filter([list_filter(languages, lambda x: x <> 'en')[1], 'en'], lambda x: x IS NOT NULL) AS l
      FROM regions_fx))""",
    "tl AS (SELECT lang, category, list(term ORDER BY term_ord) AS ts FROM terms_fx GROUP BY lang, category)",
    """core AS (SELECT t.lang, list(t.term ORDER BY c.cat_ord, t.term_ord) AS ts FROM terms_fx t
      JOIN cats c ON c.c = t.category GROUP BY t.lang)""",
    "allt AS (SELECT lang, list(term ORDER BY cat_ord, term_ord) AS ts FROM terms_fx GROUP BY lang)",
    f"""cat_q AS (SELECT 1 AS phase, 'google' AS source_hint, ql.region_ord, ql.lang_ord, cats.cat_ord AS kind_ord,
      'state' AS level, ql.name AS state, ql.slug AS state_slug, ql.lang AS language, cats.c AS category,
      '(' || array_to_string(list_transform(tl.ts, lambda t: {_Q}), ' OR ') || ') ' || ql.name AS query_string,
      CAST([] AS VARCHAR[]) AS districts
      FROM ql JOIN cats ON TRUE JOIN tl ON tl.lang = ql.lang AND tl.category = cats.c)""",
    """phr_q AS (SELECT 1 AS phase, 'google' AS source_hint, ql.region_ord, ql.lang_ord, 4 + p.k AS kind_ord,
      'state' AS level, ql.name AS state, ql.slug AS state_slug, ql.lang AS language, p.c || '_phrase' AS category,
      '"' || tl.ts[1] || '" ' || ql.name AS query_string, CAST([] AS VARCHAR[]) AS districts
      FROM ql JOIN (VALUES ('weather', 0), ('health', 1)) p(c, k) ON TRUE
      JOIN tl ON tl.lang = ql.lang AND tl.category = p.c)""",
    f"""bq AS (SELECT ql.*, s.src, s.lim, CASE WHEN s.src = 'gnews' AND NOT list_contains({_GN}, ql.lang) THEN 'en'
               ELSE ql.lang END AS qlang
      FROM ql JOIN (VALUES ('newsdata', 512), ('gnews', 200)) s(src, lim) ON TRUE)""",
    f"""bq2 AS (SELECT bq.*, list_transform(core.ts, lambda t: {_Q}) AS qt, core.ts AS raw,
               bq.lim - (length(bq.name) + 3) AS budget FROM bq JOIN core ON core.lang = bq.qlang)""",
    """broad_q AS (SELECT 1 AS phase, src AS source_hint, region_ord, lang_ord, 0 AS kind_ord, 'state' AS level,
      name AS state, slug AS state_slug, qlang AS language, CAST(NULL AS VARCHAR) AS category,
      '(' || CASE WHEN len(fit) > 0 THEN array_to_string(fit, ' OR ') ELSE substr(raw[1], 1, greatest(1, budget)) END
      || ') ' || name AS query_string, CAST([] AS VARCHAR[]) AS districts
      FROM (SELECT *, list_filter(qt, lambda t, i: list_sum(list_transform(list_slice(qt, 1, i),
               lambda u, j: length(u) + CASE WHEN j > 1 THEN 4 ELSE 0 END)) <= budget) AS fit FROM bq2))""",
    """state_q AS (SELECT *, substr(sha256(source_hint || '|' || state_slug || '|' || language || '|' || level || '|'
                    || query_string), 1, 16) AS query_key
      FROM (SELECT * FROM cat_q UNION ALL SELECT * FROM phr_q UNION ALL SELECT * FROM broad_q))""",
])


def _dist_ctes(source: str, limit: int) -> str:
    skip = f"AND list_contains({_GN}, ql.lang)" if source == "gnews" else ""
    return ",\n".join([
        f"""dq AS (SELECT ql.region_ord, ql.name, ql.slug, ql.lang_ord, ql.lang,
              coalesce(tl.ts[1], allt.ts[1], 'heatwave') AS heat
            FROM ql JOIN (SELECT DISTINCT state FROM gazetteer_fx) gs ON gs.state = ql.name {skip}
            LEFT JOIN tl ON tl.lang = ql.lang AND tl.category = 'weather' LEFT JOIN allt ON allt.lang = ql.lang)""",
        f"""dd AS (SELECT dq.*, g.district, g.district_ord + 1 AS i,
              length(CASE WHEN contains(g.district, ' ') THEN '"' || g.district || '"' ELSE g.district END) AS n,
              {limit} - (length(dq.heat) + 3 + CASE WHEN dq.name <> '' THEN length(dq.name) + 1 ELSE 0 END) AS budget
            FROM dq JOIN gazetteer_fx g ON g.state = dq.name)""",
        """fold AS (SELECT region_ord, lang_ord, i, 0 AS b, n AS used FROM dd WHERE i = 1
            UNION ALL
            SELECT f.region_ord, f.lang_ord, d.i,
                   CASE WHEN f.used + d.n + 4 > d.budget THEN f.b + 1 ELSE f.b END,
                   CASE WHEN f.used + d.n + 4 > d.budget THEN d.n ELSE f.used + d.n + 4 END
            FROM fold f JOIN dd d ON d.region_ord = f.region_ord AND d.lang_ord = f.lang_ord AND d.i = f.i + 1)""",
        f"""dist_q AS (SELECT 2 AS phase, '{source}' AS source_hint, dd.region_ord, dd.lang_ord, f.b AS kind_ord,
              'district' AS level, dd.name AS state, dd.slug AS state_slug, dd.lang AS language,
              CAST(NULL AS VARCHAR) AS category,
              dd.heat || ' (' || string_agg(CASE WHEN contains(dd.district, ' ') THEN '"' || dd.district || '"'
                 ELSE dd.district END, ' OR ' ORDER BY dd.i) || ')' || CASE WHEN dd.name <> '' THEN ' ' || dd.name ELSE '' END
                 AS query_string,
              list(dd.district ORDER BY dd.i) AS districts
            FROM dd JOIN fold f ON f.region_ord = dd.region_ord AND f.lang_ord = dd.lang_ord AND f.i = dd.i
            GROUP BY dd.region_ord, dd.lang_ord, f.b, dd.name, dd.slug, dd.lang, dd.heat)""",
    ])


def _with(body: str, extra: str = "") -> str:
    return "WITH RECURSIVE " + QT_CTES + (",\n" + extra if extra else "") + "\n" + body


def _dims(spark, sf):
    return regions_fx(spark, sf), fx_df(spark, "terms_fx")


@register("query_languages", _with("SELECT region_ord, name, slug, lang_ord, lang FROM ql"))
def q_query_languages(spark, sf):
    return QG.query_languages(regions_fx(spark, sf))


@register("category_queries", _with(f"SELECT {_QCOLS} FROM cat_q"))
def q_category_queries(spark, sf):
    return QG.category_queries(*_dims(spark, sf))


@register("phrase_queries", _with(f"SELECT {_QCOLS} FROM phr_q"))
def q_phrase_queries(spark, sf):
    return QG.phrase_queries(*_dims(spark, sf))


@register("broad_queries", _with(f"SELECT {_QCOLS} FROM broad_q WHERE source_hint = 'newsdata'"))
def q_broad_queries(spark, sf):
    return QG.broad_queries(*_dims(spark, sf), "newsdata")


@register("gnews_language_policy", _with(f"SELECT {_QCOLS} FROM broad_q WHERE source_hint = 'gnews'"))
def q_gnews_policy(spark, sf):
    return QG.broad_queries(*_dims(spark, sf), "gnews")


@register("query_key", _with("SELECT source_hint, state_slug, language, level, query_string, query_key FROM state_q"))
def q_query_key(spark, sf):
    return QG.state_queries(*_dims(spark, sf)).select("source_hint", "state_slug", "language", "level",
                                                      "query_string", "query_key")


for _src, _lim in [("google", 2000), ("newsdata", 512), ("gnews", 200), ("google", 40)]:
    _name = "district_batches" if (_src, _lim) == ("google", 2000) else f"district_batches_{_src}_{_lim}"

    def _mk(src=_src, lim=_lim):
        def q(spark, sf):
            r, t = _dims(spark, sf)
            return QG.district_queries(r, t, fx_df(spark, "gazetteer_fx"), src, lim)
        return q

    register(_name, _with(f"SELECT {_QCOLS} FROM dist_q", _dist_ctes(_src, _lim)))(_mk())


@register("resume_pending_queries", _with(
    "SELECT * EXCLUDE (query_key), query_key FROM state_q WHERE query_key NOT IN "
    "(SELECT query_key FROM state_q WHERE substr(query_key, 1, 1) < '5')"))
def q_resume(spark, sf):
    qs = QG.state_queries(*_dims(spark, sf))
    ledger = qs.where(F.substring("query_key", 1, 1) < "5").select("query_key")
    return QG.pending_queries(qs, ledger)


@register("ledger_update", _with(
    "SELECT DISTINCT query_key FROM state_q WHERE substr(query_key, 1, 1) < '5' OR source_hint = 'gnews'"))
def q_ledger_update(spark, sf):
    qs = QG.state_queries(*_dims(spark, sf))
    ledger = qs.where(F.substring("query_key", 1, 1) < "5").select("query_key")
    return QG.updated_ledger(ledger, qs.where(F.col("source_hint") == "gnews"))


_ACTIVE = """(SELECT replace(lower(state), ' ', '-') AS state_slug,
   count(*) FILTER (WHERE language = 'es' AND district IS NOT NULL) AS n_articles FROM articles_v GROUP BY 1)"""


@register("active_regions", "WITH RECURSIVE articles_v AS (" + ARTICLES_V_SQL + "),\n" + QT_CTES + ",\n"
          + _dist_ctes("google", 40)
          + f"\nSELECT {_QCOLS} FROM dist_q WHERE state_slug IN (SELECT state_slug FROM {_ACTIVE} WHERE n_articles > 0)")
def q_active_regions(spark, sf):
    r, t = _dims(spark, sf)
    dq = QG.district_queries(r, t, fx_df(spark, "gazetteer_fx"), "google", 40)
    refs = refs_v(spark, sf)
    res = refs.groupBy(F.replace(F.lower("state"), F.lit(" "), F.lit("-")).alias("state_slug")).agg(
        F.count_if((F.col("language") == "es") & F.col("district").isNotNull()).alias("n_articles"))
    return QG.active_region_queries(dq, res)


_CAPS = {"google": 5, "newsdata": 3, "gnews": None}


@register("per_source_cap", _with("""
SELECT source_hint, query_key, ord FROM (
  SELECT *, row_number() OVER (PARTITION BY source_hint ORDER BY ord) AS rn FROM (
    SELECT *, row_number() OVER (ORDER BY phase, CASE source_hint WHEN 'google' THEN 0 WHEN 'newsdata' THEN 1 ELSE 2 END,
                                 region_ord, lang_ord, kind_ord, query_string) AS ord FROM state_q))
WHERE (source_hint = 'google' AND rn <= 5) OR (source_hint = 'newsdata' AND rn <= 3) OR source_hint = 'gnews'"""))
def q_per_source_cap(spark, sf):
    qs = QG.with_query_order(QG.state_queries(*_dims(spark, sf)))
    return QG.per_source_cap(qs, _CAPS).select("source_hint", "query_key", "ord")


_SUP = " AND ".join(
    f"(source_hint <> '{s}' OR list_contains([{', '.join(repr(x) for x in ls)}], language))"
    for s, ls in QG.SOURCE_LANGUAGES.items() if ls is not None)


@register("source_language_support", _with(f"SELECT source_hint, language, query_key FROM state_q WHERE {_SUP}"))
def q_source_language_support(spark, sf):
    qs = QG.state_queries(*_dims(spark, sf))
    return QG.supported_languages(qs, QG.SOURCE_LANGUAGES).select("source_hint", "language", "query_key")
