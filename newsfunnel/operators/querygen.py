"""Search-query table generation (Q1-Q13): geography x languages x terms.

The query table is bounded by the dictionaries (regions x languages x
categories x district batches), not by the article data; it is generated as
ordinary DataFrame transforms keyed by region, so it partitions by region when
the geography grows.  All per-row list logic (OR-chains, the character-budget
prefix, the greedy district packing) runs in higher-order functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsfunnel.functions.bounded import checked_broadcast

# Categories used for queries, in query order.
QUERY_CATEGORIES = ["weather", "health", "temperature", "governance"]
# Languages the GNews source supports.
GNEWS_LANGUAGES = ["en", "hi", "bn", "ta", "te", "mr", "ml", "pa"]
# Query character limits per source.
CHAR_LIMITS = {"google": 2000, "newsdata": 512, "gnews": 200}
# Phrase-query categories and the fallback heat term.
PHRASE_CATEGORIES = ["weather", "health"]
DEFAULT_HEAT_TERM = "heatwave"
SOURCE_RANK = {"google": 0, "newsdata": 1, "gnews": 2}
# The 14 article languages (also the NewsData language set).
ARTICLE_LANGUAGES = ["en", "hi", "ta", "te", "bn", "mr", "gu", "kn", "ml", "or", "pa", "as", "ur", "ne"]
# Per-source language support (None = every language).
SOURCE_LANGUAGES = {"google": None, "newsdata": ARTICLE_LANGUAGES, "gnews": GNEWS_LANGUAGES}
# Per-run query caps per source (None = no cap).
SOURCE_CAPS = {"google": None, "newsdata": 200, "gnews": 100}

QUERY_COLS = ["phase", "source_hint", "region_ord", "lang_ord", "kind_ord", "level", "state", "state_slug",
              "language", "category", "query_string", "districts"]


def quote_if_multi_word(c: Column) -> Column:
    """Q2: wrap a term containing a space in double quotes."""
    return F.when(F.instr(c, " ") > 0, F.concat(F.lit('"'), c, F.lit('"'))).otherwise(c)


def query_languages(regions: DataFrame) -> DataFrame:
    """Q1: first non-English language then English; only English if none."""
    primary = F.get(F.filter(F.col("languages"), lambda x: x != "en"), 0)
    langs = F.array_compact(F.array(primary, F.lit("en")))
    return regions.select("region_ord", "name", "slug", F.posexplode(langs).alias("lang_ord", "lang"))


def term_lists(terms: DataFrame) -> DataFrame:
    """Per language: ordered terms per query category, core terms (query
    category order), all terms (dictionary order) and the heat term."""
    def ordered(cond: Column, *keys: str) -> Column:
        st = F.struct(*[F.col(k) for k in keys], F.col("term"))
        return F.transform(F.array_sort(F.collect_list(F.when(cond, st))), lambda x: x["term"])

    qcat = F.array_position(F.array(*[F.lit(c) for c in QUERY_CATEGORIES]), F.col("category")).cast("int")
    t = terms.withColumn("qcat", qcat)
    aggs = [ordered(F.col("category") == c, "term_ord").alias(f"t_{c}") for c in QUERY_CATEGORIES]
    aggs.append(ordered(F.col("qcat") > 0, "qcat", "term_ord").alias("core"))
    aggs.append(ordered(F.lit(True), "cat_ord", "term_ord").alias("all_terms"))
    return t.groupBy(F.col("lang").alias("tl_lang")).agg(*aggs)


def _attach_terms(q: DataFrame, terms: DataFrame, lang: Column) -> DataFrame:
    tl = checked_broadcast(term_lists(terms), payload=terms)
    return q.join(tl, lang == tl["tl_lang"], "left").drop("tl_lang")


def _rows(df: DataFrame, phase: int, source: str, level: str, category: Column, qs: Column, language: Column,
          kind: Column, districts: Column | None = None) -> DataFrame:
    return df.select(
        F.lit(phase).alias("phase"), F.lit(source).alias("source_hint"), "region_ord", "lang_ord",
        kind.cast("int").alias("kind_ord"), F.lit(level).alias("level"), F.col("name").alias("state"),
        F.col("slug").alias("state_slug"), language.alias("language"), category.cast("string").alias("category"),
        qs.alias("query_string"),
        (districts if districts is not None else F.array().cast("array<string>")).alias("districts"),
    )


def category_queries(regions: DataFrame, terms: DataFrame) -> DataFrame:
    """Q3: ``(t1 OR "t 2") Location`` per query category with terms (google)."""
    q = _attach_terms(query_languages(regions), terms, F.col("lang"))
    cats = F.posexplode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(f"t_{c}").alias("ts")) for c in QUERY_CATEGORIES]))
    x = q.select("*", cats.alias("cat_ord", "ct")).where(F.size(F.coalesce(F.col("ct.ts"), F.array())) > 0)
    qs = F.concat(F.lit("("), F.array_join(F.transform(F.col("ct.ts"), quote_if_multi_word), " OR "), F.lit(") "),
                  F.col("name"))
    return _rows(x, 1, "google", "state", F.col("ct.c"), qs, F.col("lang"), F.col("cat_ord"))


def phrase_queries(regions: DataFrame, terms: DataFrame) -> DataFrame:
    """Q4: ``"first term" Location`` for weather and health (google)."""
    q = _attach_terms(query_languages(regions), terms, F.col("lang"))
    ph = F.posexplode(F.array(*[F.struct(F.lit(f"{c}_phrase").alias("c"), F.get(F.col(f"t_{c}"), 0).alias("t"))
                                for c in PHRASE_CATEGORIES]))
    x = q.select("*", ph.alias("p_ord", "pt")).where(F.col("pt.t").isNotNull())
    qs = F.concat(F.lit('"'), F.col("pt.t"), F.lit('" '), F.col("name"))
    return _rows(x, 1, "google", "state", F.col("pt.c"), qs, F.col("lang"), F.col("p_ord") + len(QUERY_CATEGORIES))


def broad_query(terms: Column, location: Column, max_chars: int) -> Column:
    """Q5: priority prefix of quoted terms that fits the budget; if none fits,
    the first term unquoted and truncated to max(1, budget)."""
    budget = F.lit(max_chars) - (F.length(location) + F.lit(3))
    quoted = F.transform(terms, quote_if_multi_word)
    costs = F.transform(quoted, lambda t, i: F.length(t) + F.when(i > 0, F.lit(4)).otherwise(F.lit(0)))
    fits = F.filter(quoted, lambda t, i: F.aggregate(F.slice(costs, 1, i + 1), F.lit(0), lambda a, c: a + c) <= budget)
    fallback = F.array(F.substring(F.get(terms, 0), 1, F.greatest(F.lit(1), budget)))
    chosen = F.when(F.size(fits) > 0, fits).otherwise(fallback)
    return F.concat(F.lit("("), F.array_join(chosen, " OR "), F.lit(") "), location)


def broad_queries(regions: DataFrame, terms: DataFrame, source: str) -> DataFrame:
    """Q5/Q6: one broad query per region x query language for newsdata / gnews.

    GNews: a language it does not support falls back to English (which can
    yield two identical English rows for one region — the reference does)."""
    q = query_languages(regions)
    if source == "gnews":
        q = q.withColumn("qlang", F.when(F.col("lang").isin(GNEWS_LANGUAGES), F.col("lang")).otherwise(F.lit("en")))
    else:
        q = q.withColumn("qlang", F.col("lang"))
    q = _attach_terms(q, terms, F.col("qlang")).where(F.size(F.coalesce(F.col("core"), F.array())) > 0)
    qs = broad_query(F.col("core"), F.col("name"), CHAR_LIMITS[source])
    return _rows(q, 1, source, "state", F.lit(None), qs, F.col("qlang"), F.lit(0))


def state_queries(regions: DataFrame, terms: DataFrame, dedupe_keys: bool = False) -> DataFrame:
    """Phase-1 query table for all sources."""
    out = (category_queries(regions, terms).unionByName(phrase_queries(regions, terms))
           .unionByName(broad_queries(regions, terms, "newsdata")).unionByName(broad_queries(regions, terms, "gnews")))
    out = with_query_key(out)
    return out.dropDuplicates(["query_key"]) if dedupe_keys else out


def pack_districts(districts: Column, heat_term: Column, state: Column, max_chars: int) -> Column:
    """Q7: greedy packing of the ordered districts into batches (array of arrays).

    A batch is flushed when adding the next name would exceed the budget and
    the batch is non-empty; one over-long name is still emitted alone."""
    suffix = F.when(state != "", F.concat(F.lit(" "), state)).otherwise(F.lit(""))
    budget = F.lit(max_chars) - (F.length(heat_term) + F.lit(3) + F.length(suffix))
    init = F.struct(F.array().cast("array<array<string>>").alias("done"), F.array().cast("array<string>").alias("cur"),
                    F.lit(0).alias("used"))

    def step(acc, d):
        n = F.length(quote_if_multi_word(d))
        cost = n + F.when(F.size(acc["cur"]) > 0, F.lit(4)).otherwise(F.lit(0))
        flush = ((acc["used"] + cost) > budget) & (F.size(acc["cur"]) > 0)
        return F.when(flush, F.struct(F.concat(acc["done"], F.array(acc["cur"])).alias("done"),
                                      F.array(d).alias("cur"), n.alias("used"))).otherwise(
            F.struct(acc["done"].alias("done"), F.concat(acc["cur"], F.array(d)).alias("cur"),
                     (acc["used"] + cost).alias("used")))

    def finish(acc):
        return F.when(F.size(acc["cur"]) > 0, F.concat(acc["done"], F.array(acc["cur"]))).otherwise(acc["done"])

    return F.aggregate(districts, init, step, finish)


def batch_query(batch: Column, heat_term: Column, state: Column) -> Column:
    suffix = F.when(state != "", F.concat(F.lit(" "), state)).otherwise(F.lit(""))
    return F.concat(heat_term, F.lit(" ("), F.array_join(F.transform(batch, quote_if_multi_word), " OR "), F.lit(")"),
                    suffix)


def district_queries(regions: DataFrame, terms: DataFrame, gazetteer: DataFrame, source: str = "google",
                     max_chars: int | None = None) -> DataFrame:
    """Q7/Q8: district batches per region x query language; ``districts`` is the
    batch membership straight from the fold.  GNews skips unsupported languages."""
    from newsfunnel.operators.tagging import district_arrays

    limit = max_chars or CHAR_LIMITS[source]
    q = query_languages(regions)
    if source == "gnews":
        q = q.where(F.col("lang").isin(GNEWS_LANGUAGES))
    gz = checked_broadcast(district_arrays(gazetteer), payload=gazetteer)
    q = q.join(gz, q["name"] == gz["_gz_state"]).drop("_gz_state").where(F.size("districts") > 0)
    q = _attach_terms(q, terms, F.col("lang"))
    heat = F.coalesce(F.get(F.col("t_weather"), 0), F.get(F.col("all_terms"), 0), F.lit(DEFAULT_HEAT_TERM))
    q = q.withColumn("heat", heat).withColumn("batches", pack_districts(F.col("districts"), F.col("heat"), F.col("name"), limit))
    x = q.select("*", F.posexplode("batches").alias("batch_ord", "batch"))
    return _rows(x, 2, source, "district", F.lit(None), batch_query(F.col("batch"), F.col("heat"), F.col("name")),
                 F.col("lang"), F.col("batch_ord"), F.col("batch"))


def query_key(source: str = "source_hint", slug: str = "state_slug", lang: str = "language", level: str = "level",
              qs: str = "query_string") -> Column:
    """Q9: first 16 hex chars of SHA-256 over ``source|slug|language|level|query``."""
    return F.substring(F.sha2(F.concat_ws("|", F.col(source), F.col(slug), F.col(lang), F.col(level), F.col(qs)), 256), 1, 16)


def with_query_key(df: DataFrame) -> DataFrame:
    return df.withColumn("query_key", query_key())


def with_query_order(df: DataFrame) -> DataFrame:
    """Deterministic ``ord``: phase, source rank, region, language, kind.

    Numbered within each (phase, source), then shifted by the sizes of the
    groups before it; only those few sizes meet in one task."""
    rank = F.create_map(*[x for k, v in SOURCE_RANK.items() for x in (F.lit(k), F.lit(v))])[F.col("source_hint")]
    ranked = df.withColumn("_rank", rank)
    within = Window.partitionBy("phase", "_rank").orderBy("region_ord", "lang_ord", "kind_ord", "query_string")
    before = Window.orderBy("_p", "_r").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranked.groupBy(F.col("phase").alias("_p"), F.col("_rank").alias("_r")).agg(F.count("*").alias("_n"))
    offsets = sizes.select("_p", "_r", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    same = F.col("phase").eqNullSafe(F.col("_p")) & F.col("_rank").eqNullSafe(F.col("_r"))
    return (ranked.join(offsets, same).withColumn("ord", (F.col("_before") + F.row_number().over(within)).cast("int"))
            .drop("_rank", "_p", "_r", "_before"))


def pending_queries(queries: DataFrame, ledger: DataFrame) -> DataFrame:
    """Q10: queries whose key is not in the completed ledger."""
    return queries.join(ledger.select("query_key").distinct(), "query_key", "left_anti")


def updated_ledger(ledger: DataFrame, completed: DataFrame) -> DataFrame:
    """Q10: the next ledger version (set union of keys)."""
    return ledger.select("query_key").unionByName(completed.select("query_key")).distinct()


def active_region_queries(district_qs: DataFrame, phase1_results: DataFrame) -> DataFrame:
    """Q11: district queries only for states whose phase-1 queries returned
    at least one article (results: state_slug, n_articles)."""
    active = phase1_results.where(F.col("n_articles") > 0).select("state_slug").distinct()
    return district_qs.join(active, "state_slug", "left_semi")


def per_source_cap(queries: DataFrame, caps: dict[str, int | None], order: str = "ord") -> DataFrame:
    """Q12: the first N pending queries per source (None = no cap)."""
    cap_map = F.create_map(*[x for k, v in caps.items() if v is not None for x in (F.lit(k), F.lit(v))]) if any(
        v is not None for v in caps.values()) else None
    w = Window.partitionBy("source_hint").orderBy(order)
    cap = cap_map[F.col("source_hint")] if cap_map is not None else F.lit(None)
    return queries.withColumn("_rn", F.row_number().over(w)).where(cap.isNull() | (F.col("_rn") <= cap)).drop("_rn")


def supported_languages(queries: DataFrame, support: dict[str, list[str] | None]) -> DataFrame:
    """Q13: drop (source, language) pairs a source does not support (None = all)."""
    cond = F.lit(True)
    for src, langs in support.items():
        if langs is not None:
            cond = cond & ((F.col("source_hint") != src) | F.col("language").isin(langs))
    return queries.where(cond)
