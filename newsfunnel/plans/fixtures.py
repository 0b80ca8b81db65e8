"""Fixtures: article-shaped views over the driver tables plus small dictionaries.

The three dictionary inputs of the funnel (geography, terms, exclusion
patterns) are parameters: callers pass DataFrames.  For tests and the query
catalog we define small dictionaries here, once, and render them both as Spark
DataFrames and as SQL ``VALUES`` for the DuckDB oracle.  The article rows
themselves always come from the driver tables, so the work grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsfunnel.sources.dims import CATEGORIES
from newsfunnel.sources.tables import read_table

# Term dictionary fixture: (language, category, terms in priority order).
# Tokens are frequent in the driver prose; 'when' sits in two categories and
# 'the of' is a multi-word term.
TERMS = [
    ("en", "weather", ["pathetic", "when"]),
    ("en", "health", ["lywh", "the of"]),
    ("en", "water", ["inha"]),
    ("en", "governance", ["hant"]),
    ("en", "temperature", ["ouwh", "when"]),
    ("fr", "weather", ["éeau"]),
    ("fr", "health", ["ouque"]),
    ("fr", "temperature", ["ment"]),
    ("de", "weather", ["einst"]),
    ("de", "health", ["unglich"]),
    ("es", "weather", ["osci"]),
    ("es", "health", ["mente"]),
    ("es", "governance", ["ción"]),
]

# Exclusion patterns (Python regex syntax, matched case-insensitively).
PATTERNS = ["ansh", "inha", r"\bedti\b"]

# Out-of-region place list for the geo check (one ends in '.').
PLACES = ["edti", "ble.", "is the"]

# Gazetteer: districts per state, in list order.
GAZETTEER = {
    "AFRICA": ["ering", "ther", "Nalanda East", "NATION_0"],
    "AMERICA": ["edti", "anth", "ering", "Port Hant"],
    "ASIA": ["hant", "ntly", "Old Town", "Lower Inha", "ther"],
    "EUROPE": ["sch", "ver", "ment", "Einst Nord"],
    "MIDDLE EAST": ["osci", "ción", "mente", "Gran Osci", "ther"],
}

# Region attributes keyed by r_regionkey: (type, languages).
REGION_ATTRS = {
    0: ("state", ["fr", "en"]),
    1: ("state", ["en"]),
    2: ("state", ["gu", "en"]),
    3: ("ut", ["de", "en"]),
    4: ("ut", ["es", "hi", "en"]),
}

# Voters for the consensus fixture: (voter, has_key).
VOTERS = [("v1", True), ("v2", True), ("v3", True), ("v4", False)]

# Sources: name -> (rank, query char limit, per-run cap or None, languages or None)
SOURCES = {
    "google": (0, 2000, None, None),
    "newsdata": (1, 512, 200, None),
    "gnews": (2, 200, 100, ["en", "hi", "bn", "ta", "te", "mr", "ml", "pa"]),
}


# ---------------------------------------------------------------- dictionaries
def terms_rows() -> list[tuple]:
    rows = []
    cat_pos: dict[str, int] = {}
    for lang, cat, terms in TERMS:
        cat_ord = cat_pos.setdefault(lang + "/" + cat, sum(1 for k in cat_pos if k.startswith(lang + "/")))
        for i, t in enumerate(terms):
            rows.append((lang, cat, cat_ord, t, i))
    return rows


def gazetteer_rows() -> list[tuple]:
    return [(s, d, i) for s, ds in GAZETTEER.items() for i, d in enumerate(ds)]


FX_SCHEMAS = {
    "terms_fx": "lang string, category string, cat_ord int, term string, term_ord int",
    "patterns_fx": "pattern string",
    "places_fx": "place string",
    "gazetteer_fx": "state string, district string, district_ord int",
    "voters_fx": "voter string, has_key boolean",
}


def fx_rows(name: str) -> list[tuple]:
    return {
        "terms_fx": terms_rows,
        "patterns_fx": lambda: [(p,) for p in PATTERNS],
        "places_fx": lambda: [(p,) for p in PLACES],
        "gazetteer_fx": gazetteer_rows,
        "voters_fx": lambda: list(VOTERS),
    }[name]()


def fx_df(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame(fx_rows(name), FX_SCHEMAS[name])


def _sql_lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("'", "''") + "'"


def fx_sql(name: str) -> str:
    """``name(cols) AS (VALUES ...)`` CTE text for the DuckDB oracle."""
    cols = [c.strip().split()[0] for c in FX_SCHEMAS[name].split(",")]
    rows = ", ".join("(" + ", ".join(_sql_lit(v) for v in r) + ")" for r in fx_rows(name))
    return f"{name}({', '.join(cols)}) AS (VALUES {rows})"


# ---------------------------------------------------------------- article views
ARTICLES_V_SQL = """
SELECT d.doc_id AS ord,
  split_part(d.text,'.',1) || CASE WHEN d.doc_id%4=0 THEN ' - ' || d.source ELSE '' END AS title,
  CASE d.doc_id%3 WHEN 0 THEN 'https://www.' WHEN 1 THEN 'HTTPS://' ELSE 'https://' END || 'News.example.com/a/'
    || CAST(CAST(floor(d.doc_id/3) AS BIGINT) AS STRING)
    || CASE d.doc_id%3 WHEN 0 THEN '/?utm_source=feed&b=2&a=1' WHEN 1 THEN '?a=1&b=2#top' ELSE '?b=2&a=1&REF=z' END AS url,
  CASE WHEN d.doc_id%10=0 THEN 'Unknown' ELSE d.source END AS source,
  e.ts AS date, d.lang AS language, r.r_name AS state,
  CASE WHEN d.doc_id%7=0 THEN n.n_name END AS district,
  '"heat" ' || r.r_name AS search_term,
  CASE WHEN d.doc_id%11=0 THEN NULL WHEN d.doc_id%13=0 THEN '  ' ELSE d.text END AS full_text
FROM documents d JOIN events e ON e.event_id=d.doc_id
JOIN nation n ON n.n_nationkey=d.doc_id%25 JOIN region r ON r.r_regionkey=n.n_regionkey
"""

ARTICLE_COLS = ["ord", "title", "url", "source", "date", "language", "state", "district",
                "search_term", "full_text"]


def articles_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article rows derived from documents x events x nation x region."""
    d = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    e = read_table(spark, sf_dir, "events", "event_id", "ts")
    n = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    k = F.col("doc_id")
    m3 = k % 3
    title = F.concat(
        F.split_part(F.col("text"), F.lit("."), F.lit(1)),
        F.when(k % 4 == 0, F.concat(F.lit(" - "), F.col("source"))).otherwise(F.lit("")),
    )
    url = F.concat(
        F.when(m3 == 0, F.lit("https://www.")).when(m3 == 1, F.lit("HTTPS://")).otherwise(F.lit("https://")),
        F.lit("News.example.com/a/"),
        F.floor(k / 3).cast("bigint").cast("string"),
        F.when(m3 == 0, F.lit("/?utm_source=feed&b=2&a=1")).when(m3 == 1, F.lit("?a=1&b=2#top"))
        .otherwise(F.lit("?b=2&a=1&REF=z")),
    )
    # what is taken from a document is computed before the joins: a query that needs no text moves none
    d = d.select(
        k.alias("ord"),
        title.alias("title"),
        url.alias("url"),
        F.when(k % 10 == 0, F.lit("Unknown")).otherwise(F.col("source")).alias("source"),
        F.col("lang").alias("language"),
        F.when(k % 11 == 0, F.lit(None).cast("string")).when(k % 13 == 0, F.lit("  "))
        .otherwise(F.col("text")).alias("full_text"),
    )
    # dimension tables are fixed-size (25 nations, 5 regions): broadcast is bounded
    geo = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")
    return (
        d.join(e, e.event_id == d.ord)
        .join(F.broadcast(geo), geo.n_nationkey == F.col("ord") % 25)
        .select(
            "ord",
            "title",
            "url",
            "source",
            F.col("ts").alias("date"),
            "language",
            F.col("r_name").alias("state"),
            F.when(F.col("ord") % 7 == 0, F.col("n_name")).alias("district"),
            F.concat(F.lit('"heat" '), F.col("r_name")).alias("search_term"),
            "full_text",
        )
    )


# ---------------------------------------------------------------- term dictionary from the documents
TOP_TERMS = 40  # terms a language's dictionary has: four in each category
TERMS_V_SQL = f"""terms_v AS (
  SELECT lang, {'list_value(' + ", ".join(f"'{c}'" for c in CATEGORIES) + ')'}[k % 10 + 1] AS category, CAST(k % 10 AS INTEGER) AS cat_ord,
         term, CAST(k // 10 AS INTEGER) AS term_ord
  FROM (SELECT lang, term, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, term) - 1 AS k
        FROM (SELECT lang, unnest(string_split_regex(lower(text), '[^\\p{{L}}]+')) AS term FROM documents)
        WHERE length(term) >= 3 GROUP BY lang, term)
  WHERE k < {TOP_TERMS} AND (lang <> 'es' OR k % 10 < 7))"""


def terms_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent words of each language, dealt over the categories by rank; the
    Spanish dictionary lacks the last three."""
    d = read_table(spark, sf_dir, "documents", "lang", "text")
    words = d.select("lang", F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("term")).where(F.length("term") >= 3)
    w = Window.partitionBy("lang").orderBy(F.col("n").desc(), "term")
    ranked = (words.groupBy("lang", "term").agg(F.count("*").alias("n")).withColumn("k", F.row_number().over(w) - 1)
              .where(F.col("k") < TOP_TERMS))
    return ranked.where((F.col("lang") != "es") | (F.col("k") % 10 < 7)).select(
        "lang", F.element_at(F.array(*map(F.lit, CATEGORIES)), F.col("k") % 10 + 1).alias("category"),
        (F.col("k") % 10).cast("int").alias("cat_ord"), "term", F.floor(F.col("k") / 10).cast("int").alias("term_ord"))


def refs_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    return articles_v(spark, sf_dir).drop("full_text")


def sql_with(body: str, *fixtures: str, articles: bool = False, ctes_after: str = "",
             ctes_before: list[str] | None = None) -> str:
    """Prefix an oracle query with the fixture CTEs it uses (plus extra CTEs)."""
    ctes = list(ctes_before or [])
    if articles:
        ctes.append(f"articles_v AS ({ARTICLES_V_SQL})")
    ctes.extend(fx_sql(f) for f in fixtures)
    if ctes_after:
        ctes.append(ctes_after)
    return ("WITH " + ",\n".join(ctes) + "\n" + body) if ctes else body


# ---------------------------------------------------------------- regions
def regions_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions from the driver ``region`` table plus fixture type/languages."""
    r = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    attrs = spark.createDataFrame(
        [(k, t, ",".join(ls)) for k, (t, ls) in REGION_ATTRS.items()],
        "r_regionkey int, type string, langs string",
    )
    return r.join(F.broadcast(attrs), "r_regionkey").select(
        F.col("r_regionkey").alias("region_ord"),
        F.col("r_name").alias("name"),
        F.replace(F.lower(F.col("r_name")), F.lit(" "), F.lit("-")).alias("slug"),
        "type",
        F.split(F.col("langs"), ",").alias("languages"),
    )


REGIONS_FX_SQL = (
    "regions_fx AS (SELECT r.r_regionkey AS region_ord, r.r_name AS name, "
    "replace(lower(r.r_name), ' ', '-') AS slug, a.type, string_split(a.langs, ',') AS languages "
    "FROM region r JOIN (VALUES "
    + ", ".join(f"({k}, '{t}', '{','.join(ls)}')" for k, (t, ls) in REGION_ATTRS.items())
    + ") a(r_regionkey, type, langs) ON a.r_regionkey = r.r_regionkey)"
)


# ---------------------------------------------------------------- cleaning input
def cleaning_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents text decorated by doc_id with the leakage the cleaner removes."""
    d = read_table(spark, sf_dir, "documents", "doc_id", "text", "source")
    k, t, s, nl = F.col("doc_id"), F.col("text"), F.col("source"), F.lit("\n")
    m = k % 7
    first = F.split_part(t, nl, F.lit(1))
    raw = (
        F.when(m == 0, F.concat(F.lit("- Home\n- News\n - "), s, nl, t))
        .when(m == 1, F.concat(t, F.lit("\nAlso Read: "), s, F.lit("\n\nREAD ALSO - more\n"), first))
        .when(m == 2, F.concat(F.lit("ये भी पढ़ें: "), s, nl, t, F.lit("\nDownload the app for more\n  Get the App now")))
        .when(m == 3, F.concat(t, F.lit("\n\n\nRelated News\none\ntwo\n")))
        .when(m == 4, F.concat(t, F.lit("\n© 2024 "), s, F.lit(" media\nrest")))
        .when(m == 5, F.concat(F.replace(t, nl, F.lit("\n\n")), F.lit("\n\n  "), F.lower(first), F.lit("\n\n\n\n")))
        .otherwise(F.concat(t, F.lit("\nall rights reserved")))
    )
    return d.select(k.alias("doc_id"), raw.alias("raw"))


CLEANING_V_SQL = """cleaning_v AS (SELECT doc_id, CASE doc_id % 7
  WHEN 0 THEN '- Home' || chr(10) || '- News' || chr(10) || ' - ' || source || chr(10) || text
  WHEN 1 THEN text || chr(10) || 'Also Read: ' || source || chr(10) || chr(10) || 'READ ALSO - more' || chr(10) || split_part(text, chr(10), 1)
  WHEN 2 THEN 'ये भी पढ़ें: ' || source || chr(10) || text || chr(10) || 'Download the app for more' || chr(10) || '  Get the App now'
  WHEN 3 THEN text || chr(10) || chr(10) || chr(10) || 'Related News' || chr(10) || 'one' || chr(10) || 'two' || chr(10)
  WHEN 4 THEN text || chr(10) || '© 2024 ' || source || ' media' || chr(10) || 'rest'
  WHEN 5 THEN replace(text, chr(10), chr(10) || chr(10)) || chr(10) || chr(10) || '  ' || lower(split_part(text, chr(10), 1)) || chr(10) || chr(10) || chr(10) || chr(10)
  ELSE text || chr(10) || 'all rights reserved' END AS raw FROM documents)"""


# ---------------------------------------------------------------- votes / answers
# response by (ord*7 + voter_idx*3) % 6; a vote is missing when (ord + voter_idx) % 5 = 0
VOTE_RESPONSES = ["Yes", " yes, relevant", "No", None, "NO.", "maybe"]
ANSWERS = ["None", ' "Ering" ', "'edti'", "", "xyz", "nation", "ther", "Port Hant district", "  none  "]


def votes_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = articles_v(spark, sf_dir).select("ord")
    voters = F.array(*[F.struct(F.lit(v).alias("voter"), F.lit(i).alias("vi")) for i, (v, _) in enumerate(VOTERS)])
    x = a.select("ord", F.explode(voters).alias("v")).select(F.col("ord").alias("ref_id"), "v.voter", "v.vi")
    m = (F.col("ref_id") * 7 + F.col("vi") * 3) % 6
    resp = F.lit(None).cast("string")
    for i in reversed(range(len(VOTE_RESPONSES))):
        resp = F.when(m == i, F.lit(VOTE_RESPONSES[i]).cast("string")).otherwise(resp)
    return x.where((F.col("ref_id") + F.col("vi")) % 5 != 0).select("ref_id", "voter", resp.alias("response"))


def _sql_case(expr: str, values: list) -> str:
    return "CASE " + expr + " " + " ".join(f"WHEN {i} THEN {_sql_lit(v)}" for i, v in enumerate(values)) + " END"


VOTES_V_SQL = ("votes_v AS (SELECT a.ord AS ref_id, v.voter, "
               + _sql_case("(a.ord * 7 + v.vi * 3) % 6", VOTE_RESPONSES) + " AS response "
               "FROM articles_v a JOIN (VALUES " + ", ".join(f"('{v}', {i})" for i, (v, _) in enumerate(VOTERS))
               + ") v(voter, vi) ON (a.ord + v.vi) % 5 <> 0)")


def answers_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = articles_v(spark, sf_dir).select("ord").where(F.col("ord") % 4 != 3)
    m = F.col("ord") % len(ANSWERS)
    ans = F.lit(None).cast("string")
    for i in reversed(range(len(ANSWERS))):
        ans = F.when(m == i, F.lit(ANSWERS[i])).otherwise(ans)
    return a.select(F.col("ord").alias("ref_id"), ans.alias("answer"))


ANSWERS_V_SQL = ("answers_v AS (SELECT ord AS ref_id, " + _sql_case(f"ord % {len(ANSWERS)}", ANSWERS)
                 + " AS answer FROM articles_v WHERE ord % 4 <> 3)")

GZ_LISTS_SQL = "g AS (SELECT state, list(district ORDER BY district_ord) AS ds FROM gazetteer_fx GROUP BY state)"


# ---------------------------------------------------------------- landed feeds
FEED_LANG = {"en": "en", "fr": "hi", "de": "ta"}  # anything else -> 'xx' (fails validation)


def _feed_ctx() -> list:
    lang = F.col("language")
    mapped = F.lit("xx")
    for k, v in FEED_LANG.items():
        mapped = F.when(lang == k, F.lit(v)).otherwise(mapped)
    return [F.col("ord"), mapped.alias("language"), F.col("state"), F.col("search_term")]


def _xml_escape(c):
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def rss_feed_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One RSS ``<item>`` per article row; fields blanked by ``ord``."""
    a = articles_v(spark, sf_dir)
    k = F.col("ord")
    src = F.when(k % 19 == 0, F.lit("FOX Weather")).when(k % 19 == 1, F.lit("fox weather")).otherwise(F.col("source"))
    title = F.when(k % 9 == 3, F.lit("")).otherwise(_xml_escape(F.col("title")))
    pub = F.when(k % 9 == 2, F.lit("")).otherwise(
        F.concat(F.lit("<pubDate>"), F.date_format("date", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT</pubDate>")))
    src_el = F.when(k % 9 == 1, F.lit("")).otherwise(
        F.concat(F.lit('<source url="https://pub.example">'), _xml_escape(src), F.lit("</source>")))
    payload = F.concat(F.lit("<item><title>"), title, F.lit("</title><link>"), _xml_escape(F.col("url")),
                       F.lit("</link>"), pub, src_el, F.lit("</item>"))
    return a.select(*_feed_ctx(), payload.alias("payload"))


def newsdata_feed_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NewsData payloads with two results each; status 'error' when ord % 17 = 0."""
    a = articles_v(spark, sf_dir)
    k = F.col("ord")
    pub = F.when(k % 13 == 5, F.lit("bad date")).otherwise(F.date_format("date", "yyyy-MM-dd HH:mm:ss"))
    item1 = F.struct(
        F.concat(F.lit(" "), F.col("title"), F.lit(" ")).alias("title"), F.col("url").alias("link"), pub.alias("pubDate"),
        F.when(k % 5 == 1, F.lit(None)).when(k % 5 == 2, F.lit("")).otherwise(F.col("source")).alias("source_name"),
        F.when(k % 5 == 2, F.lit(None)).otherwise(F.concat(F.lit("id-"), F.col("source"))).alias("source_id"))
    item2 = F.struct(
        F.when(k % 2 == 0, F.lit("  ")).otherwise(F.concat(F.col("title"), F.lit(" (b)"))).alias("title"),
        F.concat(F.col("url"), F.lit("&p=2")).alias("link"), pub.alias("pubDate"),
        F.lit(None).cast("string").alias("source_name"), F.lit("").alias("source_id"))
    payload = F.to_json(F.struct(F.when(k % 17 == 0, F.lit("error")).otherwise(F.lit("success")).alias("status"),
                                 F.array(item1, item2).alias("results")))
    return a.select(*_feed_ctx(), payload.alias("payload"))


def gnews_feed_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GNews payloads with one article each; source/name/date blanked by ord."""
    a = articles_v(spark, sf_dir)
    k = F.col("ord")
    pub = F.when(k % 11 == 3, F.lit(None).cast("string")).otherwise(F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    srcs = F.when(k % 11 == 1, F.lit(None)).otherwise(
        F.struct(F.when(k % 11 == 2, F.lit("")).otherwise(F.col("source")).alias("name")))
    art = F.struct(F.col("title").alias("title"), F.col("url").alias("url"), pub.alias("publishedAt"),
                   srcs.alias("source"))
    return a.select(*_feed_ctx(), F.to_json(F.struct(F.array(art).alias("articles"))).alias("payload"))


FEED_LANG_SQL = ("CASE language " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in FEED_LANG.items())
                 + " ELSE 'xx' END")
