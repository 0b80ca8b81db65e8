"""Catalog entries: extraction and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsfunnel.operators import extract as X
from newsfunnel.plans.catalog import register
from newsfunnel.plans.fixtures import PLACES, articles_v, sql_with
from newsfunnel.plans.oracle_sql import D_SPACE, D_NOT_WORD, d_strip
from newsfunnel.sources.tables import read_table


def _sq(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# The oracle's own tables: tags that end a line and the entities that the pages hold.
_LINE_TAGS = ("address|article|aside|blockquote|br|dd|div|dl|dt|figcaption|figure|footer|form|h[1-6]|header|hr|li|main|nav|ol|p|pre|section|"
              "table|tbody|td|th|thead|title|tr|ul")
_NAMED = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&nbsp;": " ", "&eacute;": "é", "&copy;": "©", "&euro;": "€", "&mdash;": "—"}


def d_drop(x: str, tags: str) -> str:
    for t in tags.split("|"):
        x = f"regexp_replace({x}, '(?is)<{t}\\b[^>]*>.*?</{t}\\s*>', '', 'g')"
    return x


def _cp_ok(e: str) -> str:
    return f"(({e}) > 0 AND ({e}) <= 1114111 AND NOT (({e}) BETWEEN 55296 AND 57343))"


def d_decode(x: str) -> str:
    dec = "TRY_CAST(regexp_extract(p, '^([0-9]{1,7});', 1) AS BIGINT)"
    hexv = "TRY_CAST('0x' || regexp_extract(p, '^[xX]([0-9A-Fa-f]{1,6});', 1) AS BIGINT)"
    num = (f"list_transform(string_split({x}, '&#')[2:], lambda p: CASE "
           f"WHEN regexp_matches(p, '^[0-9]{{1,7}};') AND {_cp_ok(dec)} "
           f"THEN chr({dec}::INTEGER) || regexp_replace(p, '^[0-9]{{1,7}};', '') "
           f"WHEN regexp_matches(p, '^[xX][0-9A-Fa-f]{{1,6}};') AND {_cp_ok(hexv)} "
           f"THEN chr({hexv}::INTEGER) || regexp_replace(p, '^[xX][0-9A-Fa-f]{{1,6}};', '') "
           f"ELSE '&#' || p END)")
    out = f"CASE WHEN strpos({x}, '&#') > 0 THEN string_split({x}, '&#')[1] || array_to_string({num}, '') ELSE {x} END"
    for ent, ch in [*_NAMED.items(), ("&amp;", "&")]:
        out = f"replace({out}, {_sq(ent)}, {_sq(ch)})"
    return out


def d_html_to_text(x: str) -> str:
    t = f"regexp_replace({x}, '(?i)</?(?:{_LINE_TAGS})\\b[^>]*>', chr(10), 'g')"
    t = f"regexp_replace({t}, '(?s)<[^>]*>', '', 'g')"
    t = d_decode(t)
    t = f"regexp_replace({t}, '[ \\t\\x{{0b}}\\f\\r\\x{{1c}}-\\x{{1f}}\\x{{85}}\\p{{Z}}]+', ' ', 'g')"
    t = f"regexp_replace({t}, ' *\\n *', chr(10), 'g')"
    t = f"regexp_replace({t}, '\\n{{2,}}', chr(10), 'g')"
    t = f"regexp_replace({t}, '^[ \\n]+|[ \\n]+$', '', 'g')"
    return f"nullif({t}, '')"


def d_noise(x: str) -> str:
    return d_drop(f"regexp_replace({x}, '(?s)<!--.*?-->', '', 'g')", "script|style|noscript|template|svg|head")


_PAGES_TEXT = f"""
SELECT page_id, coalesce(prec, rec) AS main_text FROM (
  SELECT page_id,
    {d_html_to_text(d_drop("CASE WHEN art <> '' THEN art ELSE mn END", "table|nav|aside|header|footer|form"))} AS prec,
    {d_html_to_text(d_drop("CASE WHEN body <> '' THEN body ELSE h END", "nav|aside|header|footer|form"))} AS rec
  FROM (
    SELECT page_id, h,
      array_to_string(regexp_extract_all(h, '(?is)<article\\b[^>]*>(.*?)</article\\s*>', 1), chr(10)) AS art,
      array_to_string(regexp_extract_all(h, '(?is)<main\\b[^>]*>(.*?)</main\\s*>', 1), chr(10)) AS mn,
      regexp_extract(h, '(?is)<body\\b[^>]*>(.*)</body\\s*>', 1) AS body
    FROM (SELECT page_id, {d_noise('html')} AS h FROM pages)))"""


@register("page_main_text", (_PAGES_TEXT))
def q_page_main_text(spark, sf):
    p = read_table(spark, sf, "pages", "page_id", "html")
    return p.select("page_id", X.main_text("html").alias("main_text"))


def _forms_v(spark, sf):
    """Pages of every awkward form around the documents' own lines: nested tables and navigation, two articles,
    two mains, containers that are never closed, each kind of character reference."""
    d = read_table(spark, sf, "documents", "doc_id", "text")
    k, t = F.col("doc_id"), F.coalesce(F.col("text"), F.lit(""))
    esc = F.replace(F.replace(t, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&#60;"))
    body = F.replace(esc, F.lit("\n"), F.lit("<br>"))
    tail = F.lit("&#38;lt;b &#x26;amp; caf&eacute; &#128;5 &copy 2024 &amp;quot;")
    junk = F.lit("<table><tr><td>x<table><tr><td>y</table>OUTER TAIL</table><nav>a<nav>b</nav>c</nav><!-- no --><script>if (a </b) '<p>';</script>")
    art = F.concat(F.lit("<article class='a'><p>"), body, F.lit("</p>"), junk, F.lit("</article>"))
    second = F.concat(F.lit("<article><div>"), tail, F.lit("</div></article>"))
    page = (F.when(k % 5 == 0, F.concat(art, F.lit("<p>between</p>"), second))
            .when(k % 5 == 1, F.concat(F.lit("<MAIN><p>"), body, F.lit("</p></MAIN><p>out</p><main>"), tail, F.lit("</main>")))
            .when(k % 5 == 2, F.concat(F.lit("<article><p>"), body, F.lit("</p><article>"), tail, F.lit("</article>"), junk))
            .when(k % 5 == 3, F.concat(F.lit("<nav>menu<nav>sub</nav>more</nav><div>"), body, F.lit("</div><aside>side</aside><p>"), tail, F.lit("</p><footer>f</footer>")))
            .otherwise(F.concat(F.lit("<article><header>h</header><form><input></form> </article><p>"), body, F.lit("<section>"), tail)))
    return d.select(k.alias("doc_id"), F.concat(F.lit("<html><head><title>t</title><style>p{}</style></head><body>"), page, F.lit("</body></html>")).alias("html"))


@register("page_main_text_forms", f"""
SELECT doc_id, nullif(array_to_string(list_filter(list_transform(string_split(coalesce(text, '') || chr(10)
    || '&lt;b &amp; café €5 © 2024 &quot;', chr(10)), lambda x: trim(regexp_replace(x, '[^\\S\\n]+|\\p{{Z}}+|[\\x{{0b}}\\x{{1c}}-\\x{{1f}}\\x{{85}}]+', ' ', 'g'))),
    lambda x: x <> ''), chr(10)), '') AS main_text FROM documents""")
def q_page_main_text_forms(spark, sf):
    return _forms_v(spark, sf).select("doc_id", X.main_text("html").alias("main_text"))


@register("page_title", (f"""
SELECT page_id, nullif({d_strip(f"regexp_replace({d_decode(chr(32).join(['regexp_replace(t,', repr('(?s)<[^>]*>'), ',', repr(''), ',', repr('g') + ')']))}, '{D_SPACE}+', ' ', 'g')")}, '') AS title
FROM (SELECT page_id, regexp_extract(html, '(?is)<title\\b[^>]*>(.*?)</title\\s*>', 1) AS t FROM pages)"""))
def q_page_title(spark, sf):
    p = read_table(spark, sf, "pages", "page_id", "html")
    return p.select("page_id", X.page_title("html").alias("title"))


from newsfunnel.plans.fixtures import CLEANING_V_SQL, cleaning_v  # noqa: E402

S = D_SPACE
_BREAD = f"(?m)^(?:{S}*-{S}+.{{1,50}}\\n){{2,}}"
_ALSO = (f"(?mi)^{S}*(?:Also{S}+Read|Read{S}+Also|ये{S}+भी{S}+पढ़ें|यह{S}+भी{S}+पढ़ें){S}*[:|\\-]?{S}*.*$")
_APP = f"(?mi)^{S}*(?:Download{S}+(?:the{S}+)?app|Get{S}+the{S}+app|ऐप{S}+डाउनलोड{S}+करें).*$"
_REC = (f"(?mi)(?:^.*(?:recommended|related{S}+(?:news|articles|stories)|संबंधित{S}+खबरें|સંબંધિત{S}+સમાચાર).*\\n)"
        f"(?:.+\\n?){{2,}}$")
_COPY = f"(?si)\\n{S}*(?:©{S}*\\p{{Nd}}{{4}}|copyright{S}*©|[a-z]+ name,? logo).*$"


def d_para_dedup(x: str) -> str:
    k = f"lower({d_strip('p')})"
    return (f"array_to_string(list_filter(string_split({x}, chr(10) || chr(10)), lambda p, i: {k} <> '' AND "
            f"list_position(list_transform(string_split({x}, chr(10) || chr(10)), lambda p: {k}), {k}) = i), "
            f"chr(10) || chr(10))")


def d_clean(x: str) -> str:
    t = x
    for rx in (_BREAD, _ALSO, _APP, _REC, _COPY):
        t = f"regexp_replace({t}, {_sq(rx)}, '', 'g')"
    t = f"regexp_replace({t}, '\\n{{3,}}', chr(10) || chr(10), 'g')"
    return d_strip(d_para_dedup(f"({t})"))


@register("clean_text", f"WITH {CLEANING_V_SQL} SELECT doc_id, {d_clean('raw')} AS cleaned FROM cleaning_v")
def q_clean_text(spark, sf):
    return cleaning_v(spark, sf).select("doc_id", X.clean_text("raw").alias("cleaned"))


@register("paragraph_dedup", f"SELECT doc_id, {d_para_dedup('(replace(text, chr(10), chr(10) || chr(10)))')} AS deduped "
                             "FROM documents")
def q_paragraph_dedup(spark, sf):
    d = read_table(spark, sf, "documents", "doc_id", "text")
    return d.select("doc_id", X.paragraph_dedup(F.replace(F.col("text"), F.lit("\n"), F.lit("\n\n"))).alias("deduped"))


@register("short_text_discard", f"SELECT doc_id, CASE WHEN length({d_strip('text')}) >= 100 THEN text END AS kept_text "
                                "FROM documents")
def q_short_text(spark, sf):
    d = read_table(spark, sf, "documents", "doc_id", "text")
    return d.select("doc_id", X.short_text_discard("text").alias("kept_text"))


_BP = " OR ".join(f"contains(lower(raw), {_sq(p)})" for p in X.BOILERPLATE_PHRASES)


@register("boilerplate_flag", f"WITH {CLEANING_V_SQL} SELECT doc_id, (length({d_strip('raw')}) < 500 AND ({_BP})) "
                              "AS is_boilerplate FROM cleaning_v")
def q_boilerplate(spark, sf):
    return cleaning_v(spark, sf).select("doc_id", X.is_boilerplate("raw").alias("is_boilerplate"))


def _d_oor(places: list[str]) -> str:
    import re as _re
    alts = []
    for p in places:
        lit = _re.sub(r"([.^$*+?(){}\[\]|\\])", r"\\\1", p)
        w = "[\\p{L}\\p{N}_]"
        left = f"(^|{D_NOT_WORD})" if _re.match(r"\w", p[0]) else f"({w})"
        right = f"({D_NOT_WORD}|$)" if _re.match(r"\w", p[-1]) else f"({w})"
        alts.append(left + lit + right)
    return "(?i)(" + "|".join(alts) + ")"


def _oor_sql(places):
    return sql_with(f"""SELECT ord, regexp_matches(CASE WHEN full_text IS NULL THEN title
        ELSE title || ' ' || substr(full_text, 1, 1500) END, {_sq(_d_oor(places))}) AS out_of_region FROM articles_v""",
                    articles=True)


@register("out_of_region_flag", _oor_sql(PLACES))
def q_out_of_region(spark, sf):
    a = articles_v(spark, sf)
    return a.select("ord", X.is_out_of_region("title", "full_text", PLACES).alias("out_of_region"))


@register("out_of_region_flag_default", _oor_sql(X.OUT_OF_REGION_PLACES))
def q_out_of_region_default(spark, sf):
    a = articles_v(spark, sf)
    return a.select("ord", X.is_out_of_region("title", "full_text").alias("out_of_region"))





def _page_extract_sql() -> str:
    from newsfunnel.plans.catalog import ORACLES

    oor = _sq(_d_oor(X.OUT_OF_REGION_PLACES))
    return f"""
SELECT page_id, CASE WHEN kept IS NULL OR NOT regexp_matches(title || ' ' || substr(kept, 1, 1500), {oor})
                     THEN kept END AS full_text
FROM (
  SELECT page_id, title, CASE WHEN length({d_strip('cl')}) >= 100 AND NOT (length({d_strip('cl')}) < 500 AND ({_BP.replace('raw', 'cl')}))
                         THEN cl END AS kept
  FROM (
    SELECT m.page_id, coalesce(t.title, '') AS title, {d_clean('m.main_text')} AS cl
    FROM ({_PAGES_TEXT}) m JOIN ({ORACLES['page_title']}) t ON t.page_id = m.page_id))"""


@register("page_extract", _page_extract_sql())
def q_page_extract(spark, sf):
    """The whole extract stage (E1 -> E10) over the pages, titled by their <title>."""
    p = read_table(spark, sf, "pages", "page_id", "url", "html")
    p = p.withColumn("title", F.coalesce(X.page_title("html"), F.lit("")))
    return X.extract_pages(p).select("page_id", "full_text")
