"""Page text extraction and cleaning.

One narrow stage without a shuffle: every page is processed independently, so the
work scales linearly with partitions.  E1 matches nested containers, which needs a stack; it is
an Arrow-fed helper (``functions.html``, where its contract stands), linear in the page.
Everything after it is native column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsfunnel.functions.html import main_texts, title_texts
from newsfunnel.functions.text import PY_SPACE, pystrip

# Boilerplate phrases (case-insensitive substrings).
BOILERPLATE_PHRASES = [
    "download app",
    "download the app",
    "डाउनलोड करें",
    "ऐप डाउनलोड",
    "all rights reserved",
    "terms of use",
    "privacy policy",
    "cookie policy",
    "subscribe to newsletter",
    "sign up for newsletter",
    "copyright ©",
    "© copyright",
    "trademark of",
    "registered trademark",
]

# Places outside the covered country (word-boundary match).
OUT_OF_REGION_PLACES = [
    "alabama", "alaska", "arizona", "arkansas", "california", "colorado",
    "connecticut", "delaware", "florida", "georgia", "hawaii", "idaho",
    "illinois", "iowa", "kansas", "kentucky", "louisiana",
    "maine", "maryland", "massachusetts", "michigan", "minnesota",
    "mississippi", "missouri", "montana", "nebraska", "nevada",
    "new hampshire", "new jersey", "new mexico", "new york",
    "north carolina", "north dakota", "ohio", "oklahoma", "oregon",
    "pennsylvania", "rhode island", "south carolina", "south dakota",
    "tennessee", "texas", "utah", "vermont", "virginia", "washington",
    "west virginia", "wisconsin", "wyoming",
    "phoenix", "denver", "las vegas", "houston", "dallas", "chicago",
    "los angeles", "san francisco", "miami", "seattle", "boston",
    "atlanta", "portland", "san antonio", "tucson", "sacramento",
    "united states", "usa", "u.s.a", "u.s.",
    "united kingdom", "australia", "pakistan", "saudi arabia",
    "middle east", "europe", "european",
]

S = PY_SPACE


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def main_text(html: Column | str) -> Column:
    """Precision pass, recall pass only when the first yields nothing; NULL without text."""
    return F.arrow_udf(main_texts, "string")(_c(html))


def page_title(html: Column | str) -> Column:
    """Text of the first ``<title>`` on one line; NULL without text."""
    return F.arrow_udf(title_texts, "string")(_c(html))


# --------------------------------------------------------------- cleaning
# The cleaning patterns.  Unbounded group repetitions are possessive: java.util.regex then loops instead of
# recursing once a line.  The first two breadcrumbs stay open to backtracking, which
# decides only whether there are two.
_CRUMB = rf"(?:{S}*-{S}+.{{1,50}}\n)"
BREADCRUMB_RE = rf"(?dm)^{_CRUMB}{_CRUMB}{_CRUMB}*+"
ALSO_READ_RE = (rf"(?dmiu)^{S}*(?:Also{S}+Read|Read{S}+Also|ये{S}+भी{S}+पढ़ें|यह{S}+भी{S}+पढ़ें)"
                rf"{S}*[:|\-]?{S}*.*$")
APP_PROMO_RE = rf"(?dmiu)^{S}*(?:Download{S}+(?:the{S}+)?app|Get{S}+the{S}+app|ऐप{S}+डाउनलोड{S}+करें).*$"
RECOMMENDED_RE = (rf"(?dmiu)(?:^.*(?:recommended|related{S}+(?:news|articles|stories)"
                  rf"|संबंधित{S}+खबरें|સંબંધિત{S}+સમાચાર).*\n)(?:(?:.+\n?){{2,}}+|..+\n?+)$")  # two lines, or one that could be split in two
# Every RECOMMENDED_RE match contains one of these words (same flags), so texts
# without them skip the backtracking-heavy pattern; exact, not a heuristic.
RECOMMENDED_TRIGGER = r"(?iu)recommended|related|संबंधित|સંબંધિત"
COPYRIGHT_RE = rf"(?dsiu)\n{S}*(?:©{S}*\p{{Nd}}{{4}}|copyright{S}*©|[a-z]+ name,? logo).*$"


def paragraph_dedup(c: Column | str) -> Column:
    """Split on blank lines, drop empty and repeated paragraphs (key = stripped,
    lower-cased), keep first occurrences in order.

    Sort by (key, position), keep each key's first, restore position order: O(k log k) in
    the number of paragraphs.  The sorted array is bound to a lambda variable, so
    looking at the element before costs one step; the input is referenced exactly once
    (Spark would otherwise re-evaluate an upstream cleaning chain per reference).
    """
    s = F.array_sort(F.transform(F.split(_c(c), "\n\n"), lambda p, i: F.struct(
        F.lower(pystrip(p)).alias("k"), i.alias("i"), p.alias("p"))))

    def firsts(a: Column) -> Column:
        first = F.filter(a, lambda x, j: (x["k"] != "") & ((j == 0) | (F.get(a, j - 1)["k"] != x["k"])))
        return F.transform(F.array_sort(F.transform(first, lambda x: F.struct(x["i"].alias("i"), x["p"].alias("p")))), lambda x: x["p"])

    return F.array_join(F.element_at(F.transform(F.array(s), firsts), 1), "\n\n")


def clean_text(c: Column | str) -> Column:
    """Breadcrumbs, 'also read', app promos, related blocks, copyright
    tail, newline collapse, paragraph dedup, final strip.

    The related-block pattern backtracks over every long line; it can only
    match where a trigger word occurs, and the earlier removals only delete
    whole line spans (they never create a word), so texts without a trigger
    take the branch without that pattern.  Only one branch runs per row."""
    t0 = _c(c)

    def chain(t: Column, related: bool) -> Column:
        t = F.regexp_replace(t, BREADCRUMB_RE, "")
        t = F.regexp_replace(t, ALSO_READ_RE, "")
        t = F.regexp_replace(t, APP_PROMO_RE, "")
        if related:
            t = F.regexp_replace(t, RECOMMENDED_RE, "")
        t = F.regexp_replace(t, COPYRIGHT_RE, "")
        t = F.regexp_replace(t, r"\n{3,}", "\n\n")
        return pystrip(paragraph_dedup(t))

    return F.when(t0.rlike(RECOMMENDED_TRIGGER), chain(t0, True)).otherwise(chain(t0, False))


def short_text_discard(c: Column | str, min_chars: int = 100) -> Column:
    """NULL when the stripped text has fewer than ``min_chars`` characters."""
    t = _c(c)
    return F.when(F.length(pystrip(t)) >= min_chars, t)


def is_boilerplate(c: Column | str, phrases: list[str] | None = None, max_chars: int = 500) -> Column:
    """Short (< 500 stripped chars) AND contains a boilerplate phrase."""
    t = _c(c)
    low = F.lower(t)
    hit = F.lit(False)
    for p in phrases or BOILERPLATE_PHRASES:
        hit = hit | (F.instr(low, p) > 0)
    return (F.length(pystrip(t)) < max_chars) & hit


def out_of_region_regex(places: list[str] | None = None) -> str:
    """``\b(?:p1|p2|...)\b`` (Python, IGNORECASE) in Java syntax.

    For a literal list the meaning of ``\b`` at each edge is fixed by the
    word's own edge character (a word character needs a non-word neighbour,
    and vice versa), so words are grouped by edge kinds and each group is one
    prefix trie between one lookbehind and one lookahead."""
    from newsfunnel.functions.text import WORD, trie_alternation

    def is_word(ch: str) -> bool:
        return ch.isalnum() or ch == "_"

    groups: dict[tuple[bool, bool], list[str]] = {}
    for p in places or OUT_OF_REGION_PLACES:
        if p:
            groups.setdefault((is_word(p[0]), is_word(p[-1])), []).append(p)
    parts = []
    for (lw, rw), ws in groups.items():
        left = f"(?<!{WORD})" if lw else f"(?<={WORD})"
        right = f"(?!{WORD})" if rw else f"(?={WORD})"
        parts.append(f"{left}(?:{trie_alternation(ws)}){right}")
    return "(?iu)" + "|".join(parts) if parts else "(?!)"


def is_out_of_region(title: Column | str, text: Column | str, places: list[str] | None = None,
                     prefix_chars: int = 1500) -> Column:
    """A listed place (word-bounded, case-insensitive) in the title plus
    the first ``prefix_chars`` characters of the text (the rule's own window)."""
    t, x = _c(title), _c(text)
    combined = F.when(x.isNull(), t).otherwise(F.concat(t, F.lit(" "), F.substring(x, 1, prefix_chars)))
    return combined.rlike(out_of_region_regex(places))


def extract_pages(df: DataFrame, html: str = "html", url: str = "url", title: str = "title",
                  out: str = "full_text", places: list[str] | None = None) -> DataFrame:
    """E1 -> E2..E7 -> E8 -> E9 -> E10 on rows carrying raw HTML.

    Rows on skip-listed domains or without HTML get NULL text; one output row
    per input row (never fails the batch).  Each stage's text is computed once
    (``with_columns_once``) because the next stage reads it several times.
    """
    from newsfunnel.functions.lineage import with_columns_once
    from newsfunnel.operators.filters import skip_domain

    x = with_columns_once(df, {"_raw": F.when(~skip_domain(url), main_text(html))})
    x = with_columns_once(x, {"_clean": clean_text("_raw")})
    kept = F.when((F.length(pystrip("_clean")) >= 100) & ~is_boilerplate("_clean"), F.col("_clean"))
    x = with_columns_once(x, {"_kept": kept})
    text = F.when(~is_out_of_region(title, "_kept", places), F.col("_kept"))
    return x.withColumn(out, text).drop("_raw", "_clean", "_kept")
