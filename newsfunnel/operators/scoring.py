"""Dictionary relevance score (D7) and the exclusion filter.

Plan: one row per article all the way, one narrow stage, the text read once.  Each language's
terms are one prefix trie, written into the plan as a literal regular expression.  It
matches empty at every place where a term may start and captures the longest one
there, so terms that overlap are all found; those that are whole-word beginnings of a longer one
follow from the dictionary (``_within``).  No expression is compiled per row.
"""

from __future__ import annotations

import json
from functools import reduce

import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsfunnel.functions.bounded import bounded_collect
from newsfunnel.functions.lineage import with_columns_once
from newsfunnel.functions.pyregex import alternation
from newsfunnel.functions.text import WORD, java_regex_literal, trie_alternation


def combined_text(title: str = "title", text: str = "full_text") -> Column:
    """lower(title + '\\n' + text): empty title is skipped, NULL text is skipped."""
    t, x = F.col(title), F.col(text)
    has_t = t.isNotNull() & (t != "")
    return F.lower(
        F.when(has_t & x.isNotNull(), F.concat(t, F.lit("\n"), x))
        .when(has_t, t)
        .when(x.isNotNull(), x)
        .otherwise(F.lit(""))
    )


TRIE_TERMS = 5_000  # terms of one pattern; a larger dictionary takes several


def _languages(terms: DataFrame) -> dict[str, dict[str, set[str]]]:
    """language -> lower-cased term -> categories."""
    out: dict[str, dict[str, set[str]]] = {}
    for r in bounded_collect(terms.select("lang", F.lower(F.col("term")).alias("lt"), "category").distinct()):
        if r["lt"]:
            out.setdefault(r["lang"], {}).setdefault(r["lt"], set()).add(r["category"])
    return out


_WORD_CHAR = regex.compile(WORD)


def _within(term: str, known: dict[str, set[str]]) -> list[str]:
    """The terms that stand where ``term`` does: itself and its beginnings that end with a word."""
    return [term[:n] for n in range(1, len(term) + 1)
            if term[:n] in known and (n == len(term) or not _WORD_CHAR.match(term[n]))]


_HIT = "struct<lt:string,cat:string>"


def _anywhere(words: list[str]) -> str:
    """Matches empty where one of ``words`` starts and captures the longest; a class of first
    letters turns most places away before anything else is looked at."""
    first = "".join(java_regex_literal(c) for c in sorted({w[0] for w in words}))
    return f"(?=[{first}])(?<!{WORD})(?=({trie_alternation(words)})(?!{WORD}))"


def _hits(text: Column, known: dict[str, set[str]]) -> Column:
    """The terms of ``known`` in ``text`` with no word character on either side, as array of (term, category)."""
    words = sorted(known)
    if not words:
        return F.array().cast(f"array<{_HIT}>")
    found = [F.regexp_extract_all(text, F.lit(_anywhere(words[k:k + TRIE_TERMS])), F.lit(1)) for k in range(0, len(words), TRIE_TERMS)]
    stand = {w: [{"lt": t, "cat": c} for t in _within(w, known) for c in sorted(known[t])] for w in words}
    table = F.from_json(F.lit(json.dumps(stand)), f"map<string,array<{_HIT}>>")  # folded into a literal
    longest = F.array_distinct(F.concat(*found))
    return F.array_distinct(F.flatten(F.transform(longest, lambda w: F.try_element_at(table, w))))


def score_relevance(df: DataFrame, terms: DataFrame, out: str = "relevance_score",
                    title: str = "title", text: str = "full_text", language: str = "language") -> DataFrame:
    """Add the relevance score in [0, 1].

    text = lower(title \\n full_text); terms of {language, 'en'}; a hit is a
    term with no word character on either side.  n = distinct matched terms,
    c = distinct matched categories.  score = min(n/3,1)*0.5 + min(c/2,1)*0.3
    + 0.2 if a matched term is a plain substring of the lower title; with NULL
    text and a title hit the score is at least 0.3; capped at 1.
    """
    known = _languages(terms)
    english = known.get("en", {})
    txt = combined_text(title, text)
    matched = F.when(F.lit(False), F.array().cast(f"array<{_HIT}>"))
    for lang, own in sorted((k, v) for k, v in known.items() if k not in ("en", None, "")):
        matched = matched.when(F.col(language) == lang, _hits(F.col("_txt"), {t: own.get(t, set()) | english.get(t, set()) for t in {*own, *english}}))
    matched = matched.otherwise(_hits(F.col("_txt"), english))
    n = F.size(F.array_distinct(F.transform(F.col("_m"), lambda t: t["lt"])))
    c = F.size(F.array_distinct(F.transform(F.col("_m"), lambda t: t["cat"])))
    low_title = F.lower(F.coalesce(F.col(title), F.lit("")))
    title_hit = F.exists(F.col("_m"), lambda t: F.instr(low_title, t["lt"]) > 0)
    raw = (
        F.least(n.cast("double") / F.lit(3.0), F.lit(1.0)) * F.lit(0.5)
        + F.least(c.cast("double") / F.lit(2.0), F.lit(1.0)) * F.lit(0.3)
        + F.when(title_hit, F.lit(0.2)).otherwise(F.lit(0.0))
    )
    raw = F.when(F.col(text).isNull() & title_hit, F.greatest(raw, F.lit(0.3))).otherwise(raw)
    score = F.when(n == 0, F.lit(0.0)).otherwise(F.least(raw, F.lit(1.0)))
    j = with_columns_once(with_columns_once(df, {"_txt": txt}), {"_m": matched})
    return j.withColumn(out, score).drop("_txt", "_m")


PATTERNS_AT_ONCE = 2_000


def exclusion_regex(patterns: DataFrame | list[str], col: str = "pattern") -> list[str]:
    """Java alternations of the exclusion patterns (Python syntax, IGNORECASE); one unless there are thousands."""
    pats = patterns if isinstance(patterns, list) else [r[col] for r in bounded_collect(patterns.select(col))]
    return [alternation(pats[k:k + PATTERNS_AT_ONCE]) for k in range(0, len(pats), PATTERNS_AT_ONCE)]


def filter_excluded(df: DataFrame, terms: DataFrame, patterns: DataFrame | list[str],
                    score: str = "relevance_score", threshold: float = 0.05) -> DataFrame:
    """Score, then drop only rows with score < threshold AND an exclusion hit.

    The matched-terms array is computed once per row (``with_columns_once``),
    so the filter only re-derives cheap arithmetic from it, and the exclusion
    regex runs only for rows under the threshold (short-circuit AND)."""
    scored = score_relevance(df, terms, out=score)
    found = [combined_text().rlike(rx) for rx in exclusion_regex(patterns)]
    if not found:
        return scored
    return scored.where(~((F.col(score) < threshold) & reduce(lambda a, b: a | b, found)))

