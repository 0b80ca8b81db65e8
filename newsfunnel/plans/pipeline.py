"""Composed funnels.

``dedup_and_filter`` is the heart of the funnel: drop rows without text ->
URL dedup -> title dedup -> relevance score + exclusion filter.
``article_funnel`` is the full batch chain over landed refs and pages.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from newsfunnel.functions.lineage import materialize
from newsfunnel.operators.extract import extract_pages
from newsfunnel.operators.filters import cap, date_range, drop_empty_text, filter_districts
from newsfunnel.operators.scorers import Scorer, filter_refs, tag_with_scorer
from newsfunnel.operators.scoring import filter_excluded
from newsfunnel.operators.tagging import tag_from_answers, tag_from_text
from newsfunnel.operators.titledup import dedup_by_title
from newsfunnel.operators.urldedup import dedup_by_url
from newsfunnel.operators.verdicts import filter_by_verdict
from newsfunnel.sources.sinks import write_output


Watch = Callable[[DataFrame, str], DataFrame]


class StageCounts:
    """W7 for a composed run: rows (and rows with text) of each stage, observed while the
    run's own jobs pass them; no job of its own.  Pass it as ``watch``; ``rows()`` after the result was written."""

    def __init__(self):
        self.seen: dict[str, Observation] = {}

    def __call__(self, df: DataFrame, stage: str) -> DataFrame:
        self.seen[stage] = Observation(f"{stage}-{uuid.uuid4().hex}")
        text: Column = F.col("full_text") if "full_text" in df.columns else F.lit(None).cast("string")
        return df.observe(self.seen[stage], F.count(F.lit(1)).alias("n_rows"), F.count(text).alias("with_text"))

    def rows(self) -> list[tuple[int, str, int, int]]:
        """(place, stage, rows, rows with text); waits for the jobs that pass the stages."""
        return [(k, s, int(o.get["n_rows"]), int(o.get["with_text"])) for k, (s, o) in enumerate(self.seen.items())]


def _unwatched(df: DataFrame, stage: str) -> DataFrame:
    return df


def dedup_and_filter(articles: DataFrame, terms: DataFrame, patterns, threshold: float = 0.85, watch: Watch = _unwatched) -> DataFrame:
    """F8 -> D3 -> D6 -> D7/D8 (each step a DataFrame transform)."""
    by_url = materialize(watch(dedup_by_url(watch(drop_empty_text(articles), "text")), "url"), "url-dedup")  # the title stage reads its input twice
    return watch(filter_excluded(watch(dedup_by_title(by_url, threshold), "title"), terms, patterns), "kept")


def with_pages(refs: DataFrame, pages: DataFrame) -> DataFrame:
    """``refs`` with ``_html``, the page of their URL (NULL without one).

    Pages that no ref asks for go first; the page of a URL is chosen by its digest (fixed-size
    buffers, a hash aggregate), so only the chosen pages are joined."""
    asked = pages.where(F.col("html").isNotNull()).join(refs.select("url").distinct(), "url", "left_semi")
    named = asked.select(F.col("url").alias("_page_url"), F.col("html").alias("_html"), F.xxhash64("html").alias("_digest"))
    one = named.groupBy(F.col("_page_url").alias("_url")).agg(F.min("_digest").alias("_first"))
    chosen = named.join(one, (F.col("_page_url") == F.col("_url")) & (F.col("_digest") == F.col("_first"))).drop("_url", "_first", "_digest")
    return refs.join(chosen.dropDuplicates(["_page_url"]), F.col("url") == F.col("_page_url"), "left").drop("_page_url")


def article_funnel(refs: DataFrame, pages: DataFrame, terms: DataFrame, patterns, gazetteer: DataFrame,
                   start: str | None = None, end: str | None = None, district_slugs: list[str] | None = None,
                   verdicts: DataFrame | None = None, answers: DataFrame | None = None, max_articles: int | None = None,
                   places: list[str] | None = None, threshold: float = 0.85, out: str | None = None, scorer: Scorer | None = None,
                   watch: Watch = _unwatched) -> DataFrame:
    """The whole batch chain, stage by stage:

    date range -> districts -> relevance verdicts -> cap (only with ``max_articles``) -> extraction, cleaning and
    geo check of the landed pages (``pages``: url, html) -> district tags from the
    text, then from answers -> URL and title dedup -> score and exclusion ->
    optional write to ``out``.

    A ref without a page has no text and goes at the dedup stage; of several
    pages of a URL the one with the smallest hash counts (a narrow choice: pages are
    shipped once, to their refs).  ``scorer`` answers where no table of verdicts or
    answers is given; ``watch`` sees every stage (``StageCounts``).
    """
    df = watch(refs, "refs")
    if start:
        df = date_range(df, start, end)
    if district_slugs:
        df = filter_districts(df, district_slugs)
    df = watch(df, "selected")
    if verdicts is not None:
        df = filter_by_verdict(df, verdicts)
    elif scorer is not None:
        df = filter_refs(df, scorer)
    df = watch(df, "relevant")
    if max_articles is not None:
        df = cap(df, max_articles)
    df = materialize(df, "funnel-refs")
    df = with_pages(df, pages)
    df = watch(extract_pages(df, html="_html", places=places).drop("_html"), "extracted")
    df = tag_from_text(df, gazetteer)
    if answers is not None:
        df = tag_from_answers(df, gazetteer, answers)
    elif scorer is not None:
        df = tag_with_scorer(df, gazetteer, scorer)
    done = dedup_and_filter(materialize(df, "funnel-texts"), terms, patterns, threshold, watch)
    if out:
        done = materialize(done, "funnel-articles")
        write_output(done, out)
    return done
