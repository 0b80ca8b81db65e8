"""Query catalog: one Spark query and (where SQL-expressible) one DuckDB oracle
per operator of the inventory.  ``__spark_entry__`` only re-exports these."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


def _load_all() -> None:
    # importing registers the queries
    from newsfunnel.plans import cat_dedup, cat_extract, cat_filters, cat_funnel, cat_landed, cat_query, cat_sinks, cat_sources, cat_stream, cat_tagging  # noqa: F401


_load_all()
