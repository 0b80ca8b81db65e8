"""Title verdicts and consensus.

Verdicts come from any scorer (a ``mapInPandas`` callable, or answers landed
as a table); these operators render prompts, parse responses fail-open and
combine votes.  Consensus needs no voters x refs product: a missing vote is a
yes, so ``yes = n_voters - explicit_no``, aggregated over the votes only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsfunnel.functions.bounded import checked_broadcast
from newsfunnel.functions.text import pystrip

# Relevance prompt format ({state}, {district}, {title},
# {text_preview} are filled per article).
RELEVANCE_PROMPT = """\
RELEVANT (Yes):
- Heatwave or extreme heat events in {state} (or {district} if given)
- Temperature records or forecasts showing unusual heat in {state}
- Heat-related health issues (heatstroke, heat deaths, dehydration) in {state}
- Heat-caused infrastructure problems (power outages, water shortages) in {state}
- Government heat advisories, IMD warnings, or red/orange alerts for {state}
- National-level or multi-state heat news that covers {state} or the region it belongs to
- Weather forecasts that discuss heat, rising temperatures, or hot conditions in {state}
- Articles about rain or storms that discuss relief FROM HEAT or end of a heat spell in {state}
- Articles mentioning broad Indian regions that INCLUDE {state} (e.g. "Indo-Gangetic Plains", "North India", "South India", "central India", "eastern India", river basins like "Ganga belt", "Yamuna belt", "Godavari basin", "Cauvery basin", Deccan Plateau, Vidarbha, Marathwada, Telangana Plateau, Konkan, Coastal Andhra, etc.)

NOT RELEVANT (No):
- Heat news ONLY about a different Indian state with no connection to {state} (e.g. "Delhi records 47°C" when target is Kerala — answer No. But "North India heatwave" when target is Bihar — answer Yes because Bihar is in North India)
- Heat news from outside India (USA, Pakistan, Middle East, etc.) with no mention of {state} or India
- Weather articles about rain, cold, fog, or storms with NO mention of heat or temperatures
- Products, entertainment, or sports mentioning "heat"
- Articles where heat/temperature is mentioned only incidentally

State: {state}
District: {district}
Title: {title}
Content (first 500 chars): {text_preview}

Answer ONLY "Yes" or "No"."""


def relevance_prompt(title: str = "title", text: str = "full_text", state: str = "state",
                     district: str = "district") -> Column:
    """preview = first 500 chars stripped or '(no text)'; empty state/district
    fall back to '(unknown)' / '(not specified)'."""
    t = F.col(text)
    preview = F.when(t.isNotNull() & (t != ""), pystrip(F.substring(t, 1, 500))).otherwise(F.lit(""))
    values = {
        "state": F.coalesce(F.nullif(F.col(state), F.lit("")), F.lit("(unknown)")),
        "district": F.coalesce(F.nullif(F.col(district), F.lit("")), F.lit("(not specified)")),
        "title": F.col(title),
        "text_preview": F.coalesce(F.nullif(preview, F.lit("")), F.lit("(no text)")),
    }
    import re

    parts: list[Column] = []
    pieces = re.split(r"\{(\w+)\}", RELEVANCE_PROMPT)
    for i, p in enumerate(pieces):
        parts.append(values[p] if i % 2 else F.lit(p))
    return F.concat(*parts)


def parse_verdict(response: Column | str) -> Column:
    """R2: keep when lower(strip(response)) starts with 'yes'; NULL (missing or
    failed call) -> True (fail-open)."""
    r = F.col(response) if isinstance(response, str) else response
    return F.coalesce(F.startswith(F.lower(pystrip(r)), F.lit("yes")), F.lit(True))


def filter_by_verdict(refs: DataFrame, verdicts: DataFrame, key: str = "ord") -> DataFrame:
    """Refs left-joined to (ref_id, response); keep verdict True, order kept.
    Of several responses to a ref the first in byte order counts (a missing one last)."""
    v = verdicts.groupBy(F.col("ref_id").alias("_rid")).agg(F.min("response").alias("_resp"))
    j = refs.join(v, refs[key] == v["_rid"], "left")
    return j.where(parse_verdict("_resp")).drop("_rid", "_resp")


def majority_vote(refs: DataFrame, votes: DataFrame, voters: DataFrame, key: str = "ord") -> DataFrame:
    """Keep iff yes > n/2, n = voters that have a key; a missing or failed
    vote counts as yes.  Adds ``yes_votes`` and ``n_voters``."""
    keyed = voters.where(F.col("has_key")).select("voter")
    n = keyed.agg(F.count(F.lit(1))).scalar()
    no = (
        votes.join(checked_broadcast(keyed), "voter")
        .where(~parse_verdict("response"))
        .groupBy("ref_id")
        .agg(F.count_distinct("voter").alias("_no"))
    )
    j = refs.join(no, refs[key] == no["ref_id"], "left").drop("ref_id")
    yes = n - F.coalesce(F.col("_no"), F.lit(0))
    return (
        j.withColumn("n_voters", n)
        .withColumn("yes_votes", yes)
        .where(F.col("yes_votes").cast("double") > F.col("n_voters").cast("double") / F.lit(2.0))
        .drop("_no")
    )
