"""Row filters of the funnel (F1-F8).  All are plain predicates that Catalyst
pushes below projections — date bounds reach the parquet scan as
``PushedFilters``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsfunnel.functions.text import pystrip
from newsfunnel.functions.urls import url_host

# Title heat-signal words (case-insensitive substring match; the
# trailing space of "loo " is intended).
HEAT_SIGNALS = [
    # English
    "heat", "heatwave", "heat wave", "hot", "scorching", "sweltering",
    "sunstroke", "sun stroke", "heatstroke", "heat stroke",
    "temperature", "mercury", "celsius", "loo ",
    "drought", "water crisis", "water shortage",
    # Hindi
    "गर्मी", "लू", "तापमान", "पारा", "सूर्याघात", "तापाघात",
    "हीट", "धूप", "उष्ण", "ग्रीष्म",
    # Tamil
    "வெப்பம்", "வெப்ப அலை", "கோடை", "வெயில்",
    # Telugu
    "వేడి", "ఉష్ణ", "ఎండ", "సూర్యాఘాతం",
    # Bengali
    "গরম", "তাপ", "তাপমাত্রা", "দাবদাহ", "লু",
    # Marathi
    "उष्णता", "उन्हाळा", "तापमान", "ऊन",
    # Gujarati
    "ગરમી", "તાપમાન", "લૂ", "ઉષ્ણ",
    # Kannada
    "ಬಿಸಿ", "ಉಷ್ಣ", "ತಾಪಮಾನ", "ಬಿಸಿಗಾಳಿ",
    # Malayalam
    "ചൂട്", "ഉഷ്ണ", "താപനില", "വെയിൽ",
    # Odia
    "ଗରମ", "ତାପମାତ୍ରା", "ଉଷ୍ଣ",
    # Punjabi
    "ਗਰਮੀ", "ਤਾਪਮਾਨ", "ਲੂ",
    # Assamese
    "গৰম", "তাপমাত্ৰা",
    # Urdu
    "گرمی", "لو", "ہیٹ", "شدید گرمی",
    # Nepali
    "गर्मी", "तापक्रम", "लू",
]

# Domains whose pages never yield text (host or any subdomain).
SKIP_DOMAINS = ["msn.com"]


def _ntz(s: str | dt.datetime) -> Column:
    v = s if isinstance(s, dt.datetime) else dt.datetime.fromisoformat(s)
    return F.lit(v).cast(T.TimestampNTZType())


def date_range(df: DataFrame, start: str, end: str | None = None, col: str = "date") -> DataFrame:
    """Keep ``start 00:00:00 <= col <= end 23:59:59`` (IST wall clock, whole seconds)."""
    end = end or start
    lo = _ntz(dt.datetime.fromisoformat(start[:10]))
    hi = _ntz(dt.datetime.fromisoformat(end[:10]).replace(hour=23, minute=59, second=59))
    return df.where((F.col(col) >= lo) & (F.col(col) <= hi))


def lookback(df: DataFrame, now: str | dt.datetime, hours: int = 24, col: str = "date") -> DataFrame:
    """Keep rows with ``col >= now - hours``; ``now`` is a parameter (never the clock)."""
    n = now if isinstance(now, dt.datetime) else dt.datetime.fromisoformat(now)
    return df.where(F.col(col) >= _ntz(n - dt.timedelta(hours=hours)))


def select_states(regions: DataFrame, requested: DataFrame, slug: str = "slug") -> DataFrame:
    """Requested slugs (``req_ord, slug``) in request order joined to the regions.

    Returns every requested slug with ``known`` = found; unknown slugs stay
    visible for reporting (the caller stops when no row is known).
    """
    r = regions.withColumn("_hit", F.lit(True))
    return (
        requested.join(r, slug, "left")
        .withColumn("known", F.coalesce(F.col("_hit"), F.lit(False)))
        .drop("_hit")
    )


def district_slug_loose(col: str = "district") -> Column:
    """lower(name) with spaces as '-' ('&' is kept, unlike the output slug)."""
    return F.replace(F.lower(F.col(col)), F.lit(" "), F.lit("-"))


def filter_districts(df: DataFrame, slugs: list[str], col: str = "district") -> DataFrame:
    return df.where(F.col(col).isNotNull() & district_slug_loose(col).isin(slugs))


def title_signal_regex(words: list[str] | None = None) -> str:
    from newsfunnel.functions.text import trie_alternation

    return "(?iu)" + trie_alternation(words or HEAT_SIGNALS)


def filter_title_signal(df: DataFrame, words: list[str] | None = None, col: str = "title") -> DataFrame:
    """Keep titles containing any signal word (case-insensitive substring)."""
    return df.where(F.col(col).rlike(title_signal_regex(words)))


def cap(df: DataFrame, n: int = 5000, order: str = "ord") -> DataFrame:
    """First ``n`` rows in funnel order (a TakeOrdered; the limit is the feature)."""
    return df.orderBy(order).limit(n)


def skip_domain(url: str = "url", domains: list[str] | None = None) -> Column:
    """True when the host (minus 'www.') is a listed domain or a subdomain of one."""
    host = url_host(url)
    doms = domains or SKIP_DOMAINS
    cond = F.lit(False)
    for d in doms:
        cond = cond | (host == d) | host.endswith("." + d)
    return cond


def drop_empty_text(df: DataFrame, col: str = "full_text") -> DataFrame:
    """Drop NULL and whitespace-only text."""
    return df.where(F.col(col).isNotNull() & (F.length(pystrip(col)) > 0))
