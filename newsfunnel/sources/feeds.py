"""Landed feed payloads -> article refs.

Input is whatever the collectors landed: one row per payload with the query
context (``ord``, ``language``, ``state``, ``search_term``).  RSS ``<item>``
XML is parsed with Spark's native ``from_xml``; REST payloads with
``from_json`` and an explicit schema (no inference).  Invalid rows are dropped,
never failing the batch.  Timestamps come out as IST wall clock
(TIMESTAMP_NTZ), independent of the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsfunnel.functions.lineage import with_columns_once
from newsfunnel.functions.text import pystrip
from newsfunnel.operators.querygen import ARTICLE_LANGUAGES, SOURCE_RANK

# Publishers dropped from RSS results (exact, case-sensitive).
EXCLUDED_PUBLISHERS = [
    "FOX Weather", "Fox Weather", "The Weather Channel", "Weather Channel", "AccuWeather", "Weather.com",
    "USA TODAY", "USA Today",
    "KUSA", "KUSA.com", "WFAA", "KHOU", "KVUE", "WFLA", "12News", "azcentral", "AZCentral",
    "Fox News", "CBS News", "NBC News", "ABC News", "MSNBC",
    "New York Post", "Chicago Tribune", "Los Angeles Times",
]

IST_OFFSET_SECONDS = 5 * 3600 + 1800
REF_COLS = ["ord", "title", "url", "source", "date", "language", "state", "district", "search_term"]
RSS_SCHEMA = "title string, link string, pubDate string, source struct<_VALUE: string, _url: string>"
NEWSDATA_SCHEMA = ("status string, results array<struct<title: string, link: string, pubDate: string, "
                   "source_name: string, source_id: string>>")
GNEWS_SCHEMA = "articles array<struct<title: string, url: string, publishedAt: string, source: struct<name: string>>>"


def epoch_micros_to_ntz(micros: Column, offset_seconds: int = 0) -> Column:
    """Instant (epoch micros) -> wall clock of a fixed offset as TIMESTAMP_NTZ, whatever the session zone."""
    secs = (micros + F.lit(offset_seconds * 1_000_000)).cast("decimal(20,0)") / F.lit(1_000_000)
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), secs.cast("decimal(18,6)"))


def epoch_micros_to_ist(micros: Column) -> Column:
    """Instant (epoch micros) -> IST wall clock TIMESTAMP_NTZ (IST has no DST)."""
    return epoch_micros_to_ntz(micros, IST_OFFSET_SECONDS)


def naive_utc_to_ist(ts_ntz: Column) -> Column:
    """A naive timestamp taken as UTC -> IST wall clock."""
    return ts_ntz + F.expr(f"INTERVAL {IST_OFFSET_SECONDS} SECONDS")


# ISO 8601 as Python reads it: calendar or week dates with or without dashes, any one separator, a
# time of one to three parts with a fraction, an offset down to fractions of a second.
_ISO_RE = (r"^(\d{4})(?:-(\d{2})-(\d{2})|(\d{2})(\d{2})|-W(\d{2})(?:-(\d))?|W(\d{2})(\d)?)"
           r"(?:[^\d](\d{2})(?::(\d{2})(?::(\d{2})(?:[.,](\d+))?)?|(\d{2})(?:(\d{2})(?:[.,](\d+))?)?)?"
           r"(?:(Z)|([+-])(\d{2})(?::(\d{2})(?::(\d{2})(?:[.,](\d+))?)?|(\d{2})(?:(\d{2})(?:[.,](\d+))?)?)?)?)?$")
# Zone names of RFC 822 dates and their hours; feed parsers take other names as UTC.
_ZONES = {"GMT": 0, "UT": 0, "UTC": 0, "Z": 0, "ADT": -3, "AST": -4, "EST": -5, "EDT": -4, "CST": -6, "CDT": -5,
          "MST": -7, "MDT": -6, "PST": -8, "PDT": -7, "A": -1, "N": 1, "M": -12, "Y": 12}
_MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
# day month year time zone, or (asctime) month day time year
_RFC_RE = (r"^(?:[A-Za-z]{3,9}\.?,?\s+)?(?:(\d{1,2})\s+([A-Za-z]{3})[a-z]*\.?\s+(\d{4}|\d{2})\s+(\d{1,2}):(\d{2})(?::(\d{2}))?"
           r"(?:\s*([A-Za-z]{1,5}|[+-]\d{2}:?\d{2}))?"
           r"|([A-Za-z]{3})[a-z]*\s+(\d{1,2})\s+(\d{1,2}):(\d{2}):(\d{2})\s+(\d{4}))$")
_MARK = "\x01"
_DAY = 86_400_000_000


def _groups(s: Column, pattern: str, n: int) -> Column:
    """The pattern's groups ('' where a group took no part) by one match; NULL where nothing matches."""
    marked = F.regexp_replace(F.translate(s, _MARK, ""), pattern, _MARK + _MARK.join(f"${g}" for g in range(1, n + 1)))
    return F.when(marked.startswith(_MARK), F.split(marked, _MARK))


def _with(value: Column, fn) -> Column:
    """``fn(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def _num(c: Column) -> Column:
    return F.coalesce(F.when(c != "", c).cast("long"), F.lit(0).cast("long"))


def _micro(c: Column) -> Column:
    return F.rpad(F.substring(c, 1, 6), 6, "0").cast("long")


def _days(c: Column) -> Column:
    return F.unix_date(c).cast("long")


def iso_instant(col: Column) -> tuple[Column, Column]:
    """(micros, aware) of an ISO 8601 date, with or without time, fraction and offset.
    A naive time counts from 1970 as if it were UTC; micros is NULL where nothing parses."""
    def read(g):
        def at(i):
            return g[i]

        def either(*ks):
            return F.concat(*[at(k) for k in ks])

        year, month, day = at(1), either(2, 4), either(3, 5)
        week, weekday = either(6, 8), either(7, 9)
        calendar = F.concat_ws("-", year, month, day).try_cast("date")
        jan4 = F.concat(year, F.lit("-01-04")).try_cast("date")
        monday = F.date_sub(jan4, F.weekday(jan4))  # of week 1
        w, d = _num(week), F.when(weekday == "", F.lit(1)).otherwise(_num(weekday))
        by_week = F.date_add(monday, ((w - 1) * 7 + d - 1).cast("int"))
        # a week belongs to the year of its Thursday
        real = (w >= 1) & d.between(1, 7) & (F.year(F.date_add(monday, ((w - 1) * 7 + 3).cast("int"))) == year.cast("int"))
        date = F.when(week == "", calendar).when(real, by_week)
        hour, minute, second, frac = at(10), either(11, 14), either(12, 15), either(13, 16)
        oh, om, os_, of = at(19), either(20, 23), either(21, 24), either(22, 25)
        fits = (_num(hour) < 24) & (_num(minute) < 60) & (_num(second) < 60) & (_num(oh) < 24) & (_num(om) < 60) & (_num(os_) < 60)
        offset = F.when(at(18) == "-", -1).otherwise(1) * (((_num(oh) * 60 + _num(om)) * 60 + _num(os_)) * 1_000_000 + _micro(of))
        micros = _days(date) * _DAY + ((_num(hour) * 60 + _num(minute)) * 60 + _num(second)) * 1_000_000 + _micro(frac) - offset
        return F.struct(F.when(fits & (year.cast("int") > 0), micros).alias("micros"), ((at(17) != "") | (at(18) != "")).alias("aware"))

    got = _with(_groups(pystrip(col), _ISO_RE, 25), read)
    return got["micros"], F.coalesce(got["aware"], F.lit(False))


def rfc_instant(col: Column) -> Column:
    """Micros of an RFC 822 date: weekday, seconds and zone are optional, years may have
    two digits (from 90 on they mean 19xx), no zone means UTC; or of an asctime date (UTC);
    NULL where nothing parses."""
    def read(g):
        def either(a, b):
            return F.concat(g[a], g[b])

        day, month, year = either(1, 9), F.lower(either(2, 8)), either(3, 13)
        hour, minute, second, zone = either(4, 10), either(5, 11), either(6, 12), F.upper(g[7])
        full = F.when(F.length(year) == 4, year).when(year >= "90", F.concat(F.lit("19"), year)).otherwise(F.concat(F.lit("20"), year))
        date = F.concat_ws("-", full, F.array_position(F.array(*map(F.lit, _MONTHS)), month).cast("string"), day).try_cast("date")
        names = F.create_map(*[x for k, v in _ZONES.items() for x in (F.lit(k), F.lit(60 * v))])
        signed = F.when(F.substring(zone, 1, 1) == "-", -1).otherwise(1) * (_num(F.substring(zone, 2, 2)) * 60 + _num(F.substring(zone, -2, 2)))
        offset = F.when(zone.rlike("^[+-]"), signed).otherwise(F.coalesce(F.try_element_at(names, zone), F.lit(0)))
        fits = (_num(hour) < 24) & (_num(minute) < 60) & (_num(second) < 60)
        return F.when(fits, _days(date) * _DAY + ((_num(hour) * 60 + _num(minute) - offset) * 60 + _num(second)) * 1_000_000)

    return _with(_groups(pystrip(col), _RFC_RE, 13), read)


def rss_date_to_ist(pub: Column) -> Column:
    """RFC 822, asctime or ISO 8601; a date without zone is UTC."""
    return epoch_micros_to_ist(F.coalesce(rfc_instant(pub), iso_instant(pub)[0]))


# Item positions get 16 bits of a packed ``ord``.
ITEMS = 1 << 16


def item_ord(ord_: Column, pos: Column | None = None) -> Column:
    """Packed order key of an item: payload, then position.  What does not fit the width stops
    the job instead of mixing up keys; ``struct_ord`` has no such width."""
    pos = F.lit(0) if pos is None else pos
    fits = (pos < ITEMS) & ord_.between(0, (1 << 40) - 1)
    return F.when(fits, ord_ * ITEMS + pos).otherwise(F.raise_error(F.lit("payload ord or item position beyond the order key")).cast("long"))


def struct_ord(ord_: Column, pos: Column | None = None) -> Column:
    """Order key of an item as a struct (payload, pos): any number of payloads and items.
    ``number_refs`` makes it a long again."""
    return F.struct(ord_.alias("payload"), (F.lit(0) if pos is None else pos).cast("long").alias("pos"))


def number_refs(refs: DataFrame, order: str = "ord") -> DataFrame:
    """``order`` of any type replaced by an increasing long: one range exchange, no window."""
    return refs.orderBy(order).withColumn(order, F.monotonically_increasing_id())


def _ctx() -> list[Column]:
    return [F.col("language"), F.col("state"), F.col("search_term")]


def _refs(x: DataFrame, order: Column, missing: Column) -> DataFrame:
    """REF_COLS and ``reason``: why the ref is no valid one (NULL: it is)."""
    rows = x.select(order.alias("ord"), F.col("_f.title").alias("title"), F.col("_f.url").alias("url"), F.col("_f.source").alias("source"),
                    F.col("_f.date").alias("date"), *_ctx(), F.lit(None).cast("string").alias("district"), missing.alias("_missing"))
    return rows.select(*REF_COLS, F.coalesce("_missing", ref_reject_reason()).alias("reason"))


def _absent(**which: Column) -> Column:
    out = F.lit(None).cast("string")
    for reason, when in reversed(which.items()):
        out = F.when(when, F.lit(reason)).otherwise(out)
    return out


def _kept(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("reason").isNull()).drop("reason")


def _fields(title: Column, url: Column, source: Column, date: Column) -> Column:
    return F.struct(title.alias("title"), url.alias("url"), source.alias("source"), date.alias("date"))


_CORRUPT = "_corrupt_record"


def rss_rows(feed: DataFrame, payload: str = "payload", order=item_ord) -> DataFrame:
    """One ``<item>`` per row.  Needs title, link and pubDate; source =
    ``<source>`` text, else the text after the last ' - ' of the title
    (stripped), else 'Unknown'.  Invalid refs keep their ``reason``."""
    x = with_columns_once(feed, {"_i": F.from_xml(F.col(payload), f"{RSS_SCHEMA}, {_CORRUPT} string", {"columnNameOfCorruptRecord": _CORRUPT})})
    # element text is whitespace-stripped, as feed parsers do
    title, link = pystrip(F.coalesce(F.col("_i.title"), F.lit(""))), pystrip(F.coalesce(F.col("_i.link"), F.lit("")))
    from_title = F.when(F.instr(title, " - ") > 0, pystrip(F.regexp_extract(title, r"(?s)^.* - (.*)$", 1)))
    src = F.coalesce(F.nullif(pystrip(F.col("_i.source._VALUE")), F.lit("")), F.nullif(from_title, F.lit("")),
                     F.lit("Unknown"))
    x = with_columns_once(x, {"_f": _fields(title, link, src, rss_date_to_ist(F.col("_i.pubDate")))})
    return _refs(x, order(F.col("ord")), _absent(
        malformed=F.col(f"_i.{_CORRUPT}").isNotNull(), title_empty=F.col("_f.title") == "", url_empty=F.col("_f.url") == "",
        date_missing=F.col("_f.date").isNull(), publisher_excluded=F.col("_f.source").isin(EXCLUDED_PUBLISHERS)))


def normalize_rss(feed: DataFrame, payload: str = "payload") -> DataFrame:
    """The valid refs of ``rss_rows``."""
    return _kept(rss_rows(feed, payload))


def _json_items(feed: DataFrame, payload: str, schema: str, items: str, failed: Column) -> DataFrame:
    """One row an item of each payload (``_pos``, ``_r``), one without item for payloads that cannot be read or have none (``_why``)."""
    x = with_columns_once(feed, {"_p": F.from_json(F.col(payload), f"{schema}, {_CORRUPT} string", {"columnNameOfCorruptRecord": _CORRUPT})})
    why = F.when(F.col("_p").isNull() | F.col(f"_p.{_CORRUPT}").isNotNull(), "malformed").when(failed, "source_error").when(
        F.coalesce(F.size(items), F.lit(0)) < 1, "no_items")
    x = x.withColumn("_why", why)
    return x.select("*", F.posexplode_outer(F.when(F.col("_why").isNull(), F.col(items))).alias("_pos", "_r"))


def newsdata_rows(feed: DataFrame, payload: str = "payload", order=item_ord) -> DataFrame:
    """Status 'error' -> nothing; results[]; stripped title/link; source =
    source_name or source_id or 'Unknown' (empty = missing); naive pubDate is
    UTC; unparsable dates are dropped.  Invalid refs keep their ``reason``."""
    x = _json_items(feed, payload, NEWSDATA_SCHEMA, "_p.results", F.coalesce(F.col("_p.status"), F.lit("")) == "error")
    title, link = pystrip(F.coalesce(F.col("_r.title"), F.lit(""))), pystrip(F.coalesce(F.col("_r.link"), F.lit("")))
    src = F.coalesce(F.nullif(F.col("_r.source_name"), F.lit("")), F.nullif(F.col("_r.source_id"), F.lit("")),
                     F.lit("Unknown"))
    x = with_columns_once(x, {"_f": _fields(title, link, src, epoch_micros_to_ist(iso_instant(F.col("_r.pubDate"))[0]))})  # a naive time is UTC
    return _refs(x, order(F.col("ord"), F.coalesce("_pos", F.lit(0))), F.coalesce("_why", _absent(
        title_empty=F.col("_f.title") == "", url_empty=F.col("_f.url") == "", date_missing=F.col("_f.date").isNull())))


def normalize_newsdata(feed: DataFrame, payload: str = "payload") -> DataFrame:
    """The valid refs of ``newsdata_rows``."""
    return _kept(newsdata_rows(feed, payload))


def gnews_rows(feed: DataFrame, payload: str = "payload", order=item_ord) -> DataFrame:
    """S3: articles[]; url key 'url'; source.name, 'Unknown' when the source or
    its name is absent (an explicit empty name fails validation); ISO dates
    with 'Z' (naive ones are IST, as the model assumes).  Invalid refs keep their ``reason``."""
    x = _json_items(feed, payload, GNEWS_SCHEMA, "_p.articles", F.lit(False))
    title, link = pystrip(F.coalesce(F.col("_r.title"), F.lit(""))), pystrip(F.coalesce(F.col("_r.url"), F.lit("")))
    src = F.coalesce(F.col("_r.source.name"), F.lit("Unknown"))
    micros, aware = iso_instant(F.col("_r.publishedAt"))
    x = with_columns_once(x, {"_at": F.struct(micros.alias("micros"), aware.alias("aware"))})
    date = epoch_micros_to_ntz(F.col("_at.micros") + F.when(F.col("_at.aware"), IST_OFFSET_SECONDS * 1_000_000).otherwise(0))
    x = with_columns_once(x, {"_f": _fields(title, link, src, date)})
    return _refs(x, order(F.col("ord"), F.coalesce("_pos", F.lit(0))), F.coalesce("_why", _absent(
        title_empty=F.col("_f.title") == "", url_empty=F.col("_f.url") == "", date_missing=F.col("_f.date").isNull())))


def normalize_gnews(feed: DataFrame, payload: str = "payload") -> DataFrame:
    """S3: the valid refs of ``gnews_rows``."""
    return _kept(gnews_rows(feed, payload))


def exclude_publishers(df: DataFrame, names: list[str] | None = None, col: str = "source") -> DataFrame:
    """Drop rows whose source is on the deny-list (exact match)."""
    return df.where(~F.col(col).isin(names or EXCLUDED_PUBLISHERS))


def ref_reject_reason(title: str = "title", url: str = "url", source: str = "source", language: str = "language",
                      state: str = "state", search_term: str = "search_term", date: str = "date") -> Column:
    """First failed model rule, NULL when the ref is valid."""
    def missing(c):
        return F.col(c).isNull() | (F.length(F.col(c)) < 1)

    return (F.when(missing(title), F.lit("title_empty"))
            .when(F.length(F.col(title)) > 500, F.lit("title_too_long"))
            .when(missing(url), F.lit("url_empty"))
            .when(missing(source), F.lit("source_empty"))
            .when(F.col(date).isNull(), F.lit("date_missing"))
            .when(F.col(language).isNull() | ~F.col(language).isin(ARTICLE_LANGUAGES), F.lit("language_unsupported"))
            .when(missing(state), F.lit("state_empty"))
            .when(missing(search_term), F.lit("search_term_empty")))


def validate_refs(df: DataFrame) -> DataFrame:
    """Keep valid refs (invalid rows are dropped, never failing the batch)."""
    return df.where(ref_reject_reason().isNull())


def source_union(google: DataFrame, newsdata: DataFrame, gnews: DataFrame) -> DataFrame:
    """Union of the sources with a total order key: (source rank, payload
    ord, item position), packed into ``ord`` where the sources' own are packed, else a
    struct with the rank before them — no global sort is needed."""
    def ranked(df, src):
        if isinstance(df.schema["ord"].dataType, T.StructType):
            return df.withColumn("ord", F.struct(F.lit(SOURCE_RANK[src]).alias("rank"), "ord.payload", "ord.pos"))
        return df.withColumn("ord", F.lit(SOURCE_RANK[src]) * F.lit(1 << 56) + F.col("ord"))

    return ranked(google, "google").unionByName(ranked(newsdata, "newsdata")).unionByName(ranked(gnews, "gnews"))


def resolve_urls(df: DataFrame, resolutions: DataFrame, url: str = "url") -> DataFrame:
    """Aggregator redirect URLs take their resolved target when known;
    other URLs and failed resolutions keep the original."""
    r = resolutions.select(F.col("url").alias("_ru"), F.col("resolved").alias("_rr")).dropDuplicates(["_ru"])
    j = df.join(r, F.col(url) == F.col("_ru"), "left")
    new = F.when(F.instr(F.col(url), "news.google.com") > 0, F.coalesce(F.col("_rr"), F.col(url))).otherwise(F.col(url))
    return j.withColumn(url, new).drop("_ru", "_rr")
