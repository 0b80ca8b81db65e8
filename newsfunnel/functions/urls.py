"""URL parsing and normalisation as native Spark column expressions.

``parse_url`` is not used: it returns NULL for scheme-less input and has no
notion of Python's urlsplit rules.  We split with the RFC 3986 grammar the way
``urllib.parse.urlsplit`` does, and rebuild the way ``urlunsplit`` does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsfunnel.functions.lineage import with_columns_once

# Tracking parameters dropped from query strings (matched on the
# lower-cased key; the mixed-case entry therefore never matches).
TRACKING_PARAMS = [
    "utm_source",
    "utm_medium",
    "utm_campaign",
    "utm_term",
    "utm_content",
    "utm_id",
    "fbclid",
    "gclid",
    "yclid",
    "msclkid",
    "_ga",
    "_gl",
    "ref",
    "source",
    "mkt_tok",
    "mc_cid",
    "mc_eid",
    "hsCtaTracking",
    "si",
    "__cft__",
    "__tn__",
]

# Scheme lists of Python's urllib.parse (which schemes carry
# ``;params`` and which are rebuilt with ``//``).
USES_PARAMS = ["", "ftp", "hdl", "prospero", "http", "imap", "https", "shttp", "rtsp",
               "rtsps", "rtspu", "sip", "sips", "mms", "sftp", "tel"]
USES_NETLOC = ["", "ftp", "http", "gopher", "nntp", "telnet", "imap", "wais", "file", "mms",
               "https", "shttp", "snews", "prospero", "rtsp", "rtsps", "rtspu", "rsync", "svn",
               "svn+ssh", "sftp", "nfs", "git", "git+ssh", "ws", "wss", "itms-services"]

_SCHEME_RE = r"^([A-Za-z][A-Za-z0-9+.\-]*):"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def quote_plus(col: Column) -> Column:
    """``urllib.parse.quote_plus`` via ``url_encode`` (Java URLEncoder).

    The two differ only on '~' (Python keeps it) and '*' (Python encodes it).
    """
    return F.replace(F.replace(F.url_encode(col), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def _unquote_plus(col: Column) -> Column:
    # Python leaves a '%' without two hex digits as it is and decodes the rest
    return F.url_decode(F.regexp_replace(col, "%(?![0-9A-Fa-f]{2})", "%25"))


def _cleaned(u: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(u, r"[\t\r\n]", ""), r"^[\x00-\x20]+", "")


def _scheme_rest(u: Column) -> tuple[Column, Column]:
    has = u.rlike(_SCHEME_RE)
    return (F.when(has, F.lower(F.regexp_extract(u, _SCHEME_RE, 1))).otherwise(F.lit("")),
            F.when(has, F.regexp_replace(u, _SCHEME_RE, "")).otherwise(u))


def _net_rest(rest: Column) -> tuple[Column, Column]:
    """netloc, and what follows it without the fragment."""
    has = rest.startswith("//")
    after = F.when(has, F.regexp_replace(rest, r"^//[^/?#]*", "")).otherwise(rest)
    return F.when(has, F.regexp_extract(rest, r"^//([^/?#]*)", 1)).otherwise(F.lit("")), F.regexp_extract(after, r"^([^#]*)", 1)


def _path_query(nofrag: Column) -> tuple[Column, Column]:
    query = F.when(F.instr(nofrag, "?") > 0, F.regexp_extract(nofrag, r"^[^?]*\?(.*)$", 1)).otherwise(F.lit(""))
    return F.regexp_extract(nofrag, r"^([^?]*)", 1), query


def split_url(col: Column | str) -> dict[str, Column]:
    """urlsplit: scheme (lower-cased, '' if none), netloc, path, query."""
    scheme, rest = _scheme_rest(_cleaned(_c(col)))
    netloc, nofrag = _net_rest(rest)
    path, query = _path_query(nofrag)
    return {"scheme": scheme, "netloc": netloc, "path": path, "query": query}


def url_host(col: Column | str) -> Column:
    """Lower-cased netloc without one leading 'www.'."""
    net = F.lower(split_url(col)["netloc"])
    return F.when(net.startswith("www."), F.substring(net, 5, 1 << 30)).otherwise(net)


def _clean_query(query: Column) -> Column:
    fields = F.split(query, "&")
    # parse_qs(keep_blank_values=False): need '=' and a non-empty raw value
    fields = F.filter(fields, lambda f: (F.instr(f, "=") > 0) & (F.instr(f, "=") < F.length(f)))
    kv = F.transform(
        fields,
        lambda f: F.struct(
            _unquote_plus(F.substring_index(f, "=", 1)).alias("k"),
            _unquote_plus(F.substring(f, F.instr(f, "=") + 1, 1 << 30)).alias("v"),
        ),
    )
    kv = F.filter(kv, lambda x: ~F.lower(x["k"]).isin(TRACKING_PARAMS))
    # sorted((k, sorted(values))) == sorting the (k, v) pairs
    kv = F.array_sort(kv)
    return F.array_join(F.transform(kv, lambda x: F.concat(quote_plus(x["k"]), F.lit("="), quote_plus(x["v"]))), "&")


def _clean_parts(scheme0: Column, netloc: Column, path: Column) -> tuple[Column, Column, Column]:
    path = F.when(scheme0.isin(USES_PARAMS), F.regexp_replace(path, r";[^/]*$", "")).otherwise(path)
    path = F.regexp_replace(path, r"/+$", "")
    net = F.lower(netloc)
    return (F.when(scheme0 == "", F.lit("https")).otherwise(scheme0),
            F.when(net.startswith("www."), F.substring(net, 5, 1 << 30)).otherwise(net),
            F.when(path == "", F.lit("/")).otherwise(path))


def _assembled(scheme: Column, net: Column, path: Column, query: Column) -> Column:
    body = (
        F.when(net != "", F.concat(F.lit("//"), net, F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path))))
        .when(path.startswith("//"), F.concat(F.lit("//"), path))
        .when(scheme.isin(USES_NETLOC) & path.startswith("/"), F.concat(F.lit("//"), path))
        .otherwise(path)
    )
    return F.concat(scheme, F.lit(":"), body, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))


def normalize_url(col: Column | str) -> Column:
    """Canonical URL used as the dedup key.

    scheme lower-cased (default https), host lower-cased minus one leading
    ``www.``, trailing '/' stripped from the path ('/' when empty), ``;params``
    and fragment dropped, blank and tracking parameters dropped, remaining
    parameters sorted by key then value and re-encoded like ``quote_plus``.
    """
    p = split_url(col)
    return _assembled(*_clean_parts(p["scheme"], p["netloc"], p["path"]), _clean_query(p["query"]))


def with_normalized_url(df: DataFrame, url: str = "url", out: str = "norm_url") -> DataFrame:
    """Add the canonical URL, each intermediate part computed once a row (a nested
    expression would repeat its regexes with every reference)."""
    def staged(x: DataFrame, names: str, values) -> DataFrame:
        return with_columns_once(x, {f"__{out}_{n}": v for n, v in zip(names.split(), values)})

    def c(name: str) -> Column:
        return F.col(f"__{out}_{name}")

    x = staged(df, "u", [_cleaned(_c(url))])
    x = staged(x, "s r", _scheme_rest(c("u")))
    x = staged(x, "n f", _net_rest(c("r")))
    x = staged(x, "p q", _path_query(c("f")))
    x = staged(x, "scheme net path query", (*_clean_parts(c("s"), c("n"), c("p")), _clean_query(c("q"))))
    return x.select(*df.columns, _assembled(c("scheme"), c("net"), c("path"), c("query")).alias(out))
