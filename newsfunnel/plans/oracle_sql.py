"""Independent DuckDB (RE2) SQL building blocks for the oracle queries.

These are written against DuckDB's own function set — they are the reference
the Spark operators are checked against, not a copy of the Spark expressions.
"""

from __future__ import annotations

from newsfunnel.functions.urls import TRACKING_PARAMS, USES_NETLOC, USES_PARAMS


def _list(xs) -> str:
    return "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in xs) + "]"


# Python's whitespace set in RE2 syntax.
D_SPACE = r"[\t\n\x{0b}\f\r\x{1c}-\x{1f}\x{85}\p{Z}]"
D_WORD = r"[\p{L}\p{N}_]"
D_NOT_WORD = r"[^\p{L}\p{N}_]"


def d_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{D_SPACE}+|{D_SPACE}+$', '', 'g')"


def d_quote_plus(x: str) -> str:
    return f"replace(url_encode({x}), '%20', '+')"


def d_unquote_plus(x: str) -> str:
    return f"url_decode(replace({x}, '+', ' '))"


def d_norm_url(src: str, url: str = "url", out: str = "norm_url") -> str:
    """SELECT over ``src`` adding column ``out`` (Python urlsplit/unsplit rules)."""
    q = f"""
    SELECT * EXCLUDE (_u, _hs, _sch, _r1, _net, _r2, _nf, _qry, _pth, _kv),
      _sch || ':' ||
      CASE WHEN _net <> '' THEN '//' || _net || CASE WHEN starts_with(_pth, '/') THEN _pth ELSE '/' || _pth END
           WHEN starts_with(_pth, '//') THEN '//' || _pth
           WHEN list_contains({_list(USES_NETLOC)}, _sch) AND starts_with(_pth, '/') THEN '//' || _pth
           ELSE _pth END
      || CASE WHEN len(_kv) > 0 THEN '?' || array_to_string(list_transform(_kv,
            lambda x: {d_quote_plus('x.k')} || '=' || {d_quote_plus('x.v')}), '&') ELSE '' END AS {out}
    FROM (
      SELECT * EXCLUDE (_pth, _sch),
        CASE WHEN _sch = '' THEN 'https' ELSE _sch END AS _sch,
        coalesce(nullif(regexp_replace(
          CASE WHEN list_contains({_list(USES_PARAMS)}, _sch) THEN regexp_replace(_pth, ';[^/]*$', '') ELSE _pth END,
          '/+$', ''), ''), '/') AS _pth,
        list_sort(list_filter(list_transform(
            list_filter(string_split(_qry, '&'), lambda f: strpos(f, '=') > 0 AND strpos(f, '=') < length(f)),
            lambda f: {{'k': {d_unquote_plus("split_part(f, '=', 1)")}, 'v': {d_unquote_plus("substr(f, strpos(f, '=') + 1)")}}}),
          lambda x: NOT list_contains({_list(TRACKING_PARAMS)}, lower(x.k)))) AS _kv
      FROM (
        SELECT *,
          CASE WHEN strpos(_nf, '?') > 0 THEN substr(_nf, strpos(_nf, '?') + 1) ELSE '' END AS _qry,
          split_part(_nf, '?', 1) AS _pth
        FROM (
          SELECT * EXCLUDE (_net), split_part(_r2, '#', 1) AS _nf,
            CASE WHEN starts_with(lower(_net), 'www.') THEN substr(lower(_net), 5) ELSE lower(_net) END AS _net
          FROM (
            SELECT *,
              CASE WHEN starts_with(_r1, '//') THEN regexp_extract(_r1, '^//([^/?#]*)', 1) ELSE '' END AS _net,
              CASE WHEN starts_with(_r1, '//') THEN regexp_replace(_r1, '^//[^/?#]*', '') ELSE _r1 END AS _r2
            FROM (
              SELECT *,
                CASE WHEN _hs THEN lower(regexp_extract(_u, '^([A-Za-z][A-Za-z0-9+.\\-]*):', 1)) ELSE '' END AS _sch,
                CASE WHEN _hs THEN substr(_u, strpos(_u, ':') + 1) ELSE _u END AS _r1
              FROM (
                SELECT *, regexp_matches(_u, '^[A-Za-z][A-Za-z0-9+.\\-]*:') AS _hs
                FROM (SELECT *, regexp_replace(regexp_replace({url}, '[\\t\\r\\n]', '', 'g'), '^[\\x00-\\x20]+', '') AS _u
                      FROM {src}) ) ) ) ) ) )"""
    return q


def d_quality(text: str = "full_text", district: str = "district", source: str = "source") -> str:
    return (f"(CASE WHEN {text} IS NOT NULL THEN 100 + length({text}) ELSE 0 END"
            f" + CASE WHEN {district} IS NOT NULL THEN 10 ELSE 0 END"
            f" + CASE WHEN {source} <> 'Unknown' THEN 5 ELSE 0 END)")
