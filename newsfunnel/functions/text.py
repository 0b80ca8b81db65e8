"""Text helpers that reproduce Python ``str``/``re`` semantics with Java regex.

Spark evaluates ``rlike``/``regexp_replace`` with ``java.util.regex``.  The
feeds being cleaned were specified with Python's ``re`` module, whose classes
differ: ``\\s`` and ``\\w`` are Unicode-aware, ``$`` only treats ``\\n`` as a
line end, and ``str.strip()`` strips every Unicode space.  The helpers here
build Java patterns with the Python meaning so that every operator stays a
native column expression (whole-stage codegen, no Python in the hot path).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's whitespace set (str.isspace): ASCII \s plus \x0b, the information
# separators \x1c-\x1f, NEL and every Unicode space/line/paragraph separator.
PY_SPACE = r"[\t\n\x{0b}\f\r\x{1c}-\x{1f}\x{85}\p{Z}]"
# Python's \w for str patterns: letters, numbers, underscore (marks excluded).
WORD = r"[\p{L}\p{N}_]"
NOT_WORD = r"[^\p{L}\p{N}_]"


# The same set as explicit characters (every code point with str.isspace()).
PY_SPACE_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
                  "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def pystrip(col: Column | str) -> Column:
    """``str.strip()`` — strip leading/trailing Unicode whitespace (native btrim)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.btrim(c, F.lit(PY_SPACE_CHARS))


def java_regex_literal(s: str) -> str:
    """Escape ``s`` so Java regex matches it literally (no \\Q..\\E pitfalls)."""
    out = []
    for ch in s:
        if ch.isascii() and not ch.isalnum():
            out.append("\\" + ch)
        else:
            out.append(ch)
    return "".join(out)


def trie_alternation(words: Iterable[str]) -> str:
    """The same alternation factored into a prefix trie.

    ``java.util.regex`` tries alternatives one by one at every position; a
    trie shares prefixes (``new (?:hampshire|jersey|...)``), so each position
    costs one branch per character instead of one per word.  Backtracking
    still explores every branch, so whether a match exists — all the
    callers ask — is unchanged.
    """
    trie: dict = {}
    for w in words:
        node = trie
        for ch in w:
            node = node.setdefault(ch, {})
        node[""] = {}

    def build(node: dict) -> str:
        end = "" in node
        alts = [java_regex_literal(ch) + build(node[ch]) for ch in sorted(k for k in node if k != "")]
        if not alts:
            return ""
        body = alts[0] if len(alts) == 1 and not end else "(?:" + "|".join(alts) + ")"
        return f"(?:{body})?" if end else body

    return build(trie)


def slugify(col: Column | str) -> Column:
    """Output-folder slug: lower case, space -> '-', '&' -> 'and'."""
    c = F.col(col) if isinstance(col, str) else col
    return F.replace(F.replace(F.lower(c), F.lit(" "), F.lit("-")), F.lit("&"), F.lit("and"))
