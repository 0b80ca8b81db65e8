"""Python regular expressions in Java syntax.

The pattern is parsed with Python's own parser and written out again node by
node, so every construct keeps its Python meaning whatever the two dialects'
spellings are.  What Java cannot express raises ``ValueError``.  The result is
meant for matching with the flags ``(?iud)``: Unicode case folding, and ``\\n``
as the only line end.
"""

from __future__ import annotations

import re
from re import _constants as C
from re import _parser

# Members of Python's \s and \w, as Java class content.
_SPACE = r"\t\n\x{0b}\f\r\x{1c}-\x{1f}\x{85}\p{Z}"
_WORD = r"\p{L}\p{N}_"
_CATEGORY = {
    C.CATEGORY_DIGIT: r"\p{Nd}", C.CATEGORY_NOT_DIGIT: r"\P{Nd}", C.CATEGORY_SPACE: _SPACE, C.CATEGORY_NOT_SPACE: f"[^{_SPACE}]",
    C.CATEGORY_WORD: _WORD, C.CATEGORY_NOT_WORD: f"[^{_WORD}]",
}
_W = f"[{_WORD}]"
_AT = {
    C.AT_BEGINNING_STRING: r"\A", C.AT_END_STRING: r"\z", C.AT_BEGINNING: "^", C.AT_END: "$",
    C.AT_BOUNDARY: rf"(?:(?<={_W})(?!{_W})|(?<!{_W})(?={_W}))", C.AT_NON_BOUNDARY: rf"(?:(?<={_W})(?={_W})|(?<!{_W})(?!{_W}))",
}


def _char(code: int) -> str:
    return chr(code) if chr(code).isalnum() and code < 128 else f"\\x{{{code:x}}}"


class _Writer:
    def __init__(self, groups_before: int, flags: int):
        self.offset, self.flags = groups_before, flags

    def seq(self, nodes) -> str:
        return "".join(self.node(op, arg) for op, arg in nodes)

    def members(self, items) -> tuple[bool, str]:
        negated, out = False, []
        for op, arg in items:
            if op is C.NEGATE:
                negated = True
            elif op is C.LITERAL:
                out.append(_char(arg))
            elif op is C.RANGE:
                out.append(f"{_char(arg[0])}-{_char(arg[1])}")
            elif op is C.CATEGORY and arg in _CATEGORY:
                out.append(_CATEGORY[arg])
            else:
                raise ValueError(f"no Java form of a class with {op}")
        return negated, "".join(out)

    def repeat(self, arg, suffix: str) -> str:
        low, high, sub = arg
        high = "" if high is C.MAXREPEAT else str(high)
        return f"(?:{self.seq(sub)}){{{low},{high}}}{suffix}"

    def node(self, op, arg) -> str:
        if op is C.LITERAL:
            return _char(arg)
        if op is C.NOT_LITERAL:
            return f"[^{_char(arg)}]"
        if op is C.ANY:
            return r"[\x{0}-\x{10ffff}]" if self.flags & re.DOTALL else r"[^\n]"
        if op is C.IN:
            negated, body = self.members(arg)
            # Java's rules for negating a union of classes differ; a lookahead has none
            return rf"(?:(?![{body}])[\x{{0}}-\x{{10ffff}}])" if negated else f"[{body}]"
        if op is C.BRANCH:
            return "(?:" + "|".join(self.seq(b) for b in arg[1]) + ")"
        if op is C.SUBPATTERN:
            group, add, remove, sub = arg
            if (add | remove) & ~re.IGNORECASE:
                raise ValueError("no Java form of an inline flag")
            switch = ("i" if add else "") + ("-i" if remove else "")
            body = f"(?{switch}:{self.seq(sub)})" if switch else self.seq(sub)
            return f"({body})" if group else f"(?:{body})"
        if op is C.MAX_REPEAT:
            return self.repeat(arg, "")
        if op is C.MIN_REPEAT:
            return self.repeat(arg, "?")
        if op is C.POSSESSIVE_REPEAT:
            return self.repeat(arg, "+")
        if op is C.ATOMIC_GROUP:
            return f"(?>{self.seq(arg)})"
        if op in (C.ASSERT, C.ASSERT_NOT):
            direction, sub = arg
            return "(?" + ("<" if direction < 0 else "") + ("=" if op is C.ASSERT else "!") + self.seq(sub) + ")"
        if op is C.GROUPREF:
            return f"(?:\\{arg + self.offset})"
        if op is C.AT and arg in _AT:
            return ("(?m:" + _AT[arg] + ")") if arg in (C.AT_BEGINNING, C.AT_END) and self.flags & re.MULTILINE else _AT[arg]
        raise ValueError(f"no Java form of {op}")


def to_java(pattern: str, groups_before: int = 0) -> str:
    """The pattern in Java syntax; ``groups_before`` capturing groups stand before it."""
    try:
        tree = _parser.parse(pattern)
    except re.error as e:
        raise ValueError(f"not a Python regular expression: {pattern!r}: {e}") from e
    if tree.state.flags & (re.ASCII | re.LOCALE):
        raise ValueError("no Java form of the flags a and L")
    return _Writer(groups_before, tree.state.flags).seq(tree)


def alternation(patterns: list[str]) -> str:
    """One case-insensitive Java pattern that matches where any Python pattern does."""
    parts, groups = [], 0
    for p in patterns:
        parts.append(f"(?:{to_java(p, groups)})")
        groups += re.compile(p).groups
    return "(?iud)" + "|".join(parts)
