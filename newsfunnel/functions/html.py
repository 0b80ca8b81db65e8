"""Main text and title of one HTML page: a small helper for the workers.

Linear in the page, whatever its markup: one scan for comments and raw elements, one
for container tags, one over what is kept.

Containers are matched by a stack for each tag.  An end tag closes the last open start tag
of its name, so a container ends at its own end tag and not at the first inner one.  Start
tags without an end hide nothing (an open ``<nav>`` does not swallow the page), except
that ``article`` and ``main`` reach to the end of the page; stray end tags do nothing.

* precision: all outermost ``article`` elements, else all outermost ``main`` elements, without
  the tables, navigation, asides, headers, footers and forms inside them;
* recall, where that gives no text: the body (else the page) without navigation, asides,
  headers, footers and forms.

A removed container and every block tag end a line; other tags, comments, scripts and styles
leave nothing.  Character references follow HTML's own rules in one pass (``html.unescape``):
decimal and hexadecimal, the Windows-1252 ones, names with and without a semicolon.
"""

from __future__ import annotations

import ctypes
import html as _html
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from newsfunnel.functions.workers import ship_by_value

_BOXES = ("article", "main")
_HIDDEN = ("head", "noscript", "template", "svg")
_FRAME = ("nav", "aside", "header", "footer", "form")
_CONTAINER = re.compile(r"<(/?)(" + "|".join((*_BOXES, *_HIDDEN, *_FRAME, "table", "body")) + r")\b[^<>]*>", re.I)
_RAW = re.compile(r"<!--|<(script|style)\b", re.I)
_RAW_END = {t: re.compile(rf"</{t}\b[^<>]*>", re.I) for t in ("script", "style")}
_BREAK = re.compile(r"</?(?:p|div|br|h[1-6]|li|ul|ol|tr|td|th|table|thead|tbody|section|article|main|blockquote|pre|"
                    r"header|footer|nav|aside|figure|figcaption|dd|dt|dl|hr|form|title)\b[^<>]*>", re.I)
_TAG = re.compile(r"<[/!?a-zA-Z][^<>]*>")
_BLANKS = re.compile(r"[^\S\n]+")
_TITLE = re.compile(r"<title\b[^<>]*>", re.I)
_TITLE_END = re.compile(r"</title\b", re.I)


def _without_raw(page: str) -> str:
    """The page without comments, scripts and styles; one that is never closed stays."""
    out, at, closed = [], 0, {"": True, "script": True, "style": True}
    m = _RAW.search(page)
    while m:
        kind = (m.group(1) or "").lower()
        end = -1
        if closed[kind]:
            if kind:
                e = _RAW_END[kind].search(page, m.end())
                end = e.end() if e else -1
            else:
                end = page.find("-->", m.end())
                end = end + 3 if end >= 0 else -1
            closed[kind] = end >= 0
        if end < 0:
            out.append(page[at:m.end()])
            at = m.end()
        else:
            out.append(page[at:m.start()])
            at = end
        m = _RAW.search(page, at)
    out.append(page[at:])
    return "".join(out)


def _containers(page: str) -> tuple[dict, dict]:
    """tag -> matched (start, inner start, inner end, end) and tag -> open ones (start, inner start)."""
    spans: dict[str, list] = {}
    waiting: dict[str, list] = {}
    for m in _CONTAINER.finditer(page):
        tag = m.group(2).lower()
        if not m.group(1):
            waiting.setdefault(tag, []).append((m.start(), m.end()))
        elif waiting.get(tag):
            spans.setdefault(tag, []).append((*waiting[tag].pop(), m.start(), m.end()))
        elif tag == "body":
            spans.setdefault(tag, []).append((None, None, m.start(), m.end()))
    return spans, waiting


def _outermost(spans: list) -> list:
    out: list = []
    for s in sorted(spans):
        if not out or s[0] >= out[-1][3]:
            out.append(s)
    return out


def _text(page: str, boxes: list, noise: list) -> str:
    """Text of the boxes (inner start, inner end) without the noise spans that start in them."""
    parts, k = [], 0
    for start, end in boxes:
        at = start
        while k < len(noise) and noise[k][0] < start:
            k += 1
        while k < len(noise) and noise[k][0] < end:
            if noise[k][0] >= at:
                parts.append(page[at:noise[k][0]])
                at = min(noise[k][3], end)
            k += 1
        parts.append(page[at:end])
    flat = _TAG.sub("", _BREAK.sub("\n", "\n".join(parts)))
    lines = (x.strip() for x in _BLANKS.sub(" ", _html.unescape(flat)).split("\n"))
    return "\n".join(x for x in lines if x)


def main_text(page: str) -> str | None:
    page = _without_raw(page)
    spans, waiting = _containers(page)
    hidden = [s for t in _HIDDEN for s in spans.get(t, ())]
    frame = hidden + [s for t in _FRAME for s in spans.get(t, ())]
    for tag in _BOXES:
        found = spans.get(tag, []) + [(a, b, len(page), len(page)) for a, b in waiting.get(tag, ())]
        if found:
            text = _text(page, [s[1:3] for s in _outermost(found)], sorted(frame + spans.get("table", [])))
            if text:
                return text
            break
    bodies = sorted((s for s in spans.get("body", ()) if s[0] is not None)) or [(a, b, len(page), len(page)) for a, b in waiting.get("body", ())][:1]
    box = (bodies[0][1], max(s[2] for s in [*spans.get("body", ()), bodies[0]])) if bodies else (0, len(page))
    return _text(page, [box], sorted(frame)) or None


def title_text(page: str) -> str | None:
    m = _TITLE.search(page)
    end = _TITLE_END.search(page, m.end()) if m else None
    if not end:
        return None
    return re.sub(r"\s+", " ", _html.unescape(_TAG.sub("", page[m.end():end.start()]))).strip() or None


PART = 1 << 20  # bytes of pages that are Python strings at once


def _parts(pages: pa.Array):
    """Slices of about ``PART`` bytes (a longer page is alone)."""
    size = np.asarray(pc.fill_null(pc.binary_length(pages), 0).to_numpy(zero_copy_only=False), np.int64)
    upto, at = np.concatenate([[0], np.cumsum(size)]), 0
    while at < len(pages):
        end = max(at + 1, int(np.searchsorted(upto, upto[at] + PART, "right")) - 1)
        yield pages.slice(at, end - at)
        at = end


def _texts(pages: pa.Array, of) -> pa.Array:
    """``of`` each page; beside the batch's own bytes a worker holds one part as strings, whatever the
    batch, and gives back what it freed."""
    out = [pa.array([None if p is None else of(p) for p in part.to_pylist()], pa.string()) for part in _parts(pages)]
    whole = pa.concat_arrays(out) if out else pa.array([], pa.string())
    del out
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library
    return whole


def main_texts(pages: pa.Array) -> pa.Array:
    return _texts(pages, main_text)


def title_texts(pages: pa.Array) -> pa.Array:
    return _texts(pages, title_text)


ship_by_value(__name__)
