"""HTML extraction, cleaning rules, length/boilerplate/geo checks."""

import pytest
from newsfunnel.operators import extract as X


def one(spark, expr, **cols):
    names = list(cols)
    df = spark.createDataFrame([tuple(cols[n] for n in names)], ", ".join(f"{n} string" for n in names))
    return df.select(expr.alias("v")).first().v


CLEAN_CASES = [
    ("- Home\n- News\n- Delhi\nHeat grips the city.", "Heat grips the city."),
    # a removed line leaves its neighbours' line breaks: the text becomes two paragraphs
    ("Heat grips the city.\nAlso Read: Monsoon delayed\nMore text.", "Heat grips the city.\n\nMore text."),
    ("Heat grips the city.\nये भी पढ़ें: खबर\nMore text.", "Heat grips the city.\n\nMore text."),
    ("Heat grips the city.\nDownload the app for updates\nMore.", "Heat grips the city.\n\nMore."),
    ("Heat grips the city.\nऐप डाउनलोड करें अभी\nMore.", "Heat grips the city.\n\nMore."),
    ("Heat grips the city.\n© 2024 Some Media Ltd\nAll rights", "Heat grips the city."),
    ("Heat grips the city.\nRelated News\nOne\nTwo\nThree", "Heat grips the city."),
    ("A\n\n\n\n\nB", "A\n\nB"),
    ("Para one.\n\nPara two.\n\npara ONE.\n\n  Para one.  ", "Para one.\n\nPara two."),
    ("Clean text stays as it is.", "Clean text stays as it is."),
]


@pytest.mark.parametrize("raw,expected", CLEAN_CASES)
def test_clean_text(spark, raw, expected):
    assert one(spark, X.clean_text("t"), t=raw) == expected


def test_short_and_boilerplate(spark):
    assert one(spark, X.short_text_discard("t"), t="x" * 99) is None
    assert one(spark, X.short_text_discard("t"), t="  " + "x" * 100 + "  ") is not None
    assert one(spark, X.is_boilerplate("t"), t="Please read our Privacy Policy") is True
    assert one(spark, X.is_boilerplate("t"), t="Privacy Policy " + "x" * 500) is False
    assert one(spark, X.is_boilerplate("t"), t="Heat wave in Delhi") is False


@pytest.mark.parametrize("title,text,out", [
    ("Heatwave in Texas", None, True),
    ("Heat in Delhi", "Unlike Texas, Delhi...", True),
    ("Heat in Delhi", "x" * 1500 + " Texas", False),  # beyond the first 1500 chars
    ("Texan heat", None, False),  # whole words only
    ("Rain in u.s.military base", None, True),
    ("Rain in the U.S. today", None, False),  # '\b' after '.' needs a word char
    ("Mumbai heat, Pakistan also hot", None, True),
])
def test_out_of_region(spark, title, text, out):
    assert one(spark, X.is_out_of_region("title", "text"), title=title, text=text) is out


def test_html_precision_and_recall(spark):
    html = ("<html><head><title>T &amp; U</title><script>var t=\"</p>\";</script></head><body>"
            "<nav><ul><li>Home</li></ul></nav><!-- ad --><article><h1>Head</h1><p>One &copy; two &#233; &#x263A;</p>"
            "<table><tr><td>cell</td></tr></table><p>Three</p></article><footer>foot</footer></body></html>")
    assert one(spark, X.main_text("h"), h=html) == "Head\nOne © two é ☺\nThree"
    assert one(spark, X.page_title("h"), h=html) == "T & U"
    no_article = "<html><body><nav>menu</nav><div>Body text</div><table><tr><td>cell</td></tr></table></body></html>"
    assert one(spark, X.main_text("h"), h=no_article) == "Body text\ncell"
    assert one(spark, X.main_text("h"), h="<html><body><nav>only nav</nav></body></html>") is None


def test_all_articles_nested_ones_and_entities(spark):
    from newsfunnel.operators.extract import main_text

    pages = {
        "<body><article><p>one</p></article><p>between</p><article>two</article></body>": "one\ntwo",
        "<article>outer <article>inner</article> tail</article> rest": "outer\ninner\ntail",
        "<article>a</article></article><p>b</p><article>c": "a\nc",
        "<main>m</main>": "m",
        "<main>m</main>x<main>n</main>": "m\nn",
        "<article>caf&eacute; &euro;5 &#00000039;q&#x000027; &amp;lt; &zznope; &ngE;</article>": "café €5 'q' &lt; &zznope; ≧̸",
        # one pass over the references, by HTML's own table
        "<article>&#38;lt;b &#x26;amp; &#128; &copy x &#9999999999;</article>": "&lt;b &amp; € © x \ufffd",
        "<article>a<table>x<table>y</table>OUTER TAIL</table>b</article>": "a\nb",
        "<body>a<nav>n<nav>i</nav>t</nav>b</body>": "a\nb",
        "<p>a<nav>open <p>b": "a\nopen\nb",
        "<p>3 < 4 and 5 > 2</p>": "3 < 4 and 5 > 2",
        "<div>a<script>if (x </p>) </script>b<!-- <article>no</article> --></div>": "ab",
        "": None,
    }
    df = spark.createDataFrame(list(enumerate(pages)), "i int, h string")
    got = {r.i: r.t for r in df.select("i", main_text("h").alias("t")).collect()}
    assert [got[i] for i in range(len(pages))] == list(pages.values())


def test_bad_markup_is_linear():
    """Twenty thousand of anything takes about as long as reading it."""
    import time

    from newsfunnel.functions.html import main_text, title_text

    for junk in ("<nav>", "<nav ", "<!--", "<script>", "<article>x", "</nav>", "<" * 10, "&" * 10, "<table></nav>", "<title>", "<body>"):
        began = time.perf_counter()
        main_text(junk * 20_000)
        title_text(junk * 20_000)
        assert time.perf_counter() - began < 3, junk
    assert main_text("<table>" * 20_000 + "x" + "</table>" * 20_000 + "y") == "x\ny"
    assert main_text("<nav>" * 20_000 + "x" + "</nav>" * 20_000 + "y") == "y"


def test_containers_against_a_tree():
    """Random nesting, well formed: the text outside the removed containers, by a plain recursive walk."""
    import random

    from newsfunnel.functions.html import main_text

    rnd = random.Random(17)

    def node(depth):
        if depth == 0 or rnd.random() < 0.3:
            return f" w{rnd.randrange(1000)} "
        return (rnd.choice(["div", "nav", "p", "table", "aside", "span", "article", "main"]), [node(depth - 1) for _ in range(rnd.randrange(4))])

    def markup(n):
        return n if isinstance(n, str) else f"<{n[0]} x='1'>" + "".join(map(markup, n[1])) + f"</{n[0].upper()} >"

    def words(n, drop):
        return [n.strip()] if isinstance(n, str) else [] if n[0] in drop else [w for c in n[1] for w in words(c, drop)]

    def boxes(n, tag):
        return [] if isinstance(n, str) else [n] if n[0] == tag else [b for c in n[1] for b in boxes(c, tag)]

    for _ in range(400):
        top = ("body", [node(5) for _ in range(3)])
        want = []
        for tag in ("article", "main"):
            found = boxes(top, tag)
            if found:
                want = [w for b in found for c in b[1] for w in words(c, {"table", "nav", "aside"})]
                break
        if not want:
            want = [w for c in top[1] for w in words(c, {"nav", "aside"})]
        assert (main_text(markup(top)) or "").split() == want


def test_two_hundred_thousand_paragraphs(spark):
    import time

    texts = ["\n\n".join(f"Para {i % 90_000}" for i in range(200_000)), "\n\n".join(["same"] * 200_000), "\n\n".join(f" P{i} " for i in range(50_000)) + "\n\n\n\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    began = time.perf_counter()
    got = {r.i: r.d for r in df.select("i", X.paragraph_dedup("t").alias("d")).collect()}
    assert time.perf_counter() - began < 30
    assert got == {0: "\n\n".join(f"Para {i}" for i in range(90_000)), 1: "same", 2: "\n\n".join(f" P{i} " for i in range(50_000))}


def test_pages_of_a_batch_are_read_in_parts(monkeypatch):
    """A batch of any size: the worker makes strings of about one part of it at a time."""
    import pyarrow as pa
    from newsfunnel.functions import html

    pages = [None, "", *(f"<article>{k} {'x' * k}</article>" for k in range(200)), "<main>" + "y" * 5000 + "</main>", None]
    monkeypatch.setattr(html, "PART", 1000)
    parts = [p for p in html._parts(pa.array(pages))]
    assert [x for p in parts for x in p.to_pylist()] == pages
    assert all(len(p) == 1 or sum(len(x or "") for x in p.to_pylist()) <= 1000 for p in parts) and len(parts) > 20
    assert html.main_texts(pa.array(pages)).to_pylist() == [None if p is None else html.main_text(p) for p in pages]
    assert html.title_texts(pa.array([], pa.string())).to_pylist() == []
