"""Quality score, URL dedup, suffix strip, exact title dedup."""

import datetime as dt
import random

from helpers import greedy_title_dedup, strip_suffix
from newsfunnel.operators.titledup import dedup_by_title, similar_pairs, strip_source_suffix
from newsfunnel.operators.urldedup import dedup_by_url

SCHEMA = ("ord long, title string, url string, source string, date timestamp_ntz, language string, state string, "
          "district string, search_term string, full_text string")


def art(o, title="T", url="https://example.com/a", text=None, lang="en", district=None, source="src"):
    return (o, title, url, source, dt.datetime(2026, 2, 1), lang, "Bihar", district, "heat", text)


def test_url_dedup_rules(spark):
    rows = [
        art(1, url="https://example.com/same", text="Short text"),
        art(2, url="https://example.com/same", text="This is a much longer full text for the article"),
        art(3, url="https://example.com/article?utm_source=twitter", text="Full text here"),
        art(4, url="https://www.example.com/article/?utm_source=fb", text="Full text here"),  # tie: earlier kept
        art(5, url="https://example.com/n", text=None),
        art(6, url="https://example.com/n", text=""),  # non-null text beats null
        art(7, url="https://example.com/one"), art(8, url="https://example.com/two"),
    ]
    out = {r.ord: r for r in dedup_by_url(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert sorted(out) == [1, 3, 5, 7, 8]  # survivor takes the first occurrence's position
    assert out[1].full_text.startswith("This is a much longer")
    assert out[3].url.endswith("twitter")
    assert out[5].full_text == ""


def test_strip_suffix(spark):
    titles = ["Heatwave in Delhi - NDTV", "Heatwave in Delhi", "Heatwave - " + "A" * 41, "a - b - c", " - x", "x - "]
    df = spark.createDataFrame([(t,) for t in titles], "t string")
    got = [r.s for r in df.select(strip_source_suffix("t").alias("s")).collect()]
    assert got == [strip_suffix(t) for t in titles]


def test_title_dedup_language_buckets(spark):
    rows = [
        art(1, "Heatwave grips Delhi as mercury soars", "u1", "x", "en"),
        art(2, "Heatwave grips Delhi as mercury soars", "u2", "x", "hi"),  # other language: kept
        art(3, "Heatwave grips Delhi as mercury soars!", "u3", "much longer text", "en"),  # near: replaces 1
        art(4, "Completely unrelated cricket score", "u4", "y", "en"),
    ]
    out = sorted((r.ord, r.url) for r in dedup_by_title(spark.createDataFrame(rows, SCHEMA)).collect())
    assert out == [(1, "u3"), (2, "u2"), (4, "u4")]


def test_title_dedup_matches_brute_force(spark):
    rnd = random.Random(3)
    words = ["heat", "wave", "delhi", "city", "hot", "day", "rain", "mercury", "alert", "red"]
    base = [" ".join(rnd.choice(words) for _ in range(rnd.randint(2, 7))) for _ in range(25)]
    rows = []
    for o in range(220):
        t = rnd.choice(base)
        if rnd.random() < 0.5:  # small edits
            i = rnd.randrange(len(t) + 1)
            t = t[:i] + rnd.choice("xyz ") + t[i:]
        if rnd.random() < 0.3:
            t += " - " + rnd.choice(["NDTV", "Times", "A" * 45])
        text = None if rnd.random() < 0.3 else "t" * rnd.randint(0, 5)
        rows.append(art(o, t, f"u{o}", text, rnd.choice(["en", "hi"]), rnd.choice([None, "D"]),
                        rnd.choice(["s", "Unknown"])))
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r.ord, int(r.url[1:])) for r in dedup_by_title(df).collect())
    cols = ["ord", "title", "url", "source", "date", "language", "state", "district", "search_term", "full_text"]
    expect = greedy_title_dedup([dict(zip(cols, r)) for r in rows])
    assert got == expect


def test_pairs_on_the_length_bound(spark):
    """For every length the shortest partner that can still reach 0.85, and the next shorter one."""
    from difflib import SequenceMatcher

    rnd = random.Random(4)
    rows, want = [], set()
    for n in range(12, 500):
        a = "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz 0123456789") for _ in range(n))
        m = min(m for m in range(1, n + 1) if 2.0 * m / (n + m) >= 0.85)
        rows += [(str(n), a, 10 * n), (str(n), a[:m], 10 * n + 1), (str(n), a[:m - 1], 10 * n + 2)]
        for x, y, i, j in ((a, a[:m], 0, 1), (a, a[:m - 1], 0, 2), (a[:m], a[:m - 1], 1, 2)):
            if max(SequenceMatcher(None, x, y).ratio(), SequenceMatcher(None, y, x).ratio()) >= 0.85:
                want.add((10 * n + i, 10 * n + j))
    got = similar_pairs(spark.createDataFrame(rows, "lang string, tkey string, rep_id long"))
    assert {(r.a, r.b) for r in got.collect()} == want and (690, 691) in want


def test_title_chain_longer_than_a_hundred(spark):
    """Each title is like its neighbours only; the loop is replayed over one long component."""
    rnd = random.Random(8)
    text = "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(700))
    rows = [art(o, text[3 * o:3 * o + 30], f"u{o}", "t" * (o % 7)) for o in range(150)]
    got = sorted((r.ord, int(r.url[1:])) for r in dedup_by_title(spark.createDataFrame(rows, SCHEMA)).collect())
    cols = ["ord", "title", "url", "source", "date", "language", "state", "district", "search_term", "full_text"]
    assert got == greedy_title_dedup([dict(zip(cols, r)) for r in rows])


def test_url_dedup_plan_and_extreme_positions(spark):
    rows = [art(2 ** 62, "a", "https://e.com/x", "tt"), art(-2 ** 62, "b", "https://www.e.com/x/", "tt"), art(0, "c", "https://e.com/x#f", "t" * 100_000),
            art(5, "d", None, "t"), art(6, "e", "https://e.com/y")]
    out = dedup_by_url(spark.createDataFrame(rows, SCHEMA))
    got = sorted((r.ord, r.title) for r in out.collect())
    assert (-2 ** 62, "c") in got and (6, "e") in got and len(got) in (2, 3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan and "max_by" not in plan
    same = [art(k, f"t{k}", "https://e.com/same", "same text") for k in range(50)]
    assert [(r.ord, r.title) for r in dedup_by_url(spark.createDataFrame(same, SCHEMA)).collect()] == [(0, "t0")]


def test_titles_are_bounded_many_at_once(monkeypatch):
    """Titles of one make-up pass the counts; their common subsequences are found on arrays, not pair by pair."""
    import numpy as np
    from newsfunnel.operators import titledup as T

    rnd = random.Random(12)
    titles = ["".join(rnd.choice("abcdefgh éß中") for _ in range(rnd.choice((63, 64, 65, 150, 160)))) for _ in range(60)]
    for t in titles[:40]:
        x = list(t)
        for _ in range(len(x) // rnd.choice((6, 12, 20))):
            x[rnd.randrange(len(x))] = rnd.choice("abcdefgh xyz")
        titles.append("".join(x))
    i, j = np.nonzero(np.triu(np.ones((100, 100)), 1))
    want = [T.lcs_length(titles[p], titles[q]) for p, q in zip(i, j)]
    assert T.lcs_lengths(titles, titles, i, j, np.zeros(len(i), np.int64)).tolist() == want
    ids = list(range(100))
    found = list(T._block_pairs(ids, titles, ids, titles, True, 0.85))
    from difflib import SequenceMatcher

    brute = {(p, q) for p, q in zip(i.tolist(), j.tolist())
             if max(SequenceMatcher(None, titles[p], titles[q]).ratio(), SequenceMatcher(None, titles[q], titles[p]).ratio()) >= 0.85}
    assert {(a, b) for a, b, _, _ in found} == brute and brute
    monkeypatch.setattr(T, "lcs_length", lambda *_: 1 / 0)
    assert list(T._block_pairs(ids, titles, ids, titles, True, 0.85)) == found


def test_a_hopeless_pair_is_left_at_its_beginning():
    """With ``least`` the common subsequence of long titles is not followed to their ends; blocks of other lengths agree with brute force."""
    from difflib import SequenceMatcher
    from newsfunnel.operators import titledup as T

    class Counted(str):
        read = 0

        def __iter__(self):
            for c in str.__iter__(self):
                Counted.read += 1
                yield c

    rnd = random.Random(21)
    a, b = (Counted("".join(rnd.choice("abcdefghijklmnop") for _ in range(4000))) for _ in range(2))
    assert T.lcs_length(a, b, 3400) == 0 and Counted.read < 4000 + 2500
    assert T.lcs_length(a, a, 3400) == 4000 and T.lcs_length(a, a[:3500], 3400) == 3500
    titles = ["", "a"] + ["".join(rnd.choice("abcdé中 ") for _ in range(n)) for n in (5, 9, 40, 63, 126, 127, 300, 1023, 1030, 1100) for _ in range(4)]
    titles += [t[:len(t) // 2] + "zz" + t[len(t) // 2 + len(t) // 9:] for t in titles[2:]]
    ids = list(range(len(titles)))
    found = {(p, q) for p, q, _, _ in T._block_pairs(ids[1::2], titles[1::2], ids[::2], titles[::2], False, 0.85)}
    found |= {(p, q) for k in (0, 1) for p, q, _, _ in T._block_pairs(ids[k::2], titles[k::2], ids[k::2], titles[k::2], True, 0.85)}
    want = {(p, q) for p in ids for q in ids[p + 1:]
            if 2.3 * min(len(titles[p]), len(titles[q])) >= 0.85 * (len(titles[p]) + len(titles[q]))
            and max(SequenceMatcher(None, titles[x], titles[y]).ratio() for x, y in ((p, q), (q, p))) >= 0.85}
    assert found == want and len(want) > 12


def test_ratios_of_titles_are_found_on_bits(monkeypatch):
    """The ratio is difflib's, whatever repeats or is tied, but below 200 characters not from its loop over places."""
    import difflib

    from newsfunnel.operators import titledup as T

    rnd, pairs = random.Random(31), [("", ""), ("a", ""), ("", "a"), ("tide", "diet"), ("diet", "tide")]
    for n in (1, 7, 8, 9, 63, 64, 65, 150, 198, 199, 200, 230):
        for letters in ("ab", "abc é中", "abcdefghijklmnop "):
            x = [rnd.choice(letters) for _ in range(n)]
            y = list(x)
            for _ in range(n // 8 + 1):
                y[rnd.randrange(n)] = rnd.choice(letters + "z")
            y[n // 3:n // 2] = []
            pairs += [("".join(x), "".join(y)), ("".join(y), "".join(x)), ("".join(x), "".join(reversed(y)))]
    want = [difflib.SequenceMatcher(None, x, y).ratio() for x, y in pairs]
    titles = sorted({t for p in pairs for t in p if 7 <= len(t) < 200})
    ids = list(range(len(titles)))
    brute = {(p, q): (difflib.SequenceMatcher(None, titles[p], titles[q]).ratio(), difflib.SequenceMatcher(None, titles[q], titles[p]).ratio())
             for p in ids for q in ids[p + 1:]}
    brute = {(p, q, *r) for (p, q), r in brute.items() if max(r) >= 0.85}
    with monkeypatch.context() as m:
        m.setattr(difflib, "SequenceMatcher", None)
        assert set(T._block_pairs(ids, titles, ids, titles, True, 0.85)) == brute and len(brute) > 4
    assert [T.matching_ratio(x, y) for x, y in pairs] == want


def test_long_titles_of_the_same_words_are_left_by_their_grams(monkeypatch):
    """Titles of 200 characters or more have few matching blocks, as difflib leaves out popular characters: those of the same
    words in other orders go before any common subsequence is sought."""
    from difflib import SequenceMatcher
    from newsfunnel.operators import titledup as T

    rnd = random.Random(33)
    words = ["".join(rnd.choice("aeinorst") for _ in range(rnd.randint(2, 9))) for _ in range(50)]
    titles = [" ".join(rnd.sample(words, 50)) for _ in range(30)]
    assert min(map(len, titles)) >= 200
    ids = list(range(30))
    with monkeypatch.context() as m:
        m.setattr(T, "_coded", lambda *_: 1 / 0)
        assert list(T._block_pairs(ids, titles, ids, titles, True, 0.85)) == []
    # on both sides of 200 characters, with few and many popular characters, long repeats and far counts
    titles += [titles[0][:n] for n in (185, 199, 200, 201)] + ["es " * 70, "es " * 66, "es " * 90, "x" + "es " * 70, "se " * 70]
    for t in list(titles[:12]) + ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz0123456789 éß中") for _ in range(n)) for n in (190, 199, 205, 400, 1100)]:
        for _ in range(3):
            x = list(t)
            for _ in range(rnd.choice((2, len(x) // 12, len(x) // 7))):
                k = rnd.randrange(len(x))
                x[k:k + rnd.randrange(3)] = rnd.choice(("", "q", "es "))
            titles += [t, "".join(x)]
    titles = sorted(set(titles), key=lambda _: rnd.random())
    ids = list(range(len(titles)))
    ratio = lambda p, q: SequenceMatcher(None, titles[p], titles[q]).ratio()
    brute = {(p, q, ratio(p, q), ratio(q, p)) for p in ids for q in ids[p + 1:]
             if 2.3 * min(len(titles[p]), len(titles[q])) >= 0.85 * (len(titles[p]) + len(titles[q])) and max(ratio(p, q), ratio(q, p)) >= 0.85}
    assert set(T._block_pairs(ids, titles, ids, titles, True, 0.85)) == brute and len(brute) > 15


def test_titles_are_read_once_for_their_pairs(spark):
    """The pairs read written titles: neither the documents nor their join is in the plan again."""
    from newsfunnel.plans.catalog import QUERIES

    plan = QUERIES["title_similar_pairs"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "split_part" not in plan and "event_id" not in plan
