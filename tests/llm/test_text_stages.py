import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import AWKWARD, docs_frame, edited, prose

from newsfunnel.llm import decontam, linedup, pii, toxicity


def test_line_dedup_against_a_loop(spark):
    rnd = random.Random(6)
    shared = [[prose(rnd, 6) for _ in range(8)] for _ in range(3)]
    long_line = prose(rnd, 60)
    rows = list(AWKWARD)
    for n in range(60):
        lines = [prose(rnd, 6) for _ in range(rnd.randint(0, 12))]
        at = rnd.randint(0, len(lines))
        if n % 3 == 0:
            lines[at:at] = shared[n % 9 // 3]
        if n % 7 == 0:
            lines.insert(at, long_line)
        rows.append((n, "\n".join(lines)))
    rows += [(200, rows[-1][1]), (201, "single repeated line"), (202, "single repeated line")]
    got = linedup.dedup_lines(docs_frame(spark, rows, h=1, at=2, body="b")).collect()
    seen, want = {}, []
    for i, t in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        cuts = []
        for at, n, body in linedup.chunks(t) if t else ():
            if body in seen:
                cuts.append((at, n))
            seen[body] = i
        want.append((i, linedup.without_lines(t, cuts) if cuts else t, sum(n for _, n in cuts)))
    assert sorted({(r.doc_id, r.text, r.removed_lines) for r in got}, key=str) == sorted(want, key=str)
    assert len(got) == len(rows) and "body" in got[0]
    by = {r.doc_id: r for r in got}
    assert by[202].removed_lines == 0  # one short line is no passage
    assert sum(long_line in (r.text or "") for r in got) == 1
    assert linedup.dedup_lines(docs_frame(spark, [])).count() == 0


def test_short_passages_go_against_all_repeated_runs(spark):
    rnd = random.Random(21)
    passages = [[prose(rnd, w) for w in ws] for ws in ((30, 30), (25, 25), (20, 20, 20), (30, 60, 5), (17,) * 4, (49, 1), (24, 25))]
    passages.append([passages[0][0], "", "  ", passages[0][1], ""])
    loop = prose(rnd, 30)
    rows = [(500, "\n".join([loop] * 5)), (501, "\n".join(["", ""] * 40 + passages[1])), (502, "\n".join(["", ""] * 40 + passages[1]))]
    for n in range(80):
        lines = [prose(rnd, rnd.choice((0, 6, 12, 30))) for _ in range(rnd.randint(0, 9))]
        for p in rnd.sample(passages, 2):
            at = rnd.randint(0, len(lines))
            lines[at:at] = p
        rows.append((n, "\n".join(lines)))
    got = {r.doc_id: (r.text, r.removed_lines) for r in linedup.dedup_lines(docs_frame(spark, rows)).collect()}
    seen, again = {}, {}
    for i, t in sorted(rows):
        lines = t.split("\n")
        gone = again[i] = set()
        for at, n, body in linedup.chunks(t):
            if seen.setdefault(body, (i, at)) != (i, at):
                gone.update(range(at, at + n))
        for a in range(len(lines)):
            for e in range(a + 1, len(lines) + 1):
                body = "\n".join(lines[a:e])
                if len(body.split()) >= linedup.LONG_LINE:
                    j, b = seen.setdefault(("run", body), (i, a))
                    if j != i or b + e - a <= a:
                        gone.update(range(a, e))
    for i, t in rows:
        assert got[i] == ("\n".join(x for k, x in enumerate(t.split("\n")) if k not in again[i]), len(again[i])), i
    assert got[500] == ("\n".join([loop] * 2), 3)


def test_many_blank_lines_take_linear_time():
    lines = [""] * 20000 + ["w " * 60] + [" "] * 20000
    spans = list(zip(*(x.tolist() for x in linedup.runs(lines)[:2])))
    assert len(spans) == 40001 and len(set(linedup.run_digests(lines, spans).values())) == 40001


def test_chunk_borders_shift_with_the_lines():
    rnd = random.Random(9)
    body = [prose(rnd, 5) for _ in range(60)]
    plain = {c for _, _, c in linedup.chunks("\n".join(body))}
    for k in (1, 2, 7):
        moved = {c for _, _, c in linedup.chunks("\n".join([prose(rnd, 5) for _ in range(k)] + body))}
        assert len(plain & moved) >= 0.8 * len(plain)


def smith_waterman(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            s = decontam.MATCH if a[i - 1] == b[j - 1] else decontam.MISMATCH
            h[i, j] = max(0, h[i - 1, j - 1] + s, h[i - 1, j] + decontam.GAP, h[i, j - 1] + decontam.GAP)
    return h.max()


def test_alignment_against_the_full_matrix():
    rng = np.random.default_rng(1)
    a = [rng.integers(0, 6, rng.integers(1, 30)) for _ in range(80)]
    b = [rng.integers(0, 6, rng.integers(1, 20)) for _ in range(80)]
    best, _ = decontam.align(a, b)
    assert best.tolist() == [smith_waterman(x, y) for x, y in zip(a, b)]


def test_decontamination(spark):
    rnd = random.Random(7)
    items = [(k, prose(rnd, rnd.randint(12, 50))) for k in range(30)] + [(50, None), (51, ""), (52, "tiny item"), (53, items_text := prose(rnd, 40)), (54, items_text)]
    by = dict(items)
    rows, want = list(AWKWARD), set()
    for n in range(40):
        text = prose(rnd, 300).split(" ")
        if n % 2:
            k = n % 30
            body = by[k] if n % 4 == 1 else edited(rnd, by[k], 0.04)
            text[150:150] = body.upper().split(" ") if n % 8 == 5 else body.split(" ")
            if n % 4 == 1 or smith_waterman(text, by[k].split(" ")) >= 2 * decontam.SCORE * len(by[k].split(" ")):
                want.add((n, k))
        rows.append((n, " ".join(text)))
    rows += [(300, items_text), (301, "here is a tiny item."), (302, by[3] + " " + prose(rnd, 20_000))]
    want |= {(300, 53), (300, 54), (301, 52), (302, 3)}
    frame = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontam.contaminated(docs_frame(spark, rows, words=1, seed=2), frame).collect()}
    assert set(got) == want
    assert got[300, 53].score == 1.0 and got[300, 53].end_word == 40
    assert decontam.contaminated(docs_frame(spark, rows), frame.limit(0)).count() == 0
    assert decontam.contaminated(docs_frame(spark, []), frame).count() == 0


def test_items_of_common_seeds_only_are_still_found(spark):
    rnd = random.Random(3)
    text = prose(rnd, 20)
    frame = spark.createDataFrame([(k, text) for k in range(30)], "item_id long, text string")
    got = decontam.contaminated(docs_frame(spark, [(1, "a b " + text)]), frame).collect()
    assert {r.item_id for r in got} == set(range(30))


def test_every_item_that_the_score_accepts_is_found(spark):
    """Edited copies of short, template and long items against the full matrix of every document and item."""
    rnd = random.Random(33)
    template = prose(rnd, 25)
    texts = [prose(rnd, n) for n in (1, 2, 3, 4, 5, 8, 8, 9, 10, 11, 12, 12, 13, 20, 31, 60)] + [template + " " + prose(rnd, 6) for _ in range(25)] + ["go go go go go go go go stop"]
    items = list(enumerate(texts))

    def edit(words, share):
        out, budget = [], share * len(words)
        places = sorted(rnd.sample(range(len(words)), min(len(words), int(budget) + 1)))
        kind = rnd.choice(["insert", "change", "drop", "ends", "mixed"])
        for i, w in enumerate(words):
            k = rnd.choice(["insert", "change", "drop"]) if kind == "mixed" else kind
            if i in places and budget >= (1 if k == "insert" else 3) and k != "ends":
                budget -= 1 if k == "insert" else 3
                out += [w, f"z{rnd.randrange(10 ** 6)}"] if k == "insert" else [f"y{rnd.randrange(10 ** 6)}"] if k == "change" else []
            else:
                out.append(w)
        return out[int(budget / 4):len(out) - int(budget / 4)] if kind == "ends" else out

    every4 = [w for i, w in enumerate(texts[13].split(" ")) for w in ([w, "zz"] if i % 4 == 3 else [w])]
    rows = [(0, " ".join(every4)), (1, " ".join([*prose(rnd, 9).split(" "), *texts[6].split(" ")[:3], "other", *texts[6].split(" ")[4:]]))]
    for n in range(2, 150):
        k = rnd.randrange(len(texts))
        rows.append((n, " ".join([*prose(rnd, rnd.randint(0, 90)).split(" "), *edit(texts[k].split(" "), rnd.choice([0.2, 0.4, 0.45])), *prose(rnd, rnd.randint(0, 9)).split(" ")])))
    want = {}
    for i, t in rows:
        for k, x in items:
            score = smith_waterman([w for w in t.split(" ") if w], x.split(" ")) / (2 * len(x.split(" ")))
            if score >= decontam.SCORE:
                want[i, k] = score
    got = {(r.doc_id, r.item_id): r.score for r in decontam.contaminated(docs_frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert set(got) == set(want) and all(abs(got[p] - want[p]) < 1e-9 for p in want)
    assert (0, 13) in got and (1, 6) in got and len(got) > 100  # recall 1 on all of them


def test_seed_rule_against_all_edits():
    """No cheapest set of insertions, changes, drops and cuts leaves fewer seeds than the rule says."""
    from functools import cache

    for size in range(1, 26):
        s, need, _ = decontam.seed_rule(size)
        budget = int(0.4 * size + 1e-9)

        @cache
        def fewest(i, run, left):
            """Least whole seeds from item word i on; ``run``: whole words before it, up to s - 1."""
            if i == size:
                return 0
            out = fewest(i + 1, min(run + 1, s), left) + (run + 1 >= s)
            if left >= 1 and run:
                out = min(out, fewest(i + 1, 1, left - 1) + (s == 1))
            if left >= 2:
                out = min(out, fewest(i + 1, 0, left - (2 if i == 0 or i == size - 1 else 3)) if left >= (2 if i == 0 or i == size - 1 else 3) else out)
            return out

        assert fewest(0, 0, budget) >= need >= 1


INSULTS = ("dolt", "cretin", "wretch")


def toxic_rows(rnd, n):
    rows, labels = [], []
    for i in range(5000, 5000 + n):
        words, bad = prose(rnd, rnd.randint(20, 80), 500).split(" "), i % 4 == 0
        if bad:
            words[5] = rnd.choice(INSULTS)
            words[9] = rnd.choice(INSULTS)
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity_held_out(spark):
    rnd = random.Random(1)
    rows, labels = toxic_rows(rnd, 900)
    rows += AWKWARD
    lab = spark.createDataFrame(labels + [(5000, 0), (None, 1), (5001, None)], "doc_id long, toxic int")
    docs = docs_frame(spark, rows, terms=1)
    scored = toxicity.score(docs, toxicity.fit(docs, lab)).withColumn("held_out", toxicity.held_out()).collect()
    truth = dict(labels)
    held = [r for r in scored if r.held_out and r.doc_id in truth]
    assert all((r.score >= toxicity.THRESHOLD) == bool(truth[r.doc_id]) for r in held)
    assert all(0 <= r.score <= 1 for r in scored) and len(scored) == len(rows)
    for empty in (lab.limit(0), lab.where("toxic = 0"), lab.where("toxic = 1")):
        got = {r.score for r in toxicity.score(docs, toxicity.fit(docs, empty)).collect()}
        assert got == {1.0 if empty.where("toxic = 1").count() else 0.0}


def test_pairs_of_terms_count_more_than_their_sum():
    """Exactly one of two words is toxic: weights that only add up cannot say that."""
    rng = np.random.default_rng(2)

    def sample(n):
        has = rng.random((n, 2)) < 0.5
        feat = np.stack([np.where(has[:, 0], 0, 2), np.where(has[:, 1], 1, 3), rng.integers(4, 30, n)], 1)
        return feat, (has.sum(1) == 1).astype(float)

    feat, y = sample(1500)
    bias, w, v = toxicity.train(np.repeat(np.arange(1500), 3), feat.ravel(), y, 30, toxicity.Bounds())
    feat, y = sample(500)
    logit = bias + w[feat].sum(1) + 0.5 * ((v[feat].sum(1) ** 2).sum(1) - (v[feat] ** 2).sum((1, 2)))
    assert ((logit > 0) == (y > 0)).mean() > 0.97


def one_of_two(rnd, n, words, vocab):
    """Rows with words of their own; those with exactly one of two words, each neutral alone, are toxic."""
    rows, labels = [], []
    for i in range(n):
        text, has = prose(rnd, words, vocab).split(" "), [rnd.random() < 0.5, rnd.random() < 0.5]
        text[3:3] = [w for w, h in zip(("harbour", "lantern"), has) if h]
        rows.append((i, " ".join(text)))
        labels.append((i, int(sum(has) == 1)))
    return rows, labels


@pytest.mark.parametrize("n, words, vocab", [(1200, 12, 300), (2400, 40, 2000)])
def test_pairs_of_neutral_terms_are_learned_from_texts(spark, n, words, vocab):
    rows, labels = one_of_two(random.Random(n), n, words, vocab)
    docs = docs_frame(spark, rows)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    held = toxicity.score(docs, model).where(toxicity.held_out()).collect()
    truth = dict(labels)
    good, bad = ([r.score for r in held if truth[r.doc_id] == k] for k in (0, 1))
    assert sum((b > g) + 0.5 * (b == g) for b in bad for g in good) / len(bad) / len(good) > 0.95


def test_score_is_the_quadratic_sum_of_its_terms(spark):
    """Against a plain double loop over the pairs of terms."""
    rnd = random.Random(9)
    rows, labels = toxic_rows(rnd, 300)
    docs = docs_frame(spark, rows)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    for r in toxicity.score(docs.limit(40), model).collect():
        kept = [model.slot[t] for t in toxicity.row_terms(*toxicity.text_arrays(pa.array([r.text])), model.bounds.buckets)[1]]
        kept = [k for k in kept if k >= 0]
        z = model.bias + sum(model.weight[k] for k in kept)
        z += sum(float(model.vector[a] @ model.vector[b]) for n, a in enumerate(kept) for b in kept[:n])
        assert abs(r.score - 1 / (1 + math.exp(-z))) < 1e-9


def test_scores_ignore_ids_and_sources(spark):
    rnd = random.Random(4)
    rows, labels = toxic_rows(rnd, 200)
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    docs = docs_frame(spark, rows)
    model = toxicity.fit(docs, lab)
    a = {r.text: r.score for r in toxicity.score(docs, model).collect()}
    b = {r.text: r.score for r in toxicity.score(docs.selectExpr("doc_id + 7 AS doc_id", "text", "'xx' AS source"), model).collect()}
    assert a == b


PII_ROWS = [
    (1, "write to Anna.Li@mail.example.com or anna.li@mail.example.com, not bob@mail.example.com"),
    (2, "call +1 (988) 555-2485 or 988-555-2485; card 4111 1111 1111 1111 and 4111111111111111"),
    (3, "Ms. Mary Smith met Mr. John Smith. Frau MÜLLER and г-жа Иванова came; Ms. Mary Smith left"),
    (4, "ip 10.0.0.1, 300.1.1.1 is none; ssn 123-45-6789; iban DE89370400440532013000."),
    (5, "no entity, v1.2.3, 12345"), (6, "x" * 40_000 + " tail@mail.example.com"),
]


def luhn(s):
    d = [int(c) for c in s if c.isdigit()][::-1]
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(d)) % 10 == 0


def test_pii_surrogates(spark):
    rows = PII_ROWS + AWKWARD
    got = {r.doc_id: r for r in pii.replace_entities(docs_frame(spark, rows, type="t", core="c", row=1), "key").collect() if r.doc_id}
    old = dict(rows)
    for i in (5, 101, 102, 103, 105):
        assert got[i].text == old[i] and got[i].n_entities == 0
    assert got[100].text is None
    mails = re.findall(r"[\w.]+@[\w.]+", got[1].text)
    assert got[1].n_entities == 3 and len(mails) == 3 and mails[0] == mails[1] != mails[2]  # coreference whatever the case
    assert mails[0].endswith(".com") and "." in mails[0].split("@")[0] and mails[0].split("@")[1] == mails[2].split("@")[1]
    a, b, c, d = re.search(r"call (\S+ \S+ \S+) or (\S+); card (.{19}) and (\d{16})$", got[2].text).groups()
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", a) and re.sub(r"\D", "", a)[1:] == re.sub(r"\D", "", b)
    assert c.replace(" ", "") == d and luhn(d) and d[0] == "4" and d != "4" + "1" * 15
    m = re.fullmatch(r"Ms\. (\w+) (\w+) met Mr\. (\w+) (\w+)\. Frau (\w+) and г-жа (\w+) came; Ms\. (\w+) (\w+) left", got[3].text)
    assert m and m[1] == m[7] and m[2] == m[4] == m[8] and m[1] != m[3] and m[5].isupper() and re.fullmatch("[А-Я][а-я]+", m[6])
    assert not {"Mary", "John", "Smith", "Иванова"} & set(m.groups())
    four = re.fullmatch(r"ip ([\d.]+), 300\.1\.1\.1 is none; ssn (\d{3}-\d{2}-\d{4}); iban (DE\d{20})\.", got[4].text)
    assert four and four[1] != "10.0.0.1" and all(0 < int(x) < 255 for x in four[1].split(".")) and four[2] != "123-45-6789"
    assert "tail@" not in got[6].text and got[6].text.startswith("x" * 40_000)
    again = {r.doc_id: r.text for r in pii.replace_entities(docs_frame(spark, rows), "other").collect()}
    assert again[1] != got[1].text and again[5] == got[5].text
    assert pii.replace_entities(docs_frame(spark, []), "key").count() == 0


def test_titled_names_of_any_number_of_words(spark):
    rows = [(1, "Dr Martin Luther King spoke, Dr King left"), (2, "Mr J. Smith met Mr Smith and Mr J.R.R. Smith"),
            (3, "Herr Otto von der Heide saw Frau Heide"), (4, "Mr John F Kennedy Jr. came. Mr Smith I know, Mrs Ann Mary Lou Smith too"),
            (5, "Mr Smith Mrs Heide"), (6, "Dr Smith of King and Prof. Dr. King")]
    got = {r.doc_id: r for r in pii.replace_entities(docs_frame(spark, rows), "key").collect()}
    assert [got[i].n_entities for i in range(1, 7)] == [2, 3, 2, 3, 2, 2]
    w = r"([A-Z][a-z]+)"
    a = re.fullmatch(rf"Dr {w} {w} {w} spoke, Dr {w} left", got[1].text)
    assert a and a[3] == a[4] and not {"Martin", "Luther", "King"} & set(a.groups())
    b = re.fullmatch(rf"Mr [A-Z]\. {w} met Mr {w} and Mr [A-Z]\.[A-Z]\.[A-Z]\. {w}", got[2].text)
    assert b and b[1] == b[2] == b[3] != "Smith"
    c = re.fullmatch(rf"Herr {w} von der {w} saw Frau {w}", got[3].text)
    assert c and c[2] == c[3] != "Heide" and c[1] != "Otto"
    d = re.fullmatch(rf"Mr {w} [A-Z] {w} Jr\. came\. Mr {w} I know, Mrs {w} {w} {w} {w} too", got[4].text)
    assert d and d[3] == d[7] == b[1] and not {"John", "Kennedy", "Ann", "Mary", "Lou"} & set(d.groups())
    assert re.fullmatch(rf"Mr {b[1]} Mrs {c[2]}", got[5].text) and got[6].text == f"Dr {b[1]} of King and Prof. Dr. {a[3]}"


def test_pii_replacements_stay_distinct(spark):
    # one-letter mailboxes: 26 of one format, so draws must collide and grow
    rows = [(n, f"{chr(97 + n)}@m.com") for n in range(26)]
    got = [r.text for r in pii.replace_entities(docs_frame(spark, rows), "k").collect()]
    assert len(set(got)) == 26 and not set(got) & {t for _, t in rows}


def test_pii_runs_no_python(spark):
    plan = pii.replace_entities(docs_frame(spark, PII_ROWS), "k")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_pii_full_formats_end_and_stay_distinct(spark):
    """Every string of a format occurs: the rounds end, nothing keeps its own, no two share one."""
    rows = [("phone", f"{n:04d}") for n in range(10_000)] + [("ssn", f"{n:03d}") for n in range(1000)] + [("card", f"4{n:04d}") for n in range(10_000)]
    rows += [("ip", f"10.{a}.0.255") for a in range(256)] + [("email", f"{a}@{b}.com") for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyz"]
    rows += [("phone", f"{n:07d}") for n in range(0, 10 ** 7, 997)] + [("iban", f"DE{c}37040044053201300{n}") for c in (89, 12) for n in range(10)]
    rows += [("given_latin_f", f"name{n}") for n in range(3000)] + [("email", "_@-.com"), ("ip", "0.0.255.0")]
    got = pii.mapping(spark.createDataFrame(rows, "type string, core string"), "k").collect()
    made = {(r.type, r.core): r.made for r in got}
    assert len(made) == len(got) == len(rows) and len({(t, m) for (t, _), m in made.items()}) == len(rows)
    assert not [k for k, m in made.items() if m == k[1]]
    for (t, c), m in made.items():
        if t in ("phone", "ssn", "card"):
            assert len(m) == len(c) and m.isdigit()
        if t == "ip":
            assert all(0 < int(o) < 255 for o in m.split("."))
        if t == "card":
            assert m[0] == c[0] and luhn(m) == luhn(c)
        if t == "iban":
            assert m[:2] == "DE" and len(m) == len(c) and iban_holds(m) == iban_holds(c)
        if t == "phone" and len(c) == 7:
            assert ("phone", m) not in made  # room enough: no real number is given out
    again = {(r.type, r.core): r.made for r in pii.mapping(spark.createDataFrame(rows[::-1], "type string, core string"), "k").collect()}
    assert again == made


def iban_holds(x):
    return int("".join(str(int(c, 36)) for c in x[4:] + x[:4])) % 97 == 1


def test_pii_spaced_ibans_names_with_marks_and_slavic_endings(spark):
    rows = [(1, "pay DE89 3704 0044 0532 0130 00 or DE89370400440532013000 now"), (2, "Mr. O'Brien-Lee met Mr O'BRIEN-LEE"), (3, "GB29 NWBK 6016 1331 9268 19 THE END"),
            (4, "г-н Иванов, г-жа Иванова и г-жа Шевченко"), (5, "FR14 2004 1010 0505 0001 3M02 606 ok"), (6, "card 4111 1111 1111 1111 and 4111-1111-1111-1112")]
    got = {r.doc_id: r for r in pii.replace_entities(docs_frame(spark, rows), "key").collect()}
    a = re.fullmatch(r"pay (DE\d\d \d{4} \d{4} \d{4} \d{4} \d\d) or (DE\d{20}) now", got[1].text)
    assert a and a[1].replace(" ", "") == a[2] != "DE89370400440532013000" and iban_holds(a[2])
    b = re.fullmatch(r"Mr\. (\w)'([A-Z]\w+)-([A-Z]\w+) met Mr (\w)'(\w+)-(\w+)", got[2].text)
    assert b and (b[1] + b[2] + b[3]).upper() == b[4] + b[5] + b[6] and "BRIEN" not in got[2].text.upper()
    c = re.fullmatch(r"(GB\d\d [A-Z]{4} \d{4} \d{4} \d{4} \d\d) THE END", got[3].text)
    assert c and iban_holds(c[1].replace(" ", "")) and "NWBK" not in got[3].text
    d = re.fullmatch(r"г-н (\w+), г-жа (\w+) и г-жа (\w+)", got[4].text)
    assert d and d[1] + "а" == d[2] and d[1] != "Иванов" and re.search("(ов|ев|ин)$", d[1]) and not d[3].endswith("ова")
    e = re.fullmatch(r"(FR\d\d \d{4} \d{4} \d{4} \d{4} \d[A-Z]\d\d \d{3}) ok", got[5].text)
    assert e and iban_holds(e[1].replace(" ", ""))
    f = re.fullmatch(r"card (\d{4} \d{4} \d{4} \d{4}) and (\d{4}-\d{4}-\d{4}-\d{4})", got[6].text)
    assert f and luhn(f[1].replace(" ", "")) and not luhn(f[2].replace("-", "")) and f[1][0] == f[2][0] == "4"


def test_lines_are_read_once_for_chunks_and_runs(monkeypatch):
    """One reading of a text's lines serves both, with the results that each has alone."""
    rnd = random.Random(41)
    text = "\n".join(" ".join(rnd.choice("ab cd ef".split()) for _ in range(rnd.randint(0, 70))) for _ in range(60))
    alone = [h for _, _, h in zip(*linedup.runs(text.split("\n")))]
    calls = []
    hashes = linedup.line_hashes
    monkeypatch.setattr(linedup, "line_hashes", lambda lines: calls.append(1) or hashes(lines))
    found = linedup.piece_hashes(text).tolist()
    assert len(calls) == 1 and found[len(found) - len(alone):] == alone and len(found) == len(linedup.chunks(text)) + len(alone)


def test_lines_of_many_texts_are_read_together(monkeypatch):
    """All texts of a slice take one reading, with the results that each has alone; blanks are those of ``str.split``."""
    rnd = random.Random(43)
    odd = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u200a\u200b\u2028\u2029\u202f\u205f\u2060\u3000\u3001\xa1\u1681 é中😀"
    texts = ["", "\n", "x\n", "\n\nx", odd, *odd, "\u3000", "a\u2028", "\xa0b", "\n".join(["w " * 60] * 3), "", "w " * 60]
    texts += ["\n".join("".join(rnd.choice(["ab", "c", " ", *odd]) for _ in range(rnd.choice((0, 1, 9, 300)))) for _ in range(rnd.randint(0, 200))) for _ in range(40)]
    together = linedup.lines_of(*texts)
    lines = [x for t in texts for x in t.split("\n")]
    assert together.words.tolist() == [len(x.split()) for x in lines]
    assert [together.body(k, k + 1) for k in range(len(lines))] == [x.encode() for x in lines]
    alone = sorted(h for t in texts for h in linedup.piece_hashes(t).tolist())
    found = [(k, *c) for k, t in enumerate(texts) for c in linedup.chunks(t)]
    calls, hashes = [], linedup.line_hashes
    monkeypatch.setattr(linedup, "line_hashes", lambda x: calls.append(1) or hashes(x))
    assert sorted(linedup.piece_hashes(*texts).tolist()) == alone and len(calls) == 1
    rows, at, n, _, bodies = linedup.pieces(together, lambda h: np.ones(len(h), bool))
    assert [(r, a, m, b[1:].decode()) for r, a, m, b in zip(rows.tolist(), at.tolist(), n.tolist(), bodies) if b[:1] == b"="] == found
    assert all("\n".join(texts[r].split("\n")[a:a + m]) == b for r, a, m, b in found) and linedup.piece_hashes().tolist() == []
