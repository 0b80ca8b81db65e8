"""op 12 against plain loops over every order of the filters."""

import itertools
import random
import re

from llm_helpers import AWKWARD, DOC_SCHEMA

from newsfunnel.llm import filteraudit


def fails(text, smaller):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return "".join(k for k, v in {
        "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
        "D": bool(re.search(r"[#$%&*|]", text)), "E": smaller}.items() if v)


def model(docs, labels):
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    first = {}
    for i, text, *_ in docs:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    rows = [(lang or "", i, fails(text or "", i is not None and first[text or ""] < i)) for i, text, lang in docs]
    out = []
    for part in {r[0] for r in rows}:
        of = [r for r in rows if r[0] == part]
        here = []
        for order in itertools.permutations("ABCDE"):
            alive = list(of)
            for k, f in enumerate(order):
                gone = [r for r in alive if f in r[2]]
                alive = [r for r in alive if f not in r[2]]
                here.append([part, "".join(order), k + 1, len(alive), len(gone), sum(f in r[2] for r in of) - len(gone), sum(r[2] == f for r in of),
                             sum(r[1] in good for r in gone if r[1] is not None), sum(r[1] in toxic for r in gone if r[1] is not None)])
        total = {f: sum(h[4] for h in here if h[1][h[2] - 1] == f) for f in "ABCDE"}
        out += [tuple([*h, total[h[1][h[2] - 1]]]) for h in here]
    return sorted(out)


def frames(spark, docs, labels):
    d = spark.createDataFrame([(i, t, lang, "s", 0) for i, t, lang in docs], DOC_SCHEMA)
    return d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_every_order_and_step(spark):
    rnd = random.Random(21)
    docs = []
    for i in range(260):
        n = rnd.choice([3, 99, 100, 140])
        words = [rnd.choice(["WORD", "Word", "word", "w"]) + str(rnd.randrange(rnd.choice([60, 900]))) for _ in range(n)]
        docs.append((rnd.choice([i, i, i, None, i - 1]), " ".join(words) + rnd.choice(["", "", " $", " a|b", "\n"]), rnd.choice(["en", "fr", "", None])))
    docs += [(1000 + k, rnd.choice(docs[:6])[1], "en") for k in range(200)]  # a text that many rows hold
    docs += [(i, t, None) for i, t in AWKWARD] + [(5, "É" * 99, "de"), (6, "A" * 10 + "é" * 90, "de"), (7, "A" * 11 + "é" * 89, "de")]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for i in list(range(0, 400, 2)) + [4, 4, 8] + list(range(1000, 1200))] + [(None, 1, 1)]
    d, lab = frames(spark, docs, labels)
    d = d.selectExpr("*", "1 as id", "2 as part", "3 as filter", "4 as words", "5 as A")
    got = filteraudit.interaction_audit(d, lab)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(tuple(r) for r in got.collect()) == model(docs, labels)


def test_no_failures_and_empty(spark):
    clean = " ".join(f"w{k}" for k in range(120))
    d, lab = frames(spark, [(1, clean, "en"), (2, clean + " x", "en")], [(1, 1, 0)])
    got = filteraudit.interaction_audit(d, lab).collect()
    assert len(got) == 600 and {(r.kept, r.removed, r.shapley) for r in got} == {(2, 0, 0)}
    assert filteraudit.interaction_audit(d.limit(0), lab.limit(0)).count() == 0
    one, _ = frames(spark, [(1, "only A, thrice", "en")] * 3, [])
    assert {(r.filter_order[r.step - 1], r.removed, r.unique_fails) for r in filteraudit.interaction_audit(one, lab.limit(0)).collect()} == {
        (f, 3 if f == "A" else 0, 3 if f == "A" else 0) for f in "ABCDE"}
