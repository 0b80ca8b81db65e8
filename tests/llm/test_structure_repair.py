"""op 11 against an exhaustive search, a suffix DP on (cost, letters) and plain loops over the rows."""

import hashlib
import itertools
import random
import re
import zlib

from newsfunnel.llm import dialogue
from newsfunnel.llm.dialogue import MOVES, NEXT, ROLE, Repair

INK = re.compile(r"[^\x20\x09-\x0D]")


def rows_after_damage(rows):
    """conv -> [(turn, role, text)] in order, by the contract's words."""
    out = {}
    for conv, turn, role, text in rows:
        got = out.setdefault(conv, [])
        said = [" " if v is None else str(v) for v in (conv, turn)]
        role, text = (" " if v is None else v for v in (role, text))
        n = zlib.crc32(":".join(said).encode()) % 20
        if n == 1:
            text = ""
        if n == 2:
            text = re.sub("[.!?]", "", text)
        if n == 4:
            role = "user"
        got.extend([(turn, role, text)] * (0 if n == 0 else 2 if n == 3 else 1))
    for got in out.values():
        got.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    return out


def faults(turns):
    seen, out = set(), []
    for _, role, text in turns:
        ink = INK.findall(text)
        out.append("b" if not ink else "d" if (role, text) in seen else "t" if ink[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def suffix_best(turns, marks):
    """(cost, letters) from the end: exact, as a letter put before two suffixes keeps their order."""
    INF = (10 ** 9, "")
    best = [0 if s in (0, 3) else None for s in range(4)]
    best = [(0, "") if b == 0 else INF for b in best]

    def closed(b):
        b = list(b)
        for _ in range(3):
            b = [min(b[s], (b[NEXT[s]][0] + 5, "I" + b[NEXT[s]][1])) for s in range(4)]
        return b

    best = closed(best)
    for (_, role, _), mark in zip(reversed(turns), reversed(marks)):
        pen = 5 if mark == "t" else 0
        new = []
        for s in range(4):
            options = [(best[s][0] + 2, "D" + best[s][1])]
            if mark not in ("b", "d"):
                t = MOVES.get((s, role[:1]))
                if t is not None:
                    options.append((best[t][0] + pen, "K" + best[t][1]))
                options.append((best[NEXT[s]][0] + 1 + pen, "R" + best[NEXT[s]][1]))
            new.append(min(options))
        best = closed(new)
    return best[0]


def exhaustive(turns, marks):
    best = None
    n = len(turns)
    for edits in itertools.product("DKR", repeat=n):
        for gaps in itertools.product(range(3), repeat=n + 1):
            letters = "".join("I" * g + e for g, e in zip(gaps, [*edits, ""]))
            cost = 5 * sum(gaps)
            said, k = [], 0
            for x in letters:
                if x == "I":
                    said.append("ua")
                    continue
                (_, role, _), mark = turns[k], marks[k]
                k += 1
                if x == "D":
                    cost += 2
                    continue
                if mark in ("b", "d"):
                    cost = None
                    break
                cost += (x == "R") + (5 if mark == "t" else 0)
                said.append(role[:1] if x == "K" else "ua")
            if cost is None or (best is not None and (cost, letters) >= best):
                continue
            if any(len(c) == 1 and re.fullmatch(r"(s?(ua)+)?", "".join(c)) for c in [[""]] if not said) or any(
                    re.fullmatch(r"(s?(ua)+)?", "".join(c)) for c in itertools.product(*said)):
                best = (cost, letters)
    return best


def repaired(turns, letters):
    out, state, k = [], 0, 0
    for x in letters:
        if x == "I":
            state = NEXT[state]
            out.append(f"{ROLE[state]}:")
            continue
        _, role, text = turns[k]
        k += 1
        if x == "K":
            state = MOVES[state, role[:1]]
            out.append(f"{role}:{text}")
        elif x == "R":
            state = NEXT[state]
            out.append(f"{ROLE[state]}:{text}")
    assert state in (0, 3) and k == len(turns)
    return "\n".join(out)


def model(rows):
    out = {}
    for conv, turns in rows_after_damage(rows).items():
        marks = faults(turns)
        cost, letters = suffix_best(turns, marks)
        known = [t for t, _, _ in turns if t is not None]
        first = [r[:1] for _, r, _ in turns]
        out[conv] = (max(known) - min(known) + 1 - len(set(known)) if known else 0, marks.count("b"), marks.count("d"), marks.count("t"),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:])), cost, letters,
                     hashlib.sha256(repaired(turns, letters).encode()).hexdigest())
    return out


SCHEMA = "conv_id long, turn long, role string, text string"


def some_turns(rnd, n):
    return [(rnd.choice([None, *range(n + 2)]), rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "agent"]),
             rnd.choice(["yes.", "no!", "cut", " ", "", "é?\n", "more.", f"t{rnd.random()}."])) for _ in range(n)]


def test_scalar_minimum_is_the_exhaustive_one():
    rnd = random.Random(11)
    for _ in range(120):
        turns = some_turns(rnd, rnd.randrange(4))
        marks = [rnd.choice(["", "", "", "t", "b", "d"]) for _ in turns]
        r = Repair()
        for (_, role, text), m in zip(turns, marks):
            r.row(role, text, m in ("b", "d"), m == "t")
        want = exhaustive(turns, marks)
        assert r.result()[:2] == want == suffix_best(turns, marks)


def test_long_conversations_over_many_blocks():
    rnd = random.Random(12)
    for n in (63, 64, 65, 128, 700):
        for kinds in (["user"], ["user", "assistant"], ["assistant", "system", "user"], ["tool", "user"]):
            for marked in ([""], ["t"], ["", "t", "b", "d"]):
                turns = [(k, rnd.choice(kinds), f"x{k % 9}.") for k in range(n)]
                marks = [rnd.choice(marked) for _ in turns]
                r = Repair()
                for (_, role, text), m in zip(turns, marks):
                    r.row(role, text, m in ("b", "d"), m == "t")
                cost, letters = suffix_best(turns, marks)
                assert r.result() == (cost, letters, hashlib.sha256(repaired(turns, letters).encode()).hexdigest())


def test_query_rows_against_the_model(spark):
    rnd = random.Random(13)
    rows = [(c, t, r, x) for c in range(120) for t, r, x in some_turns(rnd, rnd.randrange(1, 12))]
    rows += [(c, t, ("user", "assistant")[t % 2], f"turn {t}.") for c in range(500, 540) for t in range(6)]
    rows += [(None, 1, None, None), (None, None, "user", "hi."), (7, None, None, None), (600, 2 ** 62, "user", "a."), (600, -2 ** 62, "user", "b.")]
    rows += rows[40:60]
    rows += [(900, t // 3, rnd.choice(["user", "assistant"]), f"{t % 50}.") for t in range(2000)]  # one long conversation
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    want = model(rows)
    damaged = dialogue.damage(df.selectExpr("*", "1 as key", "2 as sha", "3 as copies"))
    audits = dialogue.repair_audit(damaged)
    got = {r[0]: tuple(r)[1:] for r in audits.collect()}
    assert set(got) == set(want)
    for c in want:
        assert got[c] == (min(want[c][0], 2 ** 63 - 1), *want[c][1:]), c
    # the repaired turns themselves
    said = {}
    for r in sorted(dialogue.repaired_turns(damaged, audits).collect(), key=lambda r: r.seq):
        said.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    assert {c: hashlib.sha256("\n".join(said.get(c, [])).encode()).hexdigest() for c in want} == {c: w[-1] for c, w in want.items()}


def test_nothing_left_and_empty(spark):
    gone = next(c for c in range(10 ** 6) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(gone, 0, "user", "hi.")], SCHEMA)
    assert [tuple(r) for r in dialogue.repair_audit(dialogue.damage(df)).collect()] == [
        (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert dialogue.repair_audit(dialogue.damage(df.limit(0))).count() == 0


def test_query_over_the_whole_table(spark):
    import __spark_entry__ as E

    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r[0]: tuple(r)[1:] for r in E.queries()["op11_structure_repair"](spark, sf).collect()}
    assert got == model(rows)
