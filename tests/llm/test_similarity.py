import random

import numpy as np
import pytest
import xxhash
from llm_helpers import AWKWARD, brute_components, docs_frame, edited, prose, word_set

from newsfunnel.llm import bitsliced, linkgroups, ngram_join, sigtree
from newsfunnel.llm.words import Words


def groups(rnd):
    rows, n = list(AWKWARD), 1000
    for size, share in ((2, 0.0), (3, 0.01), (12, 0.015), (40, 0.03)):
        base = prose(rnd, rnd.randint(60, 400))
        for _ in range(size):
            rows.append((n, edited(rnd, base, share)))
            n += 1
    common = prose(rnd, 30)
    for _ in range(30):
        rows.append((n, prose(rnd, rnd.randint(5, 60)) + " " + common))
        n += 1
    # a chain: each text drops one word at the front and takes one at the end
    words = prose(rnd, 400, 10 ** 6).split(" ")
    for k in range(0, 60, 3):
        rows.append((n, " ".join(words[k:k + 120])))
        n += 1
    rnd.shuffle(rows)
    return rows


def test_components_against_all_pairs(spark):
    rnd = random.Random(11)
    for k, percent in ((3, 90), (5, 80)):
        rows = groups(rnd)
        got = ngram_join.linked_documents(docs_frame(spark, rows, node=1, sig="s"), k, percent).collect()
        assert sorted((tuple(r) for r in got), key=str) == brute_components(rows, k, percent)
    assert ngram_join.linked_documents(docs_frame(spark, [])).count() == 0
    assert [tuple(r) for r in ngram_join.linked_documents(docs_frame(spark, [(1, None), (2, "")])).orderBy("doc_id").collect()] == [(1, 0, 1), (2, 0, 2)]


def test_groups_larger_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    rnd = random.Random(12)
    rows = groups(rnd)
    got = ngram_join.linked_documents(docs_frame(spark, rows), 3, 90).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_components(rows, 3, 90)


def test_summary_bound_never_prunes_a_link():
    rng = np.random.default_rng(5)
    for _ in range(400):
        base = rng.integers(0, 2 ** 63, rng.integers(4, 200)).astype(np.uint64)
        sets = [np.unique(np.concatenate([base[rng.random(len(base)) > rng.random() * 0.15], rng.integers(0, 2 ** 63, rng.integers(0, 6)).astype(np.uint64)]))
                for _ in range(8)]
        sets = [s for s in sets if len(s)]
        leaves = [sigtree.Node(i, len(s), sigtree.signature(s)) for i, s in enumerate(sets)]
        half = len(leaves) // 2
        ups = []
        for part in (leaves[:half], leaves[half:]):
            g = sigtree.Groups(len(leaves))
            for x in part[1:]:
                g.join(part[0].item, x.item)
            ups += [sigtree.Node.summary(k, *x[1:]) for k, x in enumerate(sigtree.summaries(part, g))]
        linked = any(100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b)) for a in sets[:half] for b in sets[half:])
        if len(ups) == 2 and linked:
            assert sigtree.possible(*ups, 80)


def test_summary_of_equal_sizes_against_a_narrower_signature():
    """A word changed in each of ten copies keeps the size; the text cut to 126 shingles has half the width."""
    rng = np.random.default_rng(15)

    def tokens(words):
        return np.unique([xxhash.xxh3_64_intdigest(" ".join(map(str, words[i:i + 3]))) for i in range(len(words) - 2)]).astype(np.uint64)

    for _ in range(200):
        words = rng.integers(0, 10 ** 6, 132).tolist()
        copies = []
        for i in rng.integers(3, 129, 10).tolist():
            copies.append(tokens([*words[:i], 10 ** 6 + i, *words[i + 1:]]))
        cut = tokens(words[:128])
        assert {len(c) for c in copies} == {130} and len(cut) == 126
        assert any(100 * len(np.intersect1d(c, cut)) >= 90 * len(np.union1d(c, cut)) for c in copies)
        leaves = [sigtree.Node(i, len(c), sigtree.signature(c)) for i, c in enumerate(copies)]
        g = sigtree.Groups(10)
        for i in range(1, 10):
            g.join(0, i)
        (up,) = (sigtree.Node.summary(0, *x[1:]) for x in sigtree.summaries(leaves, g))
        assert sigtree.possible(up, sigtree.Node(1, 126, sigtree.signature(cut)), 90)


def test_tree_bound_never_prunes_a_link():
    rng = np.random.default_rng(3)
    for _ in range(300):
        base = rng.integers(0, 2 ** 63, rng.integers(1, 200)).astype(np.uint64)
        sets = [np.unique(np.concatenate([base[rng.random(len(base)) > rng.random() * 0.2], rng.integers(0, 2 ** 63, rng.integers(0, 6)).astype(np.uint64)]))
                for _ in range(9)]
        sets = [s for s in sets if len(s)]
        for percent in (50, 80, 90, 100):
            tree = sigtree.build([sigtree.Node(i, len(s), sigtree.signature(s)) for i, s in enumerate(sets)])

            def linked(i, j):
                c = len(np.intersect1d(sets[i], sets[j]))
                return 100 * c >= percent * (len(sets[i]) + len(sets[j]) - c)

            g, h = sigtree.Groups(len(sets)), sigtree.Groups(len(sets))
            for i, j in sigtree.spanning_links(tree, len(sets), percent, linked):
                assert g.join(i, j)
            for i in range(len(sets)):
                for j in range(i):
                    if linked(i, j):
                        h.join(i, j)
            assert all((g.find(i) == g.find(j)) == (h.find(i) == h.find(j)) for i in range(len(sets)) for j in range(i))


def test_components_of_chains_and_hubs(spark, monkeypatch):
    rnd = random.Random(6)
    pairs = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 400)] + [(5000 + i, 5000 + rnd.randrange(900)) for i in range(700)]
    pairs += pairs[:50] + [(7, 7)]
    rnd.shuffle(pairs)
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in pairs:
        p, q = find(a), find(b)
        up[max(p, q)] = min(p, q)
    want = {x: find(x) for x in list(up)}
    links = spark.createDataFrame([(-a, -b) for a, b in pairs], "a long, b long").selectExpr("-a AS a", "-b AS b")
    for size in (1 << 17, 40):
        monkeypatch.setattr(linkgroups, "TASK_LINKS", size)
        got = linkgroups.link_components(links).collect()
        assert len(got) == len(want) and {r.node: r.comp for r in got} == want
    assert linkgroups.link_components(links.limit(0)).count() == 0


def test_words_that_polynomials_confuse(spark):
    """The Thue-Morse words of 1,024 letters are equal modulo 2**64 under every base."""
    bits = [0]
    while len(bits) < 1024:
        bits += [1 - x for x in bits]
    one, other = "".join("ab"[x] for x in bits), "".join("ba"[x] for x in bits)
    got = ngram_join.linked_documents(docs_frame(spark, [(1, one), (2, other), (3, one)])).orderBy("doc_id").collect()
    assert [r.component_id for r in got] == [1, 2, 1]


def test_span_hashes_depend_on_every_byte_and_nothing_else():
    rnd = random.Random(9)
    words = sorted({bytes(rnd.choice(b"abz") for _ in range(rnd.randint(1, 40))) for _ in range(3000)})
    text = b" ".join(words)
    w = Words(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    hashes = w.hashes().tolist()
    assert len(set(hashes)) == len(words)
    again = b"  ".join(reversed(words))
    assert Words(np.frombuffer(again, np.uint8), np.array([0, len(again)])).hashes().tolist() == hashes[::-1]
    assert len(Words(np.zeros(0, np.uint8), np.array([0])).hashes()) == 0


def test_shingle_sets():
    import pyarrow as pa

    rnd = random.Random(4)
    texts = [t for _, t in AWKWARD] + [prose(rnd, rnd.randint(0, 9), 5) for _ in range(200)]
    for k in (1, 3, 5):
        assert [len(s) for s in ngram_join.token_sets(pa.array(texts, pa.string()), k)] == [len(word_set(t, k)) for t in texts]


def brute_top(rows, k):
    # repeated rows count as often as they stand, as in the query's SQL
    ok = [(i, tuple(v)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    ints = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in ok]
    out = {}
    for q, v in ints:
        if q % 100 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ints if i != q)
            out[q] = [(i, -s) for s, i in sorted([(-s, i) for i, s in out.get(q, [])] + scored)[:k]]
    return out


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(8)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(0, 0.2, 7)]) for i in range(450)]
    rows += [(1000 + i, rows[5][1]) for i in range(60)]  # ties
    rows += [(2000, [0.0] * 7), (2001, [0.0] * 7), (3000, None), (3001, [1.0, None, 1.0]), (3002, [float("nan")] * 7), (3003, [float("inf")] * 7),
             (None, [1.0] * 7), (4000, [0.5] * 3), rows[6], rows[6], (5000, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS v", "2 AS rb")
    got = bitsliced.top_k(df, df.where("vec_id % 100 = 0"), 10, row_block=128, query_block=3).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        by.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert by == brute_top(rows, 10)
    empty = df.where("vec_id < 0")
    assert bitsliced.top_k(empty, empty, 10).count() == 0
    few = df.where("vec_id in (0, 1, 2)")
    assert bitsliced.top_k(few, few.where("vec_id = 0"), 10).count() == 2


def test_finite_vectors_of_any_size_take_part(spark):
    rng = np.random.default_rng(18)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(0, 10.0 ** (i % 5), 6)]) for i in range(400)]
    rows += [(1000 + i, [3e6 + i, -4e6, 5e5, 0.0, 1.0, 2e6]) for i in range(20)]
    rows += [(2000, [1e15, 0.0, 0.0, 0.0, 0.0, 0.25]), (2001, [0.001, 0.0, 0.0, 0.0, 0.0, 0.25])]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows if i != 300]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    # products with the largest row would pass 64 bits, so it meets small queries only
    asked = df.where("vec_id % 100 = 0 and vec_id <> 2000 and vec_id <> 1000")
    small = [r for r in rows if r[0] != 2000]
    got = {}
    for r in bitsliced.top_k(df.where("vec_id <> 2000"), asked, 10, row_block=64, query_block=3).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == {q: v for q, v in brute_top(small, 10).items() if q != 1000}
    one = bitsliced.top_k(df, df.where("vec_id = 2001"), 3).orderBy("rank").collect()
    ints = {i: [int(np.floor(1024 * x)) for x in v] for i, v in rows}
    want = sorted((-sum(a * b for a, b in zip(ints[2001], v)), i) for i, v in ints.items() if i != 2001)[:3]
    assert [(r.vec_id, r.score) for r in one] == [(i, -s) for s, i in want] and one[0].vec_id == 2000
    with pytest.raises(Exception, match="64 bits"):
        bitsliced.top_k(df, df.where("vec_id = 1001"), 3).collect()


def test_block_kernel_against_matrix_product():
    rng = np.random.default_rng(0)
    for _ in range(200):
        n, q, d = rng.integers(1, 90), rng.integers(1, 6), rng.integers(1, 5)
        top = int(rng.integers(1, 2000))
        x, y = rng.integers(-top, top + 1, (n, d)), rng.integers(-top, top + 1, (q, d))
        ids, own = rng.permutation(n + 5)[:n], rng.integers(0, n, q)
        got = bitsliced.top_of_block(own, y, ids, x, 4, int(rng.integers(1, 7)))
        at = 0
        for i in range(q):
            want = sorted((-int(x[j] @ y[i]), ids[j]) for j in range(n) if ids[j] != own[i])[:4]
            assert [(-s, v) for v, s in zip(got[1][at:at + len(want)], got[2][at:at + len(want)])] == want
            at += len(want)
        assert at == len(got[0])
