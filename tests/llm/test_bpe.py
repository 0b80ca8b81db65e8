import random

import public_tokenizers as P
import tiktoken
from llm_helpers import AWKWARD, docs_frame
from tokenizers import Tokenizer

from newsfunnel.llm import bpe
from newsfunnel.llm.prefix_bpe import PrefixBPE, PrefixCounts, read_ranks

ALPHABET = ["a", "b", "e", "th", "in", "'", "'s", "'re", "l", "'ll", " ", "  ", "\n", "\t", " ", "\x1c", "\x85", "　", "é", "ß", "1",
            "２", "½", "中", "😀", "́", "-", "!?", "<|endoftext|>", "<|", "of", "ſ", "​", "\0", "Hello", "the", "ing"]


def models():
    tokens, ids, _ = read_ranks(P.path("byte_bpe_50k.tiktoken"))
    plain = PrefixBPE(tokens, ids, P.PATTERN)
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=dict(zip(tokens, ids)), special_tokens={})
    return plain, enc, PrefixBPE(*read_ranks(P.path("byte_bpe_50k.json"))[:2], P.PATTERN, read_ranks(P.path("byte_bpe_50k.json"))[2]), \
        Tokenizer.from_file(P.path("byte_bpe_50k.json"))


def test_prefix_tables_against_the_libraries():
    plain, enc, special, lib = models()
    rnd = random.Random(5)
    for _ in range(600):
        s = "".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 25)))
        want = enc.encode_ordinary(s)
        assert plain.encode(s) == want
        assert special.encode(s) == lib.encode(s, add_special_tokens=False).ids
        table = plain.text_table(s)
        assert [plain.ids[t] for t in plain.walk(table)] == want
        a = rnd.randint(0, len(s))
        b = rnd.randint(a, len(s))
        new = "".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 3)))
        assert plain.replace(s, table, a, b, new) == (s[:a] + new + s[b:], plain.text_table(s[:a] + new + s[b:]))
        counts = [len(lib.encode(s[:e], add_special_tokens=False).ids) for e in range(len(s) + 1)]
        pc = PrefixCounts(special, s)
        assert [pc.count(e) for e in range(len(s) + 1)] == counts
        for limit in (0, 1, 3, 6):
            assert pc.cut(limit) == max(e for e, c in enumerate(counts) if c <= limit)


def test_every_vocabulary_entry_is_its_own_encoding():
    plain, enc, _, _ = models()
    for r in range(0, len(plain.tokens), 97):
        assert plain.walk(plain.table(plain.tokens[r])) == [plain.rank[t] for t in map(plain.tokens.__getitem__, enc._encode_single_piece(plain.tokens[r]))]


def test_encode_decode_rows(spark):
    _, enc, _, _ = models()
    vocab = bpe.vocabulary(spark, P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    rows = AWKWARD + [(1, "word " * 30_000), (2, "double  space and trailing ")]
    got = bpe.decode(bpe.encode(docs_frame(spark, rows, extra=1), vocab), vocab).collect()
    want = sorted(((i, enc.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows), key=str)
    assert sorted(((r.doc_id, list(r.ids), bytes(r.decoded)) for r in got), key=str) == want
    assert bpe.encode(docs_frame(spark, []), vocab).count() == 0


def test_columns_of_the_same_name_are_replaced(spark):
    from newsfunnel.llm import linedup, pii, secrets, toxicity

    _, enc, _, _ = models()
    vocab = bpe.vocabulary(spark, P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    df = docs_frame(spark, [(1, "a b c")], IDS="x", decoded=1, n_tokens="y", Findings=2, score="z", removed_lines="q", N_ENTITIES="e", ids_1=3)
    coded = bpe.decode(bpe.encode(df, vocab), vocab)
    row = coded.first()
    assert list(row.ids) == enc.encode_ordinary("a b c") and bytes(row.decoded) == b"a b c" and row.ids_1 == 3
    assert "ids" in bpe.encode_decode(df, vocab).columns and "IDS" in bpe.encode(df, vocab, ids_col="tokens").columns
    assert bpe.token_counts(df, vocab, 1).first().n_tokens == 3
    assert secrets.scan(df).first().findings == [] and linedup.dedup_lines(df).first().removed_lines == 0
    assert pii.replace_entities(df, "k").first().n_entities == 0
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    assert 0 <= toxicity.score(df, toxicity.fit(df, labels)).first().score <= 1


def test_append_and_edit_rows(spark):
    from pyspark.sql import functions as F

    _, enc, _, _ = models()
    vocab = bpe.vocabulary(spark, P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    rows = [(1, "some text that goe"), (2, ""), (3, "it  '"), (4, None)]
    coded = bpe.encode(docs_frame(spark, rows), vocab, table_col="table")
    longer = bpe.reencode(coded.withColumns({"s": F.lit(None).cast("int"), "e": F.lit(None).cast("int"), "new": F.lit("s on 're")}),
                          vocab, "text", "table", "s", "e", "new").collect()
    for r in longer:
        assert r.new_text == (r.text or "") + "s on 're" and list(r.new_ids) == enc.encode_ordinary(r.new_text)


def test_counts_and_budget(spark):
    from pyspark.sql import functions as F

    lib = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    vocab = bpe.vocabulary(spark, P.path("byte_bpe_50k.json"), P.PATTERN)
    n = lambda t: len(lib.encode(t, add_special_tokens=False).ids)
    rows = AWKWARD + [(1, "ends <|endoftext|> inside <|endoftext|>"), (2, "the thing. " * 40), (3, "a  b\n c " * 9)]
    for r in bpe.token_counts(docs_frame(spark, rows), vocab, 12).collect():
        t = r.text or ""
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(t.encode()), n(t), n(t) > 12)
        if len(t) < 500:
            assert r.fit_chars == max(e for e in range(len(t) + 1) if n(t[:e]) <= 12)
    ends = docs_frame(spark, [(1, "it's  two\nlines <|endoftext|> x")]).withColumn("ends", F.array(*map(F.lit, range(0, 40))))
    got = bpe.prefix_counts(ends, vocab, "ends").first()
    assert list(got.counts) == [n(got.text[:e]) for e in range(40)]


def test_limits_around_every_kind_of_border(spark):
    """The longest prefix within every small limit, on texts that are cut at each kind of border."""
    lib = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    vocab = bpe.vocabulary(spark, P.path("byte_bpe_50k.json"), P.PATTERN)
    rnd = random.Random(15)
    rows = [(k, "".join(rnd.choice(ALPHABET + [" ", " the", "\n ", "\n\n", " it's", " they've"]) for _ in range(rnd.randint(0, 14)))) for k in range(400)]
    rows += [(1000 + k, t) for k, t in enumerate(["a\n b", "a\n\n b c", "\n\n b", "we'll go", "x<|endoftext|>", "!!<|endoftext|> y", "a  <|endoftext|><|endoftext|>b", "<|endoftext", "l'l", "'re 're"])]
    df = docs_frame(spark, rows)
    for limit in (0, 1, 2, 3, 5, 8):
        for r in bpe.token_counts(df, vocab, limit).collect():
            t = r.text or ""
            counts = [len(lib.encode(t[:e], add_special_tokens=False).ids) for e in range(len(t) + 1)]
            assert r.n_tokens == counts[-1] and r.over_limit == (counts[-1] > limit), t
            assert r.fit_chars == max(e for e, n in enumerate(counts) if n <= limit), (t, limit)


def test_a_megabyte_without_a_space(spark):
    """Time in proportion to the length, for one unbroken run of each kind."""
    import time

    plain, enc, special, lib = models()
    rnd = random.Random(16)
    letters = "".join(rnd.choice("etaoinshrdlucm") for _ in range(1 << 20))
    kinds = {"letters": letters, "one": "a" * (1 << 20), "signs": "=-" * (1 << 19), "blanks": "\n" * (1 << 18) + " x", "special": "!" * (1 << 18) + "<|endoftext|>" * 50}
    vocab = bpe.vocabulary(spark, P.path("byte_bpe_50k.json"), P.PATTERN)
    df = docs_frame(spark, list(enumerate(kinds.values())))
    began = time.perf_counter()
    got = {r.doc_id: r for r in bpe.token_counts(df, vocab, 1024).collect()}
    assert time.perf_counter() - began < 60
    for k, t in enumerate(kinds.values()):
        small = lib.encode(t[:got[k].fit_chars + 40], add_special_tokens=False).ids
        assert got[k].over_limit and len(lib.encode(t[:got[k].fit_chars], add_special_tokens=False).ids) <= 1024 < len(small) + 1
        assert got[k].n_tokens == len(lib.encode(t, add_special_tokens=False).ids)


def test_workers_drop_the_tables_of_other_operators(spark):
    """One worker at a time: its tables stay for tasks of their owner and go when another operator begins."""
    from newsfunnel.llm import common

    vocab = bpe.vocabulary(spark, P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    one = spark.range(1).selectExpr("'some words' AS text").coalesce(1)
    tables = bpe._tables(vocab)
    assert bpe._tables(vocab) is tables
    common.forget_others("bpe")
    assert bpe._tables(vocab) is tables
    common.forget_others("")
    assert not common.held("bpe")
    assert bpe.encode(one, vocab).first().ids


def test_each_pre_token_is_counted_once(monkeypatch):
    """Chunks that share a pre-token share its table, and have the counts that each has alone."""
    from newsfunnel.llm.prefix_bpe import exact_counts

    special = models()[2]
    rnd = random.Random(27)
    words = ["undchtz", "ofthing", "the", "éçmenten", "中😀ß", "12½"]
    chunks = [a + b + c for a in words for b in ("", ",", ".\n", "\n\n", "'s ".strip(), "!?'re", "\x1c", "\x85　") for c in ("", "Does")]
    chunks += ["".join(rnd.choice([x for x in ALPHABET if " " not in x]) for _ in range(rnd.randint(1, 9))) for _ in range(400)]
    chunks = [c for c in chunks if bpe._chunks(special, "x " + c)]
    want = {c: list(exact_counts(special, " " + c)) for c in chunks}
    cache = bpe._Counts(special)
    cache.prepare([["x", *chunks[:40]]], 900_000)
    cache.prepare([["x", *chunks]], 900_000)
    assert {c: list(cache[c]) for c in chunks} == want
    made = []
    table = special.table
    monkeypatch.setattr(special, "table", lambda piece, last=None: made.append(piece) or table(piece, last))
    cache = bpe._Counts(special)
    cache.prepare([["x", "undchtz"]], 900_000)
    cache.prepare([["x", "undchtz,", "undchtz.", "undchtz.\nDoes", "undchtz,,"]], 900_000)
    assert made.count(b" undchtz") == 1 and len(made) == len(set(made))
