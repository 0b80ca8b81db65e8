"""Fixture rows and brute-force models for the training-data operators."""

from __future__ import annotations

import random
import re

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs_frame(spark, rows, **extra):
    """rows: (doc_id, text). ``extra`` adds constant columns, for clashing names."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOC_SCHEMA)
    for name, value in extra.items():
        df = df.withColumn(name, F.lit(value))
    return df


def prose(rnd: random.Random, n: int, vocab: int = 4000) -> str:
    return " ".join(f"w{rnd.randrange(vocab)}" for _ in range(n))


def edited(rnd: random.Random, text: str, share: float) -> str:
    return " ".join(f"x{rnd.randrange(10 ** 6)}" if rnd.random() < share else w for w in text.split(" "))


AWKWARD = [
    (100, None), (101, ""), (102, "   \n\t "), (None, "a text without an id"), (103, "one"), (104, "one two"),
    (105, "é" * 5000 + " tail"), (106, "same text twice here"), (106, "same text twice here"), (107, "same text twice here"),
    (108, " wide space​ and \U0001F600 emoji \U0001F600\n\n\nlines\r\nend "),
]


def word_set(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute_components(rows, k, percent):
    """doc_id -> (n_shingles, component_id), by all pairs."""
    sets = [(i, word_set(t, k)) for i, t in rows]
    up = {i: i for i, _ in sets if i is not None}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for n, (a, x) in enumerate(sets):
        for b, y in sets[:n]:
            if a is None or b is None or not x or not y:
                continue
            if 100 * len(x & y) >= percent * len(x | y):
                p, q = find(a), find(b)
                up[max(p, q)] = min(p, q)
    return sorted(((i, len(s), find(i) if i is not None else None) for i, s in sets), key=str)
