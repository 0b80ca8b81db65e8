"""Secret scan over whole texts through a trigram inverted index.

Each rule is a regex.  Its Boolean trigram query is derived from the parsed
regex; every slice of rows is one index segment with posting lists of exactly
the trigrams that the rules need.  Posting lists are intersected and joined as
the query says, and the regex verifies the candidate rows.  Rules without a
mandatory trigram (long hex runs) scan every row.  Segments are independent:
the scan is narrow, and a lost executor costs only its own segments.

Defined results: a null text counts as ''; repeated rows are scanned each on
its own; an empty table gives an empty table; other columns pass through, one named
like the result is replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsfunnel.llm.common import map_batches, slices, text_arrays, without
from newsfunnel.llm.trigrams import Postings, trigram_query, trigrams_of


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern`` whose ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    flags: int = re.ASCII
    group: int = 0
    least: int = 0


BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         re.ASCII | re.IGNORECASE, group=2, least=6),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]+", least=24),
)
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[sr]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("bearer", r"bearer +[A-Za-z0-9._~+/-]{20,}", re.ASCII | re.IGNORECASE),
)
RULES = BASE_RULES + MORE_RULES

FINDINGS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                     T.StructField("end", T.LongType())]), False)


def scan(df: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", out_col: str = "findings") -> DataFrame:
    """Add ``findings``: array of (kind, start, end) in code points, end exclusive,
    by start and then by the order of ``rules``."""
    df = without(df, out_col)
    schema = T.StructType([*df.schema.fields, T.StructField(out_col, FINDINGS)])
    names = schema.names
    queries = [trigram_query(r.pattern, r.flags) for r in rules]
    wanted = set().union(*map(trigrams_of, queries))
    arrow_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batch):
        compiled = [_finder(r) for r in rules]
        for part in slices(batch, text_col):
            col = part.column(text_col)
            index = Postings(*text_arrays(col), wanted)
            found: dict[int, list] = {}
            for k, (rule, query, regex) in enumerate(zip(rules, queries, compiled)):
                for row in index.matching(query).tolist():
                    text = col[row].as_py()
                    if not text:
                        continue
                    for m in regex.finditer(text):
                        s, e = m.span(rule.group)
                        if e - s >= rule.least:
                            found.setdefault(row, []).append((m.start(), k, m.end()))
            out = [[{"kind": rules[k].kind, "start": s, "end": e} for s, k, e in sorted(found.get(row, ()))]
                   for row in range(part.num_rows)]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, arrow_type)], names=names)

    return map_batches(df, run, schema)


def _finder(rule: Rule) -> re.Pattern:
    """The rule's regex; a plain ``[class]+`` of at least n characters finds the same
    spans as ``[class]{n,}``, which skips short runs inside the regex engine."""
    pattern = rule.pattern
    if rule.group == 0 and re.fullmatch(r"\[[^\]^\\]+\]\+", pattern):
        pattern = f"{pattern[:-1]}{{{max(1, rule.least)},}}"
    return re.compile(pattern, rule.flags)


def span_text(findings: F.Column) -> F.Column:
    """``kind:start:end`` of each finding, comma-joined."""
    return F.concat_ws(",", F.transform(findings, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))))


def digest(scanned: DataFrame, findings: str = "findings") -> DataFrame:
    """Counts of the base kinds, digest of their spans, and all spans as text."""
    f = F.col(findings)
    base = F.filter(f, lambda x: x["kind"].isin(*[r.kind for r in BASE_RULES]))

    def count(kind: str) -> F.Column:
        return F.size(F.filter(f, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return scanned.select("doc_id", *(count(r.kind) for r in BASE_RULES), F.sha2(span_text(base), 256).alias("base_sha256"), span_text(f).alias("spans"))
