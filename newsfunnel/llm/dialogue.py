"""Conversation structure repair: the cheapest edits that give legal turns.

A conversation is legal when the initials of its roles read ``(s?(ua)+)?``: an optional
system turn, then user and assistant in turn, or nothing at all.  The edits of a row are
Keep (0), Rerole to user or assistant (1) and Delete (2, the only one for blank and
duplicate rows); Insert adds a turn with empty text anywhere (5).  A truncated row that
stays costs 5 more.  Of the cheapest repairs the one whose edit letters are ASCII-least
wins, and shorter sorts before longer.

Method: every path of edits has one scalar weight, a big integer.  Its high digits are the
cost; below them stands one base-8 digit for each edit, at the edit's place in the
sequence, and zeros pad the end.  So a plain integer minimum decides cost first and
letters second, and the DAG (rows x four states) is solved by taking minima alone; the
audit is read back from the winner's digits.

Long conversations: the digits of a block of ``BLOCK`` rows are kept; then the paths of
the four states are ranked and the rank becomes one digit above the next block's.  That
loses nothing: two paths that consumed the same rows are prefixes of one another only
where one has further inserts at its end (each row gives exactly one letter that is not
I), so those inserts are carried into the next block and such paths share a rank.  Equal
costs into one state therefore always differ at a digit that both have.

Spark: one shuffle by conversation.  A running row number finds duplicates; sorted rows
stream through ``mapInArrow``, which holds four paths, not the conversation.  SHA-256 takes
bytes in order only, so the bytes of one conversation pass one task, whatever its
length; they are hashed block by block and dropped.

Defined results: a null role or text counts as one space.  Rows of one turn are taken by
role, then text (byte order); null turns come first.  A role without characters has no
initial and is never kept.  Rows whose conversation id is null form one conversation.
A conversation with no row left has zeros, an empty audit and the empty string's hash.  An
empty table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsfunnel.llm.common import ship

COST = {"D": 2, "I": 5, "K": 0, "R": 1}
CUT_SHORT = 5  # a truncated row that stays
CODE = {"D": 1, "I": 2, "K": 3, "R": 4}  # digits in ASCII order; 0 pads
LETTER = {v: k for k, v in CODE.items()}
EMPTY, SYSTEM, USER, ASSISTANT = range(4)  # initials so far: none, s, ...u, ...a
MOVES = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
NEXT = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # where a free choice of role leads
ROLE = {USER: "user", ASSISTANT: "assistant"}
ADJACENT = frozenset(("su", "ua", "au"))

DIGIT = 3  # bits
BLOCK = 64
WIDTH = 3 * BLOCK + 8  # edits in a block: at most two inserts and one other a row, and what is carried
RANK_AT = DIGIT * WIDTH
COST_AT = RANK_AT + DIGIT
DIGITS = {k: [c << (DIGIT * (WIDTH - 1 - p)) for p in range(WIDTH)] for k, c in CODE.items()}
PRICE = [n << COST_AT for n in range(COST["R"] + CUT_SHORT + 1)]

RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
          "audit string, repaired_sha256 string")
_MOST = (1 << 63) - 1
_INK = r"[^\x20\x09-\x0D]"
_SPACE = " \t\n\x0b\x0c\r"


class Repair:
    """Forward pass over one conversation's rows in order; memory: four paths, the
    letters so far and the texts of one block."""

    def __init__(self):
        # state -> (weight, edits in the block, chain of emitted (role, text), base);
        # base: what stands before the block: (letters as a chain of strings, hash or None)
        self.paths = {EMPTY: (0, 0, None, (None, None))}
        self.rows = 0
        self._insert()

    def _offer(self, to, state, weight, places, chain, base):
        old = to.get(state)
        if old is None or weight < old[0]:
            to[state] = (weight, places, chain, base)

    def _insert(self):
        for _ in range(2):  # a third insert would come back to a state, at a higher cost
            for s, (w, p, chain, base) in list(self.paths.items()):
                t = NEXT[s]
                self._offer(self.paths, t, w + PRICE[COST["I"]] + DIGITS["I"][p], p + 1, (chain, ROLE[t], ""), base)

    def row(self, role: str, text: str, must_go: bool, cut_short: bool) -> None:
        extra = CUT_SHORT if cut_short else 0
        first = role[:1]
        new: dict = {}
        for s, (w, p, chain, base) in self.paths.items():
            self._offer(new, s, w + PRICE[COST["D"]] + DIGITS["D"][p], p + 1, chain, base)
            if must_go:
                continue
            t = MOVES.get((s, first))
            if t is not None:
                self._offer(new, t, w + PRICE[extra] + DIGITS["K"][p], p + 1, (chain, role, text), base)
            t = NEXT[s]
            self._offer(new, t, w + PRICE[COST["R"] + extra] + DIGITS["R"][p], p + 1, (chain, ROLE[t], text), base)
        self.paths = new
        self._insert()
        self.rows += 1
        if self.rows % BLOCK == 0:
            self._close_block()

    @staticmethod
    def _letters(weight: int, places: int) -> str:
        return "".join(LETTER[weight >> (DIGIT * (WIDTH - 1 - k)) & 7] for k in range(places))

    @staticmethod
    def _hash(chain, before):
        """``before`` and the turns of ``chain`` after it."""
        turns = []
        while chain is not None:
            chain, role, text = chain
            turns.append(f"{role}:{text}")
        if not turns:
            return before
        h = before.copy() if before is not None else hashlib.sha256()
        if before is not None:
            h.update(b"\n")
        h.update("\n".join(reversed(turns)).encode("utf-8", "surrogatepass"))
        return h

    def _close_block(self):
        seen = []
        for s, (w, p, chain, base) in self.paths.items():
            letters = self._letters(w, p)
            core = letters.rstrip("I")
            seen.append((s, w >> COST_AT, (w >> RANK_AT & 7, core), len(letters) - len(core), chain, base))
        ranks = {key: n for n, key in enumerate(sorted({x[2] for x in seen}))}
        self.paths = {}
        for s, cost, key, tail, chain, (before, sha) in seen:
            carried = []
            for _ in range(tail):
                chain, role, text = chain
                carried.append((role, text))
            base = ((before, key[1]), self._hash(chain, sha))
            weight, chain = (cost << COST_AT) + (ranks[key] << RANK_AT), None
            for k, (role, text) in enumerate(reversed(carried)):
                weight += DIGITS["I"][k]
                chain = (chain, role, text)
            self.paths[s] = (weight, tail, chain, base)

    def result(self) -> tuple[int, str, str]:
        """(cost, audit, SHA-256 of the repaired turns)."""
        w, p, chain, (before, sha) = min(self.paths[s] for s in (EMPTY, ASSISTANT) if s in self.paths)
        parts = [self._letters(w, p)]
        while before is not None:
            before, letters = before
            parts.append(letters)
        done = self._hash(chain, sha)
        return w >> COST_AT, "".join(reversed(parts)), (done or hashlib.sha256()).hexdigest()


class _Conversation:
    """The figures of one conversation while its rows stream by."""

    def __init__(self, conv_id):
        self.conv_id, self.repair = conv_id, Repair()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.initial = None

    def row(self, turn, role, text, blank, seen, cut_short):
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1
        if self.initial is not None and self.initial + role[:1] not in ADJACENT:
            self.illegal += 1
        self.initial = role[:1]
        cut_short = cut_short and not (blank or seen)
        self.blank += blank
        self.duplicate += seen and not blank
        self.truncated += cut_short
        self.repair.row(role, text, blank or seen, cut_short)

    def result(self) -> tuple:
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.turns, _MOST)
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, *self.repair.result())


def damage(conversations: DataFrame) -> DataFrame:
    """Rows after the seeded damage: (key, conv_id, turn, role, text, copies); ``copies`` is 0 for a
    dropped row (kept, without text, so that its conversation is not forgotten) and 2 for a repeated one."""
    def said(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    hit = conversations.select(said("conv_id").alias("key"), F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                               said("role").alias("role"), said("text").alias("text"),
                               (F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20).alias("hit"))
    n = F.col("hit")
    return hit.select("key", "conv_id", "turn", F.when(n == 4, "user").otherwise(F.col("role")).alias("role"),
                      F.when((n == 0) | (n == 1), "").when(n == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
                      F.when(n == 0, 0).when(n == 3, 2).otherwise(1).alias("copies"))


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows of a conversation together and in order, with their faults.  One shuffle: the
    window's key holds the shuffle's."""
    faults = rows.select("*", (~F.col("text").rlike(_INK)).alias("blank"),
                         (~F.substring(F.rtrim(F.col("text"), F.lit(_SPACE)), -1, 1).isin(".", "!", "?")).alias("cut"),
                         F.sha2(F.col("text"), 256).alias("sha"))
    same = Window.partitionBy("key", "role", "sha", F.col("copies") > 0).orderBy(F.col("turn").asc_nulls_first())
    return (faults.repartition("key").withColumn("nth", F.row_number().over(same)).drop("sha")
            .sortWithinPartitions("key", F.col("turn").asc_nulls_first(), "role", "text", "nth"))


def _rows(batches) -> Iterator[tuple]:
    cols = ("key", "conv_id", "turn", "role", "text", "copies", "blank", "cut", "nth")
    for b in batches:
        yield from zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in cols))


def _batches(records: Iterator[tuple], schema: pa.Schema, max_rows: int = 2000) -> Iterator[pa.RecordBatch]:
    held = []
    for r in records:
        held.append(r)
        if len(held) == max_rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _figures(batches) -> Iterator[tuple]:
    key, now = None, None
    for k, conv_id, turn, role, text, copies, blank, cut, nth in _rows(batches):
        if now is None or k != key:
            if now is not None:
                yield now.result()
            key, now = k, _Conversation(conv_id)
        for copy in range(copies):
            now.row(turn, role, text, blank, nth > 1 or copy > 0, cut)
    if now is not None:
        yield now.result()


def repair_audit(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (columns as ``damage`` gives them): ``RESULT``."""
    ship(rows.sparkSession)
    schema = pa.schema([(f.split()[0], pa.string() if f.endswith("string") else pa.int64()) for f in RESULT.split(", ")])
    return _ordered(rows).mapInArrow(lambda batches: _batches(_figures(batches), schema), RESULT)


def _applied(batches) -> Iterator[tuple]:
    """The edits of each conversation's audit (its first row) applied to the rows after it."""
    key, conv_id, letters, at, state, seq = None, None, "", 0, EMPTY, 0

    def inserts():
        nonlocal at, state, seq
        while at < len(letters) and letters[at] == "I":
            at, state, seq = at + 1, NEXT[state], seq + 1
            yield conv_id, seq, "I", ROLE[state], ""

    for b in batches:
        for k, c, audit, role, text, copies in zip(*(b.column(b.schema.get_field_index(n)).to_pylist() for n in ("key", "conv_id", "audit", "role", "text", "copies"))):
            if audit is not None:
                yield from inserts()
                key, conv_id, letters, at, state, seq = k, c, audit, 0, EMPTY, 0
                continue
            for _ in range(copies):
                yield from inserts()
                edit, at = letters[at], at + 1
                if edit == "K":
                    state, seq = MOVES[state, role[:1]], seq + 1
                    yield conv_id, seq, edit, role, text
                elif edit == "R":
                    state, seq = NEXT[state], seq + 1
                    yield conv_id, seq, edit, ROLE[state], text
    yield from inserts()


def repaired_turns(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """The repaired conversations: (conv_id, seq from 1, edit, role, text) of every turn that stays or is
    inserted.  ``audits``: what ``repair_audit`` gave for ``rows``."""
    plan = audits.select(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("key"), "conv_id", "audit",
                         F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"), F.lit(0).alias("copies"))
    told = plan.unionByName(rows.select("key", "conv_id", F.lit(None).cast("string").alias("audit"), "turn", "role", "text", "copies"))
    schema = pa.schema([("conv_id", pa.int64()), ("seq", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
    ship(rows.sparkSession)
    # a repeated row stands once with copies 2, and equal rows are interchangeable but for their first, which the plan's letters tell
    return (told.repartition("key")
            .sortWithinPartitions("key", F.col("audit").isNull(), F.col("turn").asc_nulls_first(), "role", "text")
            .mapInArrow(lambda batches: _batches(_applied(batches), schema), "conv_id long, seq long, edit string, role string, text string"))
