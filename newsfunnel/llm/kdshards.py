"""Sharding by a k-d tree over the rows' metadata.

Method: the tree starts with all rows and the number of leaves that the target bytes ask
for.  A node with more than one leaf is cut in two along its widest metadata dimension, at
the weighted quantile that gives each side bytes in proportion to its leaves (the
weighted median where the leaves are even in number), until every node is one leaf.  So
leaf sizes are near equal and neighbouring rows share a shard.

Dimensions: every dimension is an integer in [0, 2**20): numbers as the logarithm of their
value, strings as a hash.  A node's width in a dimension is the range that its rows take,
over the range of all rows.

Distributed medians: rows of a node are ordered by (coordinate, tie), one 60-bit key.
The cut is found without sorting or moving rows: a pass sums the weight of ``BINS``
equal bins of each node's key range with partial aggregates, picks the bin in which the
target falls (at most one row a node reaches the driver), and the next pass divides that
bin, until it holds a single key.  All nodes of a level share their passes.  A key of
1/3 of all rows is only a tall bin.  The tie is a hash of the text, then of the doc_id,
then of the row: equal texts with equal metadata stand together and share a shard unless a cut
has to pass through them.

Slots: rows are numbered within blocks of the written narrow table, of bounded size
whatever their values, and blocks are offset by their counts, so no shard is ordered in
one task.

Defined results: a null text has no bytes (size 8, the CRC of nothing); null metadata has
a place of its own (coordinate 0); a null doc_id is a value like any other.  Equal rows are
interchangeable; a cut may pass between them.  Fewer rows than leaves leave empty shards.
An empty table gives an empty table.  A key larger than the rest of its node stays
whole, as one row cannot be divided.  Slots follow the rows as they were read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsfunnel.functions.lineage import materialize
from newsfunnel.llm.common import literal_rows

COORD_BITS = 20
TIE_BITS = 40
BINS = 512  # of a node and pass; the only rows that one task orders
BLOCK_ROWS = 1 << 17  # rows of one numbering task
ROW_BYTES = 8


def log_coord(n: Column) -> Column:
    """Place of a non-negative number: its logarithm in steps of 2**-14 (null: 0)."""
    return F.coalesce(F.least(F.floor(F.log2(F.greatest(n, F.lit(0)) + 1) * (1 << 14)).cast("long") + 1, F.lit((1 << COORD_BITS) - 1)), F.lit(0).cast("long"))


def hash_coord(c: Column) -> Column:
    """Place of a string (null: 0)."""
    return F.when(c.isNull(), F.lit(0).cast("long")).otherwise(F.pmod(F.xxhash64(c), F.lit((1 << COORD_BITS) - 1)) + 1)


def document_dims() -> dict[str, Column]:
    """Metadata of ``documents``: length, bytes a character, language, source."""
    chars, size = F.length("text"), F.octet_length("text")
    return {"length": log_coord(F.col("n_chars")),
            "density": log_coord(F.when(chars > 0, 4096 * size / chars)),
            "lang": hash_coord(F.col("lang").cast("string")),
            "source": hash_coord(F.col("source").cast("string"))}


@dataclass
class Node:
    leaves: int
    first: int  # its first shard
    weight: int = 0
    dim: int = 0
    low: int = 0  # of the interval of keys that holds the cut
    high: int = 0
    before: int = 0  # weight of the node's keys below ``low``
    cut: int | None = None  # keys below it go left


def _key(dim: Column, dims: list[str]) -> Column:
    """The 60-bit key of a row along dimension number ``dim``."""
    picked = F.element_at(F.array(*[F.col(d) for d in dims]), dim + 1)
    return F.shiftleft(picked, TIE_BITS) + F.col("_tie")


def _placed(rows: DataFrame, done: list[list[Node]], dims: list[str]) -> DataFrame:
    """``rows`` with ``_node``: the first shard of the node they are in, after the cuts of the levels ``done``.

    A level's cuts are at most as many as there are shards; they join by broadcast.
    """
    out = rows
    if "_node" not in rows.columns:
        out = rows.withColumn("_node", F.lit(0))
    for level in done:
        cuts = [(n.first, n.dim, n.cut, n.first + n.leaves // 2) for n in level if n.cut is not None]
        if not cuts:
            continue
        table = F.broadcast(literal_rows(rows.sparkSession, cuts, "_node int, _dim int, _cut long, _right int"))
        out = out.join(table, "_node", "left").withColumn(
            "_node", F.when(F.col("_cut").isNotNull() & (_key(F.col("_dim"), dims) >= F.col("_cut")), F.col("_right")).otherwise(F.col("_node"))
        ).drop("_dim", "_cut", "_right")
    return out


def _widest(placed: DataFrame, open_nodes: dict[int, Node], dims: list[str], spans: list[int] | None) -> list[int]:
    """Weight, dimension and key range of each open node; the spans of all rows are those of the root."""
    stats = placed.where(F.col("_node").isin(list(open_nodes))).groupBy("_node").agg(
        F.sum("_w").alias("w"), *[f(d).alias(f"{n}_{d}") for d in dims for n, f in (("min", F.min), ("max", F.max))]).collect()
    for r in stats:
        node = open_nodes[r["_node"]]
        ranges = [(r[f"min_{d}"], r[f"max_{d}"]) for d in dims]
        if spans is None:
            spans = [max(1, b - a) for a, b in ranges]
        node.weight = r["w"]
        node.dim = max(range(len(dims)), key=lambda k: ((ranges[k][1] - ranges[k][0]) / spans[k], -k))
        node.low = ranges[node.dim][0] << TIE_BITS
        node.high = (ranges[node.dim][1] << TIE_BITS) + (1 << TIE_BITS) - 1
    return spans or [1] * len(dims)


def _narrow(placed: DataFrame, seeking: dict[int, Node], dims: list[str]) -> None:
    """One pass: the interval of each seeking node shrinks to the bin in which its target falls."""
    spark = placed.sparkSession
    asked = [(n.first, n.dim, n.low, n.high, max(1, (n.high - n.low) // BINS + 1), n.before, n.weight * (n.leaves // 2), n.leaves) for n in seeking.values()]
    table = F.broadcast(literal_rows(spark, asked, "_node int, _dim int, _low long, _high long, _step long, _before long, _goal long, _leaves int"))
    keyed = placed.join(table, "_node").withColumn("_key", _key(F.col("_dim"), dims)).where("_key between _low and _high")
    bins = keyed.groupBy("_node", "_goal", "_before", "_leaves", F.expr("(_key - _low) div _step").alias("_bin")).agg(
        F.sum("_w").alias("w"), F.min("_key").alias("least"), F.max("_key").alias("most"))
    running = Window.partitionBy("_node").orderBy("_bin")  # at most BINS rows a node
    upto = bins.withColumn("below", F.col("_before") + F.sum("w").over(running) - F.col("w"))
    # the target lies in the first bin whose end reaches goal / leaves
    goal = F.col("_goal").cast("decimal(38,0)")
    hit = upto.where(((F.col("below") + F.col("w")).cast("decimal(38,0)") * F.col("_leaves") >= goal) & (F.col("below").cast("decimal(38,0)") * F.col("_leaves") < goal))
    for r in hit.select("_node", "w", "below", "least", "most").collect():
        n = seeking[r["_node"]]
        n.low, n.high, n.before = r["least"], r["most"], r["below"]
        if n.low == n.high:  # one key: it goes to the side where the sizes differ less
            over = n.leaves * (2 * n.before + r["w"]) > 2 * n.weight * (n.leaves // 2)
            n.cut = n.low if over else n.low + 1


def kd_nodes(rows: DataFrame, dims: list[str], leaves: int) -> DataFrame:
    """``rows`` (``dims``, ``_tie`` of 40 bits, ``_w``) with ``_node``: the leaf, 0 to ``leaves`` - 1.

    ``rows`` should be a written narrow table: about four passes read it for each of the
    log2(leaves) levels.
    """
    level, done, spans = [Node(leaves, 0)], [], None
    while any(n.leaves > 1 for n in level):
        placed = _placed(rows, done, dims)
        todo = {n.first: n for n in level if n.leaves > 1}
        spans = _widest(placed, todo, dims, spans)
        seeking = {k: n for k, n in todo.items() if n.weight}
        while seeking:
            _narrow(placed, seeking, dims)
            seeking = {k: n for k, n in seeking.items() if n.cut is None}
        done.append(level)
        level = [c for n in level for c in ((Node(n.leaves // 2, n.first), Node(n.leaves - n.leaves // 2, n.first + n.leaves // 2)) if n.leaves > 1 else (n,))]
        if len(done) == 5:  # keeps the chain of joins short where there are many leaves
            rows, done = materialize(_placed(rows, done, dims), "kd-level"), []
    return _placed(rows, done, dims)


def numbered(rows: DataFrame, shard: str, row_id: str, slot: str) -> DataFrame:
    """``slot``: gapless from 0 within a shard, in the order of ``row_id`` (``monotonically_increasing_id`` of a
    written table: its high bits tell the written part, its low 33 bits the place)."""
    blocked = rows.withColumn("_block", F.shiftright(row_id, BLOCK_ROWS.bit_length() - 1))
    counts = blocked.groupBy(shard, "_block").agg(F.count("*").alias("_n"))
    # blocks are counted in groups first, so that the list of a shard's blocks is no window of one task's size
    grouped = counts.withColumn("_group", F.shiftright("_block", 16))
    within = Window.partitionBy(shard, "_group").orderBy("_block")
    across = Window.partitionBy(shard).orderBy("_group")
    groups = grouped.groupBy(shard, "_group").agg(F.sum("_n").alias("_m"))
    groups = groups.select(shard, "_group", (F.sum("_m").over(across) - F.col("_m")).alias("_start"))
    offsets = (grouped.withColumn("_at", F.sum("_n").over(within) - F.col("_n")).join(groups, [shard, "_group"])
               .select(shard, "_block", (F.col("_start") + F.col("_at")).alias("_offset")))
    place = Window.partitionBy(shard, "_block").orderBy(row_id)
    return (blocked.withColumn("_place", F.row_number().over(place)).join(offsets, [shard, "_block"])
            .withColumn(slot, (F.col("_offset") + F.col("_place") - 1).cast("long")).drop("_block", "_place", "_offset"))


def shard_facts(docs: DataFrame, dims: dict[str, Column]) -> DataFrame:
    """The narrow table that the tree works on, written once: doc_id, size, text_crc32, the dimensions, tie, weight, row id."""
    body = F.coalesce(F.col("text"), F.lit(""))
    got = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(body).cast("long") + ROW_BYTES).alias("size"),
                      F.crc32(body.cast("binary")).alias("text_crc32"), *[c.alias(f"_d{k}") for k, c in enumerate(dims.values())],
                      F.monotonically_increasing_id().alias("_row"))
    hashed = [F.pmod(F.xxhash64(F.lit(seed), F.col(c)), F.lit(1 << bits)) for seed, (c, bits) in enumerate((("text_crc32", 16), ("doc_id", 12), ("_row", 12)))]
    tie = F.shiftleft(hashed[0], 24) + F.shiftleft(hashed[1], 12) + hashed[2]
    return materialize(got.select("*", tie.alias("_tie"), F.col("size").alias("_w")), "kd-facts")


def shard_documents(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None,
                    dims: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row: ``shards`` leaves, or as many as give leaves of
    at most about ``target_bytes``."""
    dims = dims or document_dims()
    facts = shard_facts(docs, dims)
    if shards is None:
        total = facts.agg(F.sum("_w")).first()[0] or 0
        shards = max(1, -(-total // target_bytes))
    names = [f"_d{k}" for k in range(len(dims))]
    placed = kd_nodes(facts, names, shards).withColumnRenamed("_node", "shard")
    return numbered(placed.select("doc_id", "size", "text_crc32", "shard", "_row"), "shard", "_row", "slot").drop("_row")
