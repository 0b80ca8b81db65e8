"""N-gram Jaccard join of whole texts with signature trees.

Two documents link when ``100 * |A & B| >= percent * |A | B|`` over their sets
of word k-grams.  The way to the linked groups:

1. A frequency sketch of fixed size over all texts puts rare k-grams first in
   the order of k-grams; it steers cost only.
2. One pass writes for each document its set's size, fingerprint and
   signature, and its prefix: the n - ceil(percent% n) + 1 first k-grams in
   that order.  Linked sets share a k-gram of their prefixes.
3. Equal sets fall together (by fingerprint).  Prefix k-grams held by two or
   more different sets are the blocks.
4. Each block is a signature tree, traversed against itself; what the traversal
   connects is returned as a star to its smallest node (never all pairs), so
   blocks that see the same group return the same links.  The components of all
   links are clusters: no link leaves a cluster.
5. Only the sets of cluster members are made again and shipped, once per
   member; the tree of each cluster is traversed with exact comparison, and
   the links found connect everything that is linked.
6. Components of the links, and with them every document's component.

Blocks and clusters are dealt into parts of ``BLOCK`` members, so no group has
to fit one task: a block's parts meet as summary nodes, one a connected group,
a cluster's by one member of each group and then by the members outside its
largest group.

Defined results: a null text counts as ''; a text without words has the empty
set, links with nothing and is its own component; repeated rows link with each
other as equal texts; a null doc_id gets its size and a null component (it
names no document); an empty table gives an empty table.  Set hashes have 64
bits: two different k-grams or sets are taken for equal with probability 2**-64.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsfunnel.functions.lineage import materialize
from newsfunnel.llm.common import bit_marks, int_lists, map_batches, marked, ship, slices, text_arrays
from newsfunnel.llm.linkgroups import link_components
from newsfunnel.llm.sigtree import Groups, Node, build, signature, spanning_links, summaries
from newsfunnel.llm.words import Words, mix, shingles

SKETCH = 1 << 18  # counters of the frequency sketch
MARK_BITS = 1 << 24
BLOCK = 1024  # members of a block or cluster that one task takes


def token_sets(col, k: int) -> list[np.ndarray]:
    """The sorted set of k-gram hashes of each text."""
    w = Words(*text_arrays(col))
    grams, counts = shingles(w, k)
    ends = np.cumsum(counts)
    return [np.unique(grams[e - c:e]) for e, c in zip(ends, counts)]


def frequency_sketch(docs: DataFrame, k: int) -> np.ndarray:
    """How many texts hit each of SKETCH hash counters: a bound of how many hold a k-gram."""
    ship(docs.sparkSession)

    def run(batches):
        total = np.zeros(SKETCH, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                tokens = np.concatenate(token_sets(part.column("text"), k))
                total += np.bincount((tokens & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
        at = np.flatnonzero(total)
        for a in range(0, len(at), 1 << 16):
            some = at[a:a + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["at", "c"])

    folded = docs.select("text").mapInArrow(run, "at int, c long").groupBy("at").agg(F.sum("c").alias("c")).toArrow()  # SKETCH rows at most
    counts = np.zeros(SKETCH, np.int64)
    if folded.num_rows:
        counts[folded.column("at").to_numpy()] = folded.column("c").to_numpy()
    return counts


def features(docs: DataFrame, counts: np.ndarray, k: int, percent: int) -> DataFrame:
    """(doc_id, n, node, prefix, sig) of every document; node is the set's fingerprint."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def run(batch):
        often = shared.value
        for part in slices(batch, "text"):
            sizes, nodes, prefixes, sigs = [], [], [], []
            for s in token_sets(part.column("text"), k):
                n = len(s)
                sizes.append(n)
                if not n:
                    nodes.append(None)
                    prefixes.append(s)
                    sigs.append(None)
                    continue
                nodes.append(int(mix(mix(s ^ np.uint64(n)).sum(keepdims=True))[0].view(np.int64)))
                rank = often[(s & np.uint64(SKETCH - 1)).astype(np.int64)]
                length = n - -(-percent * n // 100) + 1
                prefixes.append(s[np.argsort(rank, kind="stable")[:length]])
                sigs.append(signature(s))
            flat = np.concatenate(prefixes) if prefixes else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()),
                 int_lists(flat.view(np.int64), np.array([len(p) for p in prefixes], np.int64)), pa.array(sigs, pa.binary())],
                names=["doc_id", "n", "node", "prefix", "sig"])

    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, n long, node long, prefix array<long>, sig binary")


def _dealt(df: DataFrame, key: str, count: str, member: str, everywhere: str | None = None) -> DataFrame:
    """Rows of each group, dealt into parts of BLOCK members by column ``part``.  With
    ``everywhere``, how many rows of the group have ``outside``, these are dealt into parts
    of BLOCK too, and each of their parts meets each part of the group."""
    n = F.ceil(F.col(count) / BLOCK)
    own = F.pmod(F.xxhash64(member), n)
    if everywhere:
        k = F.ceil(F.col(everywhere) / BLOCK)

        def upto(count: F.Column) -> F.Column:
            return F.sequence(F.lit(0).cast("long"), count - 1)

        member_of = F.transform(upto(k), lambda j: own * k + j)
        outer = F.pmod(F.xxhash64(F.col(member), F.lit("outside")), k)
        df = df.withColumn("part", F.explode(F.when(F.col("outside"), F.array_union(member_of, F.transform(upto(n), lambda i: i * k + outer)))
                                             .otherwise(member_of)))
    else:
        df = df.withColumn("part", own)
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return df.repartition(parts, key, "part").sortWithinPartitions(key, "part")


def _groups(batches, keys: list[str]):
    """Tables of rows with equal keys, from batches sorted by the keys."""
    rest = None
    for b in batches:
        t = pa.Table.from_batches([b])
        if rest is not None:
            t = pa.concat_tables([rest, t]).combine_chunks()
        if not t.num_rows:
            continue
        cols = [t.column(k).to_numpy() for k in keys]
        new = np.concatenate([[True], np.any([c[1:] != c[:-1] for c in cols], axis=0)])
        starts = np.flatnonzero(new).tolist()
        for a, e in zip(starts[:-1], starts[1:]):
            yield t.slice(a, e - a)
        rest = t.slice(starts[-1])
    if rest is not None and rest.num_rows:
        yield rest


_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _pairs(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([a for a, _ in rows], pa.int64()), pa.array([b for _, b in rows], pa.int64())], schema=_PAIR)


def _centres(nodes: list[int], groups: Groups) -> dict[int, int]:
    """node -> smallest node of its group."""
    least: dict[int, int] = {}
    for i, node in enumerate(nodes):
        r = groups.find(i)
        least[r] = min(node, least.get(r, node))
    return {node: least[groups.find(i)] for i, node in enumerate(nodes)}


def _news(centre: dict[int, int], told: set) -> list[tuple[int, int]]:
    """The stars' links that the task has not returned lately."""
    if len(told) > 200_000:
        told.clear()
    new = [(a, b) for a, b in centre.items() if a != b and (a, b) not in told]
    told.update(new)
    return new


def possible_links(sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): possible links that connect all possibly linked sets of each block,
    a star for each connected group.

    A block is taken in parts, each by its own tree.  What a part connects becomes
    one summary node; the tree over a block's summaries, one level up, connects
    the parts.  A block of one part is done by its first tree.
    """
    # two sets whose sizes are too far apart make no block
    near = (F.col("c") > 2) | (F.col("high") * percent <= F.col("low") * 100)
    held = materialize(sets.select("n", F.explode("prefix").alias("token")).groupBy("token")
                       .agg(F.count("*").alias("c"), F.min("n").alias("low"), F.max("n").alias("high"))
                       .where((F.col("c") > 1) & near).select("token", "c"), "ngram-blocks")
    rows = materialize(sets.select("node", F.explode("prefix").alias("token")).join(held, "token"), "ngram-postings")

    def parts(batches):
        """Links of each part (token null), and the summaries of parts of larger blocks."""
        out, told = [], set()
        for g in _groups(batches, ["token", "part"]):
            nodes, sizes, sigs = (g.column(c).to_pylist() for c in ("node", "n", "sig"))
            leaves = [Node(i, n, s) for i, (n, s) in enumerate(zip(sizes, sigs))]
            groups = Groups(len(leaves))
            if len(leaves) > 1:
                spanning_links(build(leaves), len(leaves), percent, lambda i, j: True, groups)
            centre = _centres(nodes, groups)
            out += [(None, a, b, None, None, None, None) for a, b in _news(centre, told)]
            if g.column("c")[0].as_py() > BLOCK:
                token = g.column("token")[0].as_py()
                out += [(token, centre[nodes[i]], None, low, high, sig, shared) for i, low, high, sig, shared in summaries(leaves, groups)]
            if len(out) > 10_000:
                yield from _rows(out, schema)
                out = []
        yield from _rows(out, schema)

    schema = pa.schema([("token", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("low", pa.int64()), ("high", pa.int64()),
                        ("sig", pa.binary()), ("shared", pa.int64())])
    dealt = _dealt(rows.join(sets.select("node", "n", "sig"), "node"), "token", "c", "node")
    found = materialize(dealt.mapInArrow(parts, "token long, a long, b long, low long, high long, sig binary, shared long"), "ngram-parts")

    def across(batches):
        """Links between the summaries of a block."""
        told = set()
        for g in _groups(batches, ["token", "part"]):
            nodes = g.column("a").to_pylist()
            leaves = [Node.summary(i, *x) for i, x in enumerate(zip(*(g.column(c).to_pylist() for c in ("low", "high", "sig", "shared"))))]
            if len(leaves) > 1:
                groups = Groups(len(leaves))
                spanning_links(build(leaves), len(leaves), percent, lambda i, j: True, groups)
                yield _pairs(_news(_centres(nodes, groups), told))

    # many summaries are dealt into parts too: every part meets every other in a task of its own
    ups = found.where(F.col("token").isNotNull())
    many = materialize(ups.groupBy(F.col("token").alias("m_token")).agg(F.ceil(F.count("*") / BLOCK).alias("m")), "ngram-summaries")
    own, m = F.pmod(F.xxhash64("a"), F.col("m")), F.col("m")
    other = F.explode(F.filter(F.sequence(F.lit(0).cast("long"), m - 1), lambda j: (m == 1) | (j != own)))
    ups = (ups.join(many, F.col("token") == F.col("m_token")).withColumn("other", other)
           .withColumn("part", F.least(own, "other") * m + F.greatest(own, "other")).drop("m_token", "other", "m"))
    n = max(int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    links = ups.repartition(n, "token", "part").sortWithinPartitions("token", "part").mapInArrow(across, "a long, b long")
    return found.where(F.col("token").isNull()).select("a", "b").unionByName(links)


def _rows(rows: list[tuple], schema: pa.Schema):
    cols = list(zip(*rows)) or [()] * len(schema)
    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def exact_links(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b): links found in each part of a cluster, by exact comparison; ``rows`` are
    dealt and hold ``group``, what was connected before (its pairs are not compared)."""

    def run(batches):
        for g in _groups(batches, ["comp", "part"]):
            if g.num_rows < 2:
                continue
            nodes, sizes, sigs, known = (g.column(c).to_pylist() for c in ("node", "n", "sig", "group"))
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in g.column("tokens")]
            groups, first = Groups(len(nodes)), {}
            for i, k in enumerate(known):
                groups.join(first.setdefault(k, i), i)

            def linked(i, j):
                common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                return 100 * common >= percent * (sizes[i] + sizes[j] - common)

            tree = build([Node(i, n, s) for i, (n, s) in enumerate(zip(sizes, sigs))])
            yield _pairs([(nodes[i], nodes[j]) for i, j in spanning_links(tree, len(nodes), percent, linked, groups)])

    return rows.mapInArrow(run, "a long, b long")


def cluster_links(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b): links that connect everything linked in each cluster; ``rows`` are its
    members (comp, c, node, n, sig, tokens).

    A cluster is taken in parts.  For clusters of several parts, one member of
    each group found so far is compared with those of the other parts, which
    joins the parts of a large group of copies; then every member outside a
    cluster's largest group meets all parts, and the largest group is shipped
    once.  A cluster of one part is done by the first step.
    """
    one = materialize(exact_links(_dealt(rows.withColumn("group", F.col("node")), "comp", "c", "node"), percent), "ngram-links")
    large = materialize(rows.where(F.col("c") > BLOCK), "ngram-large")
    if large.isEmpty():
        return one

    def grouped(links: DataFrame) -> DataFrame:
        known = link_components(links).select("node", F.col("comp").alias("known"))
        return large.join(known, "node", "left").withColumn("group", F.coalesce("known", "node")).drop("known")

    now = grouped(one)
    heads = now.where(F.col("node") == F.col("group"))
    count = materialize(heads.groupBy(F.col("comp").alias("h_comp")).agg(F.count("*").alias("heads")), "ngram-heads")
    heads = heads.join(count, F.col("comp") == F.col("h_comp")).drop("h_comp")
    two = materialize(exact_links(_dealt(heads, "comp", "heads", "node"), percent), "ngram-links")
    now = materialize(grouped(one.union(two)), "ngram-large")
    sizes = now.groupBy("comp", "group").agg(F.count("*").alias("size"))
    main = materialize(sizes.groupBy(F.col("comp").alias("m_comp")).agg(F.max_by("group", F.struct("size", "group")).alias("main"), F.count("*").alias("left"),
                                                                                 (F.sum("size") - F.max("size")).alias("others")),
                       "ngram-main")
    open_ = now.join(main, F.col("comp") == F.col("m_comp")).where("left > 1").withColumn("outside", F.col("group") != F.col("main"))
    three = materialize(exact_links(_dealt(open_, "comp", "c", "node", "others"), percent), "ngram-links")
    return one.union(two).union(three)


def member_sets(docs: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """(node, tokens) of the members (node, low): made again from their documents.  A
    bitmap of their ids picks the rows before any text is split or shipped."""
    def bit(c):
        return F.pmod(F.xxhash64(c), F.lit(MARK_BITS)).alias("bit")

    shared = docs.sparkSession.sparkContext.broadcast(bit_marks(members.select(bit("low")), MARK_BITS))

    def run(batch):
        batch = batch.filter(pa.array(marked(shared.value, batch.column("bit").to_numpy())))
        for part in slices(batch, "text"):
            sets = token_sets(part.column("text"), k)
            nodes = [int(mix(mix(s ^ np.uint64(len(s))).sum(keepdims=True))[0].view(np.int64)) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(nodes, pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                                             names=["id", "node", "tokens"])

    made = map_batches(docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text", bit("doc_id")), run, "id long, node long, tokens binary")
    kept = made.join(members, (made.node == members.node) & (made.id == members.low), "left_semi")
    return kept.dropDuplicates(["node"]).select("node", "tokens")


def linked_documents(docs: DataFrame, k: int = 3, percent: int = 90) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text)."""
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    every = materialize(features(docs, frequency_sketch(docs, k), k, percent), "ngram-features")
    sets = materialize(every.where(F.col("node").isNotNull() & F.col("doc_id").isNotNull()).groupBy("node")
                       .agg(F.min("doc_id").alias("low"), F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.first("sig").alias("sig")),
                       "ngram-sets")
    clusters = link_components(possible_links(sets, percent))
    members = materialize(clusters.join(sets.select("node", "low", "n", "sig"), "node"), "ngram-members")
    sizes = materialize(members.groupBy(F.col("comp").alias("c_comp")).agg(F.count("*").alias("c")), "ngram-clusters")
    tokens = materialize(member_sets(docs, members.select("node", "low"), k), "ngram-tokens")
    rows = members.join(sizes, F.col("comp") == F.col("c_comp")).drop("c_comp").join(tokens, "node")
    comps = link_components(cluster_links(rows, percent))
    # the smallest document of each component, and that of each set
    low = sets.select("node", "low")
    least = materialize(comps.join(low, "node").groupBy("comp").agg(F.min("low").alias("least")), "ngram-least")
    of_node = materialize(comps.join(least, "comp").select("node", "least"), "ngram-of-node")
    found = materialize(low.join(of_node, "node", "left").select("node", F.coalesce("least", "low").alias("component_id")), "ngram-found")
    return (every.select("doc_id", F.col("n").alias("n_shingles"), "node").join(found, "node", "left")
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")))
