"""op 13: the law, the slots and the cuts against a tree built in plain Python."""

import random
import zlib

from llm_helpers import AWKWARD, docs_frame

from newsfunnel.llm import kdshards


def plain_tree(points, leaves):
    """points: (coordinates, tie, weight, name) -> name -> shard, by sorting."""
    spans = [max(1, max(p[0][k] for p in points) - min(p[0][k] for p in points)) for k in range(len(points[0][0]))]
    out = {}

    def split(ps, n, first):
        if n == 1 or not ps:
            out.update({p[3]: first for p in ps})
            return
        wide = [(max(p[0][k] for p in ps) - min(p[0][k] for p in ps)) / spans[k] for k in range(len(spans))]
        dim = wide.index(max(wide))
        keys = {}
        for p in ps:
            key = (p[0][dim] << 40) + p[1]
            keys[key] = keys.get(key, 0) + p[2]
        total, below, cut = sum(keys.values()), 0, None
        for key in sorted(keys):
            if (below + keys[key]) * n >= total * (n // 2):
                cut = key if n * (2 * below + keys[key]) > 2 * total * (n // 2) else key + 1
                break
            below += keys[key]
        split([p for p in ps if (p[0][dim] << 40) + p[1] < cut], n // 2, first)
        split([p for p in ps if (p[0][dim] << 40) + p[1] >= cut], n - n // 2, first + n // 2)

    split(points, leaves, 0)
    return out


def test_tree_equals_the_plain_one(spark):
    rnd = random.Random(31)
    for leaves, rows in ((24, 700), (5, 40), (3, 2), (1, 9)):
        points = []
        for k in range(rows):
            coords = tuple(rnd.choice([rnd.randrange(1 << 20), rnd.choice([0, 7, 900])]) for _ in range(3))
            points.append((coords, rnd.choice([5, rnd.randrange(1 << 40)]), rnd.choice([8, 30, 900, 40000]), k))
        points += [((7, 7, 7), 5, 100, rows + k) for k in range(rows // 2)]  # one key of a third of the rows
        df = spark.createDataFrame([(*c, t, w, k) for c, t, w, k in points], "_d0 long, _d1 long, _d2 long, _tie long, _w long, k long")
        got = {r.k: r["_node"] for r in kdshards.kd_nodes(df, ["_d0", "_d1", "_d2"], leaves).collect()}
        assert got == plain_tree(points, leaves)


def check(out, rows, shards):
    got = out.collect()
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=str) == sorted(
        ((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows), key=str)
    places = {}
    for r in got:
        places.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in places.values()) and set(places) <= set(range(shards))
    load = [0] * shards
    for r in got:
        load[r.shard] += r.size
    return load


def test_near_equal_bytes_and_hot_text(spark):
    rnd = random.Random(32)
    rows = [(k, "x" * rnd.choice([0, 10, 300, 5000])) for k in range(900)] + [(5000 + k, "the same text " * 40) for k in range(500)] + [(77, "one row, many times")] * 400
    rows += AWKWARD
    df = docs_frame(spark, rows, shard=1, slot=2, _tie=3, _row=4, size=5).repartition(7)
    load = check(kdshards.shard_documents(df, shards=24), rows, 24)
    assert max(load) - min(load) <= 2 * 5008
    by_target = kdshards.shard_documents(df, target_bytes=200_000)
    n = -(-sum(load) // 200_000)
    assert max(check(by_target, rows, n)) <= 200_000 + 5008


def test_blocks_of_slots(spark, monkeypatch):
    monkeypatch.setattr(kdshards, "BLOCK_ROWS", 8)
    rows = [(k, "y" * (k % 50)) for k in range(600)]
    check(kdshards.shard_documents(docs_frame(spark, rows).repartition(3), shards=4), rows, 4)


def test_empty_and_fewer_rows_than_shards(spark):
    df = docs_frame(spark, [(1, "a"), (2, None)])
    assert kdshards.shard_documents(df.limit(0), shards=24).count() == 0
    check(kdshards.shard_documents(df, shards=24), [(1, "a"), (2, None)], 24)


def test_query_is_native_and_keeps_the_law(spark):
    import __spark_entry__ as E

    out = E.queries()["op13_kd_shards"](spark, "/root/testdata/sf0.01")
    assert dict(out.dtypes) == {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"}
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    load = check(out, rows, 24)
    largest = max(len(t.encode()) + 8 for _, t in rows)
    assert len(load) == 24 and max(load) - min(load) <= largest
