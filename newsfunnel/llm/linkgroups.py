"""Connected components of a link table by contraction in tasks of bounded size.

A task takes about ``TASK_LINKS`` links and replaces each of its components by a star to
its smallest node.  Where one task holds all links that is the answer.  Otherwise a node
may have a centre in several tasks; these centres and the links between them are a smaller
graph, which is contracted in the same way, and its answer is carried back.  A
component's size never matters: a task sees some of its links, and the star of a node that
all rows name is dealt over all tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsfunnel.functions.lineage import materialize
from newsfunnel.llm.common import ship

TASK_LINKS = 1 << 17


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, the smallest node of each one's component)."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    root = np.arange(len(nodes))
    while True:
        p, q = root[x], root[y]
        low = np.minimum(p, q)
        new = root.copy()
        np.minimum.at(new, p, low)
        np.minimum.at(new, q, low)
        while True:
            up = new[new]
            if np.array_equal(up, new):
                break
            new = up
        if np.array_equal(new, root):
            return nodes, nodes[root]
        root = new


def _contract(batches):
    held = [(b.column("a").to_numpy(), b.column("b").to_numpy()) for b in batches]
    if not held:
        return
    nodes, roots = stars(*(np.concatenate(c) for c in zip(*held)))
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(roots)], names=["node", "comp"])


def link_components(links: DataFrame) -> DataFrame:
    """(node, comp) of every node of ``links`` (a, b: long); comp is the component's smallest node."""
    ship(links.sparkSession)
    table = materialize(links.select("a", "b"), "group-links")
    tasks = -(-table.count() // TASK_LINKS)
    # dealt by both ends: a node of many links is spread, and equal links meet
    dealt = table.repartition(tasks, "a", "b") if tasks > 1 else table.coalesce(1)
    found = materialize(dealt.mapInArrow(_contract, "node long, comp long"), "group-stars")
    if tasks <= 1:
        return found
    least = materialize(found.groupBy("node").agg(F.min("comp").alias("comp"), F.max("comp").alias("other")), "group-least")
    several = found.join(least.where("comp < other").select("node", F.col("comp").alias("low")), "node")
    between = several.where("comp > low").select(F.col("comp").alias("a"), F.col("low").alias("b")).distinct()
    if between.isEmpty():
        return least.select("node", "comp")
    up = link_components(between).select(F.col("node").alias("comp"), F.col("comp").alias("top"))
    return materialize(least.join(up, "comp", "left").select("node", F.coalesce("top", "comp").alias("comp")), "group-found")
