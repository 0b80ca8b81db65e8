"""Connected components of a link table, with the work spread over rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsfunnel.functions.lineage import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, comp) of every node of ``links`` (a, b); comp is the smallest node.

    A round gives each node the least of its own label, its neighbours' labels
    and its label's label (pointer jumping), in one aggregate; long chains
    shrink by about half a round.  Rounds go on until nothing changes.  The
    joins read written tables, so Spark can split the label of a very large
    component.
    """
    both = materialize(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                         .select("node", F.least("node", "m").alias("comp")), "labels")
    while True:
        own = labels.select("node", "comp", F.col("comp").alias("was"))
        none = F.lit(None).cast(own.schema["comp"].dataType).alias("was")
        near = both.join(labels.select(F.col("node").alias("b"), "comp"), "b").select(F.col("a").alias("node"), "comp", none)
        jump = labels.join(labels.select(F.col("node").alias("comp"), F.col("comp").alias("next")), "comp").select(
            "node", F.col("next").alias("comp"), none)
        new = materialize(own.unionByName(near).unionByName(jump).groupBy("node").agg(F.min("comp").alias("comp"), F.min("was").alias("was")), "labels")
        labels = new.select("node", "comp")
        if new.where(F.col("comp") != F.col("was")).isEmpty():
            return labels
