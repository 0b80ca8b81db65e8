"""Cutting lineage with a written table in the shared checkpoint folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame

from newsfunnel.session import ensure_checkpoint_dir


def materialize(df: DataFrame, label: str = "stage", partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once as parquet under ``spark.checkpoint.dir`` and read it back.

    One job, columnar, survives executor loss (the files live in the shared
    folder the cluster names), and later stages read only the columns they
    need.  Unlike an eager ``checkpoint()`` of an unpersisted DataFrame, the
    plan is computed once.  With ``partition_by`` each value has its own folder;
    the given schema is used to read it back, so an empty table keeps its columns.
    """
    spark = df.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), "tables", f"{label}-{uuid.uuid4().hex}")
    if not partition_by:
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_columns_once(df: DataFrame, cols: dict) -> DataFrame:
    """Add columns that are evaluated exactly once per row.

    Catalyst inlines a projected alias into every expression (and every pushed-
    down filter) that references it; for an expensive value — a parsed XML
    document, a matched-terms array — that means several evaluations per row.
    Generator outputs are attributes that cannot be inlined or filtered below,
    so the values are produced by a one-row ``inline(array(struct(...)))``.
    """
    from pyspark.sql import functions as F

    st = F.struct(*[c.alias(n) for n, c in cols.items()])
    return df.select("*", F.inline(F.array(st)))
