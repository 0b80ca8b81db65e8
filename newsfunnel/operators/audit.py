"""Request-log audits (L1, L2): failure streaks and rolling quota.

A per-source window would put a source holding a third of the log into one
task.  Both audits therefore window over (source, time bucket) partitions —
every bucket is an independent task — and stitch buckets exactly:

* quota: each row is also copied into the next bucket as *context*; with the
  bucket at least as wide as the trailing window, a RANGE frame inside
  (source, bucket) sees every row it needs, and only the bucket's own rows are
  emitted;
* streaks: the run key (successes seen so far) is a local prefix count inside
  the bucket plus the bucket's offset, a running sum over the per-bucket
  success totals — a table with one row per (source, bucket).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _micros(ts: str):
    return F.unix_micros(F.col(ts).cast("timestamp"))


def failure_streaks(log: DataFrame, source: str = "source", ts: str = "ts", success: str = "success",
                    tie: str = "event_id", threshold: int = 5, bucket_seconds: int = 3600) -> DataFrame:
    """Runs of consecutive failures per source (gaps and islands).

    run key = number of successes before the row in (ts, tie) order; failures
    sharing a key form one run.  Returns (source, run_start, run_end,
    n_failures, tripped = n_failures >= threshold)."""
    b = F.floor(_micros(ts) / F.lit(bucket_seconds * 1_000_000)).alias("_b")
    x = log.select(source, ts, tie, success, b)
    local_w = Window.partitionBy(source, "_b").orderBy(ts, tie).rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumn("_local", F.sum(F.col(success).cast("long")).over(local_w))
    totals = x.groupBy(source, "_b").agg(F.sum(F.col(success).cast("long")).alias("_n"))
    off_w = Window.partitionBy(source).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("_off", F.coalesce(F.sum("_n").over(off_w), F.lit(0))).drop("_n")
    runs = x.join(offsets, [source, "_b"]).where(~F.col(success)).withColumn("_run", F.col("_off") + F.col("_local"))
    return runs.groupBy(source, "_run").agg(
        F.min(ts).alias("run_start"), F.max(ts).alias("run_end"), F.count(F.lit(1)).alias("n_failures")
    ).select(source, "run_start", "run_end", "n_failures", (F.col("n_failures") >= threshold).alias("tripped"))


def rolling_quota(log: DataFrame, source: str = "source", ts: str = "ts", window_seconds: int = 900,
                  limit: int = 30) -> DataFrame:
    """Requests in the trailing window (inclusive) per source and an over-quota flag."""
    width = window_seconds * 1_000_000
    key = _micros(ts)
    own = log.withColumn("_k", key).withColumn("_b", F.floor(F.col("_k") / F.lit(width))).withColumn("_ctx", F.lit(False))
    ctx = own.withColumn("_b", F.col("_b") + 1).withColumn("_ctx", F.lit(True))
    w = Window.partitionBy(source, "_b").orderBy("_k").rangeBetween(-width, 0)
    both = own.unionByName(ctx).withColumn("in_window", F.count(F.lit(1)).over(w))
    return both.where(~F.col("_ctx")).drop("_k", "_b", "_ctx").withColumn("over_quota", F.col("in_window") >= limit)
