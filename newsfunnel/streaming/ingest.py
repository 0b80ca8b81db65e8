"""Streaming ingest with a 24 h URL dedup (L3) and resumable progress (L4).

``readStream`` over a folder of landed ref files -> validation -> URL
normalisation -> event-time watermark -> ``dropDuplicatesWithinWatermark`` on
the normalised URL -> partitioned parquet sink.  Progress (which files were
consumed, dedup state) lives in the query's checkpoint, so a restarted or
re-triggered job resumes where it stopped (``trigger(availableNow=True)`` for
daily batch-style runs).

``dropDuplicatesWithinWatermark`` keeps the *first* row per URL and drops rows behind the watermark
(``rows_behind_watermark`` counts them); the batch rule keeps the best quality.  ``start_best_quality_ingest`` has no watermark, takes
late rows like any other and reproduces the batch rule across micro-batches with ``foreachBatch``: each batch is deduped
with the batch operator and merged into the date partitions it touches and
those that hold copies of its URLs.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from newsfunnel.functions.lineage import materialize
from newsfunnel.functions.urls import with_normalized_url
from newsfunnel.session import ensure_checkpoint_dir
from newsfunnel.sources.feeds import validate_refs
from newsfunnel.sources.sinks import with_output_keys

REF_SCHEMA = ("ord long, title string, url string, source string, date timestamp_ntz, language string, "
              "state string, district string, search_term string, full_text string")


def checkpoint_location(spark: SparkSession, name: str) -> str:
    """A stream's checkpoint folder under the cluster's shared checkpoint dir."""
    return os.path.join(ensure_checkpoint_dir(spark), "streams", name)


def ref_stream(spark: SparkSession, src_dir: str, fmt: str = "parquet", schema: str = REF_SCHEMA,
               max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(src_dir)


def dedup_stream(refs: DataFrame, delay: str = "24 hours") -> DataFrame:
    """Validated refs, first row per normalised URL within the watermark."""
    v = with_normalized_url(validate_refs(refs))
    v = v.withColumn("event_time", F.col("date").cast("timestamp"))
    return v.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["norm_url"])


def start_ingest(spark: SparkSession, src_dir: str, out_dir: str, name: str = "ref_ingest",
                 available_now: bool = True, fmt: str = "parquet", checkpoint: str | None = None) -> StreamingQuery:
    """L3/L4: start the dedup ingest; returns the running query."""
    out = with_output_keys(dedup_stream(ref_stream(spark, src_dir, fmt))).drop("event_time")
    w = (out.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint or checkpoint_location(spark, name))
         .partitionBy("state_slug", "out_date"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start(out_dir)


def rows_behind_watermark(query: StreamingQuery) -> int:
    """Rows that the finished run of ``query`` dropped because they were later than the watermark."""
    return sum(int(op.numRowsDroppedByWatermark) for p in query.recentProgress for op in p.stateOperators)


def start_best_quality_ingest(spark: SparkSession, src_dir: str, table_dir: str, name: str = "ref_ingest_best",
                              available_now: bool = True, fmt: str = "parquet",
                              checkpoint: str | None = None) -> StreamingQuery:
    """L3 with the batch rule (best quality wins) kept across micro-batches.

    The table keeps each row's normalised URL.  A micro-batch looks its URLs up
    in that column, so it finds copies on other dates too; then it reads the
    partitions that it touches or that hold such a copy (a literal date list, so
    the scan prunes the others), dedups them together with the batch, rewrites
    them and removes those that are left without rows.  A batch that is run
    again after a failure finds its own rows and changes nothing.
    """
    from newsfunnel.operators.urldedup import dedup_by_url

    def merge(batch: DataFrame, batch_id: int) -> None:
        b = materialize(with_normalized_url(validate_refs(batch)).withColumn("out_date", F.date_format("date", "yyyy-MM-dd")), "stream-batch")
        if b.isEmpty():
            return
        touched = b.select("out_date")
        if path_exists(spark, table_dir):
            table = spark.read.schema(b.schema).parquet(table_dir)
            touched = touched.union(table.join(b.select("norm_url"), "norm_url", "left_semi").select("out_date"))
        dates = [r[0] for r in touched.distinct().collect()]  # as many as there are days
        merged = b.unionByName(table_dates(spark, table_dir, dates, b.schema).select(*b.columns)) if path_exists(spark, table_dir) else b
        # the partitions that are read are rewritten: the result is written elsewhere first
        best = materialize(dedup_by_url(merged).dropDuplicates(["norm_url"]), "stream-merge")  # a batch run again meets its own rows
        best.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("out_date").parquet(table_dir)
        left = {r[0] for r in best.select("out_date").distinct().collect()}
        for d in set(dates) - left:
            remove_path(spark, f"{table_dir}/out_date={d}")

    s = ref_stream(spark, src_dir, fmt).writeStream.foreachBatch(merge).option(
        "checkpointLocation", checkpoint or checkpoint_location(spark, name))
    s = s.trigger(availableNow=True) if available_now else s.trigger(processingTime="1 minute")
    return s.start()


def table_dates(spark: SparkSession, table_dir: str, dates: list[str], schema) -> DataFrame:
    """The partitions of these dates."""
    return spark.read.schema(schema).parquet(table_dir).where(F.col("out_date").isin(dates))


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def remove_path(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)
