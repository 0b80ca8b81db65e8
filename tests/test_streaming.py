"""L3/L4: streaming ingest dedups within the watermark and resumes."""

import datetime as dt
import os

from pyspark.sql import functions as F

from newsfunnel.streaming.ingest import REF_SCHEMA, start_best_quality_ingest, start_ingest


def _refs(spark, rows):
    return spark.createDataFrame(rows, REF_SCHEMA)


def _row(o, url, text=None, day=1, source="s"):
    return (o, f"title {o}", url, source, dt.datetime(2026, 2, day, 10, 0), "en", "Bihar", None, "heat", text)


def test_stream_dedup_and_resume(spark, tmpdir_path):
    src, out = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "out")
    ck = os.path.join(tmpdir_path, "ck")
    _refs(spark, [_row(1, "https://www.a.com/x?utm_source=t"), _row(2, "https://a.com/x"),
                  _row(3, "https://b.com/y")]).coalesce(1).write.mode("append").parquet(src)
    q = start_ingest(spark, src, out, checkpoint=ck)
    q.awaitTermination(120)
    got = spark.read.parquet(out)
    assert got.count() == 2
    assert sorted(r.norm_url for r in got.collect()) == ["https://a.com/x", "https://b.com/y"]
    # second run: only the new file is read; its duplicate of a.com/x is dropped by the stream state
    _refs(spark, [_row(4, "https://a.com/x/"), _row(5, "https://c.com/z")]).coalesce(1).write.mode("append").parquet(src)
    q = start_ingest(spark, src, out, checkpoint=ck)
    q.awaitTermination(120)
    got = spark.read.parquet(out)
    assert sorted(r.norm_url for r in got.collect()) == ["https://a.com/x", "https://b.com/y", "https://c.com/z"]


def test_best_quality_stream(spark, tmpdir_path):
    src, table = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "tbl")
    ck = os.path.join(tmpdir_path, "ck2")
    _refs(spark, [_row(1, "https://a.com/x", None), _row(2, "https://b.com/y", "t")]).coalesce(1).write.mode("append").parquet(src)
    start_best_quality_ingest(spark, src, table, checkpoint=ck).awaitTermination(120)
    _refs(spark, [_row(3, "https://www.a.com/x/", "longer text wins")]).coalesce(1).write.mode("append").parquet(src)
    start_best_quality_ingest(spark, src, table, checkpoint=ck).awaitTermination(120)
    got = {r.url: r for r in spark.read.parquet(table).collect()}
    assert len(got) == 2
    a = [r for r in got.values() if "a.com" in r.url][0]
    assert a.full_text == "longer text wins" and a.ord == 1
    assert spark.read.parquet(table).where(F.col("url").contains("b.com")).count() == 1


def test_best_quality_over_dates_and_restarts(spark, tmpdir_path):
    """A better copy on another date takes the row over, and the emptied day goes."""
    src, table, ck = (os.path.join(tmpdir_path, x) for x in ("in", "tbl", "ck"))

    def batch(*rows):
        _refs(spark, list(rows)).coalesce(1).write.mode("append").parquet(src)
        start_best_quality_ingest(spark, src, table, checkpoint=ck).awaitTermination(120)
        return sorted((r.ord, r.url, r.full_text, str(r.out_date)) for r in spark.read.parquet(table).collect())

    assert batch(_row(1, "https://a.com/x", "t", 1), _row(2, "https://b.com/y", "keep", 3)) == [
        (1, "https://a.com/x", "t", "2026-02-01"), (2, "https://b.com/y", "keep", "2026-02-03")]
    assert batch(_row(3, "https://www.a.com/x/", "longer text", 2)) == [
        (1, "https://www.a.com/x/", "longer text", "2026-02-02"), (2, "https://b.com/y", "keep", "2026-02-03")]
    assert not os.path.exists(os.path.join(table, "out_date=2026-02-01"))
    assert batch(_row(4, "https://a.com/x?ref=q", "worse", 5)) == [
        (1, "https://www.a.com/x/", "longer text", "2026-02-02"), (2, "https://b.com/y", "keep", "2026-02-03")]


def test_merge_reads_only_the_partitions_it_needs(spark, tmpdir_path):
    from newsfunnel.streaming.ingest import table_dates

    df = spark.range(30).selectExpr("id", "concat('2026-02-', lpad(id % 9 + 1, 2, '0')) AS out_date")
    df.write.partitionBy("out_date").parquet(os.path.join(tmpdir_path, "t"))
    plan = table_dates(spark, os.path.join(tmpdir_path, "t"), ["2026-02-03"], df.schema)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "2026-02-03" in plan.split("PartitionFilters: [")[1].split("]")[0]
