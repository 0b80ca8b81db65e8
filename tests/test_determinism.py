"""Order-sensitive operators give the same result under 1 and 8 shuffle partitions."""

from conftest import SF_SMALL
from newsfunnel.plans.fixtures import articles_v, fx_df
from newsfunnel.plans.pipeline import dedup_and_filter


def _run(spark, parts):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        a = articles_v(spark, SF_SMALL).repartition(parts)
        out = dedup_and_filter(a, fx_df(spark, "terms_fx"), fx_df(spark, "patterns_fx"))
        return sorted((r.ord, r.url, r.relevance_score) for r in out.collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_partition_count_does_not_change_results(spark):
    assert _run(spark, 1) == _run(spark, 8)
