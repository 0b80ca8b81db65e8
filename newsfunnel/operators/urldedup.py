"""URL normalisation, quality score and URL dedup (a narrow aggregate and a join)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsfunnel.functions.urls import with_normalized_url


def quality_score(text: str = "full_text", district: str = "district", source: str = "source") -> Column:
    """(text? 100+len : 0) + (district? 10 : 0) + (source <> 'Unknown' ? 5 : 0).

    ``length`` counts code points, as Python's ``len`` does.
    """
    t = F.col(text)
    return (
        F.when(t.isNotNull(), F.lit(100) + F.length(t)).otherwise(F.lit(0))
        + F.when(F.col(district).isNotNull(), F.lit(10)).otherwise(F.lit(0))
        + F.when(F.col(source) != "Unknown", F.lit(5)).otherwise(F.lit(0))
    ).cast("long")


_HASHES = 10 ** 9


def _whole(digits: str) -> Column:
    return F.lit(digits).cast("decimal(38,0)")


_MIDDLE, _PLACE = "5" + "0" * 18, "1" + "0" * 28  # positions are counted back from the first, above 10 hash digits


def _packed(order: str, url: str) -> tuple[Column, Column]:
    """(rank, tag): one fixed-width number whose maximum is the best row, the earlier of equals, and
    which ends in the row's tag.  Digits: quality, 19 for the position (``_MIDDLE`` + 2**62 at most), 9 for the tag."""
    tag = F.pmod(F.xxhash64(F.col(url)), F.lit(_HASHES))
    back = _whole(_MIDDLE) - F.col(order).cast("decimal(38,0)")
    return quality_score().cast("decimal(38,0)") * _whole(_PLACE) + back * _whole(str(_HASHES)) + tag.cast("decimal(38,0)"), tag


def dedup_by_url(df: DataFrame, url: str = "url", order: str = "ord") -> DataFrame:
    """Keep one row per normalised URL.

    The highest quality wins; a tie keeps the earliest row (only a strictly
    better row replaces the incumbent).  The survivor takes the position
    (``order``) of the first row seen for that URL.  ``order`` is a position
    between -4.9e18 and 4.9e18 (the job stops beyond): no two rows of one URL share it.

    Plan: quality, position and a hash of the URL are packed into one decimal, so the
    aggregate by URL has fixed-width buffers (a hash aggregate, partial before the
    shuffle: a URL holding a third of all rows costs one narrow row per map task).
    The winners are joined back by position and hash, which no hot URL skews.
    """
    rank, tag = _packed(order, url)
    best = (with_normalized_url(df, url, "_norm").select("_norm", F.col(order).alias("_ord"), rank.alias("_rank"))
            .groupBy("_norm").agg(F.max("_rank").alias("_rank"), F.min("_ord").alias("_slot")))
    low = F.col("_rank") % _whole(_PLACE)
    tagged = low % _whole(str(_HASHES))
    winners = best.select((_whole(_MIDDLE) - ((low - tagged) / _whole(str(_HASHES))).cast("decimal(38,0)")).cast("long").alias("_win"),
                          tagged.cast("long").alias("_tag"), "_slot")
    rows = df.withColumn("_url_tag", tag)
    kept = rows.join(winners, (F.col(order) == F.col("_win")) & (F.col("_url_tag") == F.col("_tag")))
    return kept.withColumn(order, F.col("_slot")).select(*[order, *[c for c in df.columns if c != order]])
