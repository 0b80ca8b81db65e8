"""Landed feed files -> article refs and a table of rejects.

Layout: one file (or several) a response under ``<root>/payload=<n>/``; the manifest tells each
payload's query (payload, language, state, search_term), as the collector logged it.

RSS documents are read by the text source with ``</item>`` as line separator: a record holds
one item, large files split, and an item that is no XML rejects itself alone.  REST answers are
read whole, one a row.  Items are ordered by (payload, file, place); ``number_refs`` turns
that order into a number where one is wanted, so there is no limit of payloads or items.

Nothing disappears: every item, every file without items and every payload of the manifest without bytes is
a ref or a row of the rejects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsfunnel.sources import feeds as FD

_ITEM = r"(?s)<item[\s>].*\z"
MANIFEST = ["payload", "language", "state", "search_term"]
REJECT_COLS = ["payload", "file", "reason", "title", "url"]


def _queried(landed: DataFrame, manifest: DataFrame) -> DataFrame:
    """Landed rows with their query; a payload that the manifest lacks has no language and so no valid ref."""
    return landed.join(manifest.select(*MANIFEST).dropDuplicates(["payload"]), "payload", "left")


def read_rss_items(spark: SparkSession, root: str) -> DataFrame:
    """(payload, file, at, item): at = (start of the split, running number); item is the
    element's text without its end tag, NULL where a record holds no item (after the last)."""
    r = spark.read.option("lineSep", "</item>").schema("value string, payload long").format("text").load(root)
    at = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("nth"))
    return r.select("payload", F.col("_metadata.file_path").alias("file"), at.alias("at"),
                    F.nullif(F.regexp_extract("value", _ITEM, 0), F.lit("")).alias("item"))


def read_payloads(spark: SparkSession, root: str) -> DataFrame:
    """(payload, file, at, body): each file whole."""
    r = spark.read.option("wholetext", "true").schema("value string, payload long").format("text").load(root)
    return r.select("payload", F.col("_metadata.file_path").alias("file"),
                    F.struct(F.lit(0).cast("long").alias("block"), F.lit(0).cast("long").alias("nth")).alias("at"), F.col("value").alias("body"))


def _no_items(files: DataFrame) -> DataFrame:
    none = F.lit(None).cast("string")
    return files.select("payload", "file", F.lit("no_items").alias("reason"), none.alias("title"), none.alias("url"))


def _nothing(landed: DataFrame, manifest: DataFrame) -> DataFrame:
    """Payloads that were asked for and of which no byte has landed (no file, or empty ones)."""
    none = F.lit(None).cast("string")
    gone = manifest.select("payload").distinct().join(landed.select("payload").distinct(), "payload", "left_anti")
    return gone.select("payload", none.alias("file"), F.lit("nothing_landed").alias("reason"), none.alias("title"), none.alias("url"))


def _order(ord_, pos=None):
    """Order key (payload, file, block, nth, pos); ``ord_`` is that struct without pos."""
    return F.struct(ord_["payload"].alias("payload"), ord_["file"].alias("file"), ord_["at"]["block"].alias("block"), ord_["at"]["nth"].alias("nth"),
                    (F.lit(0) if pos is None else pos).cast("long").alias("pos"))


def _feed(landed: DataFrame, manifest: DataFrame, body: str) -> DataFrame:
    return _queried(landed, manifest).select(F.struct("payload", "file", "at").alias("ord"), "language", "state", "search_term", F.col(body).alias("payload"))


def _split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    refs = rows.where(F.col("reason").isNull()).drop("reason")
    bad = rows.where(F.col("reason").isNotNull())
    return refs, bad.select(F.col("ord.payload").alias("payload"), F.col("ord.file").alias("file"), "reason", "title", "url")


def rss_refs(spark: SparkSession, root: str, manifest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(refs, rejects) of landed RSS documents."""
    pieces = read_rss_items(spark, root)
    # what stands after the last </item> is no item unless the file breaks off in one
    feed = _feed(pieces.where(F.col("item").isNotNull()), manifest, "item")
    refs, bad = _split(FD.rss_rows(feed.withColumn("payload", F.concat("payload", F.lit("</item>"))), order=_order))
    files = pieces.groupBy("payload", "file").agg(F.count("item").alias("n")).where("n = 0")
    return refs, bad.unionByName(_no_items(files)).unionByName(_nothing(pieces, manifest))


def newsdata_refs(spark: SparkSession, root: str, manifest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(refs, rejects) of landed answers with ``results``."""
    landed = read_payloads(spark, root)
    refs, bad = _split(FD.newsdata_rows(_feed(landed, manifest, "body"), order=_order))
    return refs, bad.unionByName(_nothing(landed, manifest))


def gnews_refs(spark: SparkSession, root: str, manifest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(refs, rejects) of landed answers with ``articles``."""
    landed = read_payloads(spark, root)
    refs, bad = _split(FD.gnews_rows(_feed(landed, manifest, "body"), order=_order))
    return refs, bad.unionByName(_nothing(landed, manifest))


_READERS = {"google": rss_refs, "newsdata": newsdata_refs, "gnews": gnews_refs}


def landed_refs(spark: SparkSession, roots: dict[str, str], manifest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S7 over files: (refs, rejects) of all sources; ``roots``: folder of each source that has landed files.
    ``ord`` is a struct (source rank, payload, file, place); ``feeds.number_refs`` makes it a number."""
    refs = rejects = None
    for name, root in roots.items():
        r, bad = _READERS[name](spark, root, manifest)
        r = r.withColumn("ord", F.struct(F.lit(FD.SOURCE_RANK[name]).alias("rank"), "ord.payload", "ord.file", "ord.block", "ord.nth", "ord.pos"))
        bad = bad.select(F.lit(name).alias("feed"), *REJECT_COLS)
        refs, rejects = (r, bad) if refs is None else (refs.unionByName(r), rejects.unionByName(bad))
    return refs, rejects
