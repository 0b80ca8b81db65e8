"""Sinks: output grouping, JSON/CSV writers, run metadata and funnel counts.

Output layout is ``<root>/state_slug=<s>/date=<yyyy-MM-dd>/district_slug=<d>``
written by one partitioned write (each task writes its own rows; no group is
ever collected into one task or the driver).  A group's envelope header
(first member's labels and the count) is an aggregate, written next to the
article lines.  ``write_envelopes`` writes one JSON document a group (header, articles,
trailer): its rows are sorted, given their line's text by a running row number and
streamed by the text writer, so a group passes one task but is never held.  CSV rows follow Python ``csv`` minimal quoting with CRLF line
ends (``csv_line``); a large group is dealt over several files by its row
count, each with the CSV writer's own header.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsfunnel.functions.lineage import materialize
from newsfunnel.functions.text import slugify

ARTICLE_FIELDS = ["title", "url", "source", "date", "language", "state", "district", "search_term",
                  "full_text", "relevance_score"]


def iso_ist(col: str = "date") -> Column:
    """IST wall-clock timestamp as ISO 8601 with '+05:30' (microseconds only when non-zero)."""
    c = F.col(col)
    frac = F.date_format(c, "SSSSSS")
    base = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    return F.concat(base, F.when(frac != "000000", F.concat(F.lit("."), frac)).otherwise(F.lit("")), F.lit("+05:30"))


def with_output_keys(df: DataFrame, state: str = "state", date: str = "date", district: str = "district") -> DataFrame:
    """State slug, calendar date (IST), district slug or NULL."""
    return df.withColumns({
        "state_slug": slugify(state),
        "out_date": F.date_format(F.col(date), "yyyy-MM-dd"),
        "district_slug": F.when(F.col(district).isNotNull() & (F.col(district) != ""), slugify(district)),
    })


def output_groups(df: DataFrame, order: str = "ord") -> DataFrame:
    """W2/W3 header per group: first member's state/district/date and the count.

    A partial aggregate (min_by + count), so a hot group costs one row per map
    task in the shuffle."""
    k = with_output_keys(df)
    return k.groupBy("state_slug", "out_date", "district_slug").agg(
        F.min_by("state", order).alias("state"),
        F.min_by(F.when(F.col("district") != "", F.col("district")), order).alias("district"),
        F.count(F.lit(1)).alias("article_count"),
        F.min(order).alias("first_ord"),
    )


def article_json(df: DataFrame) -> Column:
    """One article as JSON in model field order (nulls kept)."""
    st = F.struct(*[F.col(c) if c != "date" else iso_ist("date").alias("date") for c in ARTICLE_FIELDS])
    return F.to_json(st, {"ignoreNullFields": "false"})


def json_text(c: Column) -> Column:
    """A value as JSON text (null kept)."""
    t = F.to_json(F.array(c), {"ignoreNullFields": "false"})
    return F.substr(t, F.lit(2), F.length(t) - 2)


def _json_block(fields: dict[str, Column], indent: str) -> Column:
    """``{...}`` over several lines, a field each."""
    parts = [F.lit(indent + "{\n")]
    for k, (name, value) in enumerate(fields.items()):
        parts += [F.lit(f'{indent}  "{name}": '), value, F.lit("\n" if k + 1 == len(fields) else ",\n")]
    return F.concat(*parts, F.lit(indent + "}"))


def write_envelopes(df: DataFrame, root: str, order: str = "ord") -> None:
    """One indented JSON document a group, as one text file in the group's folder: state, district
    (null at state level) and date of the group, article_count, and the articles by ``order``.

    One exchange by group; the count is joined in from the groups' aggregate, the
    external sort may spill, and the writer streams.  Overwrites the groups it writes only."""
    parts = ["state_slug", "out_date", "district_slug"]
    keyed = with_output_keys(df)
    head = output_groups(df, order).select(*[F.col(p).alias(f"_{p}") for p in parts], F.col("state").alias("_state"), F.col("district").alias("_district"), "article_count")
    same = reduce(lambda a, b: a & b, (F.col(p).eqNullSafe(F.col(f"_{p}")) for p in parts))
    nth = F.row_number().over(Window.partitionBy(*parts).orderBy(order))
    rows = keyed.join(head, same).withColumn("_nth", nth)
    first = F.concat(F.lit('{\n  "state": '), json_text(F.col("_state")), F.lit(',\n  "district": '), json_text(F.col("_district")),
                     F.lit(',\n  "date": '), json_text(F.col("out_date")), F.lit(',\n  "article_count": '), F.col("article_count").cast("string"), F.lit(',\n  "articles": [\n'))
    article = _json_block({c: json_text(iso_ist("date") if c == "date" else F.col(c)) for c in ARTICLE_FIELDS}, "    ")
    line = F.concat(F.when(F.col("_nth") == 1, first).otherwise(F.lit("")), article,
                    F.when(F.col("_nth") == F.col("article_count"), F.lit("\n  ]\n}")).otherwise(F.lit(",")))
    (rows.select(*parts, line.alias("value")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).text(root))


def read_envelopes(spark: SparkSession, root: str) -> DataFrame:
    """(state_slug, out_date, district_slug, envelope): each group's document."""
    schema = "value string, state_slug string, out_date string, district_slug string"
    return spark.read.option("wholetext", "true").schema(schema).format("text").load(root).select(
        "state_slug", "out_date", "district_slug", F.rtrim("value", F.lit("\n")).alias("envelope"))


def csv_field(c: Column) -> Column:
    """Python csv QUOTE_MINIMAL: quote when the field holds ',', '"', CR or LF."""
    s = F.coalesce(c.cast("string"), F.lit(""))
    return F.when(s.rlike('[,"\r\n]'), F.concat(F.lit('"'), F.replace(s, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(s)


def csv_line(df: DataFrame) -> Column:
    cols = [iso_ist("date") if c == "date" else F.col(c) for c in ARTICLE_FIELDS]
    return F.concat(F.concat_ws(",", *[csv_field(c) for c in cols]), F.lit("\r"))


# Python csv's minimal quoting: '"' doubled inside quotes, blanks kept, nothing for NULL and ''.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "emptyValue": "", "nullValue": "",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_output(df: DataFrame, root: str, metadata: DataFrame | None = None, rows_per_file: int = 100_000,
                 order: str = "ord") -> None:
    """One partitioned JSON-lines write, one partitioned CSV write, the groups' JSON
    documents and headers, and the run metadata.

    The input is evaluated once (a written table).  A group is dealt over as
    many tasks as its row count asks for, by a hash of ``order``; every CSV file
    has the writer's own header.  Re-running overwrites only the groups it
    writes (dynamic partition overwrite), so a retried job is idempotent."""
    parts = ["state_slug", "out_date", "district_slug"]
    keyed = materialize(with_output_keys(df), "output")
    sizes = materialize(keyed.groupBy(*[F.col(p).alias(f"_{p}") for p in parts]).agg(
        F.ceil(F.count("*") / F.lit(rows_per_file)).alias("_files")), "output-groups")
    same = reduce(lambda a, b: a & b, (F.col(p).eqNullSafe(F.col(f"_{p}")) for p in parts))
    dealt = (keyed.join(sizes, same).withColumn("_salt", F.pmod(F.xxhash64(order), F.col("_files")))
             .repartition(*parts, "_salt").sortWithinPartitions(*parts, order))
    options = {"partitionOverwriteMode": "dynamic", "maxRecordsPerFile": str(rows_per_file)}
    (dealt.select(*parts, article_json(dealt).alias("value"))
     .write.mode("overwrite").options(**options).partitionBy(*parts).text(f"{root}/articles_json"))
    (dealt.select(*parts, *[(iso_ist("date") if c == "date" else F.col(c)).alias(c) for c in ARTICLE_FIELDS])
     .write.mode("overwrite").options(**options, **CSV_OPTIONS).partitionBy(*parts).csv(f"{root}/articles_csv"))
    write_envelopes(keyed, f"{root}/envelopes", order)
    output_groups(keyed, order).write.mode("overwrite").options(**options).partitionBy(*parts).json(f"{root}/groups")
    if metadata is not None:
        metadata.coalesce(1).write.mode("overwrite").json(f"{root}/_metadata")


def run_metadata(refs: DataFrame, extracted: DataFrame, filtered: DataFrame, collection_ts: str,
                 sources: list[str] | None = None) -> DataFrame:
    """One row — timestamp, sources, sorted distinct search terms, counts.

    ``articles_found`` counts the refs that reached extraction (after date,
    verdict and cap filters), as the run log reports it."""
    srcs = sources or ["google_news", "newsdata", "gnews"]
    r = refs.agg(F.sort_array(F.collect_set("search_term")).alias("query_terms_used"),
                 F.count(F.lit(1)).alias("found"))
    x = extracted.agg(F.count("full_text").alias("extracted")).scalar()
    f = filtered.agg(F.count(F.lit(1)).alias("filtered")).scalar()
    return r.select(
        F.lit(collection_ts).alias("collection_timestamp"),
        F.array(*[F.lit(s) for s in srcs]).alias("sources_queried"),
        "query_terms_used",
        F.create_map(F.lit("articles_found"), F.col("found"),
                     F.lit("articles_extracted"), x,
                     F.lit("articles_filtered"), f).alias("counts"),
    )


def funnel_counts(df: DataFrame) -> DataFrame:
    """Stage counts in one pass (count_if over flags)."""
    from newsfunnel.functions.text import pystrip

    return df.agg(
        F.count(F.lit(1)).alias("articles_found"),
        F.count_if(F.col("full_text").isNotNull()).alias("articles_extracted"),
        F.count_if(F.col("full_text").isNotNull() & (F.length(pystrip("full_text")) > 0)).alias("articles_with_text"),
        F.count_if(F.col("district").isNotNull()).alias("articles_tagged"),
        F.count_if(F.col("source") != "Unknown").alias("articles_with_source"),
    )
