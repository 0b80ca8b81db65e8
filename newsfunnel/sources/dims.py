"""Dimension loaders: nested geography and term dictionaries.

Both dictionaries arrive as nested JSON documents.  They are exploded with
``posexplode`` so list order survives as ordinal columns, validated with
aggregates, and are small enough (bounded by geography / vocabulary) to be
broadcast by the operators that use them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsfunnel.operators.querygen import ARTICLE_LANGUAGES

# The ten term categories, in dictionary order.
CATEGORIES = ["weather", "health", "water", "power", "agriculture", "labor",
              "governance", "urban_infra", "education", "temperature"]

GEO_SCHEMA = ("states array<struct<name: string, slug: string, type: string, languages: array<string>, "
              "districts: array<struct<name: string, slug: string>>>>")
TERMS_SCHEMA = "version string, languages map<string, struct<name: string, categories: map<string, array<string>>>>"


def read_geo(spark, path: str) -> DataFrame:
    return spark.read.schema(GEO_SCHEMA).option("multiLine", "true").json(path)


def explode_geo(doc: DataFrame, col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(regions, districts) from the nested document.

    regions: region_ord, name, slug, type, languages, valid
    districts: state, state_slug, district_ord, district, district_slug"""
    src = doc.select(F.from_json(F.col(col), GEO_SCHEMA).alias("d")).select("d.*") if col else doc
    st = src.select(F.posexplode("states").alias("region_ord", "s"))
    langs_ok = F.forall(F.col("s.languages"), lambda x: x.isin(ARTICLE_LANGUAGES))
    regions = st.select(
        "region_ord", F.col("s.name").alias("name"), F.col("s.slug").alias("slug"), F.col("s.type").alias("type"),
        F.col("s.languages").alias("languages"),
        (F.col("s.type").isin("state", "ut") & (F.size("s.languages") > 0) & langs_ok
         & (F.size("s.districts") > 0)).alias("valid"),
    )
    districts = st.select(F.col("s.name").alias("state"), F.col("s.slug").alias("state_slug"),
                          F.posexplode("s.districts").alias("district_ord", "d")).select(
        "state", "state_slug", "district_ord", F.col("d.name").alias("district"), F.col("d.slug").alias("district_slug"))
    return regions, districts


def explode_terms(doc: DataFrame, col: str | None = None) -> DataFrame:
    """(lang, language_name, category, cat_ord, term, term_ord) in document order."""
    src = doc.select(F.from_json(F.col(col), TERMS_SCHEMA).alias("d")).select("d.*") if col else doc
    langs = src.select(F.explode("languages").alias("lang", "l"))
    cats = langs.select("lang", F.col("l.name").alias("language_name"),
                        F.posexplode("l.categories").alias("cat_ord", "category", "terms"))
    return cats.select("lang", "language_name", "category", "cat_ord",
                       F.posexplode("terms").alias("term_ord", "term"))


def validate_terms(terms: DataFrame) -> DataFrame:
    """Per language, are all ten categories present (each non-empty)?"""
    return terms.groupBy("lang").agg(
        F.count_distinct(F.when(F.col("category").isin(CATEGORIES), F.col("category"))).alias("n_categories"),
    ).withColumn("complete", F.col("n_categories") == len(CATEGORIES))


def region_lookup(regions: DataFrame, districts: DataFrame, slugs: DataFrame) -> DataFrame:
    """Requested slugs -> region attributes; unknown slugs get languages
    ['en'] and no districts."""
    dl = districts.groupBy("state_slug").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("district_ord", "district"))), lambda x: x["district"])
        .alias("districts"))
    r = regions.join(dl, regions["slug"] == dl["state_slug"], "left").drop("state_slug")
    j = slugs.join(r, "slug", "left")
    return j.select(
        "req_ord", "slug", "name", "type",
        F.coalesce(F.col("languages"), F.array(F.lit("en"))).alias("languages"),
        F.coalesce(F.col("districts"), F.array().cast("array<string>")).alias("districts"),
    )


def states_only(regions: DataFrame) -> DataFrame:
    return regions.where(F.col("type") == "state")


def uts_only(regions: DataFrame) -> DataFrame:
    return regions.where(F.col("type") == "ut")


def terms_by_category(terms: DataFrame) -> DataFrame:
    """(lang, category, terms) in priority order plus, with category NULL,
    each language's terms flattened in dictionary category order."""
    per_cat = terms.groupBy("lang", "category").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("term_ord", "term"))), lambda x: x["term"]).alias("terms"))
    flat = terms.groupBy("lang").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("cat_ord", "term_ord", "term"))), lambda x: x["term"])
        .alias("terms")).withColumn("category", F.lit(None).cast("string"))
    return per_cat.unionByName(flat)
