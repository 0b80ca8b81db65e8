"""Gazetteer district tagging.

The gazetteer is dimension data (states x districts, bounded by geography):
it is reduced to one ordered ``array<district>`` per state and attached with a
broadcast hash join on the state, so every article is matched in place with
higher-order functions — no shuffle of the article rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsfunnel.functions.bounded import checked_broadcast
from newsfunnel.functions.lineage import with_columns_once
from newsfunnel.functions.text import pystrip


def district_arrays(gazetteer: DataFrame, state: str = "state", district: str = "district",
                    order: str = "district_ord") -> DataFrame:
    """(state, districts) with districts in gazetteer order."""
    return gazetteer.groupBy(state).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(district).alias("d")))),
                    lambda x: x["d"]).alias("districts")
    ).withColumnRenamed(state, "_gz_state")


def with_state_districts(df: DataFrame, gazetteer: DataFrame, state: str = "state", out: str = "state_districts") -> DataFrame:
    arr = checked_broadcast(district_arrays(gazetteer).withColumnRenamed("districts", "_gz_ds"), payload=gazetteer)
    return df.join(arr, df[state] == arr["_gz_state"], "left").drop("_gz_state").withColumnRenamed("_gz_ds", out)


def first_contained(districts: Column, text: Column) -> Column:
    """First district (list order) whose lower-cased name is a substring of ``text``."""
    return F.get(F.filter(districts, lambda d: F.instr(text, F.lower(d)) > 0), 0)


def tag_from_batch(df: DataFrame, batch: str = "districts", title: str = "title", district: str = "district") -> DataFrame:
    """Empty batch -> unchanged; one district -> assigned to every row
    (overwrites); several -> first in batch order contained in the lower title,
    else unchanged."""
    b = F.col(batch)
    hit = first_contained(b, F.lower(F.col(title)))
    tagged = (
        F.when(b.isNull() | (F.size(b) == 0), F.col(district))
        .when(F.size(b) == 1, b[0])
        .otherwise(F.coalesce(hit, F.col(district)))
    )
    return df.withColumn(district, tagged)


def tag_from_text(df: DataFrame, gazetteer: DataFrame, title: str = "title", text: str = "full_text",
                  district: str = "district", state: str = "state") -> DataFrame:
    """Untagged rows only; districts of the row's state in gazetteer order;
    plain substring of lower(title) [+ ' ' + lower(text) when text is non-empty]."""
    j = with_state_districts(df, gazetteer, state, "_sd")
    t = F.col(text)
    search = F.when(F.col(district).isNull() & F.col("_sd").isNotNull(), F.when(
        t.isNotNull() & (t != ""), F.concat(F.lower(F.col(title)), F.lit(" "), F.lower(t))).otherwise(F.lower(F.col(title))))
    # the lowered text is read once per district inside the lambda: compute it once per row
    j = with_columns_once(j, {"_search": search})
    hit = first_contained(F.coalesce(F.col("_sd"), F.array().cast("array<string>")), F.col("_search"))
    return j.withColumn(district, F.when(F.col(district).isNull(), hit).otherwise(F.col(district))).drop(
        "_sd", "_search")


def resolve_answer(answer: Column, districts: Column) -> Column:
    """Map a free-text answer onto the district list (NULL = no match)."""
    a = F.regexp_replace(F.regexp_replace(pystrip(answer), r'^"+|"+\z', ""), r"^'+|'+\z", "")
    la = F.lower(a)
    exact = F.get(F.filter(districts, lambda d: F.lower(d) == la), 0)
    partial = F.get(F.filter(districts, lambda d: (F.instr(la, F.lower(d)) > 0) | (F.instr(F.lower(d), la) > 0)), 0)
    return F.when(answer.isNull() | (la == "none"), F.lit(None).cast("string")).otherwise(F.coalesce(exact, partial))


def tag_from_answers(df: DataFrame, gazetteer: DataFrame, answers: DataFrame, key: str = "ord",
                     district: str = "district", state: str = "state") -> DataFrame:
    """T3 applied to untagged rows of known states; answers = (ref_id, answer).  Of
    several answers to a ref the first in byte order counts (a missing one last)."""
    j = with_state_districts(df, gazetteer, state, "_sd")
    one = answers.groupBy(F.col("ref_id").alias("_rid")).agg(F.min("answer").alias("_ans"))
    j = j.join(one, F.col(key) == F.col("_rid"), "left")
    eligible = F.col(district).isNull() & F.col("_sd").isNotNull() & (F.size(F.col("_sd")) > 0)
    res = resolve_answer(F.col("_ans"), F.col("_sd"))
    return j.withColumn(district, F.when(eligible, res).otherwise(F.col(district))).drop("_sd", "_rid", "_ans")


def district_prompt(title: str = "title", text: str = "full_text", state: str = "state",
                    districts: str = "state_districts") -> Column:
    """T4: the district question for one article (list joined ', ', text cut to 500)."""
    # The district question format.
    return F.concat(
        F.lit("Which single district in "), F.col(state), F.lit(" is this article PRIMARILY about?\nDistricts: "),
        F.array_join(F.col(districts), ", "), F.lit("\n\nTitle: "), F.col(title), F.lit("\nText: "),
        F.substring(F.coalesce(F.col(text), F.lit("")), 1, 500),
        F.lit("\n\nRules:\n- Reply with ONLY the district name from the list above.\n"
              "- If the article mentions multiple districts or is about the state as a whole, reply ONLY \"None\".\n"
              "- If you cannot determine the district, reply ONLY \"None\"."),
    )
