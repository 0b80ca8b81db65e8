"""Corpus pipeline: from raw documents to token ids.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next
one's ``docs``.  All but the last return the columns of ``documents``; columns
beyond those pass through.

1. toxicity: a factorization machine learned from ``labels``; documents scored 0.7 or more go.
2. line_dedup: repeated multi-line chunks and long lines stay at their first place only;
   documents of which nothing is left go.
3. ngram_join: of each group of linked documents (word 5-grams, Jaccard 0.8) the
   one with the smallest doc_id stays.
4. decontamination: documents that hold a ``benchmark`` item, whole or edited, go.
5. bpe: token ids of what is left, decoded again as a check.

Defined results: a null text is treated as '' by every stage and stays null; ''
stays; rows without a doc_id are kept by stages that decide by document; of rows
that share a doc_id one stays after stage 3; empty tables give empty tables.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsfunnel.functions.lineage import materialize
from newsfunnel.llm import bpe, decontam, linedup, ngram_join, toxicity
from newsfunnel.llm.common import documents, free_name

SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80
TOKEN_MEMO = 30_000  # chunks that a worker of the token stage remembers


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))
    score = free_name(docs, "_score")
    return toxicity.score(docs, model, score_col=score).where(F.col(score) < toxicity.THRESHOLD).drop(score)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    gone = free_name(docs, "_removed")
    cut = linedup.dedup_lines(docs, removed_col=gone)
    changed = F.col(gone) > 0
    cut = cut.where(~(changed & (F.trim("text") == "")))
    return cut.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).drop(gone)


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = ngram_join.linked_documents(docs.select("doc_id", "text"), SHINGLE_WORDS, SIMILAR_PERCENT)
    stay = materialize(found.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct(), "pipeline-stay")
    kept = docs.join(stay, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.unionByName(docs.where(F.col("doc_id").isNull())).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    found = materialize(decontam.contaminated(docs, items).select("doc_id").distinct(), "pipeline-leaks")
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    vocab = bpe.vocabulary(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    sha = free_name(docs, "_sha")
    named = docs.select("doc_id", "lang", "source", "n_chars", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias(sha))
    # small parts and tables: the session holds all stages' memory
    back = bpe.encode_decode(named, vocab, memo=TOKEN_MEMO, part_bytes=1 << 18)
    return back.select("doc_id", "lang", "source", "n_chars", F.size("ids").cast("long").alias("n_tokens"), "ids",
                       (F.sha2("decoded", 256) == F.col(sha)).alias("round_trip"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_join", keep_one_of_similar),
    ("decontamination", drop_contaminated),
    ("bpe", to_tokens),
]
ORACLE_SQL = None  # scores, alignments and token ids are beyond SQL; see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
