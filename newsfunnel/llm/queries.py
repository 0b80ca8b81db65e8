"""Queries over whole tables, one for each operator, and their SQL where DuckDB can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsfunnel.llm import bitsliced, bpe, decontam, dialogue, filteraudit, kdshards, licenses, linedup, ngram_join, pii, secrets, toxicity
from newsfunnel.llm.common import documents, sha256_ints

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TOKEN_LIMIT = 1024
TOKEN_MEMO = 900_000  # chunks that a worker remembers where no other stage needs its memory
PII_KEY = "corpus-v1"  # the key is a parameter; a real one comes from the caller


def _register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return deco


@_register("op5_byte_bpe")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = bpe.vocabulary(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    back = bpe.encode_decode(documents(spark, sf_dir, "doc_id", "text"), vocab, memo=TOKEN_MEMO)
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), sha256_ints(F.col("ids")).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


@_register("op9_token_counts")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = bpe.vocabulary(spark, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    counted = bpe.token_counts(documents(spark, sf_dir, "doc_id", "text"), vocab, TOKEN_LIMIT, memo=TOKEN_MEMO)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars")


@_register("op2_secret_scan")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(documents(spark, sf_dir, "doc_id", "text")))


@_register("op3_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score",
                         (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


@_register("op8_topk_search", """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS a FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.a, c.a) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    vecs = spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet").select("vec_id", "embedding")
    return bitsliced.top_k(vecs, vecs.where(F.col("vec_id") % 100 == 0), 10)


@_register("op6_license_scan")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.scan(documents(spark, sf_dir, "doc_id", "text")))


@_register("op10_line_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linedup.dedup_lines(documents(spark, sf_dir, "doc_id", "text")).select("doc_id", "removed_lines", "text")


@_register("op4_decontamination")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontam.contaminated(documents(spark, sf_dir, "doc_id", "text"), items)


@_register("op1_ngram_join", r"""
WITH RECURSIVE
w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                 '[\x20\x09-\x0D]+'), lambda x: x <> '') AS a FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(a) = 0 THEN [] WHEN len(a) < 3 THEN [array_to_string(a, ' ')]
        ELSE list_transform(range(1, len(a) - 1), lambda i: a[i] || ' ' || a[i + 1] || ' ' || a[i + 2]) END) AS g FROM w),
e AS (SELECT doc_id, len(g) AS n, unnest(g) AS t FROM s),
p AS (SELECT x.doc_id AS a, y.doc_id AS b FROM e x JOIN e y ON x.t = y.t AND x.doc_id < y.doc_id
      GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))),
l AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT s.doc_id, CAST(len(g) AS BIGINT) AS n_shingles, (SELECT min(b) FROM r WHERE r.a = s.doc_id) AS component_id FROM s
""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked_documents(documents(spark, sf_dir, "doc_id", "text"))


@_register("op7_pii_surrogates")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_entities(documents(spark, sf_dir, "doc_id", "text"), PII_KEY).select("doc_id", "n_entities", "text")


@_register("op11_structure_repair")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet")
    return dialogue.repair_audit(dialogue.damage(turns))


@_register("op12_filter_audit", """
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS a,
             min(doc_id) OVER (PARTITION BY t) AS first FROM d),
q AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY 1),
f AS (
  SELECT w.part, coalesce(q.good, 0) AS good, coalesce(q.toxic, 0) AS toxic,
         CASE WHEN len(a) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(a)) < 80 * len(a) THEN 'B' ELSE '' END
         || CASE WHEN 100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * len(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN w.doc_id > first THEN 'E' ELSE '' END AS fails
  FROM w LEFT JOIN q ON w.doc_id = q.doc_id),
c AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY 1, 2),
x AS (SELECT * FROM (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) v(x)),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
      WHERE a.x <> b.x AND a.x <> c.x AND a.x <> d.x AND a.x <> e.x AND b.x <> c.x AND b.x <> d.x AND b.x <> e.x
        AND c.x <> d.x AND c.x <> e.x AND d.x <> e.x),
s AS (SELECT filter_order, CAST(k AS INTEGER) AS step, substr(filter_order, CAST(k AS INTEGER), 1) AS x,
             substr(filter_order, 1, CAST(k AS INTEGER) - 1) AS before FROM o, range(1, 6) r(k)),
r AS (
  SELECT c.part, s.filter_order, s.step, s.x,
    sum(CASE WHEN translate(fails, before || x, '') = fails THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN contains(fails, x) AND translate(fails, before, '') = fails THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN contains(fails, x) AND translate(fails, before, '') <> fails THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails = x THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN contains(fails, x) AND translate(fails, before, '') = fails THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN contains(fails, x) AND translate(fails, before, '') = fails THEN toxic ELSE 0 END) AS toxic_lost
  FROM c, s GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM r
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return filteraudit.interaction_audit(documents(spark, sf_dir, "doc_id", "text", "lang"), labels)


@_register("op13_kd_shards")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = kdshards.shard_documents(documents(spark, sf_dir), shards=24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
