"""The registered queries of this subpackage, one per operator, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe_codec,
    decontaminate,
    manifest,
    near_dedup,
    pitman_yor,
    private_terms,
    quality,
    quote_threads,
    simhash,
    token_alignment,
    token_counts,
    topk_search,
    toxicity,
)
from .common import crc_mod, table

VOCABULARY = "word_bpe_49k.json"


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), "vec_id", "embedding",
                             F.col("id") % 50 == 0, k=5)


def op2_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = crc_mod(F.col("doc_id"), 5) == 1
    scored = pitman_yor.score(table(spark, sf_dir, "documents"), ~held)
    return scored.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = crc_mod(F.col("doc_id"), 3) == 1
    scored = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held)
    return scored.select("doc_id", held.alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op6_quote_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quote_threads.threads(table(spark, sf_dir, "conversations"))


def op7_private_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = private_terms.find(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[count(k) for k in private_terms.KINDS],
        F.sha2(private_terms.joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        private_terms.joined(F.concat("base", "terms")).alias("spans"))


def op8_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, contaminated, item_ids, edits) of every document."""
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", (F.size("items") > 0).alias("contaminated"),
                        F.col("items.item_id").alias("item_ids"), F.col("items.edits").alias("edits"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = crc_mod(F.col("doc_id"), 5) == 0
    cost = toxicity.char_model(docs)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held, cost)
    return toxicity.score(docs, model, cost).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = (crc_mod(F.col("doc_id"), 3) == 0) & F.col("doc_id").isNotNull()
    return manifest.proofs(table(spark, sf_dir, "documents"), tampered).drop("path")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                 public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {f.__name__: f for f in (
    op1_exact_topk, op2_pitman_yor, op3_quality, op4_near_dedup, op5_token_counts, op6_quote_threads, op7_private_terms,
    op8_bpe_codec,
    op9_decontaminate, op10_toxicity, op11_simhash_dedup, op12_merkle_manifest, op13_token_alignment)}

ORACLE_SQL = {
    "op6_quote_threads": quote_threads.THREADS_SQL,
    "op12_merkle_manifest": manifest.PROOFS_SQL,
    "op1_exact_topk": """
        WITH v AS (
            SELECT row_number() OVER () AS row, vec_id, [floor(256 * x::DOUBLE) for x in embedding] AS q
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND list_count(embedding) = len(embedding)
              AND len([x for x in embedding if NOT isfinite(x)]) = 0),
        s AS (
            SELECT a.row, a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
            FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.row <> b.row AND len(a.q) = len(b.q)),
        r AS (
            SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS rank FROM s)
        SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5""",
}
