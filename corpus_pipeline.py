"""A cleaning pipeline over ``documents``.

Each stage calls one operator, and its rows are written and read again as the next one's
input. Stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm import bpe_codec, decontaminate, near_dedup, private_terms, toxicity
from revlens.llm.common import crc_mod, table
from revlens.session import drop_staged, staging_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more for toxicity go."""
    cost = toxicity.char_model(docs)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), crc_mod(F.col("doc_id"), 5) != 0, cost)
    return toxicity.keep_clean(docs, model, cost)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return near_dedup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts is generalised, terms that disclose it are removed."""
    return private_terms.sanitise(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256) of each text that is left: its ids, and the digest of what they decode to."""
    return bpe_codec.encode_and_decode(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", remove_personal_data),
    ("bpe", encode),
]

# Fitted models and hash sketches have no SQL form: tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows go to the shared folder as Parquet, where
    the last one's stay for the caller."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        where = staging_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(where)
        docs = spark.read.parquet(where)
        if before:
            drop_staged(spark, before)
        before = where
    return docs
