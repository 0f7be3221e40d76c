"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile

import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.session import checkpoint_dir

# Rows in one Arrow batch: whole documents travel in batches, so the default
# of 10,000 rows could hold gigabytes of long texts.
BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


WORD_CACHE = 1 << 18


class WordHash(dict):
    """word (bytes) -> its 64-bit hash, kept in a bounded cache."""

    def __missing__(self, word: bytes) -> int:
        got = xxhash.xxh64_intdigest(word)
        if len(word) <= 64:
            if len(self) >= WORD_CACHE:
                self.clear()
            self[word] = got
        return got


word_hash = WordHash()

_held: list[dict] = []


def hold(*caches: dict) -> None:
    """At the start of a task: the caches that it is going to fill. A Python worker goes on from one
    stage's tasks to the next one's, so caches that others held are emptied."""
    for c in _held:
        if not any(c is x for x in caches):
            c.clear()
    _held[:] = caches

_shipped: set = set()


def prepare(spark: SparkSession) -> None:
    """Small Arrow batches, and this library's modules on the executors' path (once a session)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    where = os.path.join(tempfile.mkdtemp(prefix="revlens-code-"), "revlens_code.zip")
    with zipfile.ZipFile(where, "w") as z:
        for folder, _, names in os.walk(top):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    spark.sparkContext.addPyFile(where)
    _shipped.add(app)


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` (long) and ``text`` (null: empty); other columns are left out,
    so no extra column can clash with one that an operator adds."""
    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (a null id: of the empty text)."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(n))


def staged(df: DataFrame) -> DataFrame:
    """Cut the lineage: written once to the shared checkpoint folder."""
    spark = df.sparkSession
    folder = checkpoint_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def labelled(docs: DataFrame, labels: DataFrame, label: str, keep: Column,
             most: int) -> DataFrame:
    """At most ``most`` labelled documents (label 0 or 1), drawn by a hash of the id.

    ``keep`` chooses the rows whose labels may be learnt. The draw is the bounded
    sample that a classifier is fitted on; its ids (16 bytes each) are small enough
    to broadcast because of that bound. An id with several labels keeps the largest.
    """
    drawn = (labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                           F.col(label).cast("int").alias("label"))
             .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & keep)
             .groupBy("doc_id").agg(F.max("label").alias("label"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    return texts(docs).join(F.broadcast(drawn), "doc_id")
