"""Reviews staged once: exact dedup, length moments and the catalog join without moving texts.

The rows are written once as Parquet, each with a digest of its columns, a row id and a slice
(a part of the task that wrote it), bucketed by slice. From then on texts stay where they are:

* dedup shuffles digests and ids only. Of the rows of a digest the one of least id stays; the
  others are *surplus*, and an anti join takes them out of the staged rows by id. The surplus id of
  a pair comes with its group; only ids of larger groups need a second look. Surplus ids
  are broadcast in blocks, each a range of ids that one or more writing tasks gave out and at
  most ``BROADCAST_BYTES`` together (one task's alone are far less: it wrote one input split);
* the same pass sums up lengths (count, sum, sum of squares over one row a digest), so z-scores
  need no second look at the rows;
* the catalog comes to the reviews: each slice asks for its distinct products, the answers are
  joined by product on the narrow side and shuffled by slice into the buckets' layout. A product
  that a third of all reviews name is one answer a slice, and no exchange stands above the
  reviews (``spark.sql.requireAllClusterKeysForCoPartition`` is off, as buckets follow the slice
  alone, one of the two join keys);
* a task deals its rows to its slices in runs that lengthen: neighbours, which often resemble each
  other, stay together and compress together, and few rows still spread over all slices.

Sums pass through ``DataFrame.observe``: both observed stages write a table, so they are result
stages, whose metrics Spark counts once for each partition, also if executors are lost.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from revlens import schemas, session

SPREAD = 4                       # slices that one writing task deals its rows to
BROADCAST_BYTES = 64 << 20
ID_BYTES = 32                    # of a broadcast row id, about
DIGEST_BYTES = 128               # of a broadcast digest with its least id, about
TASK_SHIFT = 33                  # a row id's bits above it are the writing task's
MOST_TASKS = 1 << 29


def row_digest(columns: list[str]) -> Column:
    """SHA-256 over the columns, each as length and text; NULL differs from empty, and -0.0 is 0.0
    as in a DISTINCT."""
    def part(c: str) -> Column:
        if c == "text":              # hashed by itself, not copied
            return F.coalesce(F.sha2(F.col(c).cast("binary"), 256), F.lit("-"))
        value = (F.col(c) + F.lit(0.0) if c == "rating" else F.col(c)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))
    return F.unhex(F.sha2(F.concat(*[part(c) for c in columns]).cast("binary"), 256))


@dataclass
class StagedReviews:
    """Staged rows and what the narrow pass found out about them."""

    spark: SparkSession
    rows: DataFrame
    paths: list[str]
    total: int = 0
    unique: int = 0
    mean: float | None = None
    std: float | None = None
    surplus: DataFrame | None = None
    blocks: list[tuple[int, int]] = field(default_factory=list)      # ranges [from, to) of writing tasks

    def drop(self) -> None:
        for path in self.paths:
            session.drop_staged(self.spark, path)
        self.paths.clear()

    def distinct_rows(self) -> DataFrame:
        """The staged rows without surplus copies."""
        if self.total == self.unique:
            return self.rows
        out = None
        for lo, hi in self.blocks:
            ids = self.surplus.where(_within(lo, hi)) if len(self.blocks) > 1 else self.surplus
            part = self.rows.where(_within(lo, hi)) if len(self.blocks) > 1 else self.rows
            part = part.join(F.broadcast(ids), "row_id", "left_anti")
            out = part if out is None else out.unionByName(part)
        return out

    def with_catalog(self, rows: DataFrame, catalog: DataFrame, key: str = schemas.KEY) -> DataFrame:
        """``rows`` (staged ones with further columns) x catalog on ``key``, in place; the slice is dropped."""
        self.spark.conf.set(session.CO_LOCATION, "false")
        asked = self.rows.select("slice", key).where(F.col(key).isNotNull()).distinct()
        answers = asked.join(catalog, key)
        return rows.join(answers.hint("shuffle_hash"), ["slice", key]).drop("slice")


def _within(lo: int, hi: int) -> Column:
    return (F.col("row_id") >= lo << TASK_SHIFT) & (F.col("row_id") < hi << TASK_SHIFT)


def _run(row_id: Column) -> Column:
    """The run that a task's row belongs to: the n-th one is 2n + 1 rows long."""
    return F.floor(F.sqrt(row_id.bitwiseAND(F.lit((1 << TASK_SHIFT) - 1))))


def stage_rows(rows: DataFrame, extra: tuple[str, ...] = (), buckets: int | None = None) -> StagedReviews:
    """Writes the review columns and ``extra`` with digest, row id, length and slice."""
    spark = rows.sparkSession
    buckets = 4 * (buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))    # finer ones even out
    at = F.monotonically_increasing_id()
    wide = (rows.select(*schemas.REVIEW_COLUMNS, *extra, F.length("text").alias("length"), at.alias("row_id"),
                        row_digest(schemas.REVIEW_COLUMNS).alias("digest"))
            .withColumn("slice", F.shiftright("row_id", TASK_SHIFT) * SPREAD + F.pmod(_run(F.col("row_id")), F.lit(SPREAD))))
    path, name = session.staging_path(spark, "reviews"), f"revlens_{uuid.uuid4().hex}"
    with session.open_files(spark, SPREAD), session.dropped_shuffles(spark):        # a task's rows go to the files of its slices as they come
        wide.write.format("parquet").option("path", path).option("compression", session.parquet_codec(spark)).bucketBy(buckets, "slice").saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")           # the name only: the files are external, the frame knows them
    return StagedReviews(spark, table, [path])


def find_surplus(staged: StagedReviews) -> StagedReviews:
    """The narrow pass: surplus ids, counts and the moments of the lengths of distinct rows."""
    spark, seen = staged.spark, Observation()
    groups = staged.rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("row_id").alias("keep"),
                                               F.max("row_id").alias("last"), F.min("length").alias("length"))
    length = F.col("length").cast("decimal(10,0)")
    told = groups.observe(seen, F.count(F.lit(1)).alias("unique"), F.sum("n").alias("total"), F.count_if(F.col("n") > 2).alias("many"),
                          F.count("length").alias("n"), F.sum(length).alias("s1"), F.sum(length * length).alias("s2"))
    path = session.staging_path(spark, "copied")
    with session.dropped_shuffles(spark):
        told.where("n > 1").select("digest", "n", "keep", "last").write.parquet(path)
    staged.paths.append(path)
    sums = seen.get
    staged.unique, staged.total = sums["unique"], sums["total"] or 0
    n, s1, s2 = sums["n"], int(sums["s1"] or 0), int(sums["s2"] or 0)
    staged.mean = s1 / n if n else None
    staged.std = math.sqrt(float(n * s2 - s1 * s1) / (float(n) * float(n - 1))) if n > 1 else None
    if staged.total > staged.unique:
        ids, copied = session.staging_path(spark, "surplus"), spark.read.parquet(path)
        found = copied.where("n = 2").select(F.col("last").alias("row_id"))
        if sums["many"]:
            more = copied.where("n > 2").select("digest", "keep")
            if sums["many"] <= BROADCAST_BYTES // DIGEST_BYTES:
                more = F.broadcast(more)
            found = found.unionByName(staged.rows.select("digest", "row_id").join(more, "digest").where("row_id <> keep").select("row_id"))
        with session.dropped_shuffles(spark):
            found.write.parquet(ids)
        staged.paths.append(ids)
        staged.surplus = spark.read.parquet(ids)
        staged.blocks = _blocks(staged)
    return staged


def _blocks(staged: StagedReviews) -> list[tuple[int, int]]:
    most = max(1, BROADCAST_BYTES // ID_BYTES)
    if staged.total - staged.unique <= most:
        return [(0, MOST_TASKS)]
    # one row for each writing task that has surplus rows
    counts = (staged.surplus.groupBy(F.shiftright("row_id", TASK_SHIFT).alias("task")).count().orderBy("task").collect())
    bounds, held = [0], 0
    for task, n in counts:
        if held and held + n > most:
            bounds.append(task)
            held = 0
        held += n
    return [*zip(bounds, [*bounds[1:], MOST_TASKS])]
