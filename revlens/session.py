"""Session settings the jobs rely on, and the shared staging folder.

Semantics that depend on session state are pinned here instead of inside
every operator:

* ``spark.sql.session.timeZone = UTC`` -- epoch milliseconds are turned into
  calendar fields in the session time zone, so results are only reproducible
  with a fixed zone.
* ``spark.sql.caseSensitive = true`` -- raw catalog files carry keys that
  differ only by case; without it an inferred JSON scan fails with
  COLUMN_ALREADY_EXISTS.
* ANSI mode stays on (the Spark 4 default); every ratio uses ``try_divide``.
* AQE with partition coalescing and skew-join splitting, so a product that
  holds a large share of all reviews is split at runtime instead of landing
  in one task.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job expects. Sizes are left to the cluster defaults except
# where noted.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.caseSensitive": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


CO_LOCATION = "spark.sql.requireAllClusterKeysForCoPartition"     # false: rows dealt by one join key stay there


def configure(spark: SparkSession, case_sensitive: bool = True) -> SparkSession:
    """Apply the job settings to an existing session (idempotent)."""
    for key, value in JOB_CONF.items():
        if key == "spark.sql.caseSensitive" and not case_sensitive:
            continue
        spark.conf.set(key, value)
    return spark


def size_shuffle(spark: SparkSession, shuffle_bytes: int,
                 target_bytes: int = 256 * 1024 * 1024) -> int:
    """Set ``spark.sql.shuffle.partitions`` so each reduce task starts near
    ``target_bytes`` for a shuffle of about ``shuffle_bytes`` (never below the
    cluster's parallelism); AQE then coalesces what turns out smaller. For the
    dedup of ~100 TB of raw reviews this gives ~400k partitions of 256 MB.
    """
    parts = max(spark.sparkContext.defaultParallelism, -(-shuffle_bytes // target_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_bytes))
    return parts


@contextmanager
def sized_shuffle(spark: SparkSession, shuffle_bytes: int, target_bytes: int = 256 * 1024 * 1024):
    """``size_shuffle`` for the length of a job; the caller's settings return after it."""
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        yield size_shuffle(spark, shuffle_bytes, target_bytes)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


COMPRESSED, EXPANSION = (".gz", ".bz2", ".zst", ".deflate", ".lz4", ".snappy"), 8


def _expansion(fs, path) -> int:
    """``EXPANSION`` if the first data file at or under ``path`` is a compressed text file, else 1."""
    files = fs.listFiles(path, True)
    while files.hasNext():
        name = files.next().getPath().getName()
        if not name.startswith(("_", ".")):
            return EXPANSION if name.endswith(COMPRESSED) else 1
    return 1


def input_bytes(spark: SparkSession, paths) -> int:
    """Bytes of files, folders and globs, as their file systems report them; compressed text counts
    ``EXPANSION`` times, about what it takes in a shuffle."""
    total, conf = 0, spark.sparkContext._jsc.hadoopConfiguration()
    for p in [paths] if isinstance(paths, str) else paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        for found in fs.globStatus(path) or []:
            total += fs.getContentSummary(found.getPath()).getLength() * _expansion(fs, found.getPath())
    return total


@contextmanager
def open_files(spark: SparkSession, files: int):
    """A task that writes by bucket or folder keeps up to ``files`` files open side by side instead of
    sorting its rows by them. Spark goes over to sorting, texts and all, once a task has as many files
    as its limit says, so the limit is one more."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    old = spark.conf.get(key, None)
    spark.conf.set(key, str(files + 1))
    try:
        yield
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


@contextmanager
def dropped_shuffles(spark: SparkSession):
    """Steps that write a table: their shuffle files go with the step, not when the driver next collects
    its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


def parquet_codec(spark: SparkSession) -> str:
    """What Parquet tables are compressed with: the deployment's codec if it names one, else zstd."""
    named = spark.sparkContext.getConf().get("spark.sql.parquet.compression.codec", None)
    return named or "zstd"


def pin(spark: SparkSession) -> None:
    """What the queries need of a session: the time zone and the Parquet codec."""
    pin_time_zone(spark)
    spark.conf.set("spark.sql.parquet.compression.codec", parquet_codec(spark))


def pin_time_zone(spark: SparkSession) -> None:
    """Only the time zone: enough for the calendar features to be stable."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "revlens") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("REVLENS_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in JOB_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the deployment (a distributed file
    system path every executor can reach). Only a local-mode session without
    the setting gets a private temporary folder, which is then registered as
    the checkpoint dir so ``DataFrame.checkpoint()`` uses the same place.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.sparkContext.getCheckpointDir()
        except Exception:  # no classic SparkContext (e.g. a Connect session)
            configured = None
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a cluster job needs a shared "
            "folder for its staged tables"
        )
    folder = tempfile.mkdtemp(prefix="revlens-ckpt-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the checkpoint dir for one staged table."""
    return f"{checkpoint_dir(spark)}/revlens/{name}-{uuid.uuid4().hex[:12]}"


def drop_staged(spark: SparkSession, path: str) -> None:
    """Delete a table that ``staging_path`` named; other paths are refused."""
    if not path.startswith(f"{checkpoint_dir(spark)}/revlens/"):
        raise ValueError(f"{path} isn't a staged table")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
