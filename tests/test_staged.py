"""Staged reviews, committed sinks, one parse, sampling of copies, distributed selection."""

import os

import pytest
from pyspark.sql import functions as F

from revlens import schemas
from revlens.operators import clean as cl
from revlens.operators import explore as ex
from revlens.operators import quality as qa
from revlens.operators import staged as st
from revlens.plans import jobs
from revlens.sources import sinks
from tests.test_jobs import SMOKE_PRODUCT, SMOKE_REVIEWS, _write_jsonl

ROW = ("P1", "A1", "U1", 5.0, "t", "x", 1, 0, True)
ODD = [ROW, ROW, ROW, (None,) * 9, (None,) * 9, ("P1", "A1", "U1", 5.0, "t", None, 1, 0, True), ("P1", "A1", "U1", 5.0, "t", "", 1, 0, True),
       ("P1", "A1", "U1", -0.0, "t", "x", 1, 0, True), ("P1", "A1", "U1", 0.0, "t", "x", 1, 0, True),
       ("P1", "A1", "U1", float("nan"), "t", "x", 1, 0, True), ("P1", "A1", "U1", float("nan"), "t", "x", 1, 0, True),
       ("P1A", "1", "U1", 5.0, "t", "x", 1, 0, True), ("P1", "A1", "U1", 5.0, "t", "é" * 70_000, 1, 0, True)]


def _rows(df):
    return sorted(map(repr, df.select(*schemas.REVIEW_COLUMNS).collect()))


@pytest.mark.parametrize("limit", [st.BROADCAST_BYTES, 40])
def test_staged_dedup_equals_distinct(spark, monkeypatch, limit):
    monkeypatch.setattr(st, "BROADCAST_BYTES", limit)         # 40 bytes: a block of ids for each writing task
    df = spark.createDataFrame(ODD * 7, schemas.REVIEW_SCHEMA).repartition(5)
    staged = cl.stage_reviews(df)
    assert (staged.total, staged.unique) == (len(ODD) * 7, df.distinct().count())
    assert (len(staged.blocks) == 1) == (limit > 40)
    normal = lambda rows: [r.replace("rating=-0.0", "rating=0.0") for r in rows]  # noqa: E731  they are equal, either may stay
    assert normal(_rows(staged.distinct_rows())) == normal(_rows(df.distinct()))
    length = df.distinct().select(F.avg(F.length("text")), F.stddev(F.length("text"))).first()
    assert staged.mean == pytest.approx(length[0]) and staged.std == pytest.approx(length[1])
    staged.drop()


def test_staged_clean_equals_the_plain_plan(spark):
    df = spark.createDataFrame(ODD * 3, schemas.REVIEW_SCHEMA).where("NOT rating <=> CAST('nan' AS double)")
    plain = df.transform(cl.prune_reviews).transform(cl.dedup_reviews).transform(cl.add_row_features)
    plain = plain.transform(cl.add_length_z).transform(cl.add_age_features)
    got = cl.clean_reviews(df)
    assert got.columns == plain.columns
    key = lambda rows: sorted(repr(tuple(x + 0.0 if isinstance(x, float) else x for x in r)) for r in rows)
    assert key(got.collect()) == key(plain.collect())


def test_empty_and_single_inputs(spark):
    none = spark.createDataFrame([], schemas.REVIEW_SCHEMA)
    assert cl.clean_reviews(none).collect() == []
    (one,) = cl.clean_reviews(spark.createDataFrame([ROW], schemas.REVIEW_SCHEMA)).collect()
    assert one.review_text_length == 1 and one.review_text_length_z is None


def test_failed_write_leaves_the_old_table(spark, tmp_dir):
    target = f"{tmp_dir}/out/table"
    seen = lambda: [n for n in os.listdir(f"{tmp_dir}/out") if not n.endswith(".crc")]
    sinks.write_parquet(spark.range(5), target)
    bad = spark.range(100).repartition(4).select(
        F.when(F.col("id") == 99, F.raise_error(F.lit("stop")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        sinks.write_parquet(bad, target)
    with pytest.raises(Exception, match="stop"):
        sinks.write_small_csv(bad, target)
    assert spark.read.parquet(target).count() == 5 and seen() == ["table"]
    sinks.write_parquet(spark.range(7), target)
    assert spark.read.parquet(target).count() == 7 and seen() == ["table"]


def test_job_scans_each_input_once_and_drops_what_it_staged(spark, tmp_dir, monkeypatch):
    reviews = _write_jsonl(f"{tmp_dir}/raw/a.jsonl", [*SMOKE_REVIEWS, SMOKE_REVIEWS[0], "", "{broken"])
    meta = _write_jsonl(f"{tmp_dir}/meta/m.jsonl", [SMOKE_PRODUCT])
    read, parsed = [], jobs.jl.read_json_looked_into
    monkeypatch.setattr(jobs.jl, "read_json_looked_into", lambda s, p, schema: read.append(p) or parsed(s, p, schema))
    monkeypatch.setattr(jobs, "read_input", lambda *a: pytest.fail("a second look at the input"))
    dropped, drop = [], jobs.session.drop_staged
    monkeypatch.setattr(jobs.session, "drop_staged", lambda s, p: dropped.append(p) or drop(s, p))
    run = jobs.run_review_analytics(spark, reviews, meta, f"{tmp_dir}/p", f"{tmp_dir}/r")
    assert read == [[reviews], [meta]] and len(dropped) == 4
    assert run.counts["raw_reviews"] == 4 and run.findings["reviews"] == {"corrupt_rows": 1}
    assert run.counts["reviews_clean"] == 3 and run.counts["joined_reviews"] == 2
    assert not any(os.path.exists(p.removeprefix("file:")) for p in dropped)


def test_copies_are_drawn_one_by_one(spark, monkeypatch):
    monkeypatch.setattr(qa, "COPIES_AT_ONCE", 64)
    df = spark.range(4000).select(F.lit("U").alias("user_id"), F.lit("A").alias("asin"), F.lit(1).alias("timestamp"))
    some = spark.range(50).select(F.col("id").cast("string").alias("user_id"), F.lit(None).cast("string").alias("asin"), F.lit(1).alias("timestamp"))
    picks = [sorted(map(tuple, qa.deterministic_sample(df.unionByName(some).repartition(n), 0.1).collect()), key=str) for n in (1, 7)]
    assert picks[0] == picks[1]
    assert 300 < sum(r[0] == "U" for r in picks[0]) < 500
    whole = qa.deterministic_sample(df.unionByName(some), 1.0)
    assert whole.count() == 4050


def test_catalog_is_reduced_to_the_sample_before_its_shuffle(spark, monkeypatch):
    corrupt = F.lit(None).cast("string").alias(schemas.CORRUPT_COLUMN)
    reviews = spark.range(3000).select(F.col("id").cast("string").alias("user_id"), F.lit("A").alias("asin"), F.col("id").alias("timestamp"),
                                       F.concat(F.lit("P"), F.col("id") % 1000).alias("parent_asin"), F.lit("f").alias("source_file"), corrupt)
    catalog = spark.range(900).select(F.concat(F.lit("P"), F.col("id")).alias("parent_asin"))
    found = []
    for limit in (qa.BROADCAST_BYTES, 0):
        monkeypatch.setattr(qa, "BROADCAST_BYTES", limit)
        df = qa.sample_join_coverage(reviews, catalog, 0.05)
        found.append(tuple(df.first()))
        if limit:
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    assert found[0] == found[1] and 100 < found[0][1] < 200 and found[0][2] < found[0][1]


@pytest.mark.parametrize("fan_out", [2, 7, 1024])
def test_selection_over_wide_ranges(spark, monkeypatch, fan_out):
    monkeypatch.setattr(ex, "FAN_OUT", fan_out)
    values = [0] * 70 + [1] * 11 + [5, 9, 9, 10 ** 15, -3, 2 ** 40] + [*range(100, 160)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "helpful_vote long").repartition(3)
    probabilities = [0.0, 0.01, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]
    got = ex.vote_quantiles_exact(df, probabilities).collect()
    ordered = sorted(values)
    least = lambda p: next(v for i, v in enumerate(ordered) if i + 1 >= p * len(ordered))
    assert [(r.quantile, r.helpful_vote) for r in got] == [(p, float(least(p))) for p in probabilities]
    none = ex.vote_quantiles_exact(df.where("helpful_vote IS NULL"), [0.5]).collect()
    assert [tuple(r) for r in none] == [(0.5, None)]


def test_sketches_merge_within_their_error(spark):
    df = spark.range(300_000).select((F.col("id") % 7).alias("part"), F.pmod(F.xxhash64("id"), F.lit(10_000)).alias("helpful_vote"))
    merged = ex.vote_quantiles_approx(ex.vote_sketches(df, "part", 2000), [0.1, 0.5, 0.99]).collect()
    assert all(abs(r.helpful_vote - 10_000 * r.quantile) < 60 for r in merged)
    errors = ex.quantile_errors(df, [0.5, 0.9], 0.001, by="part").collect()
    assert all(r.within_error for r in errors)
    empty = ex.quantile_errors(df.limit(0), [0.5], 0.01, by="part").collect()
    assert [(r.helpful_vote, r.within_error) for r in empty] == [(None, None)]


def _writer_limits(spark, monkeypatch):
    """What the limit of files that a task keeps open is set to, from now on."""
    key, limits, plain = "spark.sql.maxConcurrentOutputFileWriters", [], type(spark.conf).set
    monkeypatch.setattr(type(spark.conf), "set", lambda self, k, v: limits.append(int(v)) if k == key and plain(self, k, v) is None else plain(self, k, v))
    return limits


def test_staging_sorts_no_texts_by_slice(spark, monkeypatch):
    """Spark sorts a task's rows, spilling their texts, once the task has as many files as the limit says."""
    limits = _writer_limits(spark, monkeypatch)
    staged = st.stage_rows(spark.createDataFrame(ODD * 9, schemas.REVIEW_SCHEMA).repartition(3))
    task = F.shiftright("row_id", st.TASK_SHIFT)
    most = staged.rows.groupBy(task).agg(F.countDistinct("slice").alias("n")).agg(F.max("n")).first()[0]
    assert most == st.SPREAD and limits and limits[0] > most
    staged.drop()


def _codecs(folder):
    import pyarrow.parquet as pq

    files = [os.path.join(at, f) for at, _, names in os.walk(folder.removeprefix("file:")) for f in names if f.endswith(".parquet")]
    return {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files}


def test_staged_rows_and_written_tables_are_zstd(spark, tmp_dir):
    df = spark.createDataFrame(ODD, schemas.REVIEW_SCHEMA)
    staged = st.stage_rows(df)
    assert _codecs(staged.paths[0]) == {"ZSTD"}
    staged.drop()
    assert _codecs(sinks.write_parquet(df, f"{tmp_dir}/t")) == {"ZSTD"}


def test_neighbours_stay_together_in_slices(spark):
    """Rows dealt one by one would spread each run of like texts over all slices, where it is stored once more each."""
    df = spark.range(40_000).select(*[F.col("id").cast(f.dataType).alias(f.name) for f in schemas.REVIEW_SCHEMA]).coalesce(1)
    staged = st.stage_rows(df)
    rows = [r.slice for r in staged.rows.select("row_id", "slice").orderBy("row_id").collect()]
    shares = [rows.count(s) / len(rows) for s in set(rows)]
    assert len(shares) == st.SPREAD and min(shares) > 0.9 / st.SPREAD
    assert sum(a != b for a, b in zip(rows, rows[1:])) < 250
    staged.drop()


def test_surplus_ids_of_pairs_and_larger_groups(spark):
    rows = [tuple(("k" if c == "text" else v) if c != "timestamp" else i for c, v in zip(schemas.REVIEW_COLUMNS, ROW)) for i in range(60)]
    pairs, more = rows + rows[::2], rows + rows[::2] + rows[::6] + [(None,) * 9] * 9
    for some, many in ((pairs, False), (more, True)):
        staged = cl.stage_reviews(spark.createDataFrame(some, schemas.REVIEW_SCHEMA).repartition(5))
        assert staged.surplus.count() == len(some) - len(set(some)) == staged.total - staged.unique
        assert _rows(staged.distinct_rows()) == _rows(spark.createDataFrame(list(set(some)), schemas.REVIEW_SCHEMA))
        staged.drop()


def test_lengths_are_counted_once_while_staging(spark):
    """Counting characters reads every text byte by byte; clean and joined rows take the staged length."""
    staged = cl.stage_reviews(spark.createDataFrame(ODD * 3, schemas.REVIEW_SCHEMA))
    plan = cl.clean_staged(staged)._jdf.queryExecution().optimizedPlan().toString()
    assert "length(text" not in plan and "review_text_length" in plan
    lengths = cl.clean_staged(staged).select("review_text_length", F.length("text").alias("n")).collect()
    assert len(lengths) == staged.unique and all(r.review_text_length == r.n for r in lengths)
    staged.drop()


def test_shuffle_files_go_with_the_step_that_staged(spark):
    import time

    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held = lambda: {f.getName() for f in (files.apply(i) for files in [disk.getAllFiles()] for i in range(files.size())) if f.getName().startswith("shuffle_")}
    before = held()
    staged = cl.stage_reviews(spark.createDataFrame(ODD * 9, schemas.REVIEW_SCHEMA).repartition(4, "user_id"))
    until = time.time() + 10
    while held() - before and time.time() < until:        # files go in the background
        time.sleep(0.1)
    assert not held() - before
    staged.drop()
