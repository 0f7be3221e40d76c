"""Physical-plan properties the design relies on at scale."""

import pytest

from revlens import schemas
from revlens.operators import clean as cl
from revlens.plans import catalog
from revlens.sources import fixture_files as ff
from revlens.sources import json_lines as jl
from tests.conftest import SF_SMALL


def _plan(df, executed=False):
    if executed:
        df.collect()  # the final adaptive plan is only known after execution
    return df._jdf.queryExecution().executedPlan().toString()


def test_rating_filter_reaches_parquet_scan(spark):
    plan = _plan(catalog.QUERIES["high_rating_by_verified"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(rating), GreaterThanOrEqual(rating,4.0)]" in plan
    assert "ReadSchema: struct<rating:double,verified_purchase:boolean>" in plan


def test_dedup_and_z_move_no_text(spark):
    """Late materialisation: no exchange above the staged rows, one dedup aggregate in all."""
    clean = catalog.QUERIES["clean_reviews"](spark, SF_SMALL)
    plan = _plan(clean, executed=True)
    assert "Exchange hashpartitioning" not in plan and "HashAggregate" not in plan and "Subquery" not in plan
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    assert "Exchange hashpartitioning" not in _plan(catalog.QUERIES["dedup_reviews"](spark, SF_SMALL), executed=True)


def _broadcast_off(spark, more=()):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", **dict(more)}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    return old


def _restore(spark, old):
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_catalog_comes_to_the_reviews(spark):
    """With broadcasts off, what is shuffled for the joined table are keys and catalog rows."""
    old = _broadcast_off(spark)
    try:
        df = catalog.QUERIES["joined_reviews"](spark, SF_SMALL)
        plan = _plan(df, executed=True)
        plan = plan.split("== Initial Plan ==")[0]
        assert "ShuffledHashJoin" in plan and "Bucketed: true" in plan
        for line in plan.splitlines():
            if "Exchange hashpartitioning" in line:
                below = plan[plan.index(line):]
                scan = below[below.index("FileScan"):].split("\n")[0]
                assert "ReadSchema" in scan and "text:string" not in scan, scan
    finally:
        _restore(spark, old)


def test_sink_roundtrip_shuffles_no_text_and_drops_what_it_staged(spark, monkeypatch):
    """Without broadcasts too the joined table takes no exchange of reviews with their texts."""
    plans, dropped, write, drop = {}, [], catalog.sinks.write_parquet, catalog.session.drop_staged
    monkeypatch.setattr(catalog.sinks, "write_parquet", lambda df, path, *a: plans.update({path.split("/")[-1]: _plan(df)}) or write(df, path, *a))
    monkeypatch.setattr(catalog.session, "drop_staged", lambda s, p: dropped.append(p) or drop(s, p))
    old = _broadcast_off(spark)
    try:
        counts = {r.dataset: r.row_count for r in catalog.QUERIES["sink_parquet_roundtrip"](spark, SF_SMALL).collect()}
    finally:
        _restore(spark, old)
    assert set(plans) == {f"{t}.parquet" for t in counts} and counts["reviews_clean"] > counts["joined_reviews"] > 0
    plan = plans["joined_reviews.parquet"]
    assert "text:string" in plan and "Exchange hashpartitioning" in plan
    for line in plan.splitlines():
        if "Exchange hashpartitioning" in line:
            below = plan[plan.index(line):]
            assert "text:string" not in below[below.index("FileScan"):].split("\n")[0]
    assert any("/reviews-" in p for p in dropped)


def test_hot_product_is_one_answer_a_slice(spark):
    from pyspark.sql import functions as F

    old = _broadcast_off(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"})
    try:
        rows = spark.range(4000).select(
            F.when(F.col("id") % 3 != 0, F.lit("HOT")).otherwise(F.concat(F.lit("P"), (F.col("id") % 50).cast("string"))).alias("parent_asin"),
            F.lit("a").alias("asin"), F.col("id").cast("string").alias("user_id"), F.lit(1.0).alias("rating"), F.lit("t").alias("title"),
            F.lit("x").alias("text"), F.col("id").alias("timestamp"), F.lit(0).cast("long").alias("helpful_vote"), F.lit(True).alias("verified_purchase"))
        staged = cl.stage_reviews(rows)
        meta = staged.rows.select("parent_asin").distinct().withColumn("rating_number", F.lit(7))
        out = staged.with_catalog(staged.rows, meta)
        assert out.count() == 4000
        answers = staged.rows.select("slice", "parent_asin").distinct()
        assert answers.where("parent_asin = 'HOT'").count() == staged.rows.select("slice").distinct().count() > 8
        staged.drop()
    finally:
        _restore(spark, old)


@pytest.mark.parametrize("name", ["feat_length_z", "z_sanity"])
def test_z_score_reuses_the_dedup_exchange(spark, name):
    plan = _plan(catalog.QUERIES[name](spark, SF_SMALL), executed=True)
    assert "ReusedExchange" in plan and "mergedValue" in plan            # mean and stddev in one subquery


def test_unused_z_adds_no_subquery(spark):
    df = catalog.QUERIES["verified_profile"](spark, SF_SMALL)
    assert "mergedValue" not in _plan(df) and "sqrt" not in _plan(df).lower()


def test_top_k_is_take_ordered(spark):
    plan = _plan(catalog.QUERIES["top_duplicate_keys"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in plan


def test_drilldown_broadcasts_only_the_top_key(spark):
    plan = _plan(catalog.QUERIES["duplicate_drilldown"](spark, SF_SMALL), executed=True)
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan


def test_no_unpartitioned_window(spark):
    for name in ("vote_quantiles", "vote_quantiles_coarse", "vote_quantiles_approx"):
        plan = _plan(catalog.QUERIES[name](spark, SF_SMALL))
        assert "Window" not in plan and "SinglePartition" not in plan
    for name in ("rating_share_by_verified", "verified_share_by_year"):
        plan = _plan(catalog.QUERIES[name](spark, SF_SMALL))
        assert "Window [" in plan
        assert "SinglePartition" not in plan.split("Window [")[1].split("\n")[0]


def test_checked_json_scan_prunes_nothing_it_needs(spark):
    path = ff.fixture_json(spark, SF_SMALL, "reviews", faulty=True)
    df = jl.read_json_checked(spark, path, schemas.REVIEW_SCHEMA).select("parent_asin")
    assert "Scan text" in _plan(df)


@pytest.mark.parametrize("name", ["sample_join_coverage", "filter_valid_metadata", "metadata_key_multiplicity",
                                  "review_quality_by_file", "metadata_duplicate_summary"])
def test_quality_queries_parse_each_line_once(spark, name):
    plan = _plan(catalog.QUERIES[name](spark, SF_SMALL))
    # the sample of sample_join_coverage is written down before: its plan parses the catalog alone
    assert plan.count("from_json(") + plan.count("jsontostructs(") == 1, plan


@pytest.mark.parametrize("name", ["verified_counts", "vote_range", "row_counts", "duplicate_totals"])
def test_text_is_shuffled_as_a_digest(spark, name):
    plan = _plan(catalog.QUERIES[name](spark, SF_SMALL))
    assert "text_digest" in plan
    assert not [line for line in plan.splitlines() if "HashAggregate(keys=[" in line and ", text#" in line]


@pytest.mark.parametrize("name", ["verified_counts", "row_counts"])
def test_digests_are_taken_before_documents_multiply(spark, name):
    plan = _plan(catalog.QUERIES[name](spark, SF_SMALL))
    assert plan.count("sha2(") == plan.count("ReadSchema: struct<doc_id:bigint,text:string>") == 1
    assert plan.index("sha2(") > plan.index("Join")         # below it


def test_row_counts_reads_the_reviews_once(spark):
    assert _plan(catalog.QUERIES["row_counts"](spark, SF_SMALL)).count("lineitem.parquet") == 1


def test_documents_are_read_whole(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").selectExpr("count(*)", "max(length(text))").first()
    got = catalog.QUERIES["clean_reviews"](spark, SF_SMALL).selectExpr("max(review_text_length)").first()[0]
    used = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").where("l_orderkey % 97 <> 0").selectExpr(
        f"count(DISTINCT l_orderkey % {docs[0]})").first()[0]
    assert got == docs[1] and used == docs[0]


@pytest.mark.parametrize("name", ["verified_profile", "polarization_profile"])
def test_profiles_partially_aggregate_before_shuffle(spark, name):
    plan = _plan(catalog.QUERIES[name](spark, SF_SMALL))
    assert "partial_" in plan


def test_hot_product_is_split_by_skew_join(spark):
    """A product holding most reviews: with broadcast off, AQE splits its
    sort-merge-join partition instead of sending it to one task."""
    from pyspark.sql import functions as F

    from revlens.operators import joins as jn

    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        reviews = spark.range(20000).select(
            F.when(F.col("id") % 3 != 0, F.lit("HOT"))
             .otherwise(F.concat(F.lit("P"), (F.col("id") % 50).cast("string")))
             .alias("parent_asin"),
            F.col("id").alias("rating"))
        meta = spark.range(50).select(F.concat(F.lit("P"), F.col("id").cast("string"))
                                      .alias("parent_asin"), F.col("id").alias("rating_number"))
        meta = meta.unionByName(spark.range(1).select(F.lit("HOT").alias("parent_asin"),
                                                      F.lit(7).alias("rating_number")))
        out = jn.join_reviews_metadata(reviews, meta).groupBy().count()
        plan = _plan(out, executed=True)
        assert out.first()[0] == 20000
        assert "SortMergeJoin" in plan and "skewed" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@pytest.mark.parametrize("faulty", [True, False])
def test_written_lines_are_compressed_and_not_sorted(spark, monkeypatch, faulty):
    """The lines carry whole texts: plain they take as much disk as the texts, and sorting them by folder as much again."""
    import glob
    import os

    from tests.test_staged import _writer_limits

    monkeypatch.setattr(ff, "_WRITTEN", {})
    limits = _writer_limits(spark, monkeypatch)
    path = ff.fixture_json(spark, SF_SMALL, "reviews", faulty).removeprefix("file:")
    files = glob.glob(f"{path}/source_file=*/part-*")
    assert files and all(f.endswith(".txt.gz") for f in files)
    assert limits[0] > len({os.path.dirname(f) for f in files})
    held = spark.read.text(path).selectExpr("sum(octet_length(value))").first()[0]
    assert sum(map(os.path.getsize, files)) < held / 2


@pytest.mark.parametrize(("name", "most"), [("prune_reviews", 3), ("join_reviews_metadata", 6)])
def test_order_lines_are_shuffled_once_to_their_documents(spark, name, most):
    """Lines, orders and documents once each; for the joined table the dedup, the reviews and the catalog too."""
    old = _broadcast_off(spark)
    try:
        plan = _plan(catalog.QUERIES[name](spark, SF_SMALL))
        assert plan.count("Exchange hashpartitioning(") == most
    finally:
        _restore(spark, old)


def test_preview_stages_only_reviews_near_the_top(spark, monkeypatch):
    staged, stage = [], cl.stage_reviews
    monkeypatch.setattr(cl, "stage_reviews", lambda df: staged.append(stage(df)) or staged[-1])
    df = catalog.QUERIES["preview_joined"](spark, SF_SMALL)
    assert df.count() == 10 and len(staged) == 1 and 10 <= staged[0].total < 200


@pytest.mark.parametrize("n", [1, 3, 4, 6, 30])
def test_preview_bound_keeps_the_first_rows_and_their_ties(spark, n):
    from revlens.operators import explore as ex

    nan = float("nan")
    rows = [("a", 2.0, "z"), ("a", 2.0, "y"), ("a", nan, "x"), ("a", None, "w"), ("a", None, "v"), ("b", -0.0, "u"), ("b", 0.0, "t"),
            ("b", 1.0, "s"), (None, 1.0, "r"), (None, None, "q"), (None, None, "p")]
    df = spark.createDataFrame(rows, "a string, b double, text string").repartition(3)
    near = df.where(ex.preview_bound(df.drop("text"), ["a", "b"], n))
    order, shown = ["a", "b", "text"], lambda d: [tuple(map(repr, r)) for r in ex.preview(d, order, order, n).collect()]
    assert shown(near) == shown(df) and near.count() <= (len(rows) if n > 6 else n + 1)


def test_text_digests_are_bytes(spark):
    df = cl.narrow_reviews(spark.createDataFrame([(None,) * 9], schemas.REVIEW_SCHEMA))
    assert dict(df.dtypes)["text_digest"] == "binary"
    assert dict(catalog.narrow_reviews(spark, SF_SMALL).dtypes)["text_digest"] == "binary"
