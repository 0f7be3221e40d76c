"""Row-level semantics, NULL handling and ANSI-safe arithmetic."""

import datetime as dt

from pyspark.sql import functions as F

from revlens import schemas
from revlens.functions import features as fx
from revlens.operators import clean as cl
from revlens.operators import joins as jn
from revlens.operators import profiles as pr


def _reviews(spark, rows):
    return spark.createDataFrame(rows, schemas.REVIEW_SCHEMA)


def _r(key="P1", user="U1", rating=5.0, text="abc", ts=1609459200000, votes=0, verified=True,
       asin="A1", title="t"):
    return (key, asin, user, rating, title, text, ts, votes, verified)


def test_null_votes_are_capped_and_flagged(spark):
    df = spark.createDataFrame([(None,), (0,), (5,), (40,)], "helpful_vote long")
    out = df.select(fx.helpful_vote_capped().alias("c"), fx.received_helpful_vote().alias("r"),
                    fx.log_helpful_vote().alias("l")).collect()
    assert [r.c for r in out] == [13, 0, 5, 13]          # least() skips NULL
    assert [r.r for r in out] == [0, 0, 1, 1]
    assert out[0].l is None and out[1].l == 0.0


def test_bins_send_null_to_last_label(spark):
    df = spark.createDataFrame([(None,), (0,), (49,), (50,), (149,), (150,), (599,), (600,)],
                               "n int")
    got = [r.b for r in df.select(fx.text_length_bin("n").alias("b")).collect()]
    assert got == ["600+", "Under 50", "Under 50", "50-149", "50-149", "150-299", "300-599",
                   "600+"]
    pop = spark.createDataFrame([(None,), (9,), (10,), (999,), (1000,)], "n long")
    got = [r.b for r in pop.select(fx.popularity_bin("n").alias("b")).collect()]
    assert got == ["1000+ ratings", "Under 10 ratings", "10-49 ratings", "200-999 ratings",
                   "1000+ ratings"]


def test_bin_rank_orders_labels(spark):
    df = spark.createDataFrame([(lab,) for lab in reversed(schemas.LENGTH_BIN_LABELS)], "b string")
    got = [r.b for r in df.withColumn("k", fx.bin_rank("b", schemas.LENGTH_BIN_LABELS))
           .orderBy("k").collect()]
    assert got == schemas.LENGTH_BIN_LABELS


def test_votes_per_year_edge_cases(spark):
    df = spark.createDataFrame([(10, 365), (10, 0), (10, -3), (None, 100), (10, None)],
                               "helpful_vote long, review_age_days int")
    got = [r.v for r in df.select(fx.votes_per_year().alias("v")).collect()]
    assert abs(got[0] - 10 / (365 / 365.25)) < 1e-12
    assert got[1:] == [0.0, 0.0, None, 0.0]


def test_encoding_true_false_null(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "verified_purchase boolean")
    assert [r.e for r in df.select(fx.flag_encoded().alias("e")).collect()] == [1, 0, 0]


def test_timestamp_truncates_toward_zero(spark):
    df = spark.createDataFrame([(1609459200999,), (-1500,), (None,)], "timestamp long")
    got = [r.t for r in df.select(fx.review_timestamp().alias("t")).collect()]
    assert got[0] == dt.datetime(2021, 1, 1, 0, 0, 0)
    assert got[1] == dt.datetime(1969, 12, 31, 23, 59, 59)  # -1.5 s -> -1 s
    assert got[2] is None


def test_ratio_percent_zero_denominator_is_null(spark):
    df = spark.createDataFrame([(1, 0), (1, 3)], "a long, b long")
    got = [r.p for r in df.select(fx.ratio_percent("a", "b", 2).alias("p")).collect()]
    assert got == [None, 33.33]


def test_clean_reviews_features_and_dedup(spark):
    rows = [_r(text="x" * 10, votes=None), _r(text="x" * 10, votes=None),
            _r(user="U2", text=None, votes=20, verified=None, ts=1700000000000)]
    out = cl.clean_reviews(_reviews(spark, rows)).orderBy("user_id").collect()
    assert len(out) == 2
    a, b = out
    assert (a.review_year, a.review_month, a.review_text_length) == (2021, 1, 10)
    assert a.helpful_vote_capped == 13 and a.received_helpful_vote == 0
    assert b.text_length_bin == "600+" and b.review_text_length is None
    assert b.verified_purchase_encoded == 0
    assert a.review_age_days == (dt.date(2023, 9, 9) - dt.date(2021, 1, 1)).days
    assert b.review_age_days < 0 and b.helpful_votes_per_year == 0.0


def test_z_score_with_zero_deviation_is_null(spark):
    rows = [_r(user=f"U{i}", text="same") for i in range(3)]
    out = cl.clean_reviews(_reviews(spark, rows)).select("review_text_length_z").collect()
    assert [r[0] for r in out] == [None, None, None]


def test_clean_metadata_imputes_store_only(spark):
    meta = spark.createDataFrame([("P1", "t", "c", None, 4.0, 3, None)], schemas.METADATA_SCHEMA)
    r = cl.clean_metadata(meta).collect()[0]
    assert r.price is None and r.price_missing and r.store_missing
    assert r.store_imputed == "Unknown" and r.store is None
    m = jn.metadata_for_join(cl.clean_metadata(meta)).collect()[0]
    assert m.store == "Unknown" and m.product_title == "t"


def test_polarization_counts_single_review_products(spark):
    rows = [_r(key="P1", user="U1", rating=5.0), _r(key="P1", user="U2", rating=1.0),
            _r(key="P2", user="U3", rating=3.0)]
    meta = spark.createDataFrame([("P1", "a", "c", 1.0, 4.0, 2, "s"),
                                  ("P2", "b", "c", 1.0, 4.0, 5, "s")], schemas.METADATA_SCHEMA)
    joined = jn.joined_reviews(cl.clean_reviews(_reviews(spark, rows)), cl.clean_metadata(meta))
    stats = {r.parent_asin: r for r in pr.product_rating_stats(joined).collect()}
    assert stats["P2"].rating_stddev is None
    assert abs(stats["P1"].rating_stddev - 2.8284271247461903) < 1e-12
    pol = pr.polarization_profile(joined).collect()[0]
    assert pol.product_count == 2
    assert pol.avg_rating_stddev == 2.828           # P2's NULL is not averaged
    assert pol.avg_extreme_rating_percent == 50.0   # (100 + 0) / 2


def test_missing_required_columns_fail_with_sorted_list(spark):
    df = spark.createDataFrame([("P1",)], "parent_asin string")
    try:
        cl.prune_reviews(df)
    except ValueError as e:
        assert "asin, helpful_vote, rating" in str(e)
    else:
        raise AssertionError("expected a ValueError")


def test_recent_filter_drops_null_year(spark):
    df = spark.createDataFrame([(2017,), (2018,), (2022,), (2023,), (None,)], "review_year int")
    assert sorted(r[0] for r in pr.recent(df).collect()) == [2018, 2022]


def test_length_profile_limits_years(spark):
    rows = [_r(user="U1", ts=1514764800000), _r(user="U2", ts=1483228800000)]  # 2018, 2017
    meta = spark.createDataFrame([("P1", "a", "c", 1.0, 4.0, 2, "s")], schemas.METADATA_SCHEMA)
    joined = jn.joined_reviews(cl.clean_reviews(_reviews(spark, rows)), cl.clean_metadata(meta))
    assert pr.length_profile(joined).agg(F.sum("review_count")).first()[0] == 1
    assert pr.verified_profile(joined).agg(F.sum("review_count")).first()[0] == 2


def test_eager_product_stats_equal_direct_with_repeated_catalog_keys(spark):
    rows = [_r(key="P1", user=f"U{i}", rating=float(1 + i % 5)) for i in range(7)]
    rows += [_r(key="P2", user="U9", rating=4.0), _r(key="P3", user="U8", rating=2.0),
             _r(key="P3", user="U7", rating=5.0)]
    meta = spark.createDataFrame([
        ("P1", "a", "c", 1.0, 4.0, 5, "s"), ("P1", "a", "c", 1.0, 4.0, 7, "s"),   # same bin twice
        ("P1", "a", "c", 1.0, 4.0, 500, "s"),                                     # another bin
        ("P2", "b", "c", 1.0, 4.0, 20, "s"), ("P2", "b", "c", 1.0, 4.0, 30, "s"),
        ("P3", "d", "c", 1.0, 4.0, None, None),
    ], schemas.METADATA_SCHEMA)
    reviews = cl.clean_reviews(_reviews(spark, rows), with_z=False)
    mj = jn.metadata_for_join(cl.clean_metadata(meta))
    direct = pr.product_rating_stats(jn.add_popularity_bin(jn.join_reviews_metadata(reviews, mj)))
    eager = pr.product_rating_stats_eager(reviews, mj)

    def rows_of(df):
        return sorted((r.parent_asin, r.product_popularity_bin, r.review_count,
                       round(r.avg_rating, 12),
                       None if r.rating_stddev is None else round(r.rating_stddev, 12),
                       round(r.extreme_rating_share, 12)) for r in df.collect())

    assert rows_of(direct) == rows_of(eager)
    assert len(rows_of(direct)) == 4
    p = {tuple(r[:2]): r for r in rows_of(eager)}
    assert p[("P1", "Under 10 ratings")][2] == 14 and p[("P2", "10-49 ratings")][4] == 0.0


def test_exact_stddev_is_partition_invariant_and_exact(spark):
    import random
    import statistics

    rnd = random.Random(7)
    vals = [rnd.randint(0, 5000) for _ in range(5000)]
    df = spark.createDataFrame([(v, 4.3, float(v % 5 + 1)) for v in vals], "x int, c double, r double")
    got = {df.repartition(n).select(fx.exact_stddev("x").alias("s"),
                                    fx.exact_stddev("c", 3).alias("c"),
                                    fx.exact_stddev("r", 3).alias("r")).first()
           for n in (1, 3, 11)}
    assert len(got) == 1                       # bit-identical whatever the partitioning
    (row,) = got
    assert abs(row.s - statistics.stdev(vals)) < 1e-9
    assert row.c == 0.0                        # constant column: exactly zero
    assert abs(row.r - statistics.stdev([v % 5 + 1 for v in vals])) < 1e-12
    one = spark.createDataFrame([(1,)], "x int").select(fx.exact_stddev("x")).first()[0]
    assert one is None


def test_join_row_count_equals_join_size(spark):
    reviews = spark.createDataFrame([("P1",), ("P1",), ("P2",), (None,), ("P9",)], "parent_asin string")
    meta = spark.createDataFrame([("P1",), ("P1",), ("P1",), ("P2",), (None,), ("P3",)],
                                 "parent_asin string")
    n = jn.join_row_count(reviews, meta).first()["row_count"]
    assert n == jn.join_reviews_metadata(reviews, meta).count() == 7
    empty = spark.createDataFrame([], "parent_asin string")
    assert jn.join_row_count(empty, meta).first()["row_count"] == 0
