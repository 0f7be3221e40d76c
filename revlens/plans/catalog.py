"""Registered queries: one callable per operator of the inventory.

Each takes ``(spark, sf_dir)``, derives the review and catalog tables from
the test tables (``revlens.sources.fixtures``) and returns a
``DataFrame``, lazy but for these: ``scan_parquet_narrow``,
``high_rating_by_verified``, the two sink queries, ``analytics_job``, ``input_validation``
``preview_joined`` and the queries that return texts of distinct reviews write and read back on every call,
exact quantiles run their passes at once, and the JSON queries write their input lines once
per session. Queries set the session's time zone to UTC and its Parquet codec to zstd, unless
the deployment names one. Column names
equal those of the SQL twins in ``revlens.plans.oracle_sql``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens import schemas, session
from revlens.operators import clean as cl
from revlens.operators import explore as ex
from revlens.operators import joins as jn
from revlens.operators import profiles as pr
from revlens.operators import quality as qa
from revlens.plans import jobs
from revlens.sources import fixture_files as ff
from revlens.sources import fixtures as fxt
from revlens.sources import json_lines as jl
from revlens.sources import sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ID_COLS = ["parent_asin", "user_id", "asin", "timestamp"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# ------------------------------------------------------------------ inputs
def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    session.pin(spark)
    return fxt.reviews_raw(spark, sf_dir)


def narrow_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw reviews with length and digest in place of the text."""
    session.pin(spark)
    return fxt.reviews_raw(spark, sf_dir, narrow=True)


def raw_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fxt.metadata(spark, sf_dir)


def clean(spark: SparkSession, sf_dir: str, with_z: bool = True, with_text: bool = False) -> DataFrame:
    rows = raw_reviews(spark, sf_dir) if with_text else narrow_reviews(spark, sf_dir)
    return cl.clean_reviews(rows, with_z=with_z, with_text=with_text)


def clean_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.clean_metadata(raw_metadata(spark, sf_dir))


def joined(spark: SparkSession, sf_dir: str, with_z: bool = True, with_text: bool = False,
           where: Column | None = None) -> DataFrame:
    """``where``: only reviews of which it holds are staged."""
    if with_text:
        raw = raw_reviews(spark, sf_dir)
        staged = cl.stage_reviews(raw if where is None else raw.where(where))
        return jn.joined_staged(staged, cl.clean_staged(staged, with_z=with_z), clean_meta(spark, sf_dir))
    return jn.joined_reviews(clean(spark, sf_dir, with_z), clean_meta(spark, sf_dir))


def checked_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faulty review JSON lines, schema-bound, with a short source name."""
    session.pin(spark)
    path = ff.fixture_json(spark, sf_dir, "reviews", faulty=True)
    df = jl.read_json_checked(spark, path, schemas.REVIEW_SCHEMA)
    return df.withColumn(schemas.SOURCE_COLUMN, jl.source_name())


def checked_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = ff.fixture_json(spark, sf_dir, "metadata", faulty=True)
    df = jl.read_json_checked(spark, path, schemas.METADATA_SCHEMA)
    return df.withColumn(schemas.SOURCE_COLUMN, jl.source_name())


# ------------------------------------------------------------------ 1. four analyses
@query
def verified_profile(spark, sf_dir):
    return pr.verified_profile(joined(spark, sf_dir, with_z=False))


@query
def length_profile(spark, sf_dir):
    return pr.length_profile(joined(spark, sf_dir, with_z=False))


@query
def popularity_profile(spark, sf_dir):
    return pr.popularity_profile(joined(spark, sf_dir, with_z=False))


@query
def product_rating_stats(spark, sf_dir):
    return pr.product_rating_stats(joined(spark, sf_dir, with_z=False))


@query
def polarization_profile(spark, sf_dir):
    return pr.polarization_profile(joined(spark, sf_dir, with_z=False))


@query
def polarization_profile_eager(spark, sf_dir):
    """Polarization with per-product aggregation ahead of the catalog join."""
    return pr.polarization_profile_eager(clean(spark, sf_dir, with_z=False),
                                         jn.metadata_for_join(clean_meta(spark, sf_dir)))


@query
def product_rating_stats_eager(spark, sf_dir):
    return pr.product_rating_stats_eager(clean(spark, sf_dir, with_z=False),
                                         jn.metadata_for_join(clean_meta(spark, sf_dir)))


@query
def length_profile_ordered(spark, sf_dir):
    return pr.length_profile_ordered(joined(spark, sf_dir, with_z=False))


@query
def popularity_profile_ordered(spark, sf_dir):
    return pr.popularity_profile_ordered(joined(spark, sf_dir, with_z=False))


@query
def polarization_profile_ordered(spark, sf_dir):
    return pr.polarization_profile_ordered(joined(spark, sf_dir, with_z=False))


@query
def verified_profile_prejoin(spark, sf_dir):
    return pr.verified_profile(clean(spark, sf_dir, with_z=False))


@query
def year_verified_profile(spark, sf_dir):
    return pr.year_verified_profile(clean(spark, sf_dir, with_z=False))


@query
def recent_verified_profile(spark, sf_dir):
    return pr.recent_verified_profile(clean(spark, sf_dir, with_z=False))


# ------------------------------------------------------------------ composite tables
@query
def clean_reviews(spark, sf_dir):
    return clean(spark, sf_dir, with_text=True)


@query
def clean_metadata(spark, sf_dir):
    return clean_meta(spark, sf_dir)


@query
def metadata_for_join(spark, sf_dir):
    return jn.metadata_for_join(clean_meta(spark, sf_dir))


@query
def joined_reviews(spark, sf_dir):
    return joined(spark, sf_dir, with_text=True)


@query
def join_reviews_metadata(spark, sf_dir):
    """The bare inner join (no popularity bin), review identity + catalog fields."""
    out = jn.join_reviews_metadata(clean(spark, sf_dir, with_z=False),
                                   jn.metadata_for_join(clean_meta(spark, sf_dir)))
    return out.select(*ID_COLS, "rating", "product_title", "main_category", "price",
                      "price_missing", "average_rating", "rating_number", "store",
                      "store_missing")


# ------------------------------------------------------------------ projections & filters
@query
def prune_reviews(spark, sf_dir):
    return cl.prune_reviews(raw_reviews(spark, sf_dir))


@query
def prune_metadata(spark, sf_dir):
    return cl.prune_metadata(raw_metadata(spark, sf_dir))


@query
def dedup_reviews(spark, sf_dir):
    return cl.dedup_staged(raw_reviews(spark, sf_dir))


@query
def filter_recent_years(spark, sf_dir):
    return pr.recent(joined(spark, sf_dir, with_z=False)).select(
        *ID_COLS, "rating", "review_year", "product_popularity_bin")


@query
def filter_min_age(spark, sf_dir):
    return ex.min_age(clean(spark, sf_dir, with_z=False)).select(
        *ID_COLS, "review_date", "review_age_days")


@query
def nonpositive_price(spark, sf_dir):
    return ex.nonpositive_price(cl.prune_metadata(raw_metadata(spark, sf_dir)))


@query
def verified_encoding_pairs(spark, sf_dir):
    return ex.verified_encoding_pairs(clean(spark, sf_dir, with_z=False))


# ------------------------------------------------------------------ features
def _features(spark, sf_dir, *cols, with_z=False):
    return clean(spark, sf_dir, with_z=with_z).select(*ID_COLS, *cols)


@query
def feat_calendar(spark, sf_dir):
    return _features(spark, sf_dir, "review_timestamp", "review_date", "review_year",
                     "review_month")


@query
def feat_text_length(spark, sf_dir):
    return clean(spark, sf_dir, with_z=False, with_text=True).select(*ID_COLS, "text", "review_text_length")


@query
def feat_votes(spark, sf_dir):
    return _features(spark, sf_dir, "helpful_vote", "received_helpful_vote",
                     "log_helpful_vote", "helpful_vote_capped")


@query
def feat_verified(spark, sf_dir):
    return _features(spark, sf_dir, "verified_purchase", "verified_purchase_encoded")


@query
def feat_length_bin(spark, sf_dir):
    return _features(spark, sf_dir, "review_text_length", "text_length_bin")


@query
def feat_length_z(spark, sf_dir):
    return _features(spark, sf_dir, "review_text_length", "review_text_length_z", with_z=True)


@query
def feat_age(spark, sf_dir):
    return _features(spark, sf_dir, "review_date", "review_age_days", "helpful_vote",
                     "helpful_votes_per_year")


@query
def feat_popularity_bin(spark, sf_dir):
    return joined(spark, sf_dir, with_z=False).select(*ID_COLS, "rating_number",
                                                      "product_popularity_bin")


# ------------------------------------------------------------------ exploration aggregates
@query
def row_counts(spark, sf_dir):
    sizes = jn.pipeline_sizes(narrow_reviews(spark, sf_dir), raw_metadata(spark, sf_dir))
    return sizes.unpivot([], sizes.columns, "dataset", "row_count")


@query
def length_stats(spark, sf_dir):
    return cl.length_stats(clean(spark, sf_dir, with_z=False))


@query
def rating_distribution(spark, sf_dir):
    return ex.rating_distribution(cl.prune_reviews(raw_reviews(spark, sf_dir)))


@query
def verified_counts(spark, sf_dir):
    return ex.verified_counts(clean(spark, sf_dir, with_z=False))


@query
def verified_rating_counts(spark, sf_dir):
    return ex.verified_rating_counts(clean(spark, sf_dir, with_z=False))


@query
def reviews_by_year(spark, sf_dir):
    return ex.reviews_by_year(clean(spark, sf_dir, with_z=False))


@query
def year_verified_counts(spark, sf_dir):
    return ex.year_verified_counts(clean(spark, sf_dir, with_z=False))


@query
def rating_share_by_verified(spark, sf_dir):
    return ex.rating_share_by_verified(clean(spark, sf_dir, with_z=False))


@query
def verified_share_by_year(spark, sf_dir):
    return ex.verified_share_by_year(clean(spark, sf_dir, with_z=False))


@query
def price_missingness(spark, sf_dir):
    return ex.price_missingness(cl.prune_metadata(raw_metadata(spark, sf_dir)))


@query
def price_summary(spark, sf_dir):
    return ex.price_summary(cl.prune_metadata(raw_metadata(spark, sf_dir)))


@query
def review_missingness(spark, sf_dir):
    return ex.review_missingness(cl.prune_reviews(raw_reviews(spark, sf_dir)))


@query
def metadata_missingness(spark, sf_dir):
    return ex.metadata_missingness(cl.prune_metadata(raw_metadata(spark, sf_dir)))


@query
def duplicate_totals(spark, sf_dir):
    return ex.duplicate_totals(narrow_reviews(spark, sf_dir))


@query
def duplicate_review_keys(spark, sf_dir):
    return ex.duplicate_review_keys(cl.prune_reviews(raw_reviews(spark, sf_dir)))


@query
def top_duplicate_keys(spark, sf_dir):
    return ex.top_duplicate_keys(cl.prune_reviews(raw_reviews(spark, sf_dir)))


@query
def duplicate_drilldown(spark, sf_dir):
    raw = raw_reviews(spark, sf_dir)
    return ex.duplicate_drilldown(raw, cl.prune_reviews(raw))


@query
def review_date_range(spark, sf_dir):
    return ex.review_date_range(clean(spark, sf_dir, with_z=False))


@query
def vote_range(spark, sf_dir):
    return ex.vote_range(clean(spark, sf_dir, with_z=False))


@query
def vote_quantiles_approx(spark, sf_dir):
    return ex.quantile_errors(clean(spark, sf_dir, with_z=False), schemas.COARSE_QUANTILES,
                              schemas.COARSE_QUANTILE_ERROR)


@query
def vote_quantiles_fine_approx(spark, sf_dir):
    return ex.quantile_errors(clean(spark, sf_dir, with_z=False), schemas.FINE_QUANTILES,
                              schemas.FINE_QUANTILE_ERROR)


@query
def vote_quantiles(spark, sf_dir):
    return ex.vote_quantiles_exact(clean(spark, sf_dir, with_z=False), schemas.FINE_QUANTILES)


@query
def vote_quantiles_coarse(spark, sf_dir):
    return ex.vote_quantiles_exact(clean(spark, sf_dir, with_z=False), schemas.COARSE_QUANTILES)


@query
def vote_zero_share(spark, sf_dir):
    return ex.vote_zero_share(clean(spark, sf_dir, with_z=False))


@query
def vote_cap_effect(spark, sf_dir):
    return ex.vote_cap_effect(clean(spark, sf_dir, with_z=False))


@query
def z_sanity(spark, sf_dir):
    return ex.z_sanity(clean(spark, sf_dir))


@query
def join_retention(spark, sf_dir):
    return ex.join_retention(jn.pipeline_sizes(narrow_reviews(spark, sf_dir), raw_metadata(spark, sf_dir)))


@query
def preview_joined(spark, sf_dir):
    """The first rows; texts are looked at only of the reviews that can be among them by the columns
    before the text, found out from the joined table without texts."""
    order = ["parent_asin", "user_id", "asin", "timestamp", "rating", "title", "text",
             "helpful_vote", "verified_purchase"]
    near = ex.preview_bound(joined(spark, sf_dir, with_z=False), order[:order.index("text")], 10)
    return ex.preview(
        joined(spark, sf_dir, with_z=False, with_text=True, where=near),
        ["parent_asin", "product_title", "store", "rating", "verified_purchase",
         "review_text_length", "helpful_vote", "rating_number"], order, 10)


# ------------------------------------------------------------------ quality (JSON lines)
@query
def review_quality_by_file(spark, sf_dir):
    return qa.review_quality_by_file(checked_reviews(spark, sf_dir))


@query
def metadata_quality_by_file(spark, sf_dir):
    return qa.metadata_quality_by_file(checked_metadata(spark, sf_dir))


@query
def filter_valid_metadata(spark, sf_dir):
    return qa.valid_rows(checked_metadata(spark, sf_dir)).drop(schemas.CORRUPT_COLUMN)


@query
def metadata_distinct_keys(spark, sf_dir):
    return qa.metadata_distinct_keys(qa.valid_rows(checked_metadata(spark, sf_dir)))


@query
def metadata_key_multiplicity(spark, sf_dir):
    return qa.metadata_key_multiplicity(qa.valid_rows(checked_metadata(spark, sf_dir)))


@query
def metadata_duplicate_summary(spark, sf_dir):
    return qa.metadata_duplicate_summary(
        qa.metadata_key_multiplicity(qa.valid_rows(checked_metadata(spark, sf_dir))))


@query
def sample_join_coverage(spark, sf_dir):
    return qa.sample_join_coverage(checked_reviews(spark, sf_dir),
                                   qa.valid_rows(checked_metadata(spark, sf_dir)),
                                   fxt.SAMPLE_FRACTION)


@query
def input_validation(spark, sf_dir):
    """The whole input validation (C6) as one long table; each input is parsed once."""
    frames, _ = jobs.validation_reports(spark, checked_reviews(spark, sf_dir), checked_metadata(spark, sf_dir), fxt.SAMPLE_FRACTION)
    return jobs.long_report(frames)


@query
def scan_json_permissive(spark, sf_dir):
    """``spark.read.json`` under the schema with a corrupt column; every field
    is referenced, so type errors anywhere in a line are seen."""
    session.pin(spark)
    path = ff.fixture_json(spark, sf_dir, "reviews", faulty=True)
    df = jl.read_json_permissive(spark, path, schemas.REVIEW_SCHEMA)
    return df.select(*schemas.REVIEW_COLUMNS,
                     F.col(schemas.CORRUPT_COLUMN).isNotNull().alias("is_corrupt"),
                     jl.source_name().alias(schemas.SOURCE_COLUMN))


@query
def scan_json_inferred(spark, sf_dir):
    """Inferred-schema scan of the clean JSON lines, checked against the contract."""
    session.pin(spark)
    path = ff.fixture_json(spark, sf_dir, "reviews", faulty=False)
    df = jl.read_json_inferred(spark, path, "reviews")
    return cl.prune_reviews(df)


@query
def scan_json_multifile(spark, sf_dir):
    """Two per-file folders named by a glob, read as one table with lineage."""
    session.pin(spark)
    base = ff.fixture_json(spark, sf_dir, "reviews", faulty=False)
    df = jl.read_json_checked(spark, f"{base}/source_file=reviews_*/*.txt.gz", schemas.REVIEW_SCHEMA)
    return (df.withColumn(schemas.SOURCE_COLUMN, jl.source_name())
            .groupBy(schemas.SOURCE_COLUMN)
            .agg(F.count(F.lit(1)).alias("row_count"),
                 F.countDistinct("parent_asin").alias("distinct_parent_asin"),
                 F.sum("helpful_vote").alias("total_helpful_vote")))


@query
def high_rating_by_verified_json(spark, sf_dir):
    """The format-comparison aggregate on the raw JSON lines (inferred schema)."""
    session.pin(spark)
    path = ff.fixture_json(spark, sf_dir, "reviews", faulty=False)
    return ex.high_rating_by_verified(jl.read_json_inferred(spark, path, "reviews"))


# ------------------------------------------------------------------ sinks & Parquet scans
@query
def scan_parquet_narrow(spark, sf_dir):
    """Raw (rating, verified_purchase) written to Parquet and counted on both sides."""
    raw = raw_reviews(spark, sf_dir).select("rating", "verified_purchase")
    path = sinks.write_parquet(raw, session.staging_path(spark, "reviews-narrow"))
    back = spark.read.parquet(path)
    return ex.row_counts([("source", raw), ("parquet", back)])


@query
def high_rating_by_verified(spark, sf_dir):
    """rating >= 4 by verified flag on the narrow Parquet copy (filter pushed to the scan)."""
    raw = raw_reviews(spark, sf_dir).select("rating", "verified_purchase")
    path = sinks.write_parquet(raw, session.staging_path(spark, "reviews-narrow"))
    return ex.high_rating_by_verified(spark.read.parquet(path))


@query
def sink_parquet_roundtrip(spark, sf_dir):
    """Write clean reviews, the catalog projection and the joined table, read back, count. The
    written catalog comes to the staged reviews, so no text is shuffled for the joined table."""
    staged = cl.stage_reviews(raw_reviews(spark, sf_dir))
    try:
        c = cl.clean_staged(staged)
        m = jn.metadata_for_join(clean_meta(spark, sf_dir))
        base = session.staging_path(spark, "processed")
        p_rev = sinks.write_parquet(c.drop("slice"), f"{base}/reviews_clean.parquet")
        p_meta = sinks.write_parquet(m, f"{base}/metadata_for_join.parquet")
        rev_back, meta_back = spark.read.parquet(p_rev), spark.read.parquet(p_meta)
        p_join = sinks.write_parquet(jn.add_popularity_bin(jn.join_reviews_metadata(c, meta_back, staged)),
                                     f"{base}/joined_reviews.parquet")
    finally:
        staged.drop()
    return ex.row_counts([("reviews_clean", rev_back), ("metadata_for_join", meta_back),
                          ("joined_reviews", spark.read.parquet(p_join))])


@query
def sink_csv_roundtrip(spark, sf_dir):
    """The polarization table written as one headed CSV file and read back typed."""
    out = pr.polarization_profile(joined(spark, sf_dir, with_z=False))
    path = sinks.write_small_csv(out, session.staging_path(spark, "polarization-csv"))
    return (spark.read.option("header", True).schema(out.schema).csv(path))


@query
def analytics_job(spark, sf_dir):
    """The whole job (C5) from raw JSON lines: clean -> join -> four analyses,
    written as Parquet and CSV; returns the polarization CSV read back typed."""
    session.pin(spark)
    reviews = ff.fixture_json(spark, sf_dir, "reviews", faulty=False)
    catalog_json = ff.fixture_json(spark, sf_dir, "catalog", faulty=False)
    base = session.staging_path(spark, "analytics-job")
    run = jobs.run_review_analytics(spark, reviews, catalog_json, f"{base}/processed",
                                    f"{base}/results", with_counts=False)
    schema = pr.polarization_profile(spark.read.parquet(run.paths["joined_reviews"])).schema
    return spark.read.option("header", True).schema(schema).csv(run.paths["polarization_analysis"])
