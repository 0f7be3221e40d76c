"""The four analyses and their companion profiles.

All are hash aggregates with a partial (map-side) and a final phase, so a
hot group key never ships more than one partial row per input task. Output
row order is unspecified unless a function says otherwise (``*_ordered``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens import schemas
from revlens.functions import features as fx


# Metric shorthands shared by the profiles.
def n() -> Column:
    return F.count(F.lit(1)).alias("review_count")


def avg_rating(name: str = "avg_rating") -> Column:
    return F.round(F.avg("rating"), 3).alias(name)


def avg_text_length() -> Column:
    return F.round(F.avg("review_text_length"), 2).alias("avg_text_length")


def avg_helpful_vote() -> Column:
    return F.round(F.avg("helpful_vote"), 3).alias("avg_helpful_vote")


def pct_helpful() -> Column:
    return F.round(F.avg("received_helpful_vote") * 100.0, 2).alias("percent_with_helpful_vote")


def avg_votes_per_year() -> Column:
    return F.round(F.avg("helpful_votes_per_year"), 3).alias("avg_helpful_votes_per_year")


def recent(df: DataFrame, years: tuple[int, int] = schemas.RECENT_YEARS) -> DataFrame:
    """Inclusive year range; a NULL year is dropped."""
    lo, hi = years
    return df.filter((F.col("review_year") >= lo) & (F.col("review_year") <= hi))


def verified_profile(df: DataFrame) -> DataFrame:
    """Verified vs unverified (NULL is its own group): n, rating, length, votes, % helped."""
    return df.groupBy("verified_purchase").agg(
        n(), avg_rating(), avg_text_length(), avg_helpful_vote(), pct_helpful())


def length_profile(df: DataFrame, years: tuple[int, int] = schemas.RECENT_YEARS) -> DataFrame:
    """Length bin -> n, rating, % helped, votes per year; reviews of the recent years only."""
    return recent(df, years).groupBy("text_length_bin").agg(
        n(), avg_rating(), pct_helpful(), avg_votes_per_year())


def popularity_profile(df: DataFrame) -> DataFrame:
    """Popularity bin -> n, rating, length, % helped, votes per year."""
    return df.groupBy("product_popularity_bin").agg(
        n(), avg_rating("avg_review_rating"), avg_text_length(), pct_helpful(),
        avg_votes_per_year())


def product_rating_stats(df: DataFrame) -> DataFrame:
    """Per product: n, mean, sample stddev (NULL for one review), share of 1/5 ratings."""
    extreme = F.when(F.col("rating").isin(*schemas.EXTREME_RATINGS), 1).otherwise(0)
    return df.groupBy("parent_asin", "product_popularity_bin").agg(
        n(),
        F.avg("rating").alias("avg_rating"),
        fx.exact_stddev("rating", schemas.RATING_SCALE).alias("rating_stddev"),
        F.avg(extreme).alias("extreme_rating_share"),
    )


def polarization_profile(df: DataFrame) -> DataFrame:
    """Popularity bin -> products, mean per-product stddev, mean extreme-rating %.

    Two aggregation levels; the first is keyed by product and partially
    aggregated before its shuffle, the second runs over one row per product.
    Products with one review have a NULL stddev: counted, but not averaged.
    """
    return polarization_from_products(product_rating_stats(df))


def product_rating_stats_eager(reviews: DataFrame, meta_for_join: DataFrame) -> DataFrame:
    """``product_rating_stats`` computed by aggregating *before* the join.

    Reviews are reduced to one row per product (count, mean, extreme share
    and the exact moment sums of the rating) with partial aggregation, and
    only those rows meet the catalog. The join input shrinks from one row per
    review to one per product, a hot product is collapsed inside each input
    task, and the wide review rows (text) are never shuffled for this
    analysis.

    Exact with repeated catalog keys too: a key present ``m`` times with the
    same popularity bin repeats that product's reviews ``m`` times in the
    row-level join, which multiplies the count and both moment sums by ``m``
    and leaves mean and extreme share unchanged.
    """
    extreme = F.when(F.col("rating").isin(*schemas.EXTREME_RATINGS), 1).otherwise(0)
    per_product = reviews.groupBy("parent_asin").agg(
        F.count(F.lit(1)).alias("_n"),
        F.avg("rating").alias("avg_rating"),
        *fx.moment_sums("rating", schemas.RATING_SCALE, "_r"),
        F.avg(extreme).alias("extreme_rating_share"),
    )
    bins = (meta_for_join.select("parent_asin", fx.popularity_bin("rating_number")
                                 .alias("product_popularity_bin"))
            .groupBy("parent_asin", "product_popularity_bin")
            .agg(F.count(F.lit(1)).alias("_m")))
    m = F.col("_m")
    return per_product.join(bins, "parent_asin", "inner").select(
        "parent_asin", "product_popularity_bin",
        (F.col("_n") * m).alias("review_count"), "avg_rating",
        fx.stddev_from_sums(F.col("_r_n") * m, F.col("_r_s1") * m, F.col("_r_s2") * m)
        .alias("rating_stddev"),
        "extreme_rating_share",
    )


def polarization_profile_eager(reviews: DataFrame, meta_for_join: DataFrame) -> DataFrame:
    """Same result as ``polarization_profile(joined)``, aggregated before the join."""
    return polarization_from_products(product_rating_stats_eager(reviews, meta_for_join))


def polarization_from_products(stats: DataFrame) -> DataFrame:
    return stats.groupBy("product_popularity_bin").agg(
        F.count(F.lit(1)).alias("product_count"),
        F.round(F.avg("rating_stddev"), 3).alias("avg_rating_stddev"),
        F.round(F.avg("extreme_rating_share") * 100.0, 2).alias("avg_extreme_rating_percent"),
    )


def year_verified_profile(df: DataFrame) -> DataFrame:
    return df.groupBy("review_year", "verified_purchase").agg(
        n(), avg_rating(), avg_text_length(), pct_helpful())


def recent_verified_profile(df: DataFrame,
                            years: tuple[int, int] = schemas.RECENT_YEARS) -> DataFrame:
    return recent(df, years).groupBy("verified_purchase").agg(
        n(), avg_rating(), avg_text_length(), pct_helpful(), avg_votes_per_year())


def with_bin_rank(df: DataFrame, label_col: str, labels) -> DataFrame:
    """Adds ``bin_order`` (1..k) and sorts by it: the display order of bins."""
    return df.withColumn("bin_order", fx.bin_rank(label_col, labels)).orderBy("bin_order")


def length_profile_ordered(df: DataFrame) -> DataFrame:
    return with_bin_rank(length_profile(df), "text_length_bin", schemas.LENGTH_BIN_LABELS)


def popularity_profile_ordered(df: DataFrame) -> DataFrame:
    return with_bin_rank(popularity_profile(df), "product_popularity_bin",
                         schemas.POPULARITY_BIN_LABELS)


def polarization_profile_ordered(df: DataFrame) -> DataFrame:
    return with_bin_rank(polarization_profile(df), "product_popularity_bin",
                         schemas.POPULARITY_BIN_LABELS)
