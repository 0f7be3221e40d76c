"""Review-to-catalog joins.

The fact side is the full review table; the catalog side is a dimension
that can itself be large (tens of millions of products), so no broadcast is
forced here. The optimizer, and AQE with measured stage sizes, pick a
broadcast hash join only while the catalog side is below
``spark.sql.adaptive.autoBroadcastJoinThreshold``; beyond that it is a
sort-merge join whose oversized partitions (one product holding a large
share of all reviews) are split by AQE's skew-join handling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens import schemas
from revlens.functions import features as fx
from revlens.operators.clean import narrow_reviews
from revlens.operators.staged import StagedReviews


def metadata_for_join(clean_meta: DataFrame) -> DataFrame:
    """Catalog projection joined to reviews (title and imputed store renamed)."""
    return clean_meta.select(
        "parent_asin",
        F.col("title").alias("product_title"),
        "main_category",
        "price",
        "price_missing",
        "average_rating",
        "rating_number",
        F.col("store_imputed").alias("store"),
        "store_missing",
    )


def join_reviews_metadata(reviews: DataFrame, meta_for_join: DataFrame, staged: StagedReviews | None = None) -> DataFrame:
    """Inner equi-join on ``parent_asin`` (key once, leftmost; NULL keys drop).

    Duplicate catalog keys multiply reviews, as in the original; run
    ``metadata_duplicate_summary`` first when that matters. With ``staged``, whose rows ``reviews``
    are (``clean.clean_staged``), the catalog rows come to the slices and no review is shuffled.
    """
    if staged is None:
        return reviews.join(meta_for_join, on=schemas.KEY, how="inner")
    out = staged.with_catalog(reviews, meta_for_join)
    return out.select(schemas.KEY, *[c for c in out.columns if c != schemas.KEY])


def duplicate_key_count(meta: DataFrame, key: str = schemas.KEY) -> DataFrame:
    """One row: how many keys occur more than once (a grouped count, partially
    aggregated, so only the single result row reaches the driver)."""
    return (meta.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
            .agg(F.coalesce(F.sum((F.col("_rows") > 1).cast("long")), F.lit(0)).alias("dup_keys")))


def one_row_per_key(meta: DataFrame, key: str = schemas.KEY) -> DataFrame:
    """Keep one catalog row per key, deterministically: the smallest row by
    the remaining columns (independent of file order and partitioning)."""
    rest = [c for c in meta.columns if c != key]
    return (meta.groupBy(key).agg(F.min(F.struct(*rest)).alias("_row"))
            .select(key, *[F.col(f"_row.{c}").alias(c) for c in rest]))


def join_row_count(reviews: DataFrame, meta: DataFrame, key: str = schemas.KEY) -> DataFrame:
    """One row, ``row_count``: the size of ``reviews JOIN meta USING (key)``
    without performing the join.

    Each side is reduced to a count per key (partially aggregated, so a hot
    product costs one row per task); the counts are combined by a union and
    one grouped sum, and the result is the sum over non-NULL keys of
    reviews(key) x catalog rows(key). With no join in the plan no
    ``key IS NOT NULL`` filter is inferred and pushed into the inputs, so the
    inputs' exchanges (the review dedup) stay reusable by sibling branches.
    """
    r = reviews.groupBy(key).agg(F.count(F.lit(1)).alias("_r"), F.lit(0).cast("long").alias("_m"))
    m = meta.groupBy(key).agg(F.lit(0).cast("long").alias("_r"), F.count(F.lit(1)).alias("_m"))
    per_key = r.unionByName(m).groupBy(key).agg(F.sum("_r").alias("_r"), F.sum("_m").alias("_m"))
    return per_key.agg(F.coalesce(F.sum(F.when(F.col(key).isNotNull(), F.col("_r") * F.col("_m"))),
                                  F.lit(0).cast("long")).alias("row_count"))


def pipeline_sizes(raw_reviews: DataFrame, raw_meta: DataFrame, key: str = schemas.KEY) -> DataFrame:
    """One row with the sizes of raw and clean reviews, of the catalog and of their join.

    The reviews are grouped by their columns once (the text as length and
    digest): group sizes give the raw count, groups the clean one, and
    counts per key on both sides the join's, as in ``join_row_count``.
    """
    narrow = narrow_reviews(raw_reviews)
    unique = narrow.groupBy(*narrow.columns).agg(F.count(F.lit(1)).alias("_raw"))
    none = F.lit(0).cast("long")
    r = unique.groupBy(key).agg(F.sum("_raw").alias("_raw"), F.count(F.lit(1)).alias("_r"), none.alias("_m"))
    m = raw_meta.groupBy(key).agg(none.alias("_raw"), none.alias("_r"), F.count(F.lit(1)).alias("_m"))
    per_key = r.unionByName(m).groupBy(key).agg(*[F.sum(c).alias(c) for c in ("_raw", "_r", "_m")])
    total = lambda c: F.coalesce(F.sum(c), none)
    return per_key.agg(
        total("_raw").alias("raw_reviews"), total("_m").alias("raw_metadata"), total("_r").alias("clean_reviews"),
        total("_m").alias("clean_metadata"),
        total(F.when(F.col(key).isNotNull(), F.col("_r") * F.col("_m"))).alias("joined_reviews"))


def add_popularity_bin(joined: DataFrame) -> DataFrame:
    return joined.withColumn("product_popularity_bin", fx.popularity_bin("rating_number"))


def joined_reviews(clean_reviews: DataFrame, clean_meta: DataFrame) -> DataFrame:
    """Clean reviews x catalog projection + popularity bin."""
    return add_popularity_bin(join_reviews_metadata(clean_reviews, metadata_for_join(clean_meta)))


def joined_staged(staged: StagedReviews, clean_rows: DataFrame, clean_meta: DataFrame) -> DataFrame:
    """As ``joined_reviews``, of staged reviews (``clean.clean_staged``)."""
    return binned_staged(staged, clean_rows, metadata_for_join(clean_meta))


def binned_staged(staged: StagedReviews, clean_rows: DataFrame, meta_for_join: DataFrame) -> DataFrame:
    """Staged reviews x catalog projection + popularity bin: the catalog rows come to the slices,
    the reviews aren't shuffled."""
    return add_popularity_bin(join_reviews_metadata(clean_rows, meta_for_join, staged))
