"""DuckDB twins of the registered queries (the independent oracle).

The fixture mapping is written again here as plain SQL common table
expressions over the pre-registered views (lineitem, orders, part,
documents); each query selects from them. Types are cast so that both
engines report the same ones (DuckDB's ``length``/``year`` are BIGINT, its
integer sums HUGEINT, its ``x / 0`` is infinity, hence ``NULLIF``).
"""

from __future__ import annotations


def _exact_sd(col: str, scale: int) -> str:
    """Sample stddev from exact DECIMAL moment sums, for z-scores that agree digit by digit;
    ``length_stats`` and ``product_rating_stats`` hold the formula against ``stddev_samp``."""
    d = f"CAST({col} AS DECIMAL({10 + scale},{scale}))"
    n = f"count({col})"
    return (f"CASE WHEN {n} > 1 THEN sqrt(CAST({n} * sum({d} * {d}) - sum({d}) * sum({d}) AS DOUBLE)"
            f" / (CAST({n} AS DOUBLE) * CAST({n} - 1 AS DOUBLE))) END")


# Review rows with the raw order key and the per-file lineage.
_REVIEW_BASE = """
rb AS (
  SELECT
    'P' || CAST(l.product AS VARCHAR) AS parent_asin,
    'A' || CAST(l.product AS VARCHAR) || '-' || CAST(l.l_suppkey % 3 AS VARCHAR) AS asin,
    'U' || CAST(o.o_custkey AS VARCHAR) AS user_id,
    CAST(1 + CAST(l.l_quantity AS BIGINT) % 5 AS DOUBLE) AS rating,
    o.o_orderpriority AS title,
    CASE WHEN l.l_orderkey % 97 <> 0 THEN d.text END AS text,
    CAST(epoch_ms(l.l_shipdate) + 662688000000
         + CASE WHEN l.l_orderkey % 211 = 0 THEN 86400000000 ELSE 0 END AS BIGINT) AS "timestamp",
    CAST(CASE WHEN l.l_orderkey % 89 = 0 THEN NULL
              WHEN l.l_discount >= CAST(0.08 AS DOUBLE) THEN l.l_orderkey % 37
              ELSE 0 END AS BIGINT) AS helpful_vote,
    CASE WHEN l.l_orderkey % 83 = 0 THEN NULL ELSE l.l_returnflag <> 'R' END AS verified_purchase,
    CASE WHEN l.l_orderkey % 2 = 0 THEN 'reviews_a' ELSE 'reviews_b' END AS source_file,
    l.l_orderkey AS ok
  FROM (SELECT *, CASE WHEN l_partkey % 61 = 0 AND l_quantity < 49 THEN l_partkey + 1 ELSE l_partkey END AS product
        FROM lineitem) l
  -- reverse(reverse(x)) is x as a plain string: DuckDB 2.0.0 fails on dictionary strings in the DISTINCT below
  JOIN (SELECT o_orderkey, o_custkey, reverse(reverse(o_orderpriority)) AS o_orderpriority FROM orders) o ON l.l_orderkey = o.o_orderkey
  JOIN documents d ON d.doc_id = l.l_orderkey % (SELECT count(*) FROM documents)
),
rr_src AS (
  SELECT * FROM rb
  UNION ALL
  SELECT * FROM rb WHERE helpful_vote = 7
),
reviews_raw AS (
  SELECT parent_asin, asin, user_id, rating, title, text, "timestamp", helpful_vote,
         verified_purchase
  FROM rr_src
)"""

_CLEAN = f"""
dedup AS (
  SELECT DISTINCT parent_asin, asin, user_id, rating, title, text, "timestamp", helpful_vote,
         verified_purchase
  FROM reviews_raw
),
f1 AS (
  SELECT *, make_timestamp(("timestamp" // 1000) * 1000000) AS review_timestamp
  FROM dedup
),
f2 AS (
  SELECT *,
    CAST(review_timestamp AS DATE) AS review_date,
    CAST(year(review_timestamp) AS INTEGER) AS review_year,
    CAST(month(review_timestamp) AS INTEGER) AS review_month,
    CAST(length(text) AS INTEGER) AS review_text_length,
    CASE WHEN helpful_vote > 0 THEN 1 ELSE 0 END AS received_helpful_vote,
    ln(1 + CAST(helpful_vote AS DOUBLE)) AS log_helpful_vote,
    CAST(least(helpful_vote, 13) AS BIGINT) AS helpful_vote_capped,
    CASE WHEN verified_purchase THEN 1 ELSE 0 END AS verified_purchase_encoded
  FROM f1
),
f3 AS (
  SELECT *,
    CASE WHEN review_text_length < 50 THEN 'Under 50'
         WHEN review_text_length < 150 THEN '50-149'
         WHEN review_text_length < 300 THEN '150-299'
         WHEN review_text_length < 600 THEN '300-599'
         ELSE '600+' END AS text_length_bin,
    CAST(DATE '2023-09-09' - review_date AS INTEGER) AS review_age_days
  FROM f2
),
len_stats AS (
  SELECT avg(review_text_length) AS m, {_exact_sd("review_text_length", 0)} AS s FROM f3
),
reviews_clean AS (
  SELECT parent_asin, asin, user_id, rating, title, text, "timestamp", helpful_vote,
    verified_purchase, review_timestamp, review_date, review_year, review_month,
    review_text_length, received_helpful_vote, log_helpful_vote, helpful_vote_capped,
    verified_purchase_encoded, text_length_bin,
    (review_text_length - (SELECT m FROM len_stats)) / NULLIF((SELECT s FROM len_stats), 0)
      AS review_text_length_z,
    review_age_days,
    CASE WHEN review_age_days > 0
         THEN helpful_vote / (review_age_days / CAST(365.25 AS DOUBLE))
         ELSE CAST(0 AS DOUBLE) END AS helpful_votes_per_year
  FROM f3
)"""

_META = """
meta_rows AS (
  SELECT p_partkey AS pk,
    CASE WHEN p_partkey % 53 = 0 THEN 'X' ELSE 'P' END || CAST(p_partkey AS VARCHAR) AS parent_asin,
    p_name AS title,
    p_type AS main_category,
    CASE WHEN p_partkey % 66 = 0 THEN CAST(0 AS DOUBLE) WHEN p_partkey % 78 = 0 THEN -p_retailprice
         WHEN p_partkey % 6 = 0 THEN p_retailprice END AS price,
    CAST(10 + p_size % 41 AS DOUBLE) / CAST(10 AS DOUBLE) AS average_rating,
    CASE WHEN p_partkey % 101 = 0 THEN NULL
         ELSE CAST((CASE p_partkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 10 WHEN 2 THEN 100 ELSE 1000 END)
                   * (1 + p_size % 9) AS BIGINT) END AS rating_number,
    CASE WHEN p_partkey % 20 = 0 THEN NULL ELSE p_brand END AS store,
    CASE WHEN p_partkey % 3 = 0 THEN 'meta_a' ELSE 'meta_b' END AS own_file
  FROM part
),
metadata AS (
  SELECT parent_asin, title, main_category, price, average_rating, rating_number, store
  FROM meta_rows
),
metadata_clean AS (
  SELECT *, price IS NULL AS price_missing, store IS NULL AS store_missing,
         coalesce(store, 'Unknown') AS store_imputed
  FROM metadata
),
metadata_for_join AS (
  SELECT parent_asin, title AS product_title, main_category, price, price_missing,
         average_rating, rating_number, store_imputed AS store, store_missing
  FROM metadata_clean
)"""

_JOINED = """
joined AS (
  SELECT r.*, m.product_title, m.main_category, m.price, m.price_missing, m.average_rating,
    m.rating_number, m.store, m.store_missing,
    CASE WHEN m.rating_number < 10 THEN 'Under 10 ratings'
         WHEN m.rating_number < 50 THEN '10-49 ratings'
         WHEN m.rating_number < 200 THEN '50-199 ratings'
         WHEN m.rating_number < 1000 THEN '200-999 ratings'
         ELSE '1000+ ratings' END AS product_popularity_bin
  FROM reviews_clean r JOIN metadata_for_join m ON r.parent_asin = m.parent_asin
)"""

# Raw catalog as delivered (copies and NULL keys) and its parsed JSON view.
_META_RAW = """
metadata_raw AS (
  SELECT pk, parent_asin, title, main_category, price, average_rating, rating_number, store,
         own_file AS source_file FROM meta_rows
  UNION ALL
  SELECT pk, parent_asin, title, main_category, price, average_rating, rating_number, store,
         'meta_c' FROM meta_rows WHERE pk % 199 = 5
  UNION ALL
  SELECT pk, parent_asin, title, main_category, price, average_rating, rating_number, store,
         own_file FROM meta_rows WHERE pk % 211 = 7
  UNION ALL
  SELECT pk, NULL, title, main_category, price, average_rating, rating_number, store,
         'meta_b' FROM meta_rows WHERE pk % 197 = 3
),
meta_checked AS (
  SELECT
    CASE WHEN pk % 251 = 0 THEN NULL ELSE parent_asin END AS parent_asin,
    CASE WHEN pk % 251 = 0 THEN NULL ELSE title END AS title,
    CASE WHEN pk % 251 = 0 THEN NULL ELSE main_category END AS main_category,
    CASE WHEN pk % 251 = 0 THEN NULL ELSE price END AS price,
    CASE WHEN pk % 251 = 0 THEN NULL ELSE average_rating END AS average_rating,
    CASE WHEN pk % 251 = 0 THEN NULL ELSE rating_number END AS rating_number,
    CASE WHEN pk % 251 = 0 THEN NULL ELSE store END AS store,
    pk % 251 = 0 AS is_corrupt,
    source_file
  FROM metadata_raw
),
meta_valid AS (
  SELECT * FROM meta_checked WHERE NOT is_corrupt AND parent_asin IS NOT NULL
)"""

# Parsed view of the faulty review lines: truncated line -> all NULL + corrupt;
# key / rating left out -> NULL; rating as a string -> NULL rating + corrupt.
_REVIEW_CHECKED = """
rev_checked AS (
  SELECT
    CASE WHEN ok % 499 = 0 OR ok % 401 = 0 THEN NULL ELSE parent_asin END AS parent_asin,
    CASE WHEN ok % 499 = 0 THEN NULL ELSE asin END AS asin,
    CASE WHEN ok % 499 = 0 THEN NULL ELSE user_id END AS user_id,
    CASE WHEN ok % 499 = 0 OR ok % 307 = 0 OR ok % 503 = 0 THEN NULL ELSE rating END AS rating,
    CASE WHEN ok % 499 = 0 THEN NULL ELSE title END AS title,
    CASE WHEN ok % 499 = 0 THEN NULL ELSE text END AS text,
    CASE WHEN ok % 499 = 0 THEN NULL ELSE "timestamp" END AS "timestamp",
    CASE WHEN ok % 499 = 0 THEN NULL ELSE helpful_vote END AS helpful_vote,
    CASE WHEN ok % 499 = 0 THEN NULL ELSE verified_purchase END AS verified_purchase,
    (ok % 499 = 0) OR (ok % 503 = 0 AND ok % 307 <> 0) AS is_corrupt,
    source_file
  FROM rr_src
)"""


_ALL = "WITH " + ",".join([_REVIEW_BASE, _CLEAN, _META, _JOINED, _META_RAW, _REVIEW_CHECKED])

ID = "parent_asin, user_id, asin, \"timestamp\""

_METRICS_V = """count(*) AS review_count,
  round(avg(rating), 3) AS avg_rating,
  round(avg(review_text_length), 2) AS avg_text_length,
  round(avg(helpful_vote), 3) AS avg_helpful_vote,
  round(avg(received_helpful_vote) * 100, 2) AS percent_with_helpful_vote"""

_PRODUCT_STATS = f"""
  SELECT parent_asin, product_popularity_bin, count(*) AS review_count,
    avg(rating) AS avg_rating, stddev_samp(rating) AS rating_stddev,
    avg(CASE WHEN rating IN (1.0, 5.0) THEN 1 ELSE 0 END) AS extreme_rating_share
  FROM joined GROUP BY parent_asin, product_popularity_bin"""

_LENGTH_PROFILE = """
  SELECT text_length_bin, count(*) AS review_count, round(avg(rating), 3) AS avg_rating,
    round(avg(received_helpful_vote) * 100, 2) AS percent_with_helpful_vote,
    round(avg(helpful_votes_per_year), 3) AS avg_helpful_votes_per_year
  FROM joined WHERE review_year BETWEEN 2018 AND 2022 GROUP BY text_length_bin"""

_POPULARITY_PROFILE = """
  SELECT product_popularity_bin, count(*) AS review_count,
    round(avg(rating), 3) AS avg_review_rating,
    round(avg(review_text_length), 2) AS avg_text_length,
    round(avg(received_helpful_vote) * 100, 2) AS percent_with_helpful_vote,
    round(avg(helpful_votes_per_year), 3) AS avg_helpful_votes_per_year
  FROM joined GROUP BY product_popularity_bin"""

_POLARIZATION = f"""
  SELECT product_popularity_bin, count(*) AS product_count,
    round(avg(rating_stddev), 3) AS avg_rating_stddev,
    round(avg(extreme_rating_share) * 100, 2) AS avg_extreme_rating_percent
  FROM ({_PRODUCT_STATS}) GROUP BY product_popularity_bin"""


def _rank(col: str, labels: list[str]) -> str:
    parts = " ".join(f"WHEN {col} = '{lab}' THEN {i}" for i, lab in enumerate(labels[:-1], 1))
    return f"CAST(CASE {parts} ELSE {len(labels)} END AS INTEGER)"


_LEN_LABELS = ["Under 50", "50-149", "150-299", "300-599", "600+"]
_POP_LABELS = ["Under 10 ratings", "10-49 ratings", "50-199 ratings", "200-999 ratings",
               "1000+ ratings"]


def _q(body: str) -> str:
    return f"{_ALL}\n{body}"


def _counts(*pairs: tuple[str, str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS dataset, CAST(count(*) AS BIGINT) AS row_count FROM {src}"
        for name, src in pairs)


def _share(keys: list[str], part: str, total: str, pct: str) -> str:
    k = ", ".join(keys)
    return f"""
  SELECT {k}, "count", {total},
    round(CAST("count" AS DOUBLE) / NULLIF({total}, 0) * 100, 2) AS {pct}
  FROM (SELECT {k}, count(*) AS "count", CAST(sum(count(*)) OVER (PARTITION BY {part}) AS BIGINT) AS {total}
        FROM reviews_clean GROUP BY {k})"""


def _exact_quantiles(probs: list[float]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT CAST({p!r} AS DOUBLE) AS quantile, "
        f"CAST(quantile_disc(helpful_vote, {p!r}) AS DOUBLE) AS helpful_vote FROM reviews_clean"
        for p in probs)


SQL: dict[str, str] = {
    # four analyses
    "verified_profile": _q(f"SELECT verified_purchase, {_METRICS_V} FROM joined GROUP BY verified_purchase"),
    "length_profile": _q(_LENGTH_PROFILE),
    "popularity_profile": _q(_POPULARITY_PROFILE),
    "product_rating_stats": _q(_PRODUCT_STATS),
    "product_rating_stats_eager": _q(_PRODUCT_STATS),
    "polarization_profile_eager": _q(_POLARIZATION),
    "analytics_job": _q(_POLARIZATION),
    "polarization_profile": _q(_POLARIZATION),
    "length_profile_ordered": _q(
        f"SELECT *, {_rank('text_length_bin', _LEN_LABELS)} AS bin_order FROM ({_LENGTH_PROFILE}) ORDER BY bin_order"),
    "popularity_profile_ordered": _q(
        f"SELECT *, {_rank('product_popularity_bin', _POP_LABELS)} AS bin_order FROM ({_POPULARITY_PROFILE}) ORDER BY bin_order"),
    "polarization_profile_ordered": _q(
        f"SELECT *, {_rank('product_popularity_bin', _POP_LABELS)} AS bin_order FROM ({_POLARIZATION}) ORDER BY bin_order"),
    "verified_profile_prejoin": _q(
        f"SELECT verified_purchase, {_METRICS_V} FROM reviews_clean GROUP BY verified_purchase"),
    "year_verified_profile": _q("""
  SELECT review_year, verified_purchase, count(*) AS review_count,
    round(avg(rating), 3) AS avg_rating, round(avg(review_text_length), 2) AS avg_text_length,
    round(avg(received_helpful_vote) * 100, 2) AS percent_with_helpful_vote
  FROM reviews_clean GROUP BY review_year, verified_purchase"""),
    "recent_verified_profile": _q("""
  SELECT verified_purchase, count(*) AS review_count,
    round(avg(rating), 3) AS avg_rating, round(avg(review_text_length), 2) AS avg_text_length,
    round(avg(received_helpful_vote) * 100, 2) AS percent_with_helpful_vote,
    round(avg(helpful_votes_per_year), 3) AS avg_helpful_votes_per_year
  FROM reviews_clean WHERE review_year BETWEEN 2018 AND 2022 GROUP BY verified_purchase"""),
    # composite tables
    "clean_reviews": _q("SELECT * FROM reviews_clean"),
    "clean_metadata": _q("SELECT * FROM metadata_clean"),
    "metadata_for_join": _q("SELECT * FROM metadata_for_join"),
    "joined_reviews": _q("SELECT * FROM joined"),
    "join_reviews_metadata": _q(f"""
  SELECT {ID}, rating, product_title, main_category, price, price_missing, average_rating,
    rating_number, store, store_missing FROM joined"""),
    # projections & filters
    "prune_reviews": _q("SELECT * FROM reviews_raw"),
    "prune_metadata": _q("SELECT * FROM metadata"),
    "dedup_reviews": _q("SELECT * FROM dedup"),
    "filter_recent_years": _q(f"""
  SELECT {ID}, rating, review_year, product_popularity_bin FROM joined
  WHERE review_year BETWEEN 2018 AND 2022"""),
    "filter_min_age": _q(f"SELECT {ID}, review_date, review_age_days FROM reviews_clean WHERE review_age_days >= 365"),
    "nonpositive_price": _q("SELECT parent_asin, title, price FROM metadata WHERE price IS NOT NULL AND price <= 0"),
    "verified_encoding_pairs": _q("SELECT DISTINCT verified_purchase, verified_purchase_encoded FROM reviews_clean"),
    # features
    "feat_calendar": _q(f"SELECT {ID}, review_timestamp, review_date, review_year, review_month FROM reviews_clean"),
    "feat_text_length": _q(f"SELECT {ID}, text, review_text_length FROM reviews_clean"),
    "feat_votes": _q(f"""
  SELECT {ID}, helpful_vote, received_helpful_vote, log_helpful_vote, helpful_vote_capped
  FROM reviews_clean"""),
    "feat_verified": _q(f"SELECT {ID}, verified_purchase, verified_purchase_encoded FROM reviews_clean"),
    "feat_length_bin": _q(f"SELECT {ID}, review_text_length, text_length_bin FROM reviews_clean"),
    "feat_length_z": _q(f"SELECT {ID}, review_text_length, review_text_length_z FROM reviews_clean"),
    "feat_age": _q(f"""
  SELECT {ID}, review_date, review_age_days, helpful_vote, helpful_votes_per_year
  FROM reviews_clean"""),
    "feat_popularity_bin": _q(f"SELECT {ID}, rating_number, product_popularity_bin FROM joined"),
    # exploration
    "row_counts": _q(_counts(("raw_reviews", "reviews_raw"), ("raw_metadata", "metadata"),
                             ("clean_reviews", "reviews_clean"), ("clean_metadata", "metadata_clean"),
                             ("joined_reviews", "joined"))),
    "length_stats": _q(f"""
  SELECT avg(review_text_length) AS mean_length, stddev_samp(review_text_length) AS std_length
  FROM reviews_clean"""),
    "rating_distribution": _q('SELECT rating, count(*) AS "count" FROM reviews_raw GROUP BY rating ORDER BY rating'),
    "verified_counts": _q('SELECT verified_purchase, count(*) AS "count" FROM reviews_clean GROUP BY verified_purchase'),
    "verified_rating_counts": _q("""
  SELECT verified_purchase, rating, count(*) AS "count" FROM reviews_clean
  GROUP BY verified_purchase, rating ORDER BY verified_purchase NULLS FIRST, rating"""),
    "reviews_by_year": _q("""
  SELECT review_year, count(*) AS "count" FROM reviews_clean GROUP BY review_year
  ORDER BY review_year NULLS FIRST"""),
    "year_verified_counts": _q("""
  SELECT review_year, verified_purchase, count(*) AS "count" FROM reviews_clean
  GROUP BY review_year, verified_purchase
  ORDER BY review_year NULLS FIRST, verified_purchase NULLS FIRST"""),
    "rating_share_by_verified": _q(_share(["verified_purchase", "rating"], "verified_purchase",
                                          "group_total", "rating_percent")),
    "verified_share_by_year": _q(_share(["review_year", "verified_purchase"], "review_year",
                                        "year_total", "percent_of_year")),
    "price_missingness": _q("""
  SELECT total_products, missing_price, available_price,
    round(CAST(missing_price AS DOUBLE) / NULLIF(total_products, 0) * 100, 2) AS missing_price_percent
  FROM (SELECT count(*) AS total_products,
          CAST(sum(CASE WHEN price IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_price,
          CAST(sum(CASE WHEN price IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS available_price
        FROM metadata)"""),
    "price_summary": _q("""
  SELECT count(price) AS "count", avg(price) AS "mean", stddev_samp(price) AS "stddev",
    min(price) AS "min", max(price) AS "max" FROM metadata"""),
    "review_missingness": _q("""
  SELECT count(*) AS total_reviews,
    CAST(sum(CASE WHEN parent_asin IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_parent_asin,
    CAST(sum(CASE WHEN rating IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_rating,
    CAST(sum(CASE WHEN text IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_text,
    CAST(sum(CASE WHEN "timestamp" IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_timestamp,
    CAST(sum(CASE WHEN helpful_vote IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_helpful_vote,
    CAST(sum(CASE WHEN verified_purchase IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_verified_purchase
  FROM reviews_raw"""),
    "metadata_missingness": _q("""
  SELECT
    CAST(sum(CASE WHEN title IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS title,
    CAST(sum(CASE WHEN main_category IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS main_category,
    CAST(sum(CASE WHEN price IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS price,
    CAST(sum(CASE WHEN average_rating IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS average_rating,
    CAST(sum(CASE WHEN rating_number IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS rating_number,
    CAST(sum(CASE WHEN store IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS store
  FROM metadata"""),
    "duplicate_totals": _q("""
  SELECT t.n AS total_reviews, u.n AS unique_reviews, t.n - u.n AS duplicate_rows
  FROM (SELECT count(*) AS n FROM reviews_raw) t, (SELECT count(*) AS n FROM dedup) u"""),
    "duplicate_review_keys": _q("""
  SELECT user_id, asin, "timestamp", count(*) AS "count" FROM reviews_raw
  GROUP BY user_id, asin, "timestamp" HAVING count(*) > 1"""),
    "top_duplicate_keys": _q("""
  SELECT user_id, asin, "timestamp", count(*) AS "count" FROM reviews_raw
  GROUP BY user_id, asin, "timestamp" HAVING count(*) > 1
  ORDER BY "count" DESC, user_id NULLS LAST, asin NULLS LAST, "timestamp" NULLS LAST LIMIT 20"""),
    "duplicate_drilldown": _q("""
  SELECT r.user_id, r.asin, r."timestamp", r.rating, r.title, r.text, r.helpful_vote,
    r.verified_purchase
  FROM reviews_raw r JOIN (
    SELECT user_id, asin, "timestamp" FROM reviews_raw GROUP BY user_id, asin, "timestamp"
    HAVING count(*) > 1
    ORDER BY count(*) DESC, user_id NULLS LAST, asin NULLS LAST, "timestamp" NULLS LAST LIMIT 1
  ) k ON r.user_id = k.user_id AND r.asin = k.asin AND r."timestamp" = k."timestamp\""""),
    "review_date_range": _q("SELECT min(review_date) AS earliest_review, max(review_date) AS latest_review FROM reviews_clean"),
    "vote_range": _q("""
  SELECT min(helpful_vote) AS min_helpful_vote, max(helpful_vote) AS max_helpful_vote,
    avg(helpful_vote) AS avg_helpful_vote FROM reviews_clean"""),
    "vote_quantiles_approx": _q(f"SELECT *, TRUE AS within_error FROM ({_exact_quantiles([0.5, 0.75, 0.9, 0.95, 0.99])})"),
    "vote_quantiles_fine_approx": _q(f"SELECT *, TRUE AS within_error FROM ({_exact_quantiles([0.95, 0.99, 0.995, 0.999])})"),
    "vote_quantiles": _q(_exact_quantiles([0.95, 0.99, 0.995, 0.999])),
    "vote_quantiles_coarse": _q(_exact_quantiles([0.5, 0.75, 0.9, 0.95, 0.99])),
    "vote_zero_share": _q("""
  SELECT total_reviews, zero_helpful_votes, positive_helpful_votes,
    round(CAST(positive_helpful_votes AS DOUBLE) / NULLIF(total_reviews, 0) * 100, 2) AS positive_helpful_percent
  FROM (SELECT count(*) AS total_reviews,
          CAST(sum(CASE WHEN helpful_vote = 0 THEN 1 ELSE 0 END) AS BIGINT) AS zero_helpful_votes,
          CAST(sum(CASE WHEN helpful_vote > 0 THEN 1 ELSE 0 END) AS BIGINT) AS positive_helpful_votes
        FROM reviews_clean)"""),
    "vote_cap_effect": _q("""
  SELECT max(helpful_vote) AS original_max, max(helpful_vote_capped) AS capped_max,
    round(avg(helpful_vote), 3) AS original_mean, round(avg(helpful_vote_capped), 3) AS capped_mean
  FROM reviews_clean"""),
    "z_sanity": _q("""
  SELECT round(avg(review_text_length_z), 3) + 0.0 AS z_score_mean,
    round(stddev_samp(review_text_length_z), 3) + 0.0 AS z_score_stddev FROM reviews_clean"""),
    "join_retention": _q("""
  SELECT c.n AS clean_reviews, j.n AS joined_reviews,
    round(CAST(j.n AS DOUBLE) / NULLIF(c.n, 0) * 100, 2) AS retention_percent
  FROM (SELECT count(*) AS n FROM reviews_clean) c, (SELECT count(*) AS n FROM joined) j"""),
    "preview_joined": _q("""
  SELECT parent_asin, product_title, store, rating, verified_purchase, review_text_length,
    helpful_vote, rating_number FROM joined
  ORDER BY parent_asin NULLS LAST, user_id NULLS LAST, asin NULLS LAST, "timestamp" NULLS LAST,
    rating NULLS LAST, title NULLS LAST, text NULLS LAST, helpful_vote NULLS LAST,
    verified_purchase NULLS LAST
  LIMIT 10"""),
    # quality (JSON lines)
    "review_quality_by_file": _q("""
  SELECT source_file, count(*) AS row_count,
    CAST(sum(CAST(is_corrupt AS BIGINT)) AS BIGINT) AS corrupt_rows,
    CAST(sum(CASE WHEN parent_asin IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_parent_asin,
    CAST(sum(CASE WHEN rating IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_rating,
    CAST(sum(CASE WHEN text IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_text,
    CAST(sum(CASE WHEN "timestamp" IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_timestamp,
    CAST(sum(CASE WHEN helpful_vote IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_helpful_vote,
    CAST(sum(CASE WHEN verified_purchase IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_verified_purchase
  FROM rev_checked GROUP BY source_file ORDER BY source_file"""),
    "metadata_quality_by_file": _q("""
  SELECT source_file, count(*) AS row_count,
    CAST(sum(CAST(is_corrupt AS BIGINT)) AS BIGINT) AS corrupt_rows,
    CAST(sum(CASE WHEN parent_asin IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_parent_asin,
    count(DISTINCT parent_asin) AS distinct_parent_asin
  FROM meta_checked GROUP BY source_file ORDER BY source_file"""),
    "filter_valid_metadata": _q("""
  SELECT parent_asin, title, main_category, price, average_rating, rating_number, store,
    source_file FROM meta_valid"""),
    "metadata_distinct_keys": _q("SELECT DISTINCT parent_asin FROM meta_valid"),
    "metadata_key_multiplicity": _q("""
  SELECT parent_asin, count(*) AS metadata_rows, count(DISTINCT source_file) AS source_file_count
  FROM meta_valid GROUP BY parent_asin"""),
    "metadata_duplicate_summary": _q("""
  SELECT
    CAST(coalesce(sum(CASE WHEN metadata_rows > 1 THEN 1 ELSE 0 END), 0) AS BIGINT) AS duplicate_parent_asin_keys,
    CAST(coalesce(sum(CASE WHEN metadata_rows > 1 THEN metadata_rows - 1 ELSE 0 END), 0) AS BIGINT) AS extra_metadata_rows,
    CAST(coalesce(sum(CASE WHEN metadata_rows > 1 AND source_file_count > 1 THEN 1 ELSE 0 END), 0) AS BIGINT) AS keys_shared_across_categories,
    CAST(coalesce(max(metadata_rows), 0) AS BIGINT) AS maximum_rows_for_one_key
  FROM (SELECT parent_asin, count(*) AS metadata_rows, count(DISTINCT source_file) AS source_file_count
        FROM meta_valid GROUP BY parent_asin)"""),
    "sample_join_coverage": _q(f"""
  SELECT source_file, sampled_reviews, matched_reviews,
    round(CAST(matched_reviews AS DOUBLE) / NULLIF(sampled_reviews, 0) * 100, 3) AS join_coverage_percent
  FROM (
    SELECT s.source_file, count(*) AS sampled_reviews,
      CAST(sum(CASE WHEN k.parent_asin IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS matched_reviews
    FROM (SELECT parent_asin, source_file
          FROM (SELECT *, row_number() OVER (PARTITION BY user_id, asin, "timestamp", parent_asin, source_file) - 1 AS copy
                FROM rev_checked WHERE NOT is_corrupt AND parent_asin IS NOT NULL)
          WHERE CAST('0x' || substr(md5('0|' || coalesce(user_id, '~') || '|' || coalesce(asin, '~') || '|'
                                        || coalesce(CAST("timestamp" AS VARCHAR), '~') || '|' || parent_asin || '|' || source_file
                                        || '|' || CAST(copy AS VARCHAR)), 1, 15) AS BIGINT) < {int(0.05 * 2 ** 60)}) s
    LEFT JOIN (SELECT DISTINCT parent_asin FROM meta_valid) k ON s.parent_asin = k.parent_asin
    GROUP BY s.source_file)
  ORDER BY source_file"""),
    "scan_json_permissive": _q("""
  SELECT parent_asin, asin, user_id, rating, title, text, "timestamp", helpful_vote,
    verified_purchase, is_corrupt, source_file FROM rev_checked"""),
    "scan_json_inferred": _q("SELECT * FROM reviews_raw"),
    "scan_json_multifile": _q("""
  SELECT source_file, count(*) AS row_count, count(DISTINCT parent_asin) AS distinct_parent_asin,
    CAST(sum(helpful_vote) AS BIGINT) AS total_helpful_vote
  FROM rr_src GROUP BY source_file"""),
    "high_rating_by_verified_json": _q("""
  SELECT verified_purchase, count(*) AS "count" FROM reviews_raw WHERE rating >= 4
  GROUP BY verified_purchase"""),
    # sinks & Parquet scans
    "scan_parquet_narrow": _q(_counts(("source", "reviews_raw"), ("parquet", "reviews_raw"))),
    "high_rating_by_verified": _q("""
  SELECT verified_purchase, count(*) AS "count" FROM reviews_raw WHERE rating >= 4
  GROUP BY verified_purchase"""),
    "sink_parquet_roundtrip": _q(_counts(("reviews_clean", "reviews_clean"),
                                         ("metadata_for_join", "metadata_for_join"),
                                         ("joined_reviews", "joined"))),
    "sink_csv_roundtrip": _q(_POLARIZATION),
}


def _long(report: str, name: str, measures: list[str], by_file: bool) -> str:
    source = "source_file" if by_file else "CAST(NULL AS VARCHAR)"
    return "\nUNION ALL\n".join(
        f"SELECT '{report}' AS report, {source} AS source_file, '{m}' AS measure, CAST({m} AS DOUBLE) AS value FROM ({SQL[name]}) AS t"
        for m in measures)


SQL["input_validation"] = "\nUNION ALL\n".join(_long(*x) for x in [
    ("review_validation", "review_quality_by_file", ["row_count", "corrupt_rows", *[f"null_{c}" for c in (
        "parent_asin", "rating", "text", "timestamp", "helpful_vote", "verified_purchase")]], True),
    ("metadata_validation", "metadata_quality_by_file", ["row_count", "corrupt_rows", "null_parent_asin", "distinct_parent_asin"], True),
    ("duplicate_metadata_keys", "metadata_duplicate_summary", ["duplicate_parent_asin_keys", "extra_metadata_rows",
                                                               "keys_shared_across_categories", "maximum_rows_for_one_key"], False),
    ("sample_join_coverage", "sample_join_coverage", ["sampled_reviews", "matched_reviews", "join_coverage_percent"], True),
])
