"""Review and catalog tables derived from the driver's TPC-H-style tables.

No review data ships with the test tables, so the review/catalog model is
mapped onto them with fixed integer rules (``FIXTURES.md`` section 3). The
same rules are written once more as DuckDB SQL in ``revlens.plans.oracle_sql``; the two
must stay in step.

Plan notes for scale:

* ``lineitem`` x ``orders`` x ``documents`` are plain equi-joins. An order's lines all take the
  document that its key names, so lines and orders are dealt by document, and the three meet
  after one shuffle each. Lines are reduced to the values that reviews have before that.
  Every order line takes the whole text of one document.
* The exact duplicates are produced with one ``explode`` over the joined rows
  instead of a second ``UNION ALL`` branch, so the join runs once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens import schemas, session

# --- Fixed values of the fixture mapping (FIXTURES.md section 3) -------------
# doc_id = l_orderkey % (number of documents); text = the whole document
SINGLE_REVIEW_MOD = 61       # lines with l_partkey % 61 = 0 AND l_quantity < 49 ...
SINGLE_REVIEW_QTY = 49       # ... review the next product (l_partkey + 1)
NULL_TEXT_MOD = 97
TIME_SHIFT_MS = 662_688_000_000
LATE_MOD = 211
LATE_SHIFT_MS = 86_400_000_000
NULL_VOTE_MOD = 89
VOTE_DISCOUNT = 0.08
VOTE_MOD = 37
NULL_VERIFIED_MOD = 83
DUPLICATE_VOTE = 7           # rows with this vote appear twice in the raw table
META_OTHER_MOD = 53          # p_partkey % 53 = 0 is catalogued as 'X...', which no review names
PRICE_MOD = 6
ZERO_PRICE_MOD, NEGATIVE_PRICE_MOD = 66, 78   # price 0, and the price below zero
NULL_RATING_NUMBER_MOD = 101
RATING_NUMBER_SCALE = [1, 10, 100, 1000]  # indexed by p_partkey % 4
STORE_NULL_MOD = 20
META_SHARED_MOD, META_SHARED_REM = 199, 5     # extra copy in 'meta_c'
META_REPEAT_MOD, META_REPEAT_REM = 211, 7     # extra copy under own file rule
META_NULLKEY_MOD, META_NULLKEY_REM = 197, 3   # extra row, NULL key, 'meta_b'
# Raw JSON-lines variant
TRUNCATED_LINE_MOD = 499     # whole line replaced by '{"parent_asin":'
STRING_RATING_MOD = 503      # rating written as a JSON string
NULL_KEY_MOD = 401           # key left out
NULL_RATING_MOD = 307        # rating left out
META_TRUNCATED_MOD = 251     # catalog line replaced by '{"parent_asin":'
TRUNCATED_LINE = '{"parent_asin":'
SAMPLE_FRACTION = 0.05
# -------------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _p(prefix: str, c: Column) -> Column:
    return F.concat(F.lit(prefix), c.cast("string"))


def _review_rows(spark: SparkSession, sf_dir: str, narrow: bool = False) -> DataFrame:
    """lineitem x orders x documents with the raw integer inputs kept. With ``narrow`` a document
    joins as the length and digest of its text, taken once before the join multiplies it."""
    spark.conf.set(session.CO_LOCATION, "false")      # lines and orders meet where their document is
    docs = table(spark, sf_dir, "documents")
    text = [F.length("text").alias("doc_length"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("doc_digest")] if narrow \
        else [F.col("text").alias("doc_text")]
    docs = docs.select("doc_id", *text)
    moved = (F.col("l_partkey") % SINGLE_REVIEW_MOD == 0) & (F.col("l_quantity") < SINGLE_REVIEW_QTY)
    named = lambda key: F.try_mod(F.col(key), docs.agg(F.count(F.lit(1))).scalar()).alias("doc_id")
    li = (
        table(spark, sf_dir, "lineitem")
        .select("l_orderkey", named("l_orderkey"),
                F.when(moved, F.col("l_partkey") + 1).otherwise(F.col("l_partkey")).alias("l_partkey"),
                (F.col("l_suppkey") % 3).alias("variant"),
                (F.lit(1) + F.col("l_quantity").cast("long") % 5).cast("double").alias("rating"),
                (F.col("l_discount") >= VOTE_DISCOUNT).alias("voted"),
                (F.col("l_returnflag") != "R").alias("verified"),
                F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("shipped"))
        .repartition("doc_id")
    )
    orders = (table(spark, sf_dir, "orders")
              .select(F.col("o_orderkey").alias("l_orderkey"), named("o_orderkey"), "o_custkey", "o_orderpriority")
              .repartition("doc_id"))
    return li.join(orders, ["doc_id", "l_orderkey"], "inner").join(docs, "doc_id", "inner")


def _review_columns(narrow: bool = False) -> list[Column]:
    ok = F.col("l_orderkey")
    told = lambda c, kind: F.when(ok % NULL_TEXT_MOD == 0, F.lit(None).cast(kind)).otherwise(F.col(c))
    text = [told("doc_length", "int").alias("review_text_length"), told("doc_digest", "binary").alias("text_digest")] if narrow \
        else [told("doc_text", "string").alias("text")]
    votes = (F.when(ok % NULL_VOTE_MOD == 0, F.lit(None).cast("long"))
             .when(F.col("voted"), ok % VOTE_MOD)
             .otherwise(F.lit(0).cast("long")))
    ts = (F.col("shipped") + F.lit(TIME_SHIFT_MS)
          + F.when(ok % LATE_MOD == 0, F.lit(LATE_SHIFT_MS)).otherwise(F.lit(0)))
    return [
        _p("P", F.col("l_partkey")).alias("parent_asin"),
        F.concat(F.lit("A"), F.col("l_partkey").cast("string"), F.lit("-"),
                 F.col("variant").cast("string")).alias("asin"),
        _p("U", F.col("o_custkey")).alias("user_id"),
        F.col("rating"),
        F.col("o_orderpriority").alias("title"),
        *text,
        ts.cast("long").alias("timestamp"),
        votes.cast("long").alias("helpful_vote"),
        F.when(ok % NULL_VERIFIED_MOD == 0, F.lit(None).cast("boolean"))
         .otherwise(F.col("verified")).alias("verified_purchase"),
    ]


def reviews_raw(spark: SparkSession, sf_dir: str, with_source: bool = False,
                with_order_key: bool = False, narrow: bool = False) -> DataFrame:
    """Raw reviews: the mapped rows plus an exact copy of each row with 7 votes.

    ``with_source`` adds the per-file lineage of the quality jobs
    (``reviews_a`` for even order keys, ``reviews_b`` for odd ones). ``narrow`` gives
    ``review_text_length`` and ``text_digest`` in place of the text.
    """
    rows = _review_rows(spark, sf_dir, narrow)
    cols = _review_columns(narrow)
    extra = []
    if with_source:
        extra.append(F.when(F.col("l_orderkey") % 2 == 0, "reviews_a")
                     .otherwise("reviews_b").alias(schemas.SOURCE_COLUMN))
    if with_order_key:
        extra.append(F.col("l_orderkey"))
    mapped = rows.select(*cols, *extra)
    copies = F.when(F.col("helpful_vote") == DUPLICATE_VOTE, 2).otherwise(1)
    return (
        mapped.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
        .drop("_copy")
    )


def _metadata_columns(key_null: Column | None = None) -> list[Column]:
    pk = F.col("p_partkey")
    key = F.when(pk % META_OTHER_MOD == 0, _p("X", pk)).otherwise(_p("P", pk))
    if key_null is not None:
        key = F.when(key_null, F.lit(None).cast("string")).otherwise(key)
    scale = F.element_at(F.array(*[F.lit(x) for x in RATING_NUMBER_SCALE]),
                         (pk % len(RATING_NUMBER_SCALE) + 1).cast("int"))
    return [
        key.alias("parent_asin"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("main_category"),
        F.when(pk % ZERO_PRICE_MOD == 0, F.lit(0.0)).when(pk % NEGATIVE_PRICE_MOD == 0, -F.col("p_retailprice"))
         .when(pk % PRICE_MOD == 0, F.col("p_retailprice")).alias("price"),
        ((F.lit(10) + F.col("p_size") % 41) / 10.0).cast("double").alias("average_rating"),
        F.when(pk % NULL_RATING_NUMBER_MOD == 0, F.lit(None).cast("long"))
         .otherwise((scale * (F.lit(1) + F.col("p_size") % 9)).cast("long"))
         .alias("rating_number"),
        F.when(pk % STORE_NULL_MOD == 0, F.lit(None).cast("string"))
         .otherwise(F.col("p_brand")).alias("store"),
    ]


def _own_file(pk: Column) -> Column:
    return F.when(pk % 3 == 0, "meta_a").otherwise("meta_b")


def metadata(spark: SparkSession, sf_dir: str, with_source: bool = False) -> DataFrame:
    """Product catalog: every part once (unique keys)."""
    part = table(spark, sf_dir, "part")
    extra = [_own_file(F.col("p_partkey")).alias(schemas.SOURCE_COLUMN)] if with_source else []
    return part.select(*_metadata_columns(), *extra)


def metadata_raw(spark: SparkSession, sf_dir: str, with_part_key: bool = False) -> DataFrame:
    """Catalog as delivered in files: duplicates within and across files and
    rows without a key. Always carries ``source_file``.

    One scan of ``part``: each part row yields 1..4 output rows through an
    ``explode`` of the variants that apply to it.
    """
    pk = F.col("p_partkey")
    variants = F.array_compact(F.array(
        F.lit(0),                                                      # the catalog row
        F.when(pk % META_SHARED_MOD == META_SHARED_REM, F.lit(1)),     # copy in meta_c
        F.when(pk % META_REPEAT_MOD == META_REPEAT_REM, F.lit(2)),     # copy, own file
        F.when(pk % META_NULLKEY_MOD == META_NULLKEY_REM, F.lit(3)),   # NULL key, meta_b
    ))
    part = table(spark, sf_dir, "part").withColumn("_variant", F.explode(variants))
    v = F.col("_variant")
    source = (F.when(v == 1, "meta_c").when(v == 3, "meta_b").otherwise(_own_file(pk)))
    extra = [pk] if with_part_key else []
    return part.select(*_metadata_columns(key_null=(v == 3)),
                       source.alias(schemas.SOURCE_COLUMN), *extra)
