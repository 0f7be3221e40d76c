"""End-to-end runs of the composite jobs on tiny JSON-lines inputs."""

import csv
import glob
import json
import os

import pytest

from revlens.plans import jobs
from revlens.sources import sinks

SMOKE_REVIEWS = [
    {"parent_asin": "K7", "asin": "K7-red", "user_id": "nora", "rating": 5.0, "title": "Kettle",
     "text": "Boils fast, pours neatly.", "timestamp": 1546300800123, "helpful_vote": 3,
     "verified_purchase": True},
    {"parent_asin": "K7", "asin": "K7-blue", "user_id": "omar", "rating": 1.0, "title": "Lid",
     "text": "The lid came loose within a week.", "timestamp": 1625097600456,
     "helpful_vote": 0, "verified_purchase": False},
]
SMOKE_PRODUCT = {"parent_asin": "K7", "title": "Kettle, 1.7 l", "main_category": "Kitchen",
                 "price": 24.5, "average_rating": 3.0, "rating_number": 2,
                 "store": "Hearth"}


def _write_jsonl(path, records):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        for r in records:
            fh.write((r if isinstance(r, str) else json.dumps(r)) + "\n")
    return path


def _read_csv(folder):
    (part,) = glob.glob(os.path.join(folder, "part-*.csv"))
    with open(part) as fh:
        return list(csv.DictReader(fh))


def test_smoke_pipeline(spark, tmp_dir):
    reviews = _write_jsonl(f"{tmp_dir}/raw/reviews.jsonl",
                           [SMOKE_REVIEWS[0], SMOKE_REVIEWS[1], SMOKE_REVIEWS[1]])
    meta = _write_jsonl(f"{tmp_dir}/raw/meta.jsonl", [SMOKE_PRODUCT])
    run = jobs.run_review_analytics(spark, reviews, meta, f"{tmp_dir}/processed",
                                    f"{tmp_dir}/results")
    assert run.counts == {"raw_reviews": 3, "raw_metadata": 1, "reviews_clean": 2, "metadata_for_join": 1,
                          "joined_reviews": 2}
    for path in run.paths.values():
        assert os.path.exists(os.path.join(path, "_SUCCESS")), path
    verified = {r["verified_purchase"]: r for r in _read_csv(run.paths["verified_analysis"])}
    assert verified["true"]["review_count"] == "1" and verified["false"]["review_count"] == "1"
    assert [r["text_length_bin"] for r in _read_csv(run.paths["length_analysis"])] == ["Under 50"]
    pol = _read_csv(run.paths["polarization_analysis"])
    assert pol == [{"product_popularity_bin": "Under 10 ratings", "product_count": "1",
                    "avg_rating_stddev": "2.828", "avg_extreme_rating_percent": "100.0"}]
    pop = _read_csv(run.paths["popularity_analysis"])
    assert pop[0]["review_count"] == "2" and pop[0]["avg_review_rating"] == "3.0"


def test_job_refuses_to_overwrite_its_input(spark, tmp_dir):
    _write_jsonl(f"{tmp_dir}/raw/rev/reviews.jsonl", SMOKE_REVIEWS)
    meta = _write_jsonl(f"{tmp_dir}/raw/meta.jsonl", [SMOKE_PRODUCT])
    reviews = f"{tmp_dir}/raw/rev"
    with pytest.raises(ValueError):   # outputs would land inside the input folder
        jobs.run_review_analytics(spark, reviews, meta, reviews, f"{tmp_dir}/results")
    with pytest.raises(ValueError):
        sinks.refuse_overlap(spark, [f"{tmp_dir}"], [reviews])


@pytest.mark.parametrize("spell", ["file://{0}/raw/rev", "file:{0}/raw/rev/", "{0}/raw/../raw/rev", "{0}/raw/r*",
                                   "{0}/raw/rev/reviews.jsonl", "{0}/raw"])
def test_overlaps_are_seen_however_paths_are_spelt(spark, tmp_dir, spell):
    _write_jsonl(f"{tmp_dir}/raw/rev/reviews.jsonl", SMOKE_REVIEWS)
    with pytest.raises(ValueError):
        sinks.refuse_overlap(spark, [f"{tmp_dir}/raw/rev"], [spell.format(tmp_dir)])
    sinks.refuse_overlap(spark, [f"{tmp_dir}/raw/rev2", f"{tmp_dir}/out"], [f"{tmp_dir}/raw/rev"])


def test_relative_paths_and_nested_bases_are_refused_before_any_write(spark, tmp_dir, monkeypatch):
    reviews = _write_jsonl(f"{tmp_dir}/raw/reviews.jsonl", SMOKE_REVIEWS)
    meta = _write_jsonl(f"{tmp_dir}/meta/meta.jsonl", [SMOKE_PRODUCT])
    here = os.path.relpath(f"{tmp_dir}/raw", spark._jvm.java.lang.System.getProperty("user.dir"))
    for processed, results in ((here, f"{tmp_dir}/r"), (f"{tmp_dir}/p", f"{tmp_dir}/meta"), (f"{tmp_dir}/p", f"{tmp_dir}/p"),
                               (f"{tmp_dir}/p", f"{tmp_dir}/p/reviews_clean.parquet"), (f"{tmp_dir}/p/q", f"{tmp_dir}/p")):
        with pytest.raises(ValueError, match="hold one another"):
            jobs.run_review_analytics(spark, [reviews], [meta], processed, results)
        assert not os.path.exists(f"{tmp_dir}/p") and not os.path.exists(f"{tmp_dir}/r")


def test_missing_column_fails_on_the_declared_schema(spark, tmp_dir):
    lacking = [{k: v for k, v in r.items() if k != "helpful_vote"} for r in SMOKE_REVIEWS]
    reviews = _write_jsonl(f"{tmp_dir}/raw/reviews.jsonl", lacking)
    meta = _write_jsonl(f"{tmp_dir}/raw/meta.jsonl", [SMOKE_PRODUCT])
    for fmt in ("json", "json-inferred"):
        with pytest.raises(ValueError, match="helpful_vote"):
            jobs.run_review_analytics(spark, reviews, meta, f"{tmp_dir}/p", f"{tmp_dir}/r", fmt=fmt)
        assert not os.path.exists(f"{tmp_dir}/p")


def test_malformed_lines_and_lost_values_are_reported(spark, tmp_dir):
    reviews = _write_jsonl(f"{tmp_dir}/raw/a.jsonl", [*SMOKE_REVIEWS, '{"parent_asin":', "not json"])
    more = _write_jsonl(f"{tmp_dir}/raw/b.jsonl", [dict(SMOKE_REVIEWS[0], user_id=None)])
    meta = _write_jsonl(f"{tmp_dir}/raw/meta.jsonl", [SMOKE_PRODUCT, dict(SMOKE_PRODUCT, parent_asin="K8", price="from 9.99")])
    run = jobs.run_review_analytics(spark, [reviews, more], [meta], f"{tmp_dir}/p", f"{tmp_dir}/r")
    assert run.findings == {"reviews": {"corrupt_rows": 2}, "metadata": {"corrupt_rows": 1, "lost_price": 1}}
    assert run.counts["raw_reviews"] == 5 and run.counts["raw_metadata"] == 2
    per_file = spark.read.parquet(f"{tmp_dir}/r/input_report/reviews").collect()
    assert sorted((r.row_count, r.corrupt_rows, r.has_text) for r in per_file) == [(1, 0, 1), (4, 2, 2)]


def test_validation_takes_lists_writes_what_it_collects_and_cleans_up(spark, tmp_dir):
    from revlens import session

    a = _write_jsonl(f"{tmp_dir}/raw/a.jsonl", SMOKE_REVIEWS[:1])
    b = _write_jsonl(f"{tmp_dir}/raw/b.jsonl", SMOKE_REVIEWS[1:])
    m = _write_jsonl(f"{tmp_dir}/raw/m.jsonl", [SMOKE_PRODUCT])
    staged = f"{session.checkpoint_dir(spark)}/revlens".removeprefix("file:")
    before = set(glob.glob(f"{staged}/validation-*"))
    out = jobs.run_input_validation(spark, [a, b], [m], f"{tmp_dir}/res", fraction=1.0)
    assert [r.sampled_reviews for r in out["sample_join_coverage"]] == [1, 1]
    assert [r["row_count"] for r in _read_csv(f"{tmp_dir}/res/review_validation")] == ["1", "1"]
    assert set(glob.glob(f"{staged}/validation-*")) == before
    with pytest.raises(ValueError):
        jobs.run_input_validation(spark, [a, b], [m], f"{tmp_dir}/raw")


def test_jobs_size_their_shuffles_from_the_input(spark, tmp_dir):
    from revlens import session

    reviews = _write_jsonl(f"{tmp_dir}/raw/reviews.jsonl", SMOKE_REVIEWS * 40)
    meta = _write_jsonl(f"{tmp_dir}/raw/meta.jsonl", [SMOKE_PRODUCT])
    size = os.path.getsize(reviews) + os.path.getsize(meta)
    assert session.input_bytes(spark, [f"{tmp_dir}/raw/*.jsonl"]) == size
    old = spark.conf.get("spark.sql.shuffle.partitions")
    run = jobs.run_review_analytics(spark, reviews, meta, f"{tmp_dir}/p", f"{tmp_dir}/r", partition_bytes=1000)
    assert run.shuffle_partitions == max(spark.sparkContext.defaultParallelism, -(-size // 1000))
    assert spark.conf.get("spark.sql.shuffle.partitions") == old


def test_validation_reports_on_bad_lines(spark, tmp_dir):
    good = dict(SMOKE_REVIEWS[0])
    string_rating = dict(SMOKE_REVIEWS[1], rating="4.0")
    reviews = _write_jsonl(f"{tmp_dir}/raw/rev/a.jsonl",
                           [good, '{"parent_asin":', json.dumps(string_rating)])
    meta = _write_jsonl(f"{tmp_dir}/raw/meta/a.jsonl",
                        [SMOKE_PRODUCT, SMOKE_PRODUCT, dict(SMOKE_PRODUCT, parent_asin=None)])
    out = jobs.run_input_validation(spark, f"{tmp_dir}/raw/rev", f"{tmp_dir}/raw/meta",
                                    fraction=1.0)
    (rv,) = out["review_validation"]
    assert (rv.row_count, rv.corrupt_rows, rv.null_parent_asin, rv.null_rating) == (3, 2, 1, 2)
    (mv,) = out["metadata_validation"]
    assert (mv.row_count, mv.corrupt_rows, mv.null_parent_asin, mv.distinct_parent_asin) == (3, 0, 1, 1)
    (dup,) = out["duplicate_metadata_keys"]
    assert tuple(dup) == (1, 1, 0, 2)
    (cov,) = out["sample_join_coverage"]
    assert (cov.sampled_reviews, cov.matched_reviews, cov.join_coverage_percent) == (1, 1, 100.0)


def test_duplicate_catalog_keys_policy(spark, tmp_dir):
    reviews = _write_jsonl(f"{tmp_dir}/raw/reviews.jsonl", SMOKE_REVIEWS)
    twice = [SMOKE_PRODUCT, dict(SMOKE_PRODUCT, store="Other Store")]
    meta = _write_jsonl(f"{tmp_dir}/raw/meta.jsonl", twice)
    keep = jobs.run_review_analytics(spark, reviews, meta, f"{tmp_dir}/k/p", f"{tmp_dir}/k/r")
    assert keep.counts["joined_reviews"] == 4            # each review once per catalog row
    with pytest.raises(ValueError):
        jobs.run_review_analytics(spark, reviews, meta, f"{tmp_dir}/f/p", f"{tmp_dir}/f/r",
                                  on_duplicate_keys="fail")
    one = jobs.run_review_analytics(spark, reviews, meta, f"{tmp_dir}/d/p", f"{tmp_dir}/d/r",
                                    on_duplicate_keys="dedupe")
    assert one.counts["joined_reviews"] == 2
    stores = {r.store for r in spark.read.parquet(one.paths["joined_reviews"]).collect()}
    assert stores == {"Hearth"}                          # smallest row wins, deterministically


def test_inferred_scan_with_case_variant_keys(spark, tmp_dir):
    from revlens import session
    from revlens.sources import json_lines as jl

    path = _write_jsonl(f"{tmp_dir}/raw/case.jsonl", ['{"Title": "a", "title": "b"}'])
    session.configure(spark)
    df = jl.read_json_inferred(spark, path, "metadata")
    assert sorted(df.columns) == ["Title", "title"]
    assert df.select("title").first()[0] == "b"


def test_job_from_parquet_inputs(spark, tmp_dir):
    from revlens import schemas

    reviews = spark.createDataFrame(
        [tuple(r[c] for c in schemas.REVIEW_COLUMNS) for r in
         [SMOKE_REVIEWS[0], SMOKE_REVIEWS[1], SMOKE_REVIEWS[1]]], schemas.REVIEW_SCHEMA)
    meta = spark.createDataFrame([tuple(SMOKE_PRODUCT[c] for c in schemas.METADATA_COLUMNS)],
                                 schemas.METADATA_SCHEMA)
    reviews.write.parquet(f"{tmp_dir}/in/reviews")
    meta.write.parquet(f"{tmp_dir}/in/meta")
    run = jobs.run_review_analytics(spark, f"{tmp_dir}/in/reviews", f"{tmp_dir}/in/meta",
                                    f"{tmp_dir}/processed", f"{tmp_dir}/results", fmt="parquet")
    assert run.counts == {"raw_reviews": 3, "raw_metadata": 1, "reviews_clean": 2, "metadata_for_join": 1,
                          "joined_reviews": 2}
    pol = _read_csv(run.paths["polarization_analysis"])
    assert pol[0]["avg_rating_stddev"] == "2.828"


def test_job_with_inferred_json_schema(spark, tmp_dir):
    reviews = _write_jsonl(f"{tmp_dir}/raw/reviews.jsonl",
                           [SMOKE_REVIEWS[0], SMOKE_REVIEWS[1], SMOKE_REVIEWS[1]])
    meta = _write_jsonl(f"{tmp_dir}/raw/meta.jsonl", [SMOKE_PRODUCT])
    run = jobs.run_review_analytics(spark, reviews, meta, f"{tmp_dir}/processed",
                                    f"{tmp_dir}/results", fmt="json-inferred")
    assert run.counts["joined_reviews"] == 2
    assert _read_csv(run.paths["polarization_analysis"])[0]["avg_extreme_rating_percent"] == "100.0"


def test_size_shuffle_targets_partition_bytes(spark):
    from revlens import session

    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        parts = session.size_shuffle(spark, 100 * 1024 ** 4)       # 100 TiB
        assert parts == 100 * 1024 ** 4 // (256 * 1024 ** 2) == 409600
        assert session.size_shuffle(spark, 1) == spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_compressed_inputs_count_as_what_they_hold(spark, tmp_dir):
    import gzip

    from revlens import session

    plain = _write_jsonl(f"{tmp_dir}/raw/a.jsonl", SMOKE_REVIEWS * 40)
    os.makedirs(f"{tmp_dir}/gz")
    with open(plain, "rb") as fh, gzip.open(f"{tmp_dir}/gz/a.jsonl.gz", "wb") as out:
        out.write(fh.read())
    size = os.path.getsize(f"{tmp_dir}/gz/a.jsonl.gz")
    assert session.input_bytes(spark, f"{tmp_dir}/gz") == size * session.EXPANSION
    meta = _write_jsonl(f"{tmp_dir}/meta.jsonl", [SMOKE_PRODUCT])
    run = jobs.run_review_analytics(spark, f"{tmp_dir}/gz", meta, f"{tmp_dir}/p", f"{tmp_dir}/r")
    assert run.counts["raw_reviews"] == 80 and run.counts["joined_reviews"] == 2
