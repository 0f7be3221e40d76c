"""Write PLANS.md: final (post-AQE) physical plans of the headline queries.

``python bench/plans.py [sf_dir]`` executes each query and records its final
adaptive plan tree, so shuffles, join strategies, partial
aggregation, pushed filters and exchange reuse can be read off directly.
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, HERE)

HEADLINE = [
    "verified_profile", "polarization_profile", "polarization_profile_eager",
    "row_counts", "sample_join_coverage", "review_quality_by_file",
    "duplicate_drilldown", "top_duplicate_keys", "rating_share_by_verified",
    "high_rating_by_verified", "vote_quantiles",
]


def final_tree(df) -> str:
    df.collect()  # the frame's own execution finalizes its adaptive plan
    plan = df._jdf.queryExecution().executedPlan().toString()
    # keep the final plan, drop the initial one and long attribute lists
    plan = plan.split("+- == Initial Plan ==")[0]
    plan = re.sub(r"#\d+L?", "", plan)
    lines = [ln[:160] for ln in plan.splitlines() if ln.strip()]
    return "\n".join(lines)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from revlens import schemas, session
    from revlens.operators import clean as cl
    from revlens.operators import joins as jn
    from revlens.plans import catalog
    from revlens.sources import fixture_files as ff

    spark = session.local_session(8, shuffle_partitions=16, app_name="revlens-plans")
    session.checkpoint_dir(spark)
    out = [f"# Executed plans ({os.path.basename(sf_dir)}, local[8], AQE on)\n",
           "Generated by `python bench/plans.py`; attribute ids stripped, lines cut at 160 chars.\n"]

    # the job's two heavy steps, as planned inside run_review_analytics
    reviews_json = ff.fixture_json(spark, sf_dir, "reviews", faulty=False)
    catalog_json = ff.fixture_json(spark, sf_dir, "catalog", faulty=False)
    reviews = spark.read.schema(schemas.REVIEW_SCHEMA).json(reviews_json)
    meta = spark.read.schema(schemas.METADATA_SCHEMA).json(catalog_json)
    staged = tempfile.mkdtemp(prefix="revlens-plans-")
    clean_df = cl.clean_reviews(reviews)
    out.append("## job step 1: reviews_clean (JSON -> dedup -> features -> z)\n")
    out.append("```\n" + final_tree(clean_df) + "\n```\n")
    clean_df.write.mode("overwrite").parquet(f"{staged}/rc")
    jn.metadata_for_join(cl.clean_metadata(meta)).write.mode("overwrite").parquet(f"{staged}/mj")
    joined = jn.add_popularity_bin(jn.join_reviews_metadata(
        spark.read.parquet(f"{staged}/rc"), spark.read.parquet(f"{staged}/mj")))
    out.append("## job step 3: joined_reviews (from the written tables)\n")
    out.append("```\n" + final_tree(joined) + "\n```\n")

    for name in HEADLINE:
        df = catalog.QUERIES[name](spark, sf_dir)
        out.append(f"## {name}\n")
        out.append("```\n" + final_tree(df) + "\n```\n")
    with open(os.path.join(HERE, "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
