import math

import numpy as np
from pyspark.sql import functions as F

from revlens.llm import topk_search
from revlens.llm.queries import ORACLE_SQL
from tests import oracle_harness as oh
from tests.llm.helpers import MIDDLE, SMALL, pandas, table

SCHEMA = "vec_id long, embedding array<double>, label int, score double"


def brute(rows, k):
    held = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (q, own) in enumerate(held):
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(own, v)), i) for j, (i, v) in enumerate(held)
                            if j != at and len(v) == len(own))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


def search(spark, rows, k=5):
    df = spark.createDataFrame([(i, v, 0, 0.0) for i, v in rows], SCHEMA)
    got = topk_search.top_k(df, "vec_id", "embedding", F.col("id") % 50 == 0, k).collect()
    return sorted(tuple(r) for r in got)


def test_table_against_brute_force(spark):
    rows = [(i, v.astype(float).tolist()) for i, v in zip(*(pandas("embeddings")[c] for c in ("vec_id", "embedding")))]
    got = topk_search.top_k(table(spark, "embeddings", SMALL), "vec_id", "embedding", F.col("id") % 50 == 0)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 5)


def test_ties_nulls_repeats_lengths(spark):
    rows = [(i, [0.5, 0.25]) for i in range(120)]                      # all tie
    rows += [(200, None), (250, [None, 1.0]), (300, [float("nan"), 1.0]), (350, [float("inf"), 0.0]),
             (None, [1.0, 1.0]), (400, [1.0]), (401, [2.0]), (50, [0.75, 0.25]), (50, [0.75, 0.25]), (450, [])]
    assert search(spark, rows) == brute(rows, 5)


REPEATED = ([(0, [1.0]), (7, [2.0]), (7, [2.0]), (8, [1.0])] + [(100, [3.0])] * 9
            + [(150, [float(i)]) for i in (1, 1, 2, 3)] + [(9, [0.5])] * 3 + [(200, [-0.0]), (200, [0.0])])


def test_rows_that_repeat_an_id_each_take_part(spark, monkeypatch):
    probe = [(0, [1.0]), (7, [2.0]), (7, [2.0]), (8, [1.0])]
    assert [r[2] for r in search(spark, probe)] == [7, 7, 8]
    assert search(spark, REPEATED) == brute(REPEATED, 5)
    monkeypatch.setattr(topk_search, "SHARD_ROWS", 3)
    monkeypatch.setattr(topk_search, "BLOCK_ROWS", 1)
    monkeypatch.setattr(topk_search, "FAN_IN", 2)
    assert search(spark, REPEATED) == brute(REPEATED, 5)


def test_sql_twin_with_repeated_ids(spark, tmp_dir):
    rows = spark.createDataFrame([(i, v, 0, 0.0) for i, v in REPEATED], SCHEMA).coalesce(1)
    rows.write.parquet(f"{tmp_dir}/e")
    con = oh.duck(MIDDLE)
    con.execute(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_dir}/e/*.parquet')")
    res = oh.compare(spark, con, "t", lambda s, d: topk_search.top_k(rows, "vec_id", "embedding", F.col("id") % 50 == 0),
                     ORACLE_SQL["op1_exact_topk"], "")
    assert res["status"] == "match", res


def test_blocks_shards_and_merges(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "SHARD_ROWS", 7)
    monkeypatch.setattr(topk_search, "BLOCK_ROWS", 2)
    monkeypatch.setattr(topk_search, "FAN_IN", 3)
    rng = np.random.default_rng(1)
    rows = [(int(i), rng.integers(-3, 3, 4).astype(float).tolist()) for i in range(400)]
    assert search(spark, rows) == brute(rows, 5)


def test_huge_values_are_held_at_the_ends(spark):
    got = search(spark, [(0, [1e300]), (1, [1e300]), (2, [-1e300])])
    assert got == [(0, 1, 1, 2 ** 63 - 1), (0, 2, 2, -(2 ** 63 - 1))]


def test_few_and_none(spark):
    assert search(spark, [(0, [1.0])]) == []
    assert search(spark, []) == []
