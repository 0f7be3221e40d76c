"""Every registered query against its DuckDB twin (small scale for speed;
``python tests/oracle_harness.py /root/testdata/sf0.01`` runs the driver's
scale)."""

import pytest

import __spark_entry__ as entry_mod
from revlens.plans import catalog
from tests import oracle_harness as oh
from tests.conftest import SF_SMALL

QUERIES = catalog.QUERIES
SQL = entry_mod.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oh.duck(SF_SMALL)


def test_every_query_has_sql_or_is_declared_rows_only():
    assert set(QUERIES) == (set(SQL) & set(QUERIES)) | entry_mod.ROWS_ONLY


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    res = oh.compare(spark, con, name, QUERIES[name], SQL.get(name), SF_SMALL)
    assert res["status"] in ("match", "rows-only"), res
    if res["status"] == "rows-only":
        assert res["spark_rows"] > 0


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) == 5
    assert df.columns == ["product_popularity_bin", "product_count", "avg_rating_stddev",
                          "avg_extreme_rating_percent"]
