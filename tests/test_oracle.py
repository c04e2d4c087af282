"""Every registered proof query against its DuckDB oracle on sf0.001."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "scripts"))

import __spark_entry__ as entry  # noqa: E402
import oracle_check  # noqa: E402

SF = "/root/testdata/sf0.001"
# The optional training-data operators have tests of their own.
QUERIES = {k: v for k, v in entry.queries().items() if k.startswith("q_")}
SQL = {k: v for k, v in entry.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip("test data not present")
    return oracle_check.duck(SF)


def test_every_query_has_an_oracle_or_is_listed():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) - set(SQL) == set()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    assert oracle_check.compare(spark, con, name, QUERIES[name], SQL[name], SF)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 1500 and len(df.columns) == 15
