"""Every registered query equals its DuckDB oracle on the smallest fixture."""

import pytest

from tools.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def _names():
    from __spark_entry__ import oracle_sql

    return sorted(oracle_sql())


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    from __spark_entry__ import oracle_sql, queries

    ok, msg, _, _ = compare(spark, con, name, queries()[name], oracle_sql()[name], SF)
    assert ok, msg


def test_entry_smoke(spark):
    from __spark_entry__ import entry, queries, oracle_sql
    from wakeline.plans.queries import QUERIES

    df = entry(spark)
    assert df.count() > 0
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())
