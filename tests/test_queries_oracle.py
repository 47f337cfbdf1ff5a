"""Every registered query against its DuckDB twin on sf0.001 (the driver
runs the same comparison at sf0.01); queries without a twin are run and
checked for a stable schema."""

import pytest

from oracle_compare import SF_SMALL, compare, duck

import __spark_entry__ as entry_mod

QUERIES = entry_mod.queries()
ORACLE = entry_mod.oracle_sql()
@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_a_twin():
    from fieldmart.plans.queries import QUERIES as CORE

    assert set(CORE) <= set(ORACLE)


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() >= 0 and "avg_flow_rate_tpd" in df.columns


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    res = compare(QUERIES[name](spark, SF_SMALL), con, ORACLE[name])
    assert res["rows_spark"] == res["rows_oracle"], res
    assert res["cols_match"], res
    assert res["hash_match"], res

