"""Every registered query equals its DuckDB oracle (rows, columns, values)."""

import pytest

import oracle_compare as oc
from conftest import SF_SMALL
from tripflow.plans.catalog import queries
from tripflow.plans.oracle import oracle_sql

QUERIES = queries()
ORACLE = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oc.duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    res = oc.compare(QUERIES[name](spark, SF_SMALL), con, ORACLE[name])
    assert res["columns_match"], res
    assert res["spark_rows"] == res["oracle_rows"], res
    assert res["exact"], res.get("diffs")
