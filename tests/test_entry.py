"""The driver contract in __spark_entry__.py."""

import oracle_compare as oc
from conftest import SF_MID

import __spark_entry__ as E


def test_entry_runs_with_stable_schema(spark):
    a, b = E.entry(spark), E.entry(spark)
    assert a.schema == b.schema
    assert a.columns == ["trip_date", "borough", "taxi_type", "trip_count", "total_revenue", "avg_distance"]
    assert a.count() == 343


def test_every_query_has_oracle_sql_that_binds():
    from tripflow.plans import catalog
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and set(catalog.queries()) <= set(o) and len(q) >= 50
    con = oc.duck(SF_MID)
    for name, sql in o.items():
        con.execute(f"EXPLAIN {sql}")  # parses and binds against the registered views
