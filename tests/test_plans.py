"""Physical-plan properties: no Python in any registered query, broadcast
only for the checked dimension, pushed filters and pruned scans, partial
aggregation before every shuffle of trip rows, top-k instead of a sort."""

import os

import pytest

from conftest import SF_SMALL
from tripflow import config
from tripflow.operators import marts
from tripflow.plans import catalog as C


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# queries that write files first, and the one Arrow-batched reader (parquet rescue)
EAGER = ("quarantine_all", "compaction_roundtrip", "schema_evolution_union", "stream_ingest", "dedup_stream",
         "rescued_parquet", "update_dq_log", "pk_violations", "change_feed", "update_row_counts",
         *(f"{k}_{t}" for k in ("stream_ingest", "dedup_stream") for t in config.TAXI_TYPES[1:]), "gold_daily_incremental", "csv_trip_scan", "maintenance_counts")
LAZY = [k for k in C.queries() if k not in EAGER]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_in_plan(spark, name):
    p = plan(C.queries()[name](spark, SF_SMALL))
    for marker in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"):
        assert marker not in p, (name, marker)


def test_scan_is_pruned(spark):
    # the events scan reads only the four columns the derivation needs
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string,value:double>" in \
        C.queries()["gold_daily_borough"](spark, SF_SMALL)._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_zones_meet_pre_aggregated_trips(spark):
    s = C._silver_all(spark, SF_SMALL)
    z = C._zones(spark, SF_SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(marts.daily_borough_metrics(s, z))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in p
    # trips are aggregated per location before the join's shuffle
    assert "partial_count" in p
    assert "SortMergeJoin" in p or "ShuffledHashJoin" in p


def test_dedup_is_partially_aggregated_before_shuffle(spark):
    p = plan(C.queries()["dedup_batch"](spark, SF_SMALL))
    assert "partial_min" in p


def test_top20_is_top_k(spark):
    p = plan(C.queries()["top20_daily"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p


def test_filters_reach_the_silver_scan(spark, scratch):
    path = os.path.join(scratch, "silver_yellow")
    C._silver(spark, SF_SMALL, "yellow").write.partitionBy(*config.SILVER_PARTITIONS["yellow"]).parquet(path)
    silver = {t: spark.read.parquet(path) for t in config.TAXI_TYPES}
    q = marts.airport_metrics(silver)
    fmt = q._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PushedFilters: [Or(In(pickup_location_id" in fmt
    # only the four columns the mart needs are read (+ partition columns)
    assert "ReadSchema: struct<pickup_datetime:timestamp_ntz,pickup_location_id:bigint,dropoff_location_id:bigint>" in fmt


def test_drop_rules_reach_the_bronze_scan(spark, scratch):
    from tripflow.functions.rules import RULES
    from tripflow.operators.conform import conform_trips
    from tripflow.operators.quality import apply_rules
    path = os.path.join(scratch, "bronze_yellow")
    C._bronze(spark, SF_SMALL, "yellow").write.parquet(path)
    kept = apply_rules(conform_trips(spark.read.parquet(path), "yellow"), RULES["yellow"])
    fmt = kept._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    pushed = fmt.split("PushedFilters:")[1].split("\n")[0]
    assert "GreaterThanOrEqual(PULocationID,1)" in pushed and "LessThanOrEqual(PULocationID,265)" in pushed, pushed


def test_pk_violations_scans_events_while_writing_silver_only(spark):
    assert "events.parquet" not in plan(C.queries()["pk_violations"](spark, SF_SMALL))


def test_parquet_rescue_is_a_scan_for_each_group_of_types(spark):
    p = plan(C.queries()["rescued_parquet"](spark, SF_SMALL))
    assert "Python" not in p and "MapInPandas" not in p
    assert p.count("FileScan parquet") >= 2 and "Union" in p
