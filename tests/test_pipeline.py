"""A full pipeline update (batch backfill and triggered streams) and the
cross-table invariants it must satisfy."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tripflow import config
from tripflow.functions.rules import RULES
from tripflow.operators.storage import pk_violations
from tripflow.plans.pipeline import read_quarantine_table, run_batch_pipeline, run_stream_pipeline, write_landing
from tripflow.sources import fixtures

AS_OF = "2025-01-01 00:00:00"


@pytest.fixture(scope="module")
def batch(spark):
    from tripflow.session import work_path
    return run_batch_pipeline(spark, SF_SMALL, work_path(spark, "pipeline_batch"), as_of=AS_OF)


def _t(spark, paths, name):
    return spark.read.parquet(paths[name])


def test_silver_is_subset_of_bronze_and_counts(spark, batch):
    expected = {"yellow": 175, "green": 157, "fhv": 180, "fhvheavy": 349}
    for t, n in expected.items():
        assert _t(spark, batch, f"silver.{t}_trips").count() == n
    assert read_quarantine_table(spark, batch).count() == 22 + 20 + 10 + 39


def test_marts_have_valid_keys(spark, batch):
    for m, pk in config.MART_PK.items():
        assert pk_violations(_t(spark, batch, f"gold.{m}"), pk).count() == 0


def test_daily_total_equals_priced_silver_with_borough(spark, batch):
    zones = _t(spark, batch, "silver.zone_lookup")
    priced = 0
    for t in ("yellow", "green", "fhvheavy"):
        s = _t(spark, batch, f"silver.{t}_trips")
        priced += s.join(zones, s.pickup_location_id == zones.location_id).count()
    daily = _t(spark, batch, "gold.daily_borough_metrics").agg(F.sum("trip_count")).first()[0]
    zone = _t(spark, batch, "gold.zone_revenue")
    zone_total = zone.agg(F.sum("trip_count")).first()[0]
    null_borough = zone.filter("borough IS NULL").agg(F.sum("trip_count")).first()[0]
    assert daily == priced
    assert zone_total - daily == null_borough == 4


def test_event_log_and_audit_views(spark, batch):
    ev = _t(spark, batch, "audit.event_log")
    flows = {json.loads(r.details)["flow_name"] for r in ev.filter("event_type = 'flow_progress'").collect()}
    assert {"silver.yellow_trips", "bronze.fhvheavy_trips_raw", "gold.zone_revenue"} <= flows
    dq = _t(spark, batch, "audit.data_quality_log")
    y = {r.expectation_name: r for r in dq.filter("dataset_name = 'silver.yellow_trips'").collect()}
    assert set(y) == {r.name for r in RULES["yellow"]}
    assert all(r.passed_records + r.failed_records == 210 for r in y.values())  # rows after dedup
    rc = {r.dataset_name: r.num_output_rows for r in _t(spark, batch, "audit.row_count_log").collect()}
    assert rc["silver.yellow_trips"] == 175 and rc["bronze.yellow_trips_raw"] == 214
    runs = _t(spark, batch, "audit.pipeline_run_log").collect()
    assert {r.state for r in runs} == {"RUNNING", "COMPLETED"}
    sla = _t(spark, batch, "audit.sla_monitoring").collect()
    assert {r.dataset_name for r in sla} == flows


def test_stream_pipeline_matches_batch(spark, batch, scratch):
    landing = {}
    for t in config.TAXI_TYPES:
        landing[t] = os.path.join(scratch, "landing", t)
        write_landing(fixtures.raw_trips(spark, SF_SMALL, t), landing[t], files=2)
    paths = run_stream_pipeline(spark, landing, fixtures.raw_zones(spark, SF_SMALL),
                                os.path.join(scratch, "tables"), as_of=AS_OF)
    for m in config.MART_DDL:
        a, b = _t(spark, paths, f"gold.{m}"), _t(spark, batch, f"gold.{m}")
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, m
    # rerun without new files: silver unchanged
    before = _t(spark, paths, "silver.yellow_trips").count()
    run_stream_pipeline(spark, landing, fixtures.raw_zones(spark, SF_SMALL), os.path.join(scratch, "tables"), AS_OF)
    assert _t(spark, paths, "silver.yellow_trips").count() == before
    assert read_quarantine_table(spark, paths).count() == read_quarantine_table(spark, batch).count()


def test_maintenance_compacts_and_purges(spark, batch):
    import glob
    from tripflow.plans.maintenance import maintained_tables, run_maintenance
    new = run_maintenance(spark, batch, as_of="2024-03-15 00:00:00")
    assert len(maintained_tables()) == 15
    for name in maintained_tables():
        assert new[name] != batch[name]
        if name == "silver.quarantine_trips":
            continue
        a, b = spark.read.parquet(new[name]), spark.read.parquet(batch[name])
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name
        assert len(glob.glob(f"{new[name]}/**/*.parquet", recursive=True)) <= \
            len(glob.glob(f"{batch[name]}/**/*.parquet", recursive=True))
    # quarantine rows were stamped 2025-01-01 (as_of of the run): none is older than 90 days before 2024-03-15
    assert read_quarantine_table(spark, new).count() == read_quarantine_table(spark, batch).count()
    later = run_maintenance(spark, batch, as_of="2025-06-01 00:00:00")
    assert read_quarantine_table(spark, later).count() == 0


def _landed(spark, scratch):
    landing = {t: os.path.join(scratch, "landing", t) for t in config.TAXI_TYPES}
    for t in config.TAXI_TYPES:
        write_landing(fixtures.raw_trips(spark, SF_SMALL, t), landing[t], files=1)
    return landing


def _land_february(spark, landing, extra=False):
    import datetime as dt
    from tripflow.sources.files import RAW_SCHEMAS
    feb = dt.datetime(2024, 2, 3, 9, 30)
    rows = [(feb + dt.timedelta(minutes=i), feb + dt.timedelta(minutes=i + 12), 10 + i, 20, 1, 1, 2.0, 9.0, 11.0, 1)
            for i in range(5)]
    df = spark.createDataFrame(rows, RAW_SCHEMAS["yellow"])
    df = df.withColumn("airport_fee", F.lit(1.75)) if extra else df
    df.coalesce(1).write.mode("append").parquet(landing["yellow"])


def test_gold_is_whole_after_a_failed_refresh(spark, scratch, monkeypatch):
    """February reaches silver, gold fails, March of nothing follows: the next
    update's marts hold February all the same."""
    from tripflow.plans import pipeline as P
    landing, root, zones = _landed(spark, scratch), os.path.join(scratch, "tables"), fixtures.raw_zones(spark, SF_SMALL)
    run = lambda: run_stream_pipeline(spark, landing, zones, root, as_of=AS_OF, flow_confs={})
    run()
    _land_february(spark, landing)
    with monkeypatch.context() as m:
        m.setattr(P, "refresh_gold", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run()
    paths = run()
    daily = _t(spark, paths, "gold.daily_borough_metrics")
    assert daily.filter("trip_date = DATE'2024-02-03' AND taxi_type = 'yellow'").agg(F.sum("trip_count")).first()[0] == 5


def test_new_raw_columns_reach_bronze(spark, scratch):
    landing, root, zones = _landed(spark, scratch), os.path.join(scratch, "tables"), fixtures.raw_zones(spark, SF_SMALL)
    run_stream_pipeline(spark, landing, zones, root, as_of=AS_OF, flow_confs={})
    _land_february(spark, landing, extra=True)
    paths = run_stream_pipeline(spark, landing, zones, root, as_of=AS_OF, flow_confs={})
    bronze = spark.read.option("mergeSchema", True).parquet(paths["bronze.yellow_trips_raw"])
    assert bronze.filter("airport_fee = 1.75").count() == 5


@pytest.mark.parametrize("stream", [False, True])
def test_logged_row_counts_are_the_tables(spark, scratch, stream):
    root, zones = os.path.join(scratch, "tables"), fixtures.raw_zones(spark, SF_SMALL)
    if stream:
        paths = run_stream_pipeline(spark, _landed(spark, scratch), zones, root, as_of=AS_OF, flow_confs={})
    else:
        paths = run_batch_pipeline(spark, SF_SMALL, root, as_of=AS_OF, flow_confs={})
    ev = spark.read.parquet(paths["audit.event_log"])
    d = F.from_json("details", "flow_name string, num_output_rows long")
    logged = {r.n: r.k for r in ev.filter("event_type = 'flow_progress'").select(
        d["flow_name"].alias("n"), d["num_output_rows"].alias("k")).collect()}
    for name, n in logged.items():
        path = os.path.join(paths["silver.quarantine_trips"], f"flow={name.removeprefix('silver.quarantine_')}") \
            if name.startswith("silver.quarantine") else paths[name]
        assert spark.read.parquet(path).count() == n, name
    assert {"silver.zone_lookup", "bronze.zone_lookup_raw"} <= set(logged) and len(logged) == 20


def test_silver_rows_are_conformed_bronze_rows(spark, batch):
    from tripflow.operators.conform import conform_trips
    for t in config.TAXI_TYPES:
        silver = _t(spark, batch, f"silver.{t}_trips").drop("_created_at")
        conformed = conform_trips(_t(spark, batch, f"bronze.{t}_trips_raw"), t).drop("_created_at")
        cols = sorted(silver.columns)
        assert silver.select(cols).exceptAll(conformed.select(cols)).count() == 0, t


def test_failed_flow_is_logged_as_error(spark, scratch):
    """A source whose raw frame lacks a required column fails its flow; the
    update is recorded FAILED with an ERROR event the error view classifies."""
    from tripflow.operators import audit
    from tripflow.plans.pipeline import table_paths
    raw = fixtures.all_raw_trips(spark, SF_SMALL)
    raw["green"] = raw["green"].drop("lpep_dropoff_datetime")
    root = os.path.join(scratch, "tables")
    with pytest.raises(Exception):
        run_batch_pipeline(spark, SF_SMALL, root, raw=raw, as_of=AS_OF, concurrent=False)
    ev = spark.read.parquet(table_paths(root)["audit.event_log"])
    errors = audit.error_log(ev).collect()
    assert len(errors) == 1 and "silver.green_trips" in errors[0].details
    states = {r.state for r in audit.run_log(ev).collect()}
    assert states == {"RUNNING", "FAILED"}


def test_flow_sessions_isolate_per_flow_confs(spark):
    from tripflow.plans.pipeline import flow_session
    parent = spark.conf.get("spark.sql.shuffle.partitions")
    heavy = flow_session(spark, config.FLOW_CONF["fhvheavy"])
    light = flow_session(spark, config.FLOW_CONF.get("green"))
    assert heavy.conf.get("spark.sql.shuffle.partitions") == "800"
    assert light.conf.get("spark.sql.shuffle.partitions") == parent
    assert spark.conf.get("spark.sql.shuffle.partitions") == parent
    assert heavy.conf.get("spark.sql.session.timeZone") == "UTC"      # parent's SQL confs carried over
    assert heavy.sparkContext is spark.sparkContext                   # same executors


def test_silver_update_has_no_batch_without_rows(spark, scratch, monkeypatch):
    from tripflow.streaming import ingest
    done, real = [], ingest.silver_into
    monkeypatch.setattr(ingest, "silver_into", lambda *a: done.append(real(*a)) or done[-1])
    before = spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled")
    zones = fixtures.raw_zones(spark, SF_SMALL)
    run_stream_pipeline(spark, _landed(spark, scratch), zones, os.path.join(scratch, "tables"), as_of=AS_OF, flow_confs={})
    assert len(done) == 4 and all(r.num_output_rows and r.batches == 1 for r in done)
    assert spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled") == before
