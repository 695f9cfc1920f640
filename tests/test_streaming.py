"""Triggered file streams: exactly-once progress, watermark dedup, late
data, observed rule counts, multi-flow target, stream = batch."""

import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tripflow import config
from tripflow.operators.marts import union_all
from tripflow.plans import medallion as M
from tripflow.plans.pipeline import write_landing
from tripflow.sources import fixtures
from tripflow.sources.files import RAW_SCHEMAS, read_stream
from tripflow.streaming import ingest

AS_OF = "2025-01-01 00:00:00"


def test_rerun_adds_nothing_and_new_files_are_picked_up(spark, scratch):
    raw = fixtures.raw_trips(spark, SF_SMALL, "yellow")
    landing, sink, ck = (os.path.join(scratch, p) for p in ("landing", "bronze", "ck"))
    early = F.coalesce(F.col("tpep_pickup_datetime") < F.lit("2024-01-15").cast("timestamp_ntz"), F.lit(True))
    write_landing(raw.filter(early), landing, files=3)
    r1 = ingest.bronze_flow(read_stream(spark, landing, RAW_SCHEMAS["yellow"]), "yellow", sink, ck)
    n1 = spark.read.parquet(sink).count()
    assert n1 == raw.filter(early).count() == r1.num_output_rows
    r2 = ingest.bronze_flow(read_stream(spark, landing, RAW_SCHEMAS["yellow"]), "yellow", sink, ck)
    assert r2.num_output_rows == 0 and spark.read.parquet(sink).count() == n1
    write_landing(raw.filter(~early), landing, files=2)
    ingest.bronze_flow(read_stream(spark, landing, RAW_SCHEMAS["yellow"]), "yellow", sink, ck)
    assert spark.read.parquet(sink).count() == raw.count()
    # rescued-data expectation observed on the stream: nothing rescued
    assert r1.observed["p0"] == r1.observed["n"] == n1


def test_stream_silver_equals_batch_silver(spark, scratch):
    for t in config.TAXI_TYPES:
        raw = fixtures.raw_trips(spark, SF_SMALL, t)
        landing = os.path.join(scratch, t, "landing")
        write_landing(raw, landing, files=1)
        res = ingest.silver_flow(M.bronze(read_stream(spark, landing, RAW_SCHEMAS[t])), t,
                                 os.path.join(scratch, t, "silver"), os.path.join(scratch, t, "ck"), AS_OF)
        got = spark.read.parquet(os.path.join(scratch, t, "silver"))
        want = M.silver(M.bronze(raw), t, AS_OF)
        cols = sorted(want.columns)
        assert got.select(cols).exceptAll(want.select(cols)).count() == 0
        assert want.select(cols).exceptAll(got.select(cols)).count() == 0
        # observed per-rule counts equal the batch metric query
        m = {x["rule_name"]: x for x in res.observed["metrics"]}
        for r in M.silver_metrics(M.bronze(raw), t, AS_OF).collect():
            assert m[r.rule_name]["failed_records"] == r.failed_records
        assert res.num_output_rows == want.count()


def _row(pickup, pu=10, fare=10.0):
    return (pickup, pickup + dt.timedelta(minutes=10), pu, 20, 1, 1, 1.0, fare, fare + 1, 1)


def test_late_rows_are_dropped_by_watermark(spark, scratch):
    landing = os.path.join(scratch, "landing")
    schema = RAW_SCHEMAS["yellow"]
    t_new = dt.datetime(2024, 1, 20, 12)
    t_old = dt.datetime(2024, 1, 5, 12)
    spark.createDataFrame([_row(t_new), _row(t_new, fare=11.0)], schema).coalesce(1).write.mode("append").parquet(landing)
    spark.createDataFrame([_row(t_new + dt.timedelta(hours=1), pu=11)], schema).coalesce(1).write.mode("append").parquet(landing)
    spark.createDataFrame([_row(t_old, pu=12), _row(t_new + dt.timedelta(hours=2), pu=13)], schema) \
        .coalesce(1).write.mode("append").parquet(landing)
    files = sorted(f for f in os.listdir(landing) if f.endswith(".parquet"))
    assert len(files) == 3
    stream = M.bronze(read_stream(spark, landing, schema, max_files_per_trigger=1))
    res = ingest.silver_flow(stream, "yellow", os.path.join(scratch, "silver"), os.path.join(scratch, "ck"), AS_OF)
    got = {r.pickup_location_id for r in spark.read.parquet(os.path.join(scratch, "silver")).collect()}
    # the duplicate (same key, other fare) is dropped; so is the row 15 days late
    assert res.dropped_duplicates >= 1
    assert res.dropped_by_watermark >= 1
    assert 12 not in got and {10, 11, 13} <= got
    assert spark.read.parquet(os.path.join(scratch, "silver")).filter("pickup_location_id = 10").count() == 1


def test_quarantine_flows_share_one_target(spark, scratch):
    events = fixtures.stream_events(spark, SF_SMALL)
    streams = {t: M.bronze(fixtures.raw_trips_from_events(events, t)) for t in config.TAXI_TYPES}
    target = os.path.join(scratch, "q")
    res = ingest.quarantine_flows(streams, target, os.path.join(scratch, "ck"), AS_OF)
    got = ingest.read_quarantine(spark, target)
    batch = union_all([M.quarantine(M.bronze(fixtures.raw_trips(spark, SF_SMALL, t)), t, AS_OF)
                       for t in config.TAXI_TYPES])
    assert set(res) == set(config.TAXI_TYPES)
    assert got.count() == batch.count()
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0
    # second run: nothing new
    ingest.quarantine_flows({t: M.bronze(fixtures.raw_trips_from_events(fixtures.stream_events(spark, SF_SMALL), t))
                             for t in config.TAXI_TYPES}, target, os.path.join(scratch, "ck"), AS_OF)
    assert ingest.read_quarantine(spark, target).count() == batch.count()


def test_stream_schema_evolves_between_runs(spark, scratch):
    from tripflow.sources.files import evolve_stream_schema
    landing, sink, ck, loc = (os.path.join(scratch, p) for p in ("landing", "bronze", "ck", "_schemas"))
    raw = fixtures.raw_trips(spark, SF_SMALL, "yellow")
    early = F.coalesce(F.col("tpep_pickup_datetime") < F.lit("2024-01-15").cast("timestamp_ntz"), F.lit(True))
    write_landing(raw.filter(early), landing)
    s1 = evolve_stream_schema(spark, landing, loc)
    ingest.bronze_flow(spark.readStream.schema(s1).parquet(landing), "yellow", sink, ck)
    assert "airport_fee" not in spark.read.parquet(sink).columns
    # upstream adds a column
    write_landing(raw.filter(~early).withColumn("airport_fee", F.lit(1.75)), landing)
    s2 = evolve_stream_schema(spark, landing, loc)
    assert s2.fieldNames()[:len(s1.fieldNames())] == s1.fieldNames() and s2.fieldNames()[-1] == "airport_fee"
    ingest.bronze_flow(spark.readStream.schema(s2).parquet(landing), "yellow", sink, ck)
    out = spark.read.option("mergeSchema", True).parquet(sink)
    assert out.count() == raw.count()
    assert out.filter("airport_fee IS NOT NULL").count() == raw.filter(~early).count()
    # no change -> same schema, same version (one more check recorded)
    assert evolve_stream_schema(spark, landing, loc) == s2
    versions = sorted(int(r.value.split("\t")[0]) for r in spark.read.text(loc).collect())
    assert versions == [0, 1, 1]


def test_restart_after_crash_before_commit_is_exactly_once(spark, scratch):
    """A crash after a micro-batch wrote its files but before the checkpoint
    recorded the commit: the restart re-runs that batch and the file sink's
    log makes the re-run a no-op (no duplicates, nothing lost)."""
    raw = fixtures.raw_trips(spark, SF_SMALL, "yellow")
    landing, sink, ck = (os.path.join(scratch, p) for p in ("landing", "bronze", "ck"))
    write_landing(raw, landing, files=3)
    stream = read_stream(spark, landing, RAW_SCHEMAS["yellow"], max_files_per_trigger=1)
    ingest.bronze_flow(stream, "yellow", sink, ck)
    commits = sorted(int(f) for f in os.listdir(os.path.join(ck, "commits")) if f.isdigit())
    assert len(commits) >= 3
    last = os.path.join(ck, "commits", str(commits[-1]))
    for f in (last, os.path.join(ck, "commits", f".{commits[-1]}.crc")):  # simulated crash before commit
        if os.path.exists(f):
            os.remove(f)
    ingest.bronze_flow(read_stream(spark, landing, RAW_SCHEMAS["yellow"], max_files_per_trigger=1),
                       "yellow", sink, ck)
    got = spark.read.parquet(sink)
    assert got.count() == raw.count()
    assert got.drop("_rescued_data").exceptAll(raw).count() == 0


def test_stateful_dedup_recovers_state_after_crash(spark, scratch):
    raw = fixtures.raw_trips(spark, SF_SMALL, "yellow")
    landing, sink, ck = (os.path.join(scratch, p) for p in ("landing", "silver", "ck"))
    write_landing(raw, landing, files=2)
    write_landing(raw.limit(50), landing, files=1)                     # replays of earlier rows
    def run():
        stream = M.bronze(read_stream(spark, landing, RAW_SCHEMAS["yellow"], max_files_per_trigger=1))
        return ingest.silver_flow(stream, "yellow", sink, ck, AS_OF, partitioned=False)
    run()
    commits = sorted(int(f) for f in os.listdir(os.path.join(ck, "commits")) if f.isdigit())
    for f in (os.path.join(ck, "commits", str(commits[-1])), os.path.join(ck, "commits", f".{commits[-1]}.crc")):
        if os.path.exists(f):
            os.remove(f)
    run()
    got = spark.read.parquet(sink)
    want = M.silver(M.bronze(raw), "yellow", AS_OF)
    cols = sorted(want.columns)
    assert got.count() == want.count()
    assert got.select(cols).exceptAll(want.select(cols)).count() == 0


def test_read_quarantine_skips_flows_not_written(spark, scratch):
    target = os.path.join(scratch, "q")
    spark.createDataFrame([], "pickup_datetime TIMESTAMP").write.parquet(os.path.join(target, "flow=yellow"))
    assert ingest.read_quarantine(spark, target).count() == 0
    assert ingest.read_quarantine(spark, os.path.join(scratch, "none")).columns[-1] == "_quarantined_at"
