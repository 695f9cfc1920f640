"""Published tables: versions, parts, and what a stopped writer leaves behind."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tripflow import config
from tripflow.operators.quality import KEPT
from tripflow.operators.storage import write_rebalanced
from tripflow.operators.tables import Table
from tripflow.plans.pipeline import read_table, run_batch_pipeline, run_stream_pipeline, table, write_landing
from tripflow.sources import fixtures
from tripflow.sources.files import RAW_SCHEMAS

AS_OF = "2025-01-01 00:00:00"


def _ids(df):
    return sorted(r.id for r in df.collect())


def _write(df, path):
    df.write.mode("overwrite").parquet(path)


def test_parts_are_read_as_published(spark, scratch):
    t = Table(spark, scratch)
    assert t.version() is None
    with pytest.raises(ValueError):
        t.read()
    assert t.append(spark.range(3), 0, _write).rows == 3
    assert t.append(spark.range(0), 1, _write).rows == 0          # an empty batch is no part
    assert t.append(spark.range(3, 5).withColumn("x", F.lit(1)), 2, _write).rows == 2
    assert _ids(t.read()) == [0, 1, 2, 3, 4] and t.read().columns == ["id", "x"]
    # what no version names isn't read, nor what a batch that runs again would write
    spark.range(99, 100).write.parquet(f"{t.root}/{t.version().folder}/part=s000000007")
    assert t.append(spark.range(50), 2, _write).rows == 0
    assert _ids(t.read()) == [0, 1, 2, 3, 4]


def test_a_batch_that_runs_again_is_written_once(spark, scratch):
    t = Table(spark, scratch)

    def stops(df, path):
        df.limit(2).write.mode("overwrite").parquet(path)
        raise OSError("lost")

    with pytest.raises(OSError):
        t.append(spark.range(5), 0, stops)
    assert t.version() is None
    assert t.append(spark.range(5), 0, _write).rows == 5 and _ids(t.read()) == [0, 1, 2, 3, 4]
    t.compacted(_write, lambda df: df.filter("id > 0"))
    assert t.append(spark.range(5), 0, _write).rows == 0 and _ids(t.read()) == [1, 2, 3, 4]
    assert t.append(spark.range(9, 10), 1, _write).rows == 1 and _ids(t.read()) == [1, 2, 3, 4, 9]


def test_a_stopped_replacement_leaves_the_old_rows(spark, scratch):
    t = Table(spark, scratch)
    t.replace(spark.range(2).write.parquet)
    before = t.data_folder()

    def stops(folder):
        spark.range(7).write.parquet(folder)
        raise OSError("lost")

    with pytest.raises(OSError):
        t.replace(stops)
    assert t.data_folder() == before and _ids(t.read()) == [0, 1]
    held = t.version()
    t.replace(spark.range(3).write.parquet)
    assert _ids(t.read()) == [0, 1, 2] and _ids(t.read(version=held)) == [0, 1]   # old readers go on
    with pytest.raises(RuntimeError):
        t.publish(held)                                                           # another writer came first


def _yellow(at, n, fare=9.0, step=1):
    rows = [(at + dt.timedelta(minutes=step * i), at + dt.timedelta(minutes=step * i + 12), 10 + i % 50, 20, 1, 1, 2.0, fare, 11.0, 1)
            for i in range(n)]
    return rows


@pytest.fixture
def history(spark, scratch):
    """A backfill of ten days of yellow trips; other sources are empty."""
    at = dt.datetime(2024, 3, 1, 6)
    rows = [r for day in range(10) for r in _yellow(at + dt.timedelta(days=day), 20)]
    raw = {t: spark.createDataFrame(rows if t == "yellow" else [], RAW_SCHEMAS[t]) for t in config.TAXI_TYPES}
    zones, root = fixtures.raw_zones(spark, SF_SMALL), os.path.join(scratch, "tables")
    run_batch_pipeline(spark, None, root, raw=raw, raw_zones=zones, as_of=AS_OF, flow_confs={})
    landing = {t: os.path.join(scratch, "landing", t) for t in config.TAXI_TYPES}
    for t in config.TAXI_TYPES:
        write_landing(spark.createDataFrame([], RAW_SCHEMAS[t]), landing[t], files=1)
    return at, rows, landing, lambda: run_stream_pipeline(spark, landing, zones, root, as_of=AS_OF, flow_confs={})


def test_stream_goes_on_from_a_backfill(spark, history):
    """Replays of the last day (known to the state) and of the first (late) add nothing;
    new trips do. Nothing of the backfill is lost to readers."""
    at, rows, landing, update = history
    paths = update()
    assert read_table(spark, paths, "silver.yellow_trips").count() == 200
    new = _yellow(at + dt.timedelta(days=9, hours=3), 5)
    bad = [(at + dt.timedelta(days=9, hours=4), None, 10, 20, 1, 1, 2.0, 9.0, 11.0, 1)]
    replays = _yellow(at + dt.timedelta(days=9), 20, fare=8.0) + rows[:20]
    write_landing(spark.createDataFrame(new + bad + replays, RAW_SCHEMAS["yellow"]), landing["yellow"], files=2)
    paths = update()
    silver = read_table(spark, paths, "silver.yellow_trips")
    assert silver.count() == 205 and silver.filter("fare_amount = 8.0").isEmpty()
    assert read_table(spark, paths, "bronze.yellow_trips_raw").count() == 200 + 46
    assert read_table(spark, paths, "silver.quarantine_trips").count() == 1
    assert spark.read.parquet(paths["gold.payment_trends"]).agg(F.sum("trip_count")).first()[0] == 205
    update()   # no new files: nothing changes
    assert read_table(spark, paths, "silver.yellow_trips").count() == 205


def test_second_backfill_starts_anew_and_a_half_one_is_refused(spark, history, scratch):
    at, rows, landing, update = history
    paths = update()
    bronze, silver = (table(spark, paths, n) for n in ("bronze.yellow_trips_raw", "silver.yellow_trips"))
    bronze.refill(bronze.read(), _write)
    with pytest.raises(RuntimeError, match="backfill of yellow"):
        update()
    silver.refill(silver.read().filter("pickup_location_id < 20").withColumn(KEPT, F.lit(True)), lambda df, path: write_rebalanced(
        df, path, [KEPT, *config.SILVER_PARTITIONS["yellow"]]), KEPT, restart=True)
    kept = silver.read().count()
    write_landing(spark.createDataFrame(_yellow(at + dt.timedelta(days=9), 20) + _yellow(at + dt.timedelta(days=11), 3), RAW_SCHEMAS["yellow"]),
                  landing["yellow"], files=1)
    paths = update()
    assert read_table(spark, paths, "silver.yellow_trips").count() == kept + 3


def test_logged_rule_counts_are_of_committed_rows(spark, scratch):
    """Rule counts of an update are those of the rows after dedup, as committed: the dropped
    ones lie beside the table's."""
    from tripflow.plans import medallion as M
    landing = {t: os.path.join(scratch, "landing", t) for t in config.TAXI_TYPES}
    raw = fixtures.all_raw_trips(spark, SF_SMALL)
    for t in config.TAXI_TYPES:
        write_landing(raw[t], landing[t], files=1)
    paths = run_stream_pipeline(spark, landing, fixtures.raw_zones(spark, SF_SMALL), os.path.join(scratch, "tables"),
                                as_of=AS_OF, flow_confs={})
    log = spark.read.parquet(paths["audit.data_quality_log"])
    for t in config.TAXI_TYPES:
        want = {r.rule_name: (r.passed_records, r.failed_records) for r in M.silver_metrics(M.bronze(raw[t]), t, AS_OF).collect()}
        got = {r.expectation_name: (r.passed_records, r.failed_records) for r in log.filter(F.col("dataset_name") == f"silver.{t}_trips").collect()}
        assert got == want and any(failed for _, failed in want.values())
    dropped = spark.read.parquet(os.path.join(os.path.dirname(paths["silver.yellow_trips"])))
    assert {r[0]: r[1] for r in dropped.groupBy("_tripflow_kept").count().collect()} == {"true": 175, "false": 35}
