"""One pipeline update, tables materialised in dependency order.

    raw -> bronze(4) -> silver(4) -> gold(6)      zone raw -> bronze -> silver
    raw -> quarantine (4 flows)                   event log -> audit(5)

Two modes share every transformation:

* ``run_batch_pipeline``: backfill from raw DataFrames (batch dedup).
* ``run_stream_pipeline``: triggered (availableNow) file streams from landing
  directories into bronze, silver and quarantine, with checkpoints so a rerun
  only processes new files; gold and audit are then recomputed in batch.

Layout choices for scale: bronze files are sorted by pickup time within each
task (no ingest shuffle; full clustering is the compaction job's work);
silver is hive-partitioned and rebalanced on its partition columns before the
write (AQE splits a hot month, coalesces small ones); gold tables are small and range-clustered on their filter
columns. Tables are published versions (``operators.tables``): readers see a table whole
or as it was. A stream that follows a backfill first gets the backfill's recent keys into
its dedup state. Rules are counted over committed files, so a repeated task counts once.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import os
import time
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from tripflow import config
from tripflow.functions.rules import RULES, bronze_rules
from tripflow.operators import audit
from tripflow.operators.conform import conform_trips, conform_zones
from tripflow.operators.dedup import dedup_trips
from tripflow.operators.marts import build, union_all
from tripflow.operators.marts import specs as mart_specs
from tripflow.operators.quality import KEPT, apply_rules, committed_metrics, flagged, rule_metrics
from tripflow.operators.storage import write_clustered, write_rebalanced
from tripflow.operators.tables import Table, Version, Written, resolved
from tripflow.plans import medallion as M
from tripflow.sources import fixtures
from tripflow.sources.files import RAW_SCHEMAS, merge_schema
from tripflow.streaming import ingest


def table_paths(root: str) -> dict[str, str]:
    p = {}
    for t in config.TAXI_TYPES:
        p[f"bronze.{t}_trips_raw"] = os.path.join(root, "bronze", f"{t}_trips_raw")
        p[f"silver.{t}_trips"] = os.path.join(root, "silver", f"{t}_trips")
    p["bronze.zone_lookup_raw"] = os.path.join(root, "bronze", "zone_lookup_raw")
    p["silver.zone_lookup"] = os.path.join(root, "silver", "zone_lookup")
    p["silver.quarantine_trips"] = os.path.join(root, "silver", "quarantine_trips")
    for m in config.MART_DDL:
        p[f"gold.{m}"] = os.path.join(root, "gold", m)
    p["audit.event_log"] = os.path.join(root, "audit", "event_log")
    for v in ("pipeline_run_log", "data_quality_log", "row_count_log", "sla_monitoring", "error_log"):
        p[f"audit.{v}"] = os.path.join(root, "audit", v)
    p["_checkpoints"] = os.path.join(root, "_checkpoints")
    p["_root"] = root
    return p


def table(spark: SparkSession, paths: dict[str, str], name: str) -> Table:
    """The published table of this name, whichever version ``paths`` points at."""
    return Table(spark, table_paths(paths["_root"])[name])


def quarantine_tables(spark: SparkSession, folder: str) -> dict[str, Table]:
    """The four sources' tables in a version of the quarantine table."""
    return {t: Table(spark, os.path.join(folder, f"flow={t}")) for t in config.TAXI_TYPES}


def quarantine_flow_tables(spark: SparkSession, paths: dict[str, str]) -> dict[str, Table]:
    """Those of the current version, which is made if there is none yet."""
    whole = table(spark, paths, "silver.quarantine_trips")
    if whole.version() is None:
        whole.replace(lambda folder: None)  # the flows fill it
    return quarantine_tables(spark, whole.data_folder())


def current_paths(spark: SparkSession, root: str) -> dict[str, str]:
    """Where each table's current data lies: a snapshot that stays readable."""
    return resolved(spark, table_paths(root))


@contextlib.contextmanager
def flow_conf(spark: SparkSession, conf: dict[str, str] | None):
    """Per-flow Spark confs, restored afterwards."""
    old = {k: spark.conf.get(k, None) for k in (conf or {})}
    for k, v in (conf or {}).items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


class EventRecorder:
    """Collects flow/update events of one update (run metadata, not data)."""

    def __init__(self, update_id: str):
        self.update_id = update_id
        self.records: list[dict] = []
        self.started = time.time()
        self.run_type = "full_refresh"
        self._lock = threading.Lock()

    def _add(self, event_type: str, details: str, level: str = "INFO", message: str = ""):
        with self._lock:
            self.records.append({"id": uuid.uuid4().hex, "timestamp": dt.datetime.now(dt.timezone.utc).replace(tzinfo=None),
                                 "event_type": event_type, "level": level, "message": message,
                                 "details": details})

    def flow(self, name: str, rows: int | None, seconds: float, metrics: list[dict] | None = None,
             status: str = config.STATUS_COMPLETED, extra_metrics: dict | None = None):
        exps = [{"name": m["rule_name"], "dataset": m["dataset"], "passed_records": m["passed_records"],
                 "failed_records": m["failed_records"]} for m in (metrics or [])]
        self._add(config.EVENT_FLOW, audit.flow_details(name, status, rows, round(seconds, 3), exps, extra_metrics))

    def error(self, name: str, message: str):
        self._add(config.EVENT_FLOW, audit.flow_details(name, "FAILED"), level=config.LEVEL_ERROR, message=message)

    def guard(self, fn, flow_pattern: str):
        """``fn(item)`` that records an ERROR flow event before re-raising."""
        def run(item):
            try:
                return fn(item)
            except Exception as e:  # noqa: BLE001 - recorded, then re-raised
                self.error(flow_pattern.format(item), f"{type(e).__name__}: {e}")
                raise
        return run

    def update(self, state: str, run_type: str):
        self._add(config.EVENT_UPDATE, audit.update_details(
            self.update_id, state, run_type, "API_CALL",
            dt.datetime.fromtimestamp(self.started, dt.timezone.utc).isoformat(), round(time.time() - self.started, 3)))


@contextlib.contextmanager
def recorded_failure(spark: SparkSession, paths: dict[str, str], rec: EventRecorder):
    """On failure: mark the update FAILED, append its events (the error
    events included) to the event log, re-raise."""
    try:
        yield
    except Exception:
        rec.update("FAILED", rec.run_type)
        audit.events_from_records(spark, rec.records).write.mode("append").parquet(paths["audit.event_log"])
        raise


def _timed_write(fn) -> float:
    t = time.time()
    fn()
    return time.time() - t


def _write_silver(df: DataFrame, taxi_type: str, path: str) -> None:
    write_rebalanced(df, path, [KEPT, *config.SILVER_PARTITIONS[taxi_type]], ["pickup_datetime"])


def written_rows(spark: SparkSession, path: str) -> int:
    """Rows of a table, from its files' footers."""
    return spark.read.parquet(path).count()


def refresh_gold(spark: SparkSession, paths: dict[str, str], rec: EventRecorder | None = None) -> None:
    """Recompute all marts from silver. A mart that failed or was never written is
    whole again after the next update, whatever had reached silver before."""
    zones = table(spark, paths, "silver.zone_lookup").read()
    silver_s = {t: table(spark, paths, f"silver.{t}_trips").read() for t in config.TAXI_TYPES}
    specs = mart_specs()

    def one(name: str) -> None:
        spec, mart = specs[name], table(spark, paths, f"gold.{name}")
        secs = _timed_write(lambda: mart.replace(lambda folder: write_clustered(
            build(spec, silver_s, zones if spec.zones else None), folder, config.MART_CLUSTER[name])))
        if rec is not None:
            rec.flow(f"gold.{name}", written_rows(spark, mart.data_folder()), secs)

    _run_all(rec.guard(one, "gold.{}") if rec is not None else one, specs, concurrent=True)


def _gold_and_audit(spark: SparkSession, paths: dict[str, str], rec: EventRecorder, as_of=None) -> None:
    refresh_gold(spark, paths, rec)
    rec.update(config.STATUS_COMPLETED, rec.run_type)
    audit.events_from_records(spark, rec.records).write.mode("append").parquet(paths["audit.event_log"])
    # the shared event view: one scan serves the five audit views (the log
    # holds a few dozen events per update, so caching it is cheap)
    ev = spark.read.parquet(paths["audit.event_log"]).cache()
    views = dict(audit.AUDIT_VIEWS)
    views["sla_monitoring"] = lambda e: audit.sla_monitoring(e, as_of)
    try:
        _run_all(lambda name: table(spark, paths, f"audit.{name}").replace(views[name](ev).write.parquet),
                 views, concurrent=True)
    finally:
        ev.unpersist()


def flow_session(spark: SparkSession, conf: dict[str, str] | None = None) -> SparkSession:
    """A session for one flow: same SparkContext (executors, cache), its own
    SQL confs (the parent's plus the flow's), so concurrent flows don't see
    each other's settings (e.g. the largest source's shuffle partitions)."""
    s = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if k.startswith("spark.sql.") and s.conf.isModifiable(k):
            s.conf.set(k, v)
    for k, v in (conf or {}).items():
        s.conf.set(k, v)
    return s


def _source_flows(s: SparkSession, t: str, raw_t: DataFrame, paths: dict[str, str], as_of,
                  rec: EventRecorder) -> None:
    """bronze -> silver and the quarantine flow of one source."""
    # bronze: raw + rescued column, locally sorted by pickup time (no ingest shuffle)
    bronze, silver = (table(s, paths, n) for n in (f"bronze.{t}_trips_raw", f"silver.{t}_trips"))
    quarantined = quarantine_flow_tables(s, paths)[t]
    done: list[Written] = []
    secs = _timed_write(lambda: done.append(bronze.refill(M.bronze(raw_t), lambda df, path: df.sortWithinPartitions(
        config.BRONZE_CLUSTER[t]).write.parquet(path))))
    rec.flow(f"bronze.{t}_trips_raw", done[-1].rows, secs, committed_metrics([done[-1].every], bronze_rules(t)))
    bronze_t = bronze.read(s)
    # silver: conform -> dedup -> flag by the drop rules -> rebalanced partitioned write. Dropped
    # rows lie beside the table, so that rules are counted over what was committed.
    deduped = flagged(dedup_trips(conform_trips(bronze_t, t, as_of), t), RULES[t])
    secs = _timed_write(lambda: done.append(silver.refill(deduped, lambda df, path: _write_silver(df, t, path), KEPT, restart=True)))
    rec.flow(f"silver.{t}_trips", done[-1].rows, secs, committed_metrics([done[-1].every], RULES[t]))
    # quarantine flow, from the same raw rows as bronze
    q = M.quarantine(bronze_t, t, as_of)
    secs = _timed_write(lambda: done.append(quarantined.refill(q, lambda df, path: df.write.parquet(path))))
    rec.flow(f"silver.quarantine_{t}", done[-1].rows, secs)


def _zone_flows(spark: SparkSession, raw_zones: DataFrame, paths: dict[str, str], as_of, rec: EventRecorder) -> None:
    """bronze -> silver of the zone dimension, the same in both modes."""
    def run(_: str) -> None:
        bronze, silver = (table(spark, paths, n) for n in ("bronze.zone_lookup_raw", "silver.zone_lookup"))
        secs = _timed_write(lambda: bronze.replace(raw_zones.write.parquet))
        rec.flow("bronze.zone_lookup_raw", written_rows(spark, bronze.data_folder()), secs)
        zones = conform_zones(bronze.read(), as_of)
        secs = _timed_write(lambda: silver.replace(apply_rules(zones, RULES["zone"]).write.parquet))
        rec.flow("silver.zone_lookup", written_rows(spark, silver.data_folder()), secs,
                 [r.asDict() for r in rule_metrics(zones, RULES["zone"]).collect()])  # one row per rule

    rec.guard(run, "silver.{}_lookup")("zone")


def run_batch_pipeline(spark: SparkSession, sf_dir: str | None, root: str,
                       raw: dict[str, DataFrame] | None = None, raw_zones: DataFrame | None = None,
                       as_of=None, flow_confs: dict | None = None, concurrent: bool = True) -> dict[str, str]:
    """Backfill every table under ``root`` from raw frames (default: the
    test-data fixtures of ``sf_dir``, read in each flow's own session).

    The four source flows are independent and run as concurrent Spark jobs
    (one thread and one session each), so small sources don't leave the
    cluster idle while the largest one runs. Returns the table paths.
    """
    paths = table_paths(root)
    rec = EventRecorder(uuid.uuid4().hex[:12])
    rec.run_type = "full_refresh"
    rec.update("RUNNING", rec.run_type)
    raw_zones = raw_zones if raw_zones is not None else fixtures.raw_zones(spark, sf_dir)
    confs = config.FLOW_CONF if flow_confs is None else flow_confs

    def run(t: str) -> None:
        if raw is not None:  # caller's frames run under their own session
            with flow_conf(raw[t].sparkSession, confs.get(t)):
                _source_flows(raw[t].sparkSession, t, raw[t], paths, as_of, rec)
        else:
            s = flow_session(spark, confs.get(t))
            _source_flows(s, t, fixtures.raw_trips(s, sf_dir, t), paths, as_of, rec)

    with recorded_failure(spark, paths, rec):
        _zone_flows(spark, raw_zones, paths, as_of, rec)
        quarantine_flow_tables(spark, paths)
        _run_all(rec.guard(run, "silver.{}_trips"), config.TAXI_TYPES, concurrent and raw is None)
        _gold_and_audit(spark, paths, rec, as_of)
    return current_paths(spark, root)


def _run_all(fn, items, concurrent: bool) -> None:
    """Run ``fn`` over ``items`` (as concurrent Spark jobs when asked);
    re-raise the first failure."""
    items = list(items)
    if not concurrent or len(items) < 2:
        for it in items:
            fn(it)
        return
    with ThreadPoolExecutor(max_workers=len(items)) as ex:
        for f in [ex.submit(fn, it) for it in items]:
            f.result()


# --------------------------------------------------------------------------- streaming


def write_landing(df: DataFrame, path: str, files: int | None = None, mode: str = "append") -> None:
    """Drop raw rows into a landing directory as new parquet files, one per
    input partition (stand-in for the upstream producer); ``files`` asks for
    an exact file count (tests of file-by-file streaming)."""
    (df.repartition(files) if files else df).write.mode(mode).parquet(path)


def run_stream_pipeline(spark: SparkSession, landing: dict[str, str], zones_raw: DataFrame, root: str,
                        as_of=None, max_files_per_trigger: int | None = None,
                        flow_confs: dict | None = None) -> dict[str, str]:
    """Incremental update: each flow consumes only files it has not seen
    (checkpointed), then gold and audit are refreshed from silver.

    ``flow_confs`` (default ``config.FLOW_CONF``) are per-flow cluster
    settings. In a stateful stream the shuffle partition count is fixed at the
    checkpoint's first run and is the number of state-store partitions, so
    choose it for the target cluster before the first run (AQE does not
    resize streaming shuffles)."""
    confs = config.FLOW_CONF if flow_confs is None else flow_confs
    paths = table_paths(root)
    ck = paths["_checkpoints"]
    rec = EventRecorder(uuid.uuid4().hex[:12])
    rec.run_type = "incremental"
    rec.update("RUNNING", rec.run_type)

    def run(t: str) -> None:
        s = flow_session(spark, confs.get(t))
        bronze, silver = table(s, paths, f"bronze.{t}_trips_raw"), table(s, paths, f"silver.{t}_trips")
        have, kept = bronze.version() or Version(), silver.version() or Version()
        if have.epoch != kept.epoch:
            raise RuntimeError(f"the backfill of {t} trips stopped between bronze and silver: run it again first")
        def silver_schema():  # the bronze table's, as it is by then
            return merge_schema(ingest.bronze_schema(bronze, RAW_SCHEMAS[t]), "_rescued_data STRING")

        silver_checkpoint = os.path.join(ck, f"silver_{t}_e{have.epoch}")
        if not kept.seeded:  # the first update after a backfill: its keys enter the dedup state
            ingest.write_seed(s, bronze, t)
            ingest.silver_into(s, silver_schema(), t, bronze, silver, silver_checkpoint, as_of)
            silver.publish(replace(silver.version(), seeded=True))
        r = ingest.bronze_into(s, landing[t], t, bronze, os.path.join(ck, f"bronze_{t}"), RAW_SCHEMAS[t], max_files_per_trigger)
        rec.flow(f"bronze.{t}_trips_raw", r.num_output_rows, r.seconds, r.observed["metrics"])
        if bronze.version() is None:  # nothing has ever landed
            return
        r = ingest.silver_into(s, silver_schema(), t, bronze, silver, silver_checkpoint, as_of)
        rec.flow(f"silver.{t}_trips", r.num_output_rows, r.seconds, r.observed.get("metrics"),
                 extra_metrics={"num_rows_dropped_by_watermark": r.dropped_by_watermark,
                                "num_dropped_duplicate_rows": r.dropped_duplicates})

    with recorded_failure(spark, paths, rec):
        _zone_flows(spark, zones_raw, paths, as_of, rec)
        _run_all(rec.guard(run, "silver.{}_trips"), config.TAXI_TYPES, concurrent=True)
        for t, r in ingest.quarantine_into(spark, landing, RAW_SCHEMAS, quarantine_flow_tables(spark, paths), ck, as_of,
                                           max_files_per_trigger).items():
            rec.flow(f"silver.quarantine_{t}", r.num_output_rows, r.seconds)
        _gold_and_audit(spark, paths, rec, as_of)
    return current_paths(spark, root)


def read_table(spark: SparkSession, paths: dict[str, str], name: str) -> DataFrame:
    """The current rows of a table, all its parts; of the quarantine table, all its flows."""
    if name == "silver.quarantine_trips":
        return read_quarantine_table(spark, table_paths(paths["_root"]))
    return table(spark, paths, name).read()


def read_quarantine_table(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """All quarantine flows, in the version that ``paths`` points at (the current one, for
    ``table_paths``); a flow that never wrote is skipped."""
    whole = table(spark, paths, "silver.quarantine_trips")
    folder = paths["silver.quarantine_trips"] if paths["silver.quarantine_trips"] != whole.root else whole.data_folder()
    frames = [flow.read() for flow in quarantine_tables(spark, folder).values() if flow.version() is not None]
    return union_all(frames) if frames else spark.createDataFrame([], config.QUARANTINE_DDL)
