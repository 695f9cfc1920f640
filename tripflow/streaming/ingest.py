"""Structured Streaming flows: bronze ingest, silver (watermark dedup + rules)
and the multi-writer quarantine target.

Every flow is a triggered run (``availableNow``): it processes the files not
yet recorded in its checkpoint and stops, so re-running without new input
adds nothing, and a run killed midway (or an executor lost) resumes from the
checkpoint with exactly-once file sinks. Rule counts are collected through
``observe``, summed over micro-batches.
"""

from __future__ import annotations

import json
import os
import threading
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tripflow import config
from tripflow.functions.rules import RULES, RuleSet, bronze_rules
from tripflow.operators.conform import conform_for_quarantine, conform_trips
from tripflow.operators.dedup import dedup_stream
from tripflow.operators.quality import KEPT, apply_rules, committed_metrics, flagged, metrics_from_observed, observe_rules
from tripflow.operators.quarantine import quarantine_trips
from tripflow.operators.tables import Table, Written
from tripflow.plans.medallion import bronze
from tripflow.sources.files import read_landed, schema_of, stream_landed

Write = Callable[[DataFrame, str], None]
_SEED = "_tripflow_seed"

REPORTS_S = 60.0  # the last reports follow a query's end within this


class Reports(StreamingQueryListener):
    """Every progress report of one query, however many there are: the query itself keeps
    the last hundred only. Reports arrive in order, the query's end after them."""

    def __init__(self, spark: SparkSession):
        self._spark, self._by_run, self._ended = spark, {}, {}
        self._lock = threading.Lock()
        spark.streams.addListener(self)

    def _end(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self._lock:
            self._by_run.setdefault(str(event.progress.runId), {})[event.progress.batchId] = event.progress

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def of(self, q: StreamingQuery) -> list:
        """The reports of a query that has ended, by batch."""
        if not self._end(str(q.runId)).wait(REPORTS_S):
            raise TimeoutError(f"the reports of stream {q.name} did not arrive")
        self._spark.streams.removeListener(self)
        found = self._by_run.get(str(q.runId), {})
        return [found[b] for b in sorted(found)]


@dataclass
class FlowResult:
    name: str
    sink: str
    num_output_rows: int = 0
    seconds: float = 0.0
    batches: int = 0
    observed: dict = field(default_factory=dict)
    dropped_by_watermark: int = 0
    dropped_duplicates: int = 0
    progresses: list = field(default_factory=list, repr=False)


def _sum_observed(progresses, name: str) -> dict:
    total: dict = {}
    for p in progresses:
        row = (p.observedMetrics or {}).get(name)
        if row is None:
            continue
        for k, v in row.asDict().items():
            if isinstance(v, (int, float)) or v is None:
                total[k] = total.get(k, 0) + (v or 0)
    return total


def start_available_now(df: DataFrame, sink: str, checkpoint: str, name: str,
                        partition_cols: list[str] | None = None) -> StreamingQuery:
    """Start appending ``df`` to a parquet sink; the query stops by itself
    once the input available at start is consumed."""
    w = (df.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).queryName(name)
         .trigger(availableNow=True))
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    return _started(df.sparkSession, lambda: w.start(sink))


def _started(spark: SparkSession, start: Callable[[], StreamingQuery]) -> StreamingQuery:
    """A query whose reports are all heard."""
    reports = Reports(spark)
    q = start()
    q.tripflow_reports = reports
    return q


def finish(q: StreamingQuery, sink: str, name: str, t0: float, observe_name: str | None = None,
           timeout_s: float | None = None) -> FlowResult:
    """Wait for a triggered query and total its progress reports."""
    if not q.awaitTermination(timeout_s):
        if timeout_s is not None:
            q.stop()
            raise TimeoutError(f"stream {name} did not finish within {timeout_s}s")
    if q.exception() is not None:
        raise q.exception()
    progresses = q.tripflow_reports.of(q)
    res = FlowResult(name=name, sink=sink, seconds=time.time() - t0, batches=len(progresses),
                     progresses=progresses)
    res.num_output_rows = sum(int(p.numInputRows or 0) for p in progresses)
    for p in progresses:
        for s in p.stateOperators or []:
            res.dropped_by_watermark += int(s.numRowsDroppedByWatermark or 0)
            res.dropped_duplicates += int((s.customMetrics or {}).get("numDroppedDuplicateRows", 0) or 0)
    if observe_name:
        res.observed = _sum_observed(progresses, observe_name)
    return res


def run_available_now(df: DataFrame, sink: str, checkpoint: str, name: str,
                      partition_cols: list[str] | None = None, observe_name: str | None = None,
                      timeout_s: float | None = None) -> FlowResult:
    t0 = time.time()
    q = start_available_now(df, sink, checkpoint, name, partition_cols)
    return finish(q, sink, name, t0, observe_name, timeout_s)


def start_into(df: DataFrame, table: Table, write: Write, checkpoint: str, name: str, kept: str | None = None,
               made: Callable[[DataFrame], DataFrame] = lambda batch: batch) -> tuple[StreamingQuery, list[Written]]:
    """Start appending ``df`` (what ``made`` makes of a micro-batch) to a published table, a
    part per micro-batch (a batch that is run again is written once); the list fills with
    what each has committed."""
    done: list[Written] = []
    w = (df.writeStream.foreachBatch(lambda batch, i: done.append(table.append(made(batch), i, write, kept)))
         .option("checkpointLocation", checkpoint).queryName(name).trigger(availableNow=True))
    return _started(df.sparkSession, w.start), done


def finish_into(q: StreamingQuery, done: list[Written], table: Table, name: str, t0: float, rules: RuleSet | None = None) -> FlowResult:
    """Wait for the query; rows and rule counts are those of the committed files."""
    res = finish(q, table.root, name, t0)
    res.num_output_rows = sum(w.rows for w in done)
    if rules is not None:
        res.observed["metrics"] = committed_metrics([w.every for w in done if w.every is not None], rules)
    return res


def _landed(spark: SparkSession, schema) -> Callable[[DataFrame], DataFrame]:
    """The rows of a micro-batch of file names, with what drifted rescued."""
    return lambda batch: read_landed(spark, [r.path for r in batch.collect()], schema)  # names of new files only


def bronze_schema(table: Table, initial) -> T.StructType:
    """The raw columns that a bronze table has so far."""
    v = table.version()
    known = T.StructType.fromJson(json.loads(v.schema)) if v and v.schema else schema_of(initial)
    return T.StructType([f for f in known.fields if f.name != "_rescued_data"])


def bronze_into(spark: SparkSession, landing: str, taxi_type: str, table: Table, checkpoint: str, schema,
                max_files_per_trigger: int | None = None) -> FlowResult:
    """New landing files -> published bronze table, each micro-batch sorted by pickup time.
    Only new files' footers are read: columns that they add are added, values that don't
    fit their declared types are rescued."""
    t0, name = time.time(), f"bronze_{taxi_type}"
    write = lambda b, path: b.sortWithinPartitions(config.BRONZE_CLUSTER[taxi_type]).write.mode("overwrite").parquet(path)
    made = lambda batch: _landed(spark, bronze_schema(table, schema))(batch)  # noqa: E731 - the schema of that moment
    q, done = start_into(stream_landed(spark, landing, max_files_per_trigger), table, write, checkpoint, name, made=made)
    return finish_into(q, done, table, name, t0, bronze_rules(taxi_type))


def write_seed(spark: SparkSession, bronze_table: Table, taxi_type: str, delay: str = config.WATERMARK_DELAY) -> None:
    """Backfilled rows that a later replay could still meet in the dedup state: those
    within the watermark delay of the newest. Older replays are late and dropped as such."""
    rows, pickup = bronze_table.read(spark), config.BRONZE_CLUSTER[taxi_type]
    newest = rows.agg(F.max(pickup)).first()[0]
    since = F.lit(None if newest is None else str(newest)).cast(rows.schema[pickup].dataType) - F.expr(f"INTERVAL {delay}")
    rows.filter(F.col(pickup) >= since).write.mode("overwrite").parquet(bronze_table.seed_folder())


def _write_batch(batch: DataFrame, path: str, folders: list[str], salts: int = 16) -> None:
    """A micro-batch, a few files a folder: streams run without AQE, so that a hot folder
    (a month) is spread by a hash of the pickup time instead of a rebalance."""
    salt = F.pmod(F.hash("pickup_datetime"), F.lit(salts))
    (batch.repartition(*folders, salt).sortWithinPartitions(*folders, "pickup_datetime")
     .write.mode("overwrite").partitionBy(*folders).parquet(path))


def silver_into(spark: SparkSession, schema, taxi_type: str, bronze_table: Table, table: Table, checkpoint: str,
                as_of=None) -> FlowResult:
    """What the bronze table's stream added -> published silver table. Seed rows pass
    through the dedup state and the watermark, and end there."""
    feed = spark.readStream.schema(schema).parquet(bronze_table.feed())
    feed = feed.withColumn(_SEED, F.col("_metadata.file_path").contains("/seed-e"))
    deduped = dedup_stream(conform_trips(feed, taxi_type, as_of), config.DEDUP_KEYS[taxi_type], "pickup_datetime")
    checked = flagged(deduped.filter(~F.col(_SEED)).drop(_SEED), RULES[taxi_type])
    t0, name = time.time(), f"silver_{taxi_type}"
    # No batch without rows, just to drop old keys from all state partitions: the next rows' batch
    # starts at the same watermark and drops them then. A key holds its pickup time, so that
    # what an old key would have met is late by then.
    setting = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")  # read as the query starts
    try:
        q, done = start_into(checked, table, lambda b, path: _write_batch(b, path, [KEPT, *config.SILVER_PARTITIONS[taxi_type]]),
                             checkpoint, name, KEPT)
    finally:
        spark.conf.set(setting, before)
    return finish_into(q, done, table, name, t0, RULES[taxi_type])


def quarantine_into(spark: SparkSession, landing: dict[str, str], schemas: dict, tables: dict[str, Table], checkpoint_root: str,
                    as_of=None, max_files_per_trigger: int | None = None) -> dict[str, FlowResult]:
    """The four quarantine flows, each from its raw files into its published table, concurrently."""
    t0, started = time.time(), {}
    for t, path in landing.items():
        def made(batch: DataFrame, t: str = t) -> DataFrame:
            return quarantine_trips(conform_for_quarantine(_landed(spark, schemas[t])(batch), t), t, as_of)

        started[t] = start_into(stream_landed(spark, path, max_files_per_trigger), tables[t],
                                lambda b, path: b.write.mode("overwrite").parquet(path),
                                os.path.join(checkpoint_root, f"quarantine_{t}"), f"quarantine_{t}", made=made)
    results = {}
    for t, (q, done) in started.items():
        results[t] = finish_into(q, done, tables[t], f"quarantine_{t}", t0)
    return results


def bronze_flow(raw_stream: DataFrame, taxi_type: str, sink: str, checkpoint: str) -> FlowResult:
    """Raw file stream -> bronze table (+ ``_rescued_data``), counting the
    rescued-data expectation."""
    rules = bronze_rules(taxi_type)
    df = observe_rules(bronze(raw_stream), rules, f"bronze_{taxi_type}")
    res = run_available_now(df, sink, checkpoint, f"bronze_{taxi_type}",
                            observe_name=f"bronze_{taxi_type}")
    res.num_output_rows = int(res.observed.get("n", 0))
    return res


def silver_stream_frame(bronze_stream: DataFrame, taxi_type: str, as_of=None,
                        delay: str = config.WATERMARK_DELAY) -> tuple[DataFrame, RuleSet]:
    """Conform -> watermark dedup -> observe all rules -> drop failures."""
    rules = RULES[taxi_type]
    conf = conform_trips(bronze_stream, taxi_type, as_of)
    deduped = dedup_stream(conf, config.DEDUP_KEYS[taxi_type], "pickup_datetime", delay)
    observed = observe_rules(deduped, rules, f"silver_{taxi_type}")
    kept = apply_rules(observed, rules)
    return kept.observe(f"silver_{taxi_type}_out", F.count(F.lit(1)).alias("rows")), rules


def silver_flow(bronze_stream: DataFrame, taxi_type: str, sink: str, checkpoint: str,
                as_of=None, partitioned: bool = True) -> FlowResult:
    df, rules = silver_stream_frame(bronze_stream, taxi_type, as_of)
    res = run_available_now(df, sink, checkpoint, f"silver_{taxi_type}",
                            partition_cols=config.SILVER_PARTITIONS[taxi_type] if partitioned else None,
                            observe_name=f"silver_{taxi_type}")
    res.observed["metrics"] = metrics_from_observed(res.observed, rules)
    out_name = f"silver_{taxi_type}_out"
    res.num_output_rows = int(_sum_observed(res.progresses, out_name).get("rows", 0))
    return res


def quarantine_flows(raw_streams: dict[str, DataFrame], target: str, checkpoint_root: str,
                     as_of=None, complete: bool = False) -> dict[str, FlowResult]:
    """One append flow per source into one quarantine target. Each flow owns
    a subdirectory (file sinks keep a per-directory commit log) and a
    checkpoint; ``read_quarantine`` reads them back as one table."""
    t0 = time.time()
    started = {}
    for t, raw in raw_streams.items():
        conf = conform_trips(raw, t) if complete else conform_for_quarantine(raw, t)
        df = quarantine_trips(conf, t, as_of, complete).observe(f"quarantine_{t}", F.count(F.lit(1)).alias("rows"))
        sink = os.path.join(target, f"flow={t}")
        started[t] = (start_available_now(df, sink, os.path.join(checkpoint_root, f"quarantine_{t}"),
                                          f"quarantine_{t}"), sink)
    # The flows run concurrently; wait for all of them.
    results = {t: finish(q, sink, f"quarantine_{t}", t0, f"quarantine_{t}") for t, (q, sink) in started.items()}
    for r in results.values():
        r.num_output_rows = int(r.observed.get("rows", 0))
    return results


def read_quarantine(spark: SparkSession, target: str, flows=config.TAXI_TYPES) -> DataFrame:
    """Union of the flow subdirectories, each read through its sink log; a
    flow that has not written yet is skipped."""
    from tripflow.session import path_exists
    frames = [spark.read.parquet(os.path.join(target, f"flow={t}")) for t in flows
              if path_exists(spark, os.path.join(target, f"flow={t}"))]
    if not frames:
        return spark.createDataFrame([], config.QUARANTINE_DDL)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
