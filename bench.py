"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` (default 8): one warm-up, then the median of
``$BENCH_REPS`` (default 3) timed runs. Each run executes the whole plan into
the ``noop`` sink (nothing is collected to the driver). Rows out come from an
``Observation`` on that write; input rows and shuffle bytes from Spark's
event log (written to a scratch folder, attributed per query through job
groups). Prints ONE JSON line.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Observation  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tripflow.plans import catalog  # noqa: E402
from tripflow.plans.pipeline import run_batch_pipeline  # noqa: E402
from tripflow.session import get_session, work_path  # noqa: E402

HEADLINE = [
    "silver_yellow", "silver_fhvheavy", "dq_metrics_fhvheavy", "quarantine_complete",
    "gold_daily_borough", "gold_hourly_demand", "gold_airport", "gold_zone_revenue",
    "gold_payment_trends", "gold_trip_type", "srv_daily_revenue", "top20_daily",
    "audit_dq_log", "audit_sla", "change_feed", "pk_violations", "dedup_stream", "stream_ingest",
]


def _run(spark, fn, sf, group: str | None = None) -> tuple[float, int]:
    if group:
        spark.sparkContext.setJobGroup(group, group)
    obs = Observation("bench")
    t = time.perf_counter()
    fn(spark, sf).observe(obs, F.count(F.lit(1)).alias("rows")).write.format("noop").mode("overwrite").save()
    secs = time.perf_counter() - t
    return secs, int(obs.get["rows"])


def _event_metrics(log_dir: str, windows: dict[str, tuple[float, float]]) -> dict[str, dict]:
    """Per job group: input rows/bytes and shuffle bytes written, summed over
    the tasks of that group's jobs. Jobs submitted from other threads (the
    pipeline's concurrent flows) carry no group: ``windows`` attributes them
    by submission time."""
    stage_group: dict[int, str] = {}
    out: dict[str, dict] = {}
    files = sorted(p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True) if os.path.isfile(p))
    for path in files:  # rolling logs: a directory of event files
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    g = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    if not g:
                        t = ev.get("Submission Time", 0) / 1000.0
                        g = next((n for n, (a, b) in windows.items() if a <= t <= b), None)
                    if g:
                        for sid in ev.get("Stage IDs", []):
                            stage_group[sid] = g
                elif kind == "SparkListenerTaskEnd":
                    g = stage_group.get(ev.get("Stage ID"))
                    m = ev.get("Task Metrics") or {}
                    if not g or not m:
                        continue
                    acc = out.setdefault(g, {"input_rows": 0, "input_bytes": 0, "shuffle_bytes": 0})
                    acc["input_rows"] += (m.get("Input Metrics") or {}).get("Records Read", 0)
                    acc["input_bytes"] += (m.get("Input Metrics") or {}).get("Bytes Read", 0)
                    acc["shuffle_bytes"] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
    return out


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    log_dir = tempfile.mkdtemp(prefix="tripflow-eventlog-")
    conf = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
            "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
            "spark.eventLog.compress": "false"}
    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus, app_name="tripflow-bench", extra=conf)
    qs = catalog.queries()
    results, rows = {}, {}
    for name in HEADLINE:
        _run(spark, qs[name], sf)
        times = []
        for i in range(reps):
            secs, n = _run(spark, qs[name], sf, f"{name}#0" if i == 0 else "other")
            times.append(secs)
        results[name] = round(statistics.median(times), 3)
        rows[name] = n
    # End to end: every table of a full batch update written as parquet.
    spark.sparkContext.setJobGroup("full_update#0", "pipeline")
    t, w0 = time.perf_counter(), time.time()
    run_batch_pipeline(spark, sf, work_path(spark, "bench_pipeline"))
    results["full_update"] = round(time.perf_counter() - t, 3)
    window = {"full_update#0": (w0, time.time())}
    spark.stop()
    metrics = _event_metrics(log_dir, window)
    details = {}
    for name in results:
        m = metrics.get(f"{name}#0", {})
        details[name] = {"rows_out": rows.get(name), "input_rows": m.get("input_rows"),
                         "shuffle_bytes": m.get("shuffle_bytes")}
    sf_label = os.path.basename(sf.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(results.values()), 3),
                      "unit": "sec", "queries": results, "sf": sf_label, "cpus": cpus, "reps": reps,
                      "details": details,
                      "conf": {"master": f"local[{cpus}]", "spark.sql.shuffle.partitions": cpus,
                               "spark.sql.adaptive.enabled": True}}))


if __name__ == "__main__":
    main()
