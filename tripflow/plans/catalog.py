"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator family. Each reads the shared test tables (through
``sources.fixtures``) in full, so its work grows with them.

Processing-time columns take fixed instants here (``AS_OF`` and friends) so
results are reproducible; in production they default to the current time.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow import config
from tripflow.operators import audit, serving, storage
from tripflow.operators.conform import conform_trips
from tripflow.operators.marts import MARTS, all_marts, build, spec, union_all
from tripflow.plans import medallion as M
from tripflow.session import work_path
from tripflow.sources import fixtures
from tripflow.sources.files import RAW_SCHEMAS, read_evolving, read_parquet_rescued, rescue
from tripflow.streaming import ingest

AS_OF = "2025-01-01 00:00:00"          # _created_at / _quarantined_at
SLA_AS_OF = "2024-02-01 00:00:00"      # "now" of the freshness check
PURGE_AS_OF = "2024-03-15 00:00:00"    # "now" of the retention purge
CHANGE_OLD_BEFORE = "2024-01-20 12:00:00"  # earlier version saw trips before this
CHANGE_NEW_FROM = "2024-01-02 00:00:00"    # later version no longer has the first day
EVOLVED_FROM = "2024-01-16 00:00:00"   # files from here on carry an extra column
TOP_N = 20
# State partitions of the registered stream runs: the session's shuffle
# partitions (the production flow conf pins 800, sized for a cluster).
STREAM_FLOW_CONF: dict = {}

Query = Callable[[SparkSession, str], DataFrame]


# --------------------------------------------------------------------------- building blocks


def _bronze(spark, sf, t):
    return M.bronze(fixtures.raw_trips(spark, sf, t))


def _silver(spark, sf, t):
    return M.silver(_bronze(spark, sf, t), t, AS_OF)


def _silver_all(spark, sf, types=config.TAXI_TYPES):
    """Silver frames of several sources, all derived from one read of the
    source table."""
    raw = fixtures.all_raw_trips(spark, sf, types)
    return {t: M.silver(M.bronze(raw[t]), t, AS_OF) for t in types}


def _bronze_all(spark, sf, types=config.TAXI_TYPES):
    raw = fixtures.all_raw_trips(spark, sf, types)
    return {t: M.bronze(raw[t]) for t in types}


def _zones(spark, sf):
    return M.silver_zones(fixtures.raw_zones(spark, sf), AS_OF)


def _mart(name):
    def q(spark, sf):
        sp = spec(name)
        s = _silver_all(spark, sf, sp.sources)   # only the sources the mart reads
        return build(sp, s, _zones(spark, sf) if sp.zones else None)
    return q


def _quarantine(spark, sf, t, complete=False):
    return M.quarantine(_bronze(spark, sf, t), t, AS_OF, complete)


# --------------------------------------------------------------------------- silver & dq


def q_silver(t):
    return lambda spark, sf: _silver(spark, sf, t)


def q_silver_zone(spark, sf):
    return _zones(spark, sf)


def q_dedup_batch(spark, sf):
    """Yellow after conform + batch dedup (before the drop rules)."""
    return M.deduplicated(_bronze(spark, sf, "yellow"), "yellow", AS_OF)


def q_duration_minutes(spark, sf):
    """Trip duration of every raw trip of every source."""
    b = _bronze_all(spark, sf)
    return union_all([
        conform_trips(b[t], t, AS_OF)
        .select("taxi_type", "pickup_datetime", "dropoff_datetime", "trip_duration_mins")
        for t in config.TAXI_TYPES])


def q_dq_metrics(t):
    return lambda spark, sf: M.silver_metrics(_bronze(spark, sf, t), t, AS_OF)


def q_dq_metrics_zone(spark, sf):
    return M.zone_metrics(fixtures.raw_zones(spark, sf), AS_OF)


def q_dq_metrics_bronze(spark, sf):
    """Rescued-data expectation on every bronze table."""
    from tripflow.functions.rules import bronze_rules
    from tripflow.operators.quality import rule_metrics
    b = _bronze_all(spark, sf)
    return union_all([rule_metrics(b[t], bronze_rules(t)) for t in config.TAXI_TYPES])


# --------------------------------------------------------------------------- quarantine


def q_quarantine(t):
    return lambda spark, sf: _quarantine(spark, sf, t)


def q_quarantine_all(spark, sf):
    """Four streaming append flows into one target, read back together."""
    target = work_path(spark, "quarantine_all")
    events = fixtures.stream_events(spark, sf)
    streams = {t: M.bronze(fixtures.raw_trips_from_events(events, t)) for t in config.TAXI_TYPES}
    ingest.quarantine_flows(streams, os.path.join(target, "table"), os.path.join(target, "_checkpoints"), AS_OF)
    return ingest.read_quarantine(spark, os.path.join(target, "table"))


def _quarantine_all_batch(spark, sf, complete=False, as_of=AS_OF):
    b = _bronze_all(spark, sf)
    return union_all([M.quarantine(b[t], t, as_of, complete)
                      for t in config.TAXI_TYPES])


def q_quarantine_complete(spark, sf):
    return _quarantine_all_batch(spark, sf, complete=True)


# --------------------------------------------------------------------------- serving


def q_serving(key):
    mart_name, fn = serving.SERVING[key]
    return lambda spark, sf: fn(_mart(mart_name)(spark, sf))


def q_top20(spark, sf):
    return serving.top_days(_mart("daily_borough_metrics")(spark, sf), TOP_N)


def q_smoke_counts(spark, sf):
    s = _silver_all(spark, sf, spec("daily_borough_metrics").sources)
    z = _zones(spark, sf)
    return serving.smoke_counts({
        "bronze.yellow_trips_raw": _bronze(spark, sf, "yellow"),
        "silver.yellow_trips": s["yellow"],
        "gold.daily_borough_metrics": MARTS["daily_borough_metrics"](s, z),
        "silver.quarantine_trips": _quarantine_all_batch(spark, sf),
    })


# --------------------------------------------------------------------------- audit


def q_audit(fn):
    return lambda spark, sf: fn(fixtures.event_log(spark, sf))


def q_audit_sla(spark, sf):
    return audit.sla_monitoring(fixtures.event_log(spark, sf), SLA_AS_OF)


# --------------------------------------------------------------------------- storage


def _silver_tables(spark, sf, types=config.TAXI_TYPES):
    """Silver written once and read back, for queries that use it many times."""
    base, out = work_path(spark, "silver"), {}
    for t, df in _silver_all(spark, sf, types).items():
        df.write.parquet(os.path.join(base, t))
        out[t] = spark.read.parquet(os.path.join(base, t))
    return out


def q_pk_violations(spark, sf):
    marts = all_marts(_silver_tables(spark, sf), _zones(spark, sf))
    return union_all([storage.pk_summary(df, config.MART_PK[n], n) for n, df in marts.items()])


def q_change_feed(spark, sf):
    """Daily mart: an earlier version (trips before CHANGE_OLD_BEFORE) vs a
    later one (trips from CHANGE_NEW_FROM on): inserts, deletes, updates."""
    s = _silver_tables(spark, sf, spec("daily_borough_metrics").sources)
    z = _zones(spark, sf)
    old_s = {t: df.filter(F.col("pickup_datetime") < F.lit(CHANGE_OLD_BEFORE).cast("timestamp_ntz"))
             for t, df in s.items()}
    new_s = {t: df.filter(F.col("pickup_datetime") >= F.lit(CHANGE_NEW_FROM).cast("timestamp_ntz"))
             for t, df in s.items()}
    fn = MARTS["daily_borough_metrics"]
    return storage.change_feed(fn(old_s, z), fn(new_s, z),
                               config.MART_PK["daily_borough_metrics"])


def q_retention_purge(spark, sf):
    """Quarantine rows kept by the 90-day purge, with each row quarantined
    at its own pickup time (late rows are old; NULL times are kept)."""
    rows = _quarantine_all_batch(spark, sf, as_of=F.col("pickup_datetime"))
    return storage.purge(rows, "_quarantined_at", PURGE_AS_OF, config.QUARANTINE_RETENTION_DAYS)


def q_compaction_roundtrip(spark, sf):
    """Silver yellow written partitioned, a file per task and month, compacted at a
    new path (file size chosen by the data, not a fixed count), read back."""
    base = work_path(spark, "compaction")
    src, dst = os.path.join(base, "v0"), os.path.join(base, "v1")
    parts = config.SILVER_PARTITIONS["yellow"]
    _silver(spark, sf, "yellow").write.mode("overwrite").partitionBy(*parts).parquet(src)
    return storage.compact(spark, src, dst, cluster_cols=["pickup_datetime"], partition_cols=parts)


# --------------------------------------------------------------------------- sources & streaming


def q_rescued_data(spark, sf):
    """Yellow raw rows as text (a CSV-like landing format) with two columns
    carrying tokens that don't parse, typed back with rescue."""
    b = fixtures.trip_base(fixtures.read_events(spark, sf)).filter(F.col("taxi_type") == "yellow")
    text = b.select(
        F.col("pickup").cast("string").alias("tpep_pickup_datetime"),
        F.col("dropoff").cast("string").alias("tpep_dropoff_datetime"),
        F.col("pu").cast("string").alias("PULocationID"),
        F.col("dol").cast("string").alias("DOLocationID"),
        F.col("k").cast("string").alias("VendorID"),
        F.when(F.col("event_id") % 37 == 0, F.lit("n/a"))
        .otherwise(F.col("passengers").cast("string")).alias("passenger_count"),
        F.col("dist").cast("string").alias("trip_distance"),
        F.col("fare").cast("string").alias("fare_amount"),
        F.col("total").cast("string").alias("total_amount"),
        F.when(F.col("event_id") % 43 == 0, F.lit("card"))
        .otherwise(F.col("payment_type").cast("string")).alias("payment_type"))
    return rescue(text, RAW_SCHEMAS["yellow"])


def _drifted_yellow(spark, sf, path):
    """Yellow landing files in two generations; in the later one ``passenger_count``
    arrives as text, with tokens that don't parse."""
    b = fixtures.trip_base(fixtures.read_events(spark, sf)).filter(F.col("taxi_type") == "yellow")
    late = F.coalesce(F.col("pickup") >= F.lit(EVOLVED_FROM).cast("timestamp_ntz"), F.lit(False))
    cols = [F.col("pickup").alias("tpep_pickup_datetime"), F.col("dropoff").alias("tpep_dropoff_datetime"),
            F.col("pu").alias("PULocationID"), F.col("dol").alias("DOLocationID"), F.col("k").alias("VendorID")]
    rest = [F.col("dist").alias("trip_distance"), F.col("fare").alias("fare_amount"),
            F.col("total").alias("total_amount"), "payment_type"]
    b.filter(~late).select(*cols, F.col("passengers").alias("passenger_count"), *rest) \
        .write.parquet(os.path.join(path, "gen=1"))
    text_count = F.when(F.col("event_id") % 37 == 0, F.lit("n/a")).otherwise(F.col("passengers").cast("string"))
    b.filter(late).select(*cols, text_count.alias("passenger_count"), *rest) \
        .write.parquet(os.path.join(path, "gen=2"))


def q_rescued_parquet(spark, sf):
    """Drifted yellow landing files read as the declared schema, with what does not fit rescued."""
    base = work_path(spark, "rescued_parquet")
    _drifted_yellow(spark, sf, base)
    return read_parquet_rescued(spark, base, RAW_SCHEMAS["yellow"])


def _drifted_update(spark, sf):
    from tripflow.plans.pipeline import run_stream_pipeline, write_landing
    base = work_path(spark, "drifted")
    landing = {t: os.path.join(base, "landing", t) for t in config.TAXI_TYPES}
    _drifted_yellow(spark, sf, landing["yellow"])
    for t in config.TAXI_TYPES[1:]:
        write_landing(fixtures.raw_trips(spark, sf, t), landing[t])
    return run_stream_pipeline(spark, landing, fixtures.raw_zones(spark, sf), os.path.join(base, "tables"), as_of=AS_OF,
                               flow_confs=STREAM_FLOW_CONF)


def q_rescued_bronze(spark, sf):
    """Bronze of drifted yellow files after a stream update."""
    from tripflow.plans.pipeline import read_table
    return read_table(spark, _drifted_update(spark, sf), "bronze.yellow_trips_raw")


def q_dq_metrics_drifted(spark, sf):
    """Rules of bronze and silver that a stream update over drifted files logged: rescued
    values fail the bronze expectation, and silver's passenger rule."""
    paths = _drifted_update(spark, sf)
    return spark.read.parquet(paths["audit.data_quality_log"]).select(
        "dataset_name", "expectation_name", "passed_records", "failed_records")


def q_update_dq_log(spark, sf):
    """A full pipeline update; its event log's expectation results (AUD-2
    over the events the run emitted itself)."""
    from tripflow.plans.pipeline import run_batch_pipeline
    paths = run_batch_pipeline(spark, sf, work_path(spark, "pipeline"), as_of=AS_OF)
    return spark.read.parquet(paths["audit.data_quality_log"]).select(
        "dataset_name", "expectation_name", "passed_records", "failed_records", "pass_rate_pct", "data_layer")


def q_gold_daily_incremental(spark, sf):
    """Daily mart after two incremental stream updates: trips land in two
    batches (before / from EVOLVED_FROM)."""
    from tripflow.plans.pipeline import run_stream_pipeline, write_landing
    base = work_path(spark, "incremental")
    raw = fixtures.all_raw_trips(spark, sf)
    landing = {t: os.path.join(base, "landing", t) for t in config.TAXI_TYPES}
    early = {t: F.coalesce(F.col(config.BRONZE_CLUSTER[t]) < F.lit(EVOLVED_FROM).cast("timestamp_ntz"),
                           F.lit(True)) for t in config.TAXI_TYPES}
    zones = fixtures.raw_zones(spark, sf)
    root = os.path.join(base, "tables")
    for stage in (True, False):
        for t in config.TAXI_TYPES:
            write_landing(raw[t].filter(early[t] if stage else ~early[t]), landing[t])
        paths = run_stream_pipeline(spark, landing, zones, root, as_of=AS_OF, flow_confs=STREAM_FLOW_CONF)
    return spark.read.parquet(paths["gold.daily_borough_metrics"])


def q_csv_trip_scan(spark, sf):
    """Yellow raw trips as a headered CSV in the 9-column sample format (ISO
    timestamps), read back with the declared schema."""
    from tripflow.sources.files import SAMPLE_CSV_SCHEMA, read_trip_csv
    path = work_path(spark, "csv_trips")
    cols = [f.split(" ")[0] for f in SAMPLE_CSV_SCHEMA.split(", ")]
    (fixtures.raw_trips(spark, sf, "yellow").select(*cols).write.option("header", True)
     .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(path))
    return read_trip_csv(spark, path)


MAINTENANCE_AS_OF = "2025-02-01 00:00:00"  # purge cutoff 90 days earlier: every quarantine row is kept


def q_maintenance_counts(spark, sf):
    """A full update, then the maintenance job (compact the 15 tables into
    new directories, purge quarantine): row counts of every maintained table."""
    from tripflow.plans.maintenance import maintained_tables, run_maintenance
    from tripflow.plans.pipeline import read_table, run_batch_pipeline
    paths = run_batch_pipeline(spark, sf, work_path(spark, "maintenance"), as_of=AS_OF)
    new = run_maintenance(spark, paths, as_of=MAINTENANCE_AS_OF)
    return serving.smoke_counts({name: read_table(spark, new, name) for name in maintained_tables()})


BACKFILL_UNTIL = "2024-01-10 00:00:00"   # history ends here; two updates follow, cut at EVOLVED_FROM
# Trips that land again in the first and the second update: some within the watermark
# delay of the newest trip (the dedup state knows them), some that are late by then.
REPLAYS = (((BACKFILL_UNTIL, 12, 0),), ((EVOLVED_FROM, 12, 0), (BACKFILL_UNTIL, 36, 30)))


def _between(t, since=None, until=None):
    """Raw trips of a source picked up in a range; unknown times count as the earliest."""
    pickup = F.col(config.BRONZE_CLUSTER[t])
    at = lambda v: F.lit(v).cast("timestamp_ntz")
    known = F.lit(True) if until is None else F.coalesce(pickup < at(until), F.lit(since is None))
    return known if since is None else known & F.coalesce(pickup >= at(since), F.lit(False))


def _replayed(t, replays):
    hours = lambda n: F.expr(f"INTERVAL {n} HOURS")
    pickup, hit = F.col(config.BRONZE_CLUSTER[t]), F.lit(False)
    for until, first, last in replays:
        end = F.lit(until).cast("timestamp_ntz")
        hit = hit | F.coalesce((pickup >= end - hours(first)) & (pickup < end - hours(last)), F.lit(False))
    return hit


def q_backfill_then_stream(spark, sf):
    """History loaded by a backfill, then two stream updates that also replay trips
    loaded before: rows per day and source of silver, per reason and source of
    quarantine, and the daily mart, as one batch over everything has them."""
    from tripflow.plans.pipeline import read_table, run_batch_pipeline, run_stream_pipeline, write_landing
    base = work_path(spark, "backfill_then_stream")
    root, zones, raw = os.path.join(base, "tables"), fixtures.raw_zones(spark, sf), fixtures.all_raw_trips(spark, sf)
    landing = {t: os.path.join(base, "landing", t) for t in config.TAXI_TYPES}
    run_batch_pipeline(spark, None, root, raw={t: df.filter(_between(t, until=BACKFILL_UNTIL)) for t, df in raw.items()},
                       raw_zones=zones, as_of=AS_OF, flow_confs=STREAM_FLOW_CONF)
    for (since, until), replays in zip(((BACKFILL_UNTIL, EVOLVED_FROM), (EVOLVED_FROM, None)), REPLAYS):
        for t, df in raw.items():
            write_landing(df.filter(_between(t, since, until)).unionByName(df.filter(_replayed(t, replays))), landing[t])
        paths = run_stream_pipeline(spark, landing, zones, root, as_of=AS_OF, flow_confs=STREAM_FLOW_CONF)
    parts = []
    for t in config.TAXI_TYPES:
        parts.append(read_table(spark, paths, f"silver.{t}_trips").groupBy(
            F.lit("silver").alias("layer"), "taxi_type", F.col("pickup_datetime").cast("date").cast("string").alias("bucket"))
            .agg(F.count("*").alias("row_count")))
    parts.append(read_table(spark, paths, "silver.quarantine_trips").groupBy(
        F.lit("quarantine").alias("layer"), "taxi_type", F.col("quarantine_reason").alias("bucket")).agg(F.count("*").alias("row_count")))
    parts.append(read_table(spark, paths, "gold.daily_borough_metrics").select(
        F.lit("gold").alias("layer"), "taxi_type", F.concat_ws("|", F.col("trip_date").cast("string"), "borough").alias("bucket"),
        F.col("trip_count").alias("row_count")))
    return union_all(parts)


PURGE_BETWEEN = "2025-06-01 00:00:00"   # maintenance between two updates: the first one's quarantine is old
SECOND_AS_OF = "2025-06-15 00:00:00"


def q_update_after_maintenance(spark, sf):
    """A stream update, the maintenance job, a second update: rows of every maintained
    table. Purged quarantine rows stay gone, all others are there once."""
    from tripflow.plans.maintenance import maintained_tables, run_maintenance
    from tripflow.plans.pipeline import read_table, run_stream_pipeline, write_landing
    base = work_path(spark, "update_after_maintenance")
    root, zones, raw = os.path.join(base, "tables"), fixtures.raw_zones(spark, sf), fixtures.all_raw_trips(spark, sf)
    landing = {t: os.path.join(base, "landing", t) for t in config.TAXI_TYPES}
    for since, until, as_of in ((None, EVOLVED_FROM, AS_OF), (EVOLVED_FROM, None, SECOND_AS_OF)):
        for t, df in raw.items():
            write_landing(df.filter(_between(t, since, until)), landing[t])
        paths = run_stream_pipeline(spark, landing, zones, root, as_of=as_of, flow_confs=STREAM_FLOW_CONF)
        if since is None:
            run_maintenance(spark, paths, as_of=PURGE_BETWEEN)
    return serving.smoke_counts({name: read_table(spark, paths, name) for name in maintained_tables()})


def q_schema_evolution_union(spark, sf):
    """Yellow landing files written in two schema generations (later files
    add ``airport_fee``), read back with merged schemas."""
    base = work_path(spark, "evolution")
    raw = fixtures.raw_trips(spark, sf, "yellow")
    late = F.coalesce(F.col("tpep_pickup_datetime") >= F.lit(EVOLVED_FROM).cast("timestamp_ntz"), F.lit(False))
    raw.filter(~late).write.parquet(os.path.join(base, "gen=1"))
    (raw.filter(late)
     .withColumn("airport_fee", F.when(F.col("PULocationID").isin(config.JFK_LOCATION_ID,
                                                                   config.LAGUARDIA_LOCATION_ID), 1.75)
                 .otherwise(0.0))
     .write.parquet(os.path.join(base, "gen=2")))
    return read_evolving(spark, base).drop("gen")


def q_stream_ingest(t):
    """Bronze of one source, ingested by a triggered file stream."""
    def q(spark, sf):
        base = work_path(spark, f"stream_ingest_{t}")
        raw = fixtures.raw_trips_from_events(fixtures.stream_events(spark, sf), t)
        ingest.bronze_flow(raw, t, os.path.join(base, "table"), os.path.join(base, "_checkpoint"))
        return spark.read.parquet(os.path.join(base, "table"))
    return q


# Landing waves of the late-row query: each is a micro-batch (or more) of its own, and all
# its trips are newer than the wave before, but for those that arrive 400 days late.
WAVES = ("2024-01-07 00:00:00", "2024-01-13 00:00:00", "2024-01-19 00:00:00", "2024-01-25 00:00:00")
LATE_BEFORE, LATE_DAYS = "2023-06-01 00:00:00", 400


def q_late_rows(t):
    """What the watermark and the dedup state drop of one source, wave by wave: rows
    read, rows too late, duplicates, rows that reach silver. Unknown times land in the
    first wave, late rows from the second on (no watermark stands before)."""
    def q(spark, sf):
        from tripflow.plans.pipeline import write_landing
        from tripflow.sources.files import read_stream
        base, pickup = work_path(spark, f"late_rows_{t}"), F.col(config.BRONZE_CLUSTER[t])
        raw, landing = fixtures.raw_trips(spark, sf, t), os.path.join(base, "landing")
        at = lambda v: F.lit(v).cast("timestamp_ntz")
        late = F.coalesce(pickup < at(LATE_BEFORE), F.lit(False))
        arrival = F.when(late, pickup + F.expr(f"INTERVAL {LATE_DAYS} DAYS")).otherwise(pickup)
        wave = sum((F.coalesce(arrival >= at(w), F.lit(False)).cast("int") for w in WAVES), F.lit(0))
        wave = F.greatest(wave, late.cast("int"))
        facts = []
        for i in range(len(WAVES) + 1):
            write_landing(raw.filter(wave == i), landing)
            r = ingest.silver_flow(M.bronze(read_stream(spark, landing, RAW_SCHEMAS[t])), t, os.path.join(base, "silver"),
                                   os.path.join(base, "_checkpoint"), AS_OF)
            facts.append((i, sum(int(p.numInputRows) for p in r.progresses), r.dropped_by_watermark, r.dropped_duplicates, r.num_output_rows))
        return spark.createDataFrame(facts, "wave INT, rows_read BIGINT, late_rows BIGINT, duplicate_rows BIGINT, silver_rows BIGINT")
    return q


def q_dedup_stream(t):
    """Silver of one source from a stream: watermark dedup + drop rules."""
    def q(spark, sf):
        base = work_path(spark, f"dedup_stream_{t}")
        raw = fixtures.raw_trips_from_events(fixtures.stream_events(spark, sf), t)
        ingest.silver_flow(M.bronze(raw), t, os.path.join(base, "table"), os.path.join(base, "_checkpoint"), AS_OF)
        return spark.read.parquet(os.path.join(base, "table"))
    return q


def q_update_row_counts(spark, sf):
    """A full pipeline update; the row counts its flows logged."""
    from tripflow.plans.pipeline import run_batch_pipeline
    paths = run_batch_pipeline(spark, sf, work_path(spark, "row_counts"), as_of=AS_OF)
    flow = F.from_json("details", "flow_name STRING, num_output_rows BIGINT")
    return (spark.read.parquet(paths["audit.event_log"]).filter(F.col("event_type") == config.EVENT_FLOW)
            .select(flow["flow_name"].alias("table_name"), flow["num_output_rows"].alias("row_count")))


# --------------------------------------------------------------------------- registry


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    for t in config.TAXI_TYPES:
        q[f"silver_{t}"] = q_silver(t)
    q["silver_zone"] = q_silver_zone
    q["dedup_batch"] = q_dedup_batch
    q["dedup_stream"] = q_dedup_stream("yellow")
    for t in config.TAXI_TYPES[1:]:
        q[f"dedup_stream_{t}"] = q_dedup_stream(t)
        q[f"stream_ingest_{t}"] = q_stream_ingest(t)
    q["duration_minutes"] = q_duration_minutes
    q["rescued_data"] = q_rescued_data
    q["rescued_parquet"] = q_rescued_parquet
    q["csv_trip_scan"] = q_csv_trip_scan
    q["schema_evolution_union"] = q_schema_evolution_union
    q["dq_metrics_bronze"] = q_dq_metrics_bronze
    for t in config.TAXI_TYPES:
        q[f"dq_metrics_{t}"] = q_dq_metrics(t)
    q["dq_metrics_zone"] = q_dq_metrics_zone
    for t in config.TAXI_TYPES:
        q[f"quarantine_{t}"] = q_quarantine(t)
    q["quarantine_all"] = q_quarantine_all
    q["quarantine_complete"] = q_quarantine_complete
    q["gold_daily_borough"] = _mart("daily_borough_metrics")
    q["gold_hourly_demand"] = _mart("hourly_demand")
    q["gold_airport"] = _mart("airport_metrics")
    q["gold_zone_revenue"] = _mart("zone_revenue")
    q["gold_payment_trends"] = _mart("payment_trends")
    q["gold_trip_type"] = _mart("trip_type_summary")
    for key in serving.SERVING:
        q[key] = q_serving(key)
    q["top20_daily"] = q_top20
    q["smoke_counts"] = q_smoke_counts
    q["audit_run_log"] = q_audit(audit.run_log)
    q["audit_dq_log"] = q_audit(audit.dq_log)
    q["audit_row_count"] = q_audit(audit.row_count_log)
    q["audit_sla"] = q_audit_sla
    q["audit_error_log"] = q_audit(audit.error_log)
    q["pk_violations"] = q_pk_violations
    q["change_feed"] = q_change_feed
    q["retention_purge"] = q_retention_purge
    q["compaction_roundtrip"] = q_compaction_roundtrip
    q["stream_ingest"] = q_stream_ingest("yellow")
    q["update_row_counts"] = q_update_row_counts
    q["update_dq_log"] = q_update_dq_log
    q["maintenance_counts"] = q_maintenance_counts
    q["gold_daily_incremental"] = q_gold_daily_incremental
    q["rescued_bronze"] = q_rescued_bronze
    q["dq_metrics_drifted"] = q_dq_metrics_drifted
    q["late_rows_yellow"] = q_late_rows("yellow")
    q["late_rows_fhvheavy"] = q_late_rows("fhvheavy")
    q["backfill_then_stream"] = q_backfill_then_stream
    q["update_after_maintenance"] = q_update_after_maintenance
    return q
