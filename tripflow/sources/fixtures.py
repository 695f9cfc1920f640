"""Trip-domain inputs derived from the shared test tables.

The test tables are a generic star schema plus an ``events`` stream; this
module maps them onto the trip domain (raw trips per source, the zone
dimension and a pipeline event log) with plain DataFrame expressions, so that
every derived row grows with the underlying tables. The derivation plants
each defect the rules look for (NULL times and locations, out-of-range
amounts, exact replays, rows 400 days late) at fixed residues of
``event_id``; all rows of ``events`` are used.

Every function accepts either a test-data directory or an already loaded
``events`` DataFrame (batch or streaming), so the same derivation feeds
batch backfills and Structured Streaming runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow import config

EVENTS_COLUMNS = ("event_id", "ts", "event_type", "value")


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def stream_events(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """``events`` as an append-only file stream (directory + glob filter,
    since a file stream needs a directory)."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    reader = (spark.readStream.schema(schema)
              .option("pathGlobFilter", "events.parquet"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(sf_dir)


def _m(n: int) -> Column:
    return F.expr(f"event_id % {n} = 0")


def trip_base(events: DataFrame) -> DataFrame:
    """One generic trip row per event, plus an exact replay of every 50th."""
    src = events.select(
        "event_id",
        "event_type",
        F.col("value").cast("decimal(18,2)").alias("v"),
        F.when(_m(101), F.col("ts") - F.expr("INTERVAL 400 DAYS")).otherwise(F.col("ts")).alias("ts"),
    )
    # every 50th event is replayed once: one scan, the row emitted twice
    copies = F.when(_m(50), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    dup = src.withColumn("_copy", F.explode(copies)).drop("_copy")
    k = F.col("event_id") % 3 + 1
    return dup.select(
        "event_id",
        F.when(F.col("event_type") == "click", "yellow")
        .when(F.col("event_type") == "view", "green")
        .when(F.col("event_type") == "purchase", "fhv")
        .otherwise("fhvheavy").alias("taxi_type"),
        F.when(~_m(97), F.col("ts")).alias("pickup"),
        F.when(~_m(89), F.timestamp_add("MINUTE", (F.col("event_id") * 13) % 1500 - 20, F.col("ts")))
        .alias("dropoff"),
        F.when(~_m(83), (F.col("event_id") * 7) % 270).alias("pu"),
        ((F.col("event_id") * 11) % 270).alias("dol"),
        k.alias("k"),
        (F.col("event_id") % 11).alias("passengers"),
        F.when(_m(41), F.lit(600.0)).otherwise(F.col("v").cast("double")).alias("dist"),
        F.when(_m(211), F.lit(10000.0)).when(_m(223), F.lit(12000.5)).when(_m(79), F.lit(0.0))
        .otherwise((F.col("v") - 2).cast("double")).alias("fare"),
        F.when(_m(227), F.lit(50000.0)).when(_m(229), F.lit(60000.0))
        .otherwise((F.col("v") - 1).cast("double")).alias("total"),
        (F.col("v") - 3).cast("double").alias("tips"),
        (F.col("v") - 4).cast("double").alias("driver_pay"),
        F.when(~_m(31), F.col("event_id") % 5 + 1).alias("payment_type"),
        F.when(~_m(29), F.col("event_id") % 3 + 1).alias("trip_type"),
    )


def raw_trips_from_events(events: DataFrame, taxi_type: str, base: DataFrame | None = None) -> DataFrame:
    """Raw trip rows of one source, in that source's own column names
    (``base``: an already built ``trip_base(events)`` to share)."""
    b = (base if base is not None else trip_base(events)).filter(F.col("taxi_type") == taxi_type)
    if taxi_type == "yellow":
        return b.select(
            F.col("pickup").alias("tpep_pickup_datetime"), F.col("dropoff").alias("tpep_dropoff_datetime"),
            F.col("pu").alias("PULocationID"), F.col("dol").alias("DOLocationID"),
            F.col("k").alias("VendorID"), F.col("passengers").alias("passenger_count"),
            F.col("dist").alias("trip_distance"), F.col("fare").alias("fare_amount"),
            F.col("total").alias("total_amount"), "payment_type")
    if taxi_type == "green":
        return b.select(
            F.col("pickup").alias("lpep_pickup_datetime"), F.col("dropoff").alias("lpep_dropoff_datetime"),
            F.col("pu").alias("PULocationID"), F.col("dol").alias("DOLocationID"),
            F.col("k").alias("VendorID"), F.col("passengers").alias("passenger_count"),
            F.col("dist").alias("trip_distance"), F.col("fare").alias("fare_amount"),
            F.col("total").alias("total_amount"), "payment_type", "trip_type")
    if taxi_type == "fhv":
        return b.select(
            F.col("pickup").alias("pickup_datetime"), F.col("dropoff").alias("dropOff_datetime"),
            F.col("pu").alias("PUlocationID"), F.col("dol").alias("DOlocationID"),
            F.when(~_m(23), F.concat(F.lit("B0000"), F.col("k").cast("string"))).alias("dispatching_base_num"))
    if taxi_type == "fhvheavy":
        return b.select(
            F.col("pickup").alias("pickup_datetime"), F.col("dropoff").alias("dropoff_datetime"),
            F.col("pu").alias("PULocationID"), F.col("dol").alias("DOLocationID"),
            F.concat(F.lit("HV000"), F.col("k").cast("string")).alias("hvfhs_license_num"),
            F.col("fare").alias("base_passenger_fare"), F.col("dist").alias("trip_miles"),
            "driver_pay", "tips")
    raise ValueError(f"unknown taxi type {taxi_type!r}")


def raw_trips(spark: SparkSession, sf_dir: str, taxi_type: str) -> DataFrame:
    return raw_trips_from_events(read_events(spark, sf_dir), taxi_type)


def all_raw_trips_from_events(events: DataFrame, types=config.TAXI_TYPES) -> dict[str, DataFrame]:
    base = trip_base(events)
    return {t: raw_trips_from_events(events, t, base) for t in types}


def all_raw_trips(spark: SparkSession, sf_dir: str, types=config.TAXI_TYPES) -> dict[str, DataFrame]:
    return all_raw_trips_from_events(read_events(spark, sf_dir), types)


def raw_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """265 locations, which all ``orders`` fall into; the last two have no
    borough and no zone name."""
    orders = (spark.read.parquet(f"{sf_dir}/orders.parquet")
              .select((F.col("o_orderkey") % 265 + 1).alias("o_orderkey")).distinct())
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_name", "n_regionkey")
    region = spark.read.parquet(f"{sf_dir}/region.parquet").select("r_regionkey", "r_name")
    named = F.col("o_orderkey") < 264
    return (orders
            .join(nation, F.col("n_nationkey") == F.col("o_orderkey") % 25)
            .join(region, F.col("r_regionkey") == F.col("n_regionkey"))
            .select(F.col("o_orderkey").cast("int").alias("LocationID"),
                    F.when(named, F.col("r_name")).alias("Borough"),
                    F.when(named, F.col("n_name")).alias("Zone")))


def event_log_from_events(events: DataFrame) -> DataFrame:
    """A pipeline event log (id, timestamp, event_type, level, message,
    details JSON) with update, flow-progress and error events."""
    eid = F.col("event_id")
    s = eid.cast("string")
    et = F.col("event_type")
    state = (F.when(eid % 4 == 0, "COMPLETED").when(eid % 4 == 1, "FAILED")
             .when(eid % 4 == 2, "RUNNING").otherwise("CANCELED"))
    update_json = F.concat(
        F.lit('{"update_id":"u'), s, F.lit('","state":"'), state,
        F.lit('","run_type":"full","cause":"sched","creation_time":"t","elapsed_seconds":'), s, F.lit("}"))
    flow = (F.when(eid % 4 == 0, "bronze.a").when(eid % 4 == 1, "silver.b")
            .when(eid % 4 == 2, "gold.c").otherwise("tmp.d"))
    status = F.when(eid % 3 == 0, "RUNNING").otherwise("COMPLETED")
    rows = F.when(eid % 5 == 0, F.lit("")).otherwise(
        F.concat(F.lit(',"num_output_rows":'), (eid * 7).cast("string")))
    dq = F.when(eid % 7 == 0, F.lit("null")).otherwise(F.concat(
        F.lit('{"expectations":[{"name":"e1","dataset":"d","passed_records":'), (eid + 1).cast("string"),
        F.lit(',"failed_records":'), (eid % 13).cast("string"),
        F.lit('},{"name":"e2","dataset":"d","passed_records":0,"failed_records":'), (eid % 2).cast("string"),
        F.lit("}]}")))
    flow_json = F.concat(
        F.lit('{"flow_name":"'), flow, F.lit('","status":"'), status, F.lit('"'), rows,
        F.lit(',"metrics":{"seconds_of_processing":'), (eid % 9).cast("string"),
        F.lit('},"data_quality":'), dq, F.lit("}"))
    message = (F.when(eid % 6 == 0, "schema mismatch").when(eid % 6 == 1, "permission denied")
               .when(eid % 6 == 2, "resource limit critical").when(eid % 6 == 3, "bad data")
               .when(eid % 6 == 4, "FATAL schema drift").otherwise("unknown"))
    return events.select(
        s.alias("id"),
        F.col("ts").alias("timestamp"),
        F.when(et == "signup", "update_progress").when(et == "error", "flow_definition")
        .otherwise("flow_progress").alias("event_type"),
        F.when(et == "error", "ERROR").otherwise("INFO").alias("level"),
        message.alias("message"),
        F.when(et == "signup", update_json).otherwise(flow_json).alias("details"),
    )


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_log_from_events(read_events(spark, sf_dir))
