"""Independent SQL (DuckDB dialect) for every registered query.

Each string runs against the raw test tables (pre-registered views) and
re-derives the fixtures, silver layers and marts in SQL. Rule predicates are
the same SQL text the Spark side evaluates (they are the specification);
everything else (dedup, joins, aggregation, JSON parsing, change feed) is
written out here independently.

Two emulations keep the comparison exact:
* ``sround(x)``: Spark rounds a DOUBLE half-up on its shortest decimal text;
  DuckDB rounds the binary value. We round the text as a DECIMAL.
* measures are summed as DECIMAL then cast to DOUBLE, as the Spark side does.
"""

from __future__ import annotations

from tripflow import config
from tripflow.functions.rules import REASONS, RULES, bronze_rules, reasons_from_rules
from tripflow.plans import catalog as C

EXACT = config.EXACT_MEASURE
REAGG = config.EXACT_REAGG


def sround(x: str, d: int = 2) -> str:
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,18)), {d}) AS DOUBLE)"


def ts(v: str) -> str:
    return f"TIMESTAMP '{v}'"


# --------------------------------------------------------------------------- fixtures

FIXTURE_CTES = """
src AS (
  SELECT event_id, event_type, CAST(value AS DECIMAL(18,2)) AS v,
         CASE WHEN event_id % 101 = 0 THEN ts - INTERVAL '1' DAY * 400 ELSE ts END AS ts FROM events),
dup AS (SELECT * FROM src UNION ALL SELECT * FROM src WHERE event_id % 50 = 0),
base AS (
  SELECT event_id, CASE event_type WHEN 'click' THEN 'yellow' WHEN 'view' THEN 'green' WHEN 'purchase' THEN 'fhv' ELSE 'fhvheavy' END AS taxi_type,
    CASE WHEN event_id % 97 = 0 THEN NULL ELSE ts END AS pickup,
    CASE WHEN event_id % 89 = 0 THEN NULL ELSE ts + INTERVAL '1' MINUTE * ((event_id * 13) % 1500 - 20) END AS dropoff,
    CASE WHEN event_id % 83 = 0 THEN NULL ELSE (event_id * 7) % 270 END AS pu,
    (event_id * 11) % 270 AS dol, event_id % 3 + 1 AS k,
    event_id % 11 AS passengers,
    CASE WHEN event_id % 41 = 0 THEN 600.0e0 ELSE CAST(v AS DOUBLE) END AS dist,
    CAST(CASE WHEN event_id % 211 = 0 THEN 10000.00 WHEN event_id % 223 = 0 THEN 12000.50 WHEN event_id % 79 = 0 THEN 0.00 ELSE v - 2 END AS DOUBLE) AS fare,
    CAST(CASE WHEN event_id % 227 = 0 THEN 50000.00 WHEN event_id % 229 = 0 THEN 60000.00 ELSE v - 1 END AS DOUBLE) AS total,
    CAST(v - 3 AS DOUBLE) AS tips, CAST(v - 4 AS DOUBLE) AS driver_pay,
    CASE WHEN event_id % 31 = 0 THEN NULL ELSE event_id % 5 + 1 END AS payment_type,
    CASE WHEN event_id % 29 = 0 THEN NULL ELSE event_id % 3 + 1 END AS trip_type
  FROM dup),
yellow_raw AS (SELECT pickup AS tpep_pickup_datetime, dropoff AS tpep_dropoff_datetime, pu AS PULocationID, dol AS DOLocationID, k AS VendorID, passengers AS passenger_count, dist AS trip_distance, fare AS fare_amount, total AS total_amount, payment_type FROM base WHERE taxi_type = 'yellow'),
green_raw AS (SELECT pickup AS lpep_pickup_datetime, dropoff AS lpep_dropoff_datetime, pu AS PULocationID, dol AS DOLocationID, k AS VendorID, passengers AS passenger_count, dist AS trip_distance, fare AS fare_amount, total AS total_amount, payment_type, trip_type FROM base WHERE taxi_type = 'green'),
fhv_raw AS (SELECT pickup AS pickup_datetime, dropoff AS dropOff_datetime, pu AS PUlocationID, dol AS DOlocationID, CASE WHEN event_id % 23 = 0 THEN NULL ELSE concat('B0000', k) END AS dispatching_base_num FROM base WHERE taxi_type = 'fhv'),
fhvheavy_raw AS (SELECT pickup AS pickup_datetime, dropoff AS dropoff_datetime, pu AS PULocationID, dol AS DOLocationID, concat('HV000', k) AS hvfhs_license_num, fare AS base_passenger_fare, dist AS trip_miles, driver_pay, tips FROM base WHERE taxi_type = 'fhvheavy'),
zones_raw AS (
  SELECT CAST(o_orderkey AS INTEGER) AS LocationID,
         CASE WHEN o_orderkey < 264 THEN r_name END AS Borough,
         CASE WHEN o_orderkey < 264 THEN n_name END AS Zone
  FROM (SELECT DISTINCT o_orderkey % 265 + 1 AS o_orderkey FROM orders)
  JOIN nation ON n_nationkey = o_orderkey % 25 JOIN region ON r_regionkey = n_regionkey),
ev AS (
  SELECT CAST(event_id AS VARCHAR) AS id, ts AS "timestamp",
    CASE event_type WHEN 'signup' THEN 'update_progress' WHEN 'error' THEN 'flow_definition' ELSE 'flow_progress' END AS event_type,
    CASE event_type WHEN 'error' THEN 'ERROR' ELSE 'INFO' END AS level,
    CASE event_id % 6 WHEN 0 THEN 'schema mismatch' WHEN 1 THEN 'permission denied' WHEN 2 THEN 'resource limit critical'
                      WHEN 3 THEN 'bad data' WHEN 4 THEN 'FATAL schema drift' ELSE 'unknown' END AS message,
    CASE WHEN event_type = 'signup' THEN
      concat('{"update_id":"u', event_id, '","state":"', CASE event_id % 4 WHEN 0 THEN 'COMPLETED' WHEN 1 THEN 'FAILED' WHEN 2 THEN 'RUNNING' ELSE 'CANCELED' END,
             '","run_type":"full","cause":"sched","creation_time":"t","elapsed_seconds":', event_id, '}')
    ELSE
      concat('{"flow_name":"', CASE event_id % 4 WHEN 0 THEN 'bronze.a' WHEN 1 THEN 'silver.b' WHEN 2 THEN 'gold.c' ELSE 'tmp.d' END,
             '","status":"', CASE WHEN event_id % 3 = 0 THEN 'RUNNING' ELSE 'COMPLETED' END, '"',
             CASE WHEN event_id % 5 = 0 THEN '' ELSE concat(',"num_output_rows":', event_id * 7) END,
             ',"metrics":{"seconds_of_processing":', event_id % 9, '},"data_quality":',
             CASE WHEN event_id % 7 = 0 THEN 'null' ELSE
               concat('{"expectations":[{"name":"e1","dataset":"d","passed_records":', event_id + 1, ',"failed_records":', event_id % 13,
                      '},{"name":"e2","dataset":"d","passed_records":0,"failed_records":', event_id % 2, '}]}') END, '}')
    END AS details
  FROM events)"""

# Conformed column lists: (output name, raw expression) in Spark column order.
RAW_CONFORM = {
    "yellow": [("pickup_datetime", "tpep_pickup_datetime"), ("dropoff_datetime", "tpep_dropoff_datetime"),
               ("pickup_location_id", "PULocationID"), ("dropoff_location_id", "DOLocationID"),
               ("VendorID", "VendorID"), ("passenger_count", "passenger_count"),
               ("trip_distance", "trip_distance"), ("fare_amount", "fare_amount"),
               ("total_amount", "total_amount"), ("payment_type", "payment_type")],
    "green": [("pickup_datetime", "lpep_pickup_datetime"), ("dropoff_datetime", "lpep_dropoff_datetime"),
              ("pickup_location_id", "PULocationID"), ("dropoff_location_id", "DOLocationID"),
              ("VendorID", "VendorID"), ("passenger_count", "passenger_count"),
              ("trip_distance", "trip_distance"), ("fare_amount", "fare_amount"),
              ("total_amount", "total_amount"), ("payment_type", "payment_type"), ("trip_type", "trip_type")],
    "fhv": [("pickup_datetime", "pickup_datetime"), ("dropoff_datetime", "dropOff_datetime"),
            ("pickup_location_id", "PUlocationID"), ("dropoff_location_id", "DOlocationID"),
            ("dispatching_base_num", "dispatching_base_num")],
    "fhvheavy": [("pickup_datetime", "pickup_datetime"), ("dropoff_datetime", "dropoff_datetime"),
                 ("pickup_location_id", "PULocationID"), ("dropoff_location_id", "DOLocationID"),
                 ("hvfhs_license_num", "hvfhs_license_num"), ("base_passenger_fare", "base_passenger_fare"),
                 ("trip_miles", "trip_miles"), ("driver_pay", "driver_pay"), ("tips", "tips")],
}
DERIVED = ["_rescued_data", "taxi_type", "pickup_year", "pickup_month", "trip_duration_mins", "_created_at"]


def conformed_columns(t: str) -> list[str]:
    return [c for c, _ in RAW_CONFORM[t]] + DERIVED


def _pred_all(rules) -> str:
    return " AND ".join(f"coalesce(({r.predicate}), false)" for r in rules) or "true"


def _layer_ctes() -> str:
    parts = []
    for t in config.TAXI_TYPES:
        renames = ", ".join(f"{raw} AS {out}" for out, raw in RAW_CONFORM[t])
        parts.append(
            f"{t}_conf AS (SELECT *, CAST(NULL AS VARCHAR) AS _rescued_data, '{t}' AS taxi_type, "
            f"CAST(year(pickup_datetime) AS INTEGER) AS pickup_year, CAST(month(pickup_datetime) AS INTEGER) AS pickup_month, "
            f"round((floor(epoch(dropoff_datetime)) - floor(epoch(pickup_datetime))) / 60, 2) AS trip_duration_mins, "
            f"CAST({ts(C.AS_OF)} AS TIMESTAMP) AS _created_at FROM (SELECT {renames} FROM {t}_raw) r)")
        keys = config.DEDUP_KEYS[t]
        order = [c for c in conformed_columns(t) if c not in keys and c != "_created_at"]
        parts.append(
            f"{t}_dedup AS (SELECT * FROM {t}_conf QUALIFY row_number() OVER (PARTITION BY {', '.join(keys)} "
            f"ORDER BY {', '.join(c + ' ASC NULLS FIRST' for c in order)}) = 1)")
        parts.append(f"{t}_silver AS (SELECT * FROM {t}_dedup WHERE {_pred_all(RULES[t].drop_rules)})")
    parts.append(
        "zones_conf AS (SELECT LocationID AS location_id, Borough AS borough, Zone AS zone_name, "
        f"CAST({ts(C.AS_OF)} AS TIMESTAMP) AS _created_at FROM zones_raw)")
    parts.append(f"zones AS (SELECT * FROM zones_conf WHERE {_pred_all(RULES['zone'].drop_rules)})")
    # harmonised measures
    parts.append(
        "priced AS ("
        "SELECT CAST(pickup_datetime AS DATE) AS trip_date, pickup_datetime, pickup_location_id, taxi_type, total_amount AS revenue, trip_distance FROM yellow_silver "
        "UNION ALL SELECT CAST(pickup_datetime AS DATE), pickup_datetime, pickup_location_id, taxi_type, total_amount, trip_distance FROM green_silver "
        "UNION ALL SELECT CAST(pickup_datetime AS DATE), pickup_datetime, pickup_location_id, taxi_type, base_passenger_fare, trip_miles FROM fhvheavy_silver)")
    parts.append(
        "alltrips AS (" + " UNION ALL ".join(
            f"SELECT pickup_datetime, pickup_location_id, dropoff_location_id, taxi_type FROM {t}_silver"
            for t in config.TAXI_TYPES) + ")")
    return ",\n".join(parts)


def _mart_ctes() -> str:
    def hits(c, loc):
        return f"CAST(SUM(CASE WHEN {c} = {loc} THEN 1 ELSE 0 END) AS BIGINT)"
    ids = f"({config.JFK_LOCATION_ID}, {config.LAGUARDIA_LOCATION_ID}, {config.NEWARK_LOCATION_ID})"
    return ",\n".join([
        f"""daily AS (SELECT trip_date, z.borough, p.taxi_type, CAST(count(*) AS BIGINT) AS trip_count,
  CAST(SUM(TRY_CAST(revenue AS {EXACT})) AS DOUBLE) AS total_revenue,
  CAST(SUM(TRY_CAST(trip_distance AS {EXACT})) AS DOUBLE) / NULLIF(COUNT(TRY_CAST(trip_distance AS {EXACT})), 0) AS avg_distance
  FROM priced p LEFT JOIN zones z ON p.pickup_location_id = z.location_id WHERE z.borough IS NOT NULL
  GROUP BY trip_date, z.borough, p.taxi_type)""",
        f"""hourly AS (SELECT CAST(hour(pickup_datetime) AS INTEGER) AS hour_of_day, CAST(dayofweek(pickup_datetime) + 1 AS INTEGER) AS day_of_week,
  z.borough, a.taxi_type, CAST(count(*) AS BIGINT) AS trip_count
  FROM alltrips a LEFT JOIN zones z ON a.pickup_location_id = z.location_id WHERE z.borough IS NOT NULL
  GROUP BY ALL)""",
        f"""airport AS (SELECT CAST(pickup_datetime AS DATE) AS trip_date, taxi_type,
  {hits('pickup_location_id', config.JFK_LOCATION_ID)} AS jfk_pickups, {hits('dropoff_location_id', config.JFK_LOCATION_ID)} AS jfk_dropoffs,
  {hits('pickup_location_id', config.LAGUARDIA_LOCATION_ID)} AS laguardia_pickups, {hits('dropoff_location_id', config.LAGUARDIA_LOCATION_ID)} AS laguardia_dropoffs,
  {hits('pickup_location_id', config.NEWARK_LOCATION_ID)} AS newark_pickups, {hits('dropoff_location_id', config.NEWARK_LOCATION_ID)} AS newark_dropoffs,
  CAST(count(*) AS BIGINT) AS total_airport_trips
  FROM alltrips WHERE pickup_location_id IN {ids} OR dropoff_location_id IN {ids} GROUP BY 1, 2)""",
        f"""zonerev AS (SELECT CAST(p.pickup_location_id AS INTEGER) AS pickup_location_id, z.zone_name, z.borough, p.taxi_type,
  CAST(count(*) AS BIGINT) AS trip_count, CAST(SUM(TRY_CAST(revenue AS {EXACT})) AS DOUBLE) AS total_revenue,
  CAST(SUM(TRY_CAST(revenue AS {EXACT})) AS DOUBLE) / NULLIF(COUNT(TRY_CAST(revenue AS {EXACT})), 0) AS avg_revenue,
  MIN(revenue) AS min_revenue, MAX(revenue) AS max_revenue
  FROM priced p LEFT JOIN zones z ON p.pickup_location_id = z.location_id
  GROUP BY p.pickup_location_id, z.zone_name, z.borough, p.taxi_type)""",
        f"""payment AS (SELECT trip_date, payment_type, taxi_type, CAST(count(*) AS BIGINT) AS trip_count,
  CAST(SUM(TRY_CAST(total_amount AS {EXACT})) AS DOUBLE) AS total_revenue,
  CAST(SUM(TRY_CAST(fare_amount AS {EXACT})) AS DOUBLE) / NULLIF(COUNT(TRY_CAST(fare_amount AS {EXACT})), 0) AS avg_fare
  FROM (SELECT CAST(pickup_datetime AS DATE) AS trip_date, payment_type, taxi_type, total_amount, fare_amount FROM yellow_silver
        UNION ALL SELECT CAST(pickup_datetime AS DATE), payment_type, taxi_type, total_amount, fare_amount FROM green_silver)
  WHERE payment_type IS NOT NULL AND trip_date IS NOT NULL GROUP BY 1, 2, 3)""",
        """triptype AS (SELECT CAST(g.pickup_datetime AS DATE) AS trip_date, z.borough, g.trip_type, CAST(count(*) AS BIGINT) AS trip_count,
  CASE WHEN g.trip_type = 1 THEN 'Street-hail' WHEN g.trip_type = 2 THEN 'Dispatch' ELSE 'Unknown' END AS trip_type_desc
  FROM green_silver g LEFT JOIN zones z ON g.pickup_location_id = z.location_id
  WHERE g.trip_type IS NOT NULL AND z.borough IS NOT NULL GROUP BY 1, 2, 3)""",
    ])


def _quarantine_select(t: str, reasons: dict[str, str], quarantined_at: str, complete: bool = False) -> str:
    vec = ", ".join(f"CASE WHEN {cond} THEN '{name}' END" for name, cond in reasons.items())
    renames = ", ".join(f"{raw} AS {out}" for out, raw in RAW_CONFORM[t])
    source = f"{t}_conf" if complete else f"(SELECT {renames}, '{t}' AS taxi_type FROM {t}_raw)"
    return (f"SELECT CAST(pickup_datetime AS TIMESTAMP) AS pickup_datetime, CAST(dropoff_datetime AS TIMESTAMP) AS dropoff_datetime, "
            f"CAST(pickup_location_id AS BIGINT) AS pickup_location_id, CAST(dropoff_location_id AS BIGINT) AS dropoff_location_id, "
            f"taxi_type, quarantine_reason, _quarantined_at FROM (SELECT *, concat_ws(', ', {vec}) AS quarantine_reason, "
            f"CAST({quarantined_at} AS TIMESTAMP) AS _quarantined_at FROM {source} c) q "
            f"WHERE quarantine_reason <> ''")


def _metrics_select(source: str, rules, dataset: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{dataset}' AS dataset, '{r.name}' AS rule_name, '{r.action}' AS action, "
        f"CAST(count_if(coalesce(({r.predicate}), false)) AS BIGINT) AS passed_records, "
        f"CAST(count(*) - count_if(coalesce(({r.predicate}), false)) AS BIGINT) AS failed_records FROM {source}"
        for r in rules)


def _layer_sql(t: str) -> str:
    """Simple CASE layer classification of a column expression."""
    return f"CASE WHEN contains({t}, 'bronze') THEN 'bronze' WHEN contains({t}, 'silver') THEN 'silver' WHEN contains({t}, 'gold') THEN 'gold' ELSE 'other' END"


def _j(path: str) -> str:
    return f"json_extract_string(details, '{path}')"


def _final_selects() -> dict[str, str]:
    q: dict[str, str] = {}
    for t in config.TAXI_TYPES:
        q[f"silver_{t}"] = f"SELECT * FROM {t}_silver"
    q["silver_zone"] = "SELECT * FROM zones"
    q["dedup_batch"] = "SELECT * FROM yellow_dedup"
    q["dedup_stream"] = "SELECT * FROM yellow_silver"
    for t in config.TAXI_TYPES[1:]:
        q[f"dedup_stream_{t}"] = f"SELECT * FROM {t}_silver"
        q[f"stream_ingest_{t}"] = f"SELECT *, CAST(NULL AS VARCHAR) AS _rescued_data FROM {t}_raw"
    q["duration_minutes"] = " UNION ALL ".join(
        f"SELECT taxi_type, pickup_datetime, dropoff_datetime, trip_duration_mins FROM {t}_conf" for t in config.TAXI_TYPES)
    # rescued data: text round trip of yellow raw with two unparsable tokens
    q["rescued_data"] = (
        "SELECT pickup AS tpep_pickup_datetime, dropoff AS tpep_dropoff_datetime, pu AS PULocationID, dol AS DOLocationID, "
        "k AS VendorID, CASE WHEN event_id % 37 = 0 THEN NULL ELSE passengers END AS passenger_count, dist AS trip_distance, "
        "fare AS fare_amount, total AS total_amount, CASE WHEN event_id % 43 = 0 THEN NULL ELSE payment_type END AS payment_type, "
        "CASE WHEN event_id % 37 = 0 OR event_id % 43 = 0 THEN concat('{', concat_ws(',', "
        "CASE WHEN event_id % 37 = 0 THEN '\"passenger_count\":\"n/a\"' END, "
        "CASE WHEN event_id % 43 = 0 THEN '\"payment_type\":\"card\"' END), '}') END AS _rescued_data "
        "FROM base WHERE taxi_type = 'yellow'")
    q["rescued_parquet"] = (
        "SELECT pickup AS tpep_pickup_datetime, dropoff AS tpep_dropoff_datetime, pu AS PULocationID, dol AS DOLocationID, "
        "k AS VendorID, CASE WHEN late AND event_id % 37 = 0 THEN NULL ELSE passengers END AS passenger_count, "
        "dist AS trip_distance, fare AS fare_amount, total AS total_amount, payment_type, "
        "CASE WHEN late AND event_id % 37 = 0 THEN '{\"passenger_count\":\"n/a\"}' END AS _rescued_data "
        f"FROM (SELECT *, coalesce(pickup >= {ts(C.EVOLVED_FROM)}, false) AS late FROM base WHERE taxi_type = 'yellow')")
    q["csv_trip_scan"] = (
        "SELECT tpep_pickup_datetime, tpep_dropoff_datetime, PULocationID, DOLocationID, VendorID, passenger_count, "
        "trip_distance, fare_amount, total_amount FROM yellow_raw")
    q["schema_evolution_union"] = (
        "SELECT *, CASE WHEN coalesce(tpep_pickup_datetime >= " + ts(C.EVOLVED_FROM) + ", false) THEN "
        f"CASE WHEN PULocationID IN ({config.JFK_LOCATION_ID}, {config.LAGUARDIA_LOCATION_ID}) THEN 1.75e0 ELSE 0.0e0 END END AS airport_fee "
        "FROM yellow_raw")
    q["dq_metrics_bronze"] = " UNION ALL ".join(
        _metrics_select(f"(SELECT *, CAST(NULL AS VARCHAR) AS _rescued_data FROM {t}_raw)", bronze_rules(t).rules,
                        bronze_rules(t).dataset) for t in config.TAXI_TYPES)
    for t in config.TAXI_TYPES:
        q[f"dq_metrics_{t}"] = _metrics_select(f"{t}_dedup", RULES[t].rules, RULES[t].dataset)
    q["dq_metrics_zone"] = _metrics_select("zones_conf", RULES["zone"].rules, RULES["zone"].dataset)
    for t in config.TAXI_TYPES:
        q[f"quarantine_{t}"] = _quarantine_select(t, REASONS[t], ts(C.AS_OF))
    q["quarantine_all"] = " UNION ALL ".join(_quarantine_select(t, REASONS[t], ts(C.AS_OF)) for t in config.TAXI_TYPES)
    q["quarantine_complete"] = " UNION ALL ".join(
        _quarantine_select(t, reasons_from_rules(RULES[t]), ts(C.AS_OF), complete=True) for t in config.TAXI_TYPES)
    q["gold_daily_borough"] = "SELECT * FROM daily"
    q["gold_hourly_demand"] = "SELECT * FROM hourly"
    q["gold_daily_incremental"] = "SELECT * FROM daily"
    q["gold_airport"] = "SELECT * FROM airport"
    q["gold_zone_revenue"] = "SELECT * FROM zonerev"
    q["gold_payment_trends"] = "SELECT * FROM payment"
    q["gold_trip_type"] = "SELECT * FROM triptype"

    def resum(c):
        return f"CAST(SUM(TRY_CAST({c} AS {REAGG})) AS DOUBLE)"

    def reavg(c):
        return f"{resum(c)} / NULLIF(COUNT(TRY_CAST({c} AS {REAGG})), 0)"

    q["srv_total_trips"] = "SELECT CAST(SUM(trip_count) AS BIGINT) AS total_trips FROM daily"
    q["srv_total_revenue"] = f"SELECT {resum('total_revenue')} AS total_revenue FROM daily"
    q["srv_avg_distance"] = f"SELECT {reavg('avg_distance')} AS avg_distance FROM daily"
    q["srv_avg_fare"] = f"SELECT {reavg('avg_fare')} AS avg_fare FROM payment"
    q["srv_daily_revenue"] = f"SELECT taxi_type, trip_date, {resum('total_revenue')} AS total_revenue FROM daily GROUP BY 1, 2"
    q["srv_trips_by_type"] = "SELECT taxi_type, CAST(SUM(trip_count) AS BIGINT) AS trip_count FROM daily GROUP BY 1"
    q["srv_hourly"] = "SELECT hour_of_day, CAST(SUM(trip_count) AS BIGINT) AS trip_count FROM hourly GROUP BY 1"
    q["srv_dow"] = "SELECT day_of_week, CAST(SUM(trip_count) AS BIGINT) AS trip_count FROM hourly GROUP BY 1"
    q["srv_airport"] = (
        "SELECT taxi_type, CAST(SUM(jfk_pickups + jfk_dropoffs) AS BIGINT) AS jfk_total_trips, "
        "CAST(SUM(laguardia_pickups + laguardia_dropoffs) AS BIGINT) AS laguardia_total_trips, "
        "CAST(SUM(newark_pickups + newark_dropoffs) AS BIGINT) AS newark_total_trips FROM airport GROUP BY 1")
    q["srv_zones"] = f"SELECT zone_name, {resum('total_revenue')} AS total_revenue FROM zonerev GROUP BY 1"
    labels = " ".join(f"WHEN {k} THEN '{v}'" for k, v in config.PAYMENT_LABELS.items())
    q["srv_payment"] = (
        f"SELECT CASE payment_type {labels} ELSE '{config.PAYMENT_OTHER}' END AS payment_method, trip_date, "
        f"{resum('total_revenue')} AS total_revenue FROM payment GROUP BY 1, 2")
    q["srv_trip_type"] = "SELECT trip_type_desc, CAST(SUM(trip_count) AS BIGINT) AS trip_count FROM triptype GROUP BY 1"
    q["top20_daily"] = (f"SELECT * FROM daily ORDER BY trip_date DESC, trip_count DESC, borough ASC, taxi_type ASC "
                        f"LIMIT {C.TOP_N}")
    q["smoke_counts"] = (
        "SELECT 'bronze.yellow_trips_raw' AS table_name, CAST(COUNT(*) AS BIGINT) AS row_count FROM yellow_raw "
        "UNION ALL SELECT 'silver.yellow_trips', COUNT(*) FROM yellow_silver "
        "UNION ALL SELECT 'gold.daily_borough_metrics', COUNT(*) FROM daily "
        "UNION ALL SELECT 'silver.quarantine_trips', COUNT(*) FROM ("
        + " UNION ALL ".join(_quarantine_select(t, REASONS[t], ts(C.AS_OF)) for t in config.TAXI_TYPES) + ")")
    # audit
    secs = f"TRY_CAST({_j('$.elapsed_seconds')} AS DOUBLE)"
    terminal = ", ".join(f"'{s}'" for s in config.TERMINAL_STATES)
    q["audit_run_log"] = (
        f"SELECT id AS event_id, \"timestamp\", {_j('$.update_id')} AS update_id, {_j('$.state')} AS state, "
        f"{_j('$.run_type')} AS run_type, {_j('$.cause')} AS cause, {_j('$.creation_time')} AS creation_time, "
        f"{sround(secs)} AS elapsed_seconds, {sround(secs + ' / 60')} AS elapsed_minutes, "
        f"CASE WHEN {_j('$.state')} IN ({terminal}) THEN true ELSE false END AS is_terminal_state "
        f"FROM ev WHERE event_type = 'update_progress'")
    exp_type = '[{"name":"VARCHAR","dataset":"VARCHAR","passed_records":"BIGINT","failed_records":"BIGINT"}]'
    q["audit_dq_log"] = (
        "SELECT event_id, \"timestamp\", dataset_name, e.name AS expectation_name, e.passed_records, e.failed_records, "
        + sround("CAST(e.passed_records AS DOUBLE) / NULLIF(e.passed_records + e.failed_records, 0) * 100")
        + f" AS pass_rate_pct, {_layer_sql('dataset_name')} AS data_layer FROM ("
        f"SELECT id AS event_id, \"timestamp\", {_j('$.flow_name')} AS dataset_name, "
        f"unnest(from_json(json_extract(details, '$.data_quality.expectations'), '{exp_type}')) AS e "
        f"FROM ev WHERE event_type = 'flow_progress' AND {_j('$.data_quality')} <> 'null')")
    n = f"TRY_CAST({_j('$.num_output_rows')} AS BIGINT)"
    ps = f"TRY_CAST({_j('$.metrics.seconds_of_processing')} AS DOUBLE)"
    q["audit_row_count"] = (
        "SELECT *, CASE WHEN processing_seconds > 0 THEN "
        + sround("num_output_rows / processing_seconds")
        + " END AS rows_per_second FROM ("
        f"SELECT id AS event_id, \"timestamp\", {_j('$.flow_name')} AS dataset_name, {n} AS num_output_rows, "
        f"{ps} AS processing_seconds, {_layer_sql(_j('$.flow_name'))} AS data_layer "
        f"FROM ev WHERE event_type = 'flow_progress' AND {_j('$.num_output_rows')} IS NOT NULL)")
    thr = ("CASE WHEN contains(dataset_name, 'bronze') THEN 6 WHEN contains(dataset_name, 'silver') THEN 12 "
           "WHEN contains(dataset_name, 'gold') THEN 24 ELSE 24 END")
    hours = sround(f"(floor(epoch({ts(C.SLA_AS_OF)})) - floor(epoch(last_successful_refresh))) / 3600")
    q["audit_sla"] = (
        "SELECT *, hours_since_refresh > sla_threshold_hours AS sla_breach, "
        "CASE WHEN hours_since_refresh > sla_threshold_hours * 2 THEN 'CRITICAL' "
        "WHEN hours_since_refresh > sla_threshold_hours THEN 'WARNING' ELSE 'OK' END AS severity FROM ("
        f"SELECT dataset_name, last_successful_refresh, {hours} AS hours_since_refresh, "
        f"CAST({thr} AS INTEGER) AS sla_threshold_hours FROM ("
        f"SELECT {_j('$.flow_name')} AS dataset_name, max(\"timestamp\") AS last_successful_refresh FROM ev "
        f"WHERE event_type = 'flow_progress' AND {_j('$.status')} = 'COMPLETED' GROUP BY 1))")
    q["audit_error_log"] = (
        "SELECT id AS event_id, \"timestamp\", message, details, "
        "CASE WHEN contains(message, 'schema') THEN 'SCHEMA' WHEN contains(message, 'permission') THEN 'PERMISSION' "
        "WHEN contains(message, 'resource') THEN 'RESOURCE' WHEN contains(message, 'data') THEN 'DATA' ELSE 'OTHER' END AS error_category, "
        "CASE WHEN contains(message, 'FATAL') OR contains(message, 'critical') THEN 'CRITICAL' "
        "WHEN contains(message, 'schema') OR contains(message, 'permission') THEN 'HIGH' ELSE 'LOW' END AS severity "
        "FROM ev WHERE level = 'ERROR'")
    # storage
    mart_cte = {"daily_borough_metrics": "daily", "hourly_demand": "hourly", "airport_metrics": "airport",
                "zone_revenue": "zonerev", "payment_trends": "payment", "trip_type_summary": "triptype"}
    pk_parts = []
    for name, cte in mart_cte.items():
        pk = config.MART_PK[name]
        anynull = " OR ".join(f"{c} IS NULL" for c in pk)
        pk_parts.append(
            f"SELECT '{name}' AS table_name, CAST(count_if(n > 1 AND NOT ({anynull})) AS BIGINT) AS duplicate_keys, "
            f"CAST(coalesce(sum(CASE WHEN {anynull} THEN n END), 0) AS BIGINT) AS null_key_rows "
            f"FROM (SELECT {', '.join(pk)}, count(*) AS n FROM {cte} GROUP BY ALL)")
    q["pk_violations"] = " UNION ALL ".join(pk_parts)
    q["change_feed"] = _change_feed_sql()
    q["retention_purge"] = (
        "SELECT * FROM (" + " UNION ALL ".join(
            _quarantine_select(t, REASONS[t], "pickup_datetime") for t in config.TAXI_TYPES)
        + f") WHERE _quarantined_at IS NULL OR _quarantined_at >= {ts(C.PURGE_AS_OF)} - INTERVAL {config.QUARANTINE_RETENTION_DAYS} DAYS")
    q["compaction_roundtrip"] = "SELECT * FROM yellow_silver"
    counts = [f"SELECT 'bronze.{t}_trips_raw' AS table_name, CAST(COUNT(*) AS BIGINT) AS row_count FROM {t}_raw"
              for t in config.TAXI_TYPES]
    counts += [f"SELECT 'silver.{t}_trips', COUNT(*) FROM {t}_silver" for t in config.TAXI_TYPES]
    counts.append("SELECT 'silver.quarantine_trips', COUNT(*) FROM ("
                  + " UNION ALL ".join(_quarantine_select(t, REASONS[t], ts(C.AS_OF)) for t in config.TAXI_TYPES) + ")")
    counts += [f"SELECT 'gold.{m}', COUNT(*) FROM {cte}" for m, cte in mart_cte.items()]
    q["maintenance_counts"] = " UNION ALL ".join(counts)
    pickup_of = {t: dict(RAW_CONFORM[t])["pickup_datetime"] for t in config.TAXI_TYPES}
    later = [_quarantine_select(t, REASONS[t], ts(C.AS_OF)).replace(f"FROM {t}_raw)", f"FROM {t}_raw WHERE {pickup_of[t]} >= {ts(C.EVOLVED_FROM)})")
             for t in config.TAXI_TYPES]
    q["update_after_maintenance"] = " UNION ALL ".join(
        [c for c in counts if "quarantine" not in c]
        + ["SELECT 'silver.quarantine_trips', COUNT(*) FROM (" + " UNION ALL ".join(later) + ")"])
    again = " OR ".join(f"(pickup_datetime >= {ts(end)} - INTERVAL {first} HOURS AND pickup_datetime < {ts(end)} - INTERVAL {last} HOURS)"
                        for replays in C.REPLAYS for end, first, last in replays)
    whole = " UNION ALL ".join(_quarantine_select(t, REASONS[t], ts(C.AS_OF)) for t in config.TAXI_TYPES)
    q["backfill_then_stream"] = (
        f"WITH q AS ({whole}), landed AS (SELECT * FROM q UNION ALL SELECT * FROM q WHERE {again}) "
        + " UNION ALL ".join(f"SELECT 'silver' AS layer, taxi_type, CAST(CAST(pickup_datetime AS DATE) AS VARCHAR) AS bucket, "
                             f"CAST(count(*) AS BIGINT) AS row_count FROM {t}_silver GROUP BY ALL" for t in config.TAXI_TYPES)
        + " UNION ALL SELECT 'quarantine', taxi_type, quarantine_reason, count(*) FROM landed GROUP BY ALL"
        " UNION ALL SELECT 'gold', taxi_type, CAST(trip_date AS VARCHAR) || '|' || borough, trip_count FROM daily")
    for t in ("yellow", "fhvheavy"):
        late = f"coalesce(pickup_datetime < {ts(C.LATE_BEFORE)}, false)"
        arrival = f"CASE WHEN {late} THEN pickup_datetime + INTERVAL {C.LATE_DAYS} DAYS ELSE pickup_datetime END"
        wave = " + ".join(f"CAST(coalesce({arrival} >= {ts(w)}, false) AS INTEGER)" for w in C.WAVES)
        wave = f"greatest({wave}, CAST({late} AS INTEGER))"
        keys = ", ".join(config.DEDUP_KEYS[t])
        q[f"late_rows_{t}"] = (
            f"WITH r AS (SELECT *, {late} AS late, {wave} AS wave FROM {t}_conf), "
            f"s AS (SELECT {wave} AS wave, count(*) AS n FROM {t}_silver GROUP BY 1) "
            f"SELECT r.wave, CAST(count(*) AS BIGINT) AS rows_read, CAST(count_if(late) AS BIGINT) AS late_rows, "
            f"CAST(count_if(NOT late) - count(DISTINCT CASE WHEN NOT late THEN row({keys}) END) AS BIGINT) AS duplicate_rows, "
            f"CAST(coalesce(any_value(s.n), 0) AS BIGINT) AS silver_rows FROM r LEFT JOIN s ON s.wave = r.wave GROUP BY r.wave")
    logged = [c for c in counts if "quarantine" not in c]
    logged += [f"SELECT 'silver.quarantine_{t}', COUNT(*) FROM ({_quarantine_select(t, REASONS[t], ts(C.AS_OF))})" for t in config.TAXI_TYPES]
    logged += ["SELECT 'bronze.zone_lookup_raw', COUNT(*) FROM zones_raw", "SELECT 'silver.zone_lookup', COUNT(*) FROM zones"]
    q["update_row_counts"] = " UNION ALL ".join(logged)
    q["stream_ingest"] = "SELECT *, CAST(NULL AS VARCHAR) AS _rescued_data FROM yellow_raw"
    dq_parts = [_metrics_select(f"(SELECT *, CAST(NULL AS VARCHAR) AS _rescued_data FROM {t}_raw)",
                                bronze_rules(t).rules, f"bronze.{t}_trips_raw") for t in config.TAXI_TYPES]
    dq_parts.append(_metrics_select("zones_conf", RULES["zone"].rules, "silver.zone_lookup"))
    dq_parts += [_metrics_select(f"{t}_dedup", RULES[t].rules, f"silver.{t}_trips") for t in config.TAXI_TYPES]
    q["rescued_bronze"] = q["rescued_parquet"]
    drifted = ("(SELECT * REPLACE (CASE WHEN coalesce(pickup >= " + ts(C.EVOLVED_FROM) + ", false) AND event_id % 37 = 0 "
               "THEN NULL ELSE passengers END AS passengers) FROM base WHERE taxi_type = 'yellow')")
    keys = "pickup, pu, dol, k"
    order = "dropoff, passengers, dist, fare, total, payment_type"
    tested = (f"(SELECT pickup AS pickup_datetime, dropoff AS dropoff_datetime, pu AS pickup_location_id, dol AS dropoff_location_id, "
              f"k AS VendorID, passengers AS passenger_count, dist AS trip_distance, fare AS fare_amount, total AS total_amount, "
              f"round((floor(epoch(dropoff)) - floor(epoch(pickup))) / 60, 2) AS trip_duration_mins FROM (SELECT * FROM {drifted} "
              f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1))")
    rescued = (f"(SELECT *, CASE WHEN late AND event_id % 37 = 0 THEN 'x' END AS _rescued_data FROM (SELECT *, "
               f"coalesce(pickup >= {ts(C.EVOLVED_FROM)}, false) AS late FROM base WHERE taxi_type = 'yellow'))")
    drift_parts = [_metrics_select(rescued, bronze_rules("yellow").rules, "bronze.yellow_trips_raw"),
                   _metrics_select(tested, RULES["yellow"].rules, "silver.yellow_trips"),
                   *(p for p in dq_parts if "yellow" not in p)]
    q["dq_metrics_drifted"] = ("SELECT dataset AS dataset_name, rule_name AS expectation_name, passed_records, failed_records FROM ("
                               + " UNION ALL ".join(drift_parts) + ")")
    q["update_dq_log"] = (
        "SELECT dataset AS dataset_name, rule_name AS expectation_name, passed_records, failed_records, "
        + sround("CAST(passed_records AS DOUBLE) / NULLIF(passed_records + failed_records, 0) * 100")
        + f" AS pass_rate_pct, {_layer_sql('dataset')} AS data_layer FROM (" + " UNION ALL ".join(dq_parts) + ")")
    return q


def _daily_from(where: str) -> str:
    return (f"SELECT trip_date, z.borough, p.taxi_type, CAST(count(*) AS BIGINT) AS trip_count, "
            f"CAST(SUM(TRY_CAST(revenue AS {EXACT})) AS DOUBLE) AS total_revenue, "
            f"CAST(SUM(TRY_CAST(trip_distance AS {EXACT})) AS DOUBLE) / NULLIF(COUNT(TRY_CAST(trip_distance AS {EXACT})), 0) AS avg_distance "
            f"FROM priced p LEFT JOIN zones z ON p.pickup_location_id = z.location_id "
            f"WHERE z.borough IS NOT NULL AND {where} GROUP BY trip_date, z.borough, p.taxi_type")


def _change_feed_sql() -> str:
    pk = config.MART_PK["daily_borough_metrics"]
    vals = ["trip_count", "total_revenue", "avg_distance"]
    on = " AND ".join(f"o.{c} IS NOT DISTINCT FROM n.{c}" for c in pk)
    differs = " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in vals)
    cols = pk + vals

    old = _daily_from(f"pickup_datetime < {ts(C.CHANGE_OLD_BEFORE)}")
    new = _daily_from(f"pickup_datetime >= {ts(C.CHANGE_NEW_FROM)}")
    return (
        f"WITH j AS (SELECT {', '.join('o.' + c + ' AS o_' + c for c in cols)}, {', '.join('n.' + c + ' AS n_' + c for c in cols)}, "
        f"o.trip_count IS NOT NULL AS in_old, n.trip_count IS NOT NULL AS in_new, ({differs}) AS differs "
        f"FROM ({old}) o FULL OUTER JOIN ({new}) n ON {on}) "
        f"SELECT 'insert' AS _change_type, {', '.join('n_' + c + ' AS ' + c for c in cols)} FROM j WHERE in_new AND NOT in_old "
        f"UNION ALL SELECT 'delete', {', '.join('o_' + c for c in cols)} FROM j WHERE in_old AND NOT in_new "
        f"UNION ALL SELECT 'update_preimage', {', '.join('o_' + c for c in cols)} FROM j WHERE in_old AND in_new AND differs "
        f"UNION ALL SELECT 'update_postimage', {', '.join('n_' + c for c in cols)} FROM j WHERE in_old AND in_new AND differs"
    )


def oracle_sql() -> dict[str, str]:
    prelude = "WITH " + FIXTURE_CTES + ",\n" + _layer_ctes() + ",\n" + _mart_ctes() + "\n"
    out = {}
    for k, sel in _final_selects().items():
        if sel.lstrip().upper().startswith("WITH "):
            # nested WITH: wrap as a subquery of the prelude
            out[k] = prelude + f"SELECT * FROM ({sel})"
        else:
            out[k] = prelude + sel
    return out
