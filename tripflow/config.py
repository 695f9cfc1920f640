"""Constants of the trip domain.

Everything below the "fixed values" marker must equal the behaviour being
reproduced (names, ids, thresholds, labels, declared schemas). They are kept
together, as plain text, in their natural order.
"""

from __future__ import annotations

TAXI_TYPES = ("yellow", "green", "fhv", "fhvheavy")

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------

# Raw column -> conformed column, per source.
RENAMES = {
    "yellow": {
        "tpep_pickup_datetime": "pickup_datetime",
        "tpep_dropoff_datetime": "dropoff_datetime",
        "PULocationID": "pickup_location_id",
        "DOLocationID": "dropoff_location_id",
    },
    "green": {
        "lpep_pickup_datetime": "pickup_datetime",
        "lpep_dropoff_datetime": "dropoff_datetime",
        "PULocationID": "pickup_location_id",
        "DOLocationID": "dropoff_location_id",
    },
    "fhv": {
        "dropOff_datetime": "dropoff_datetime",
        "PUlocationID": "pickup_location_id",
        "DOlocationID": "dropoff_location_id",
    },
    "fhvheavy": {
        "PULocationID": "pickup_location_id",
        "DOLocationID": "dropoff_location_id",
    },
}

ZONE_RENAMES = {"LocationID": "location_id", "Borough": "borough", "Zone": "zone_name"}

# Column that clusters each raw (bronze) table: the raw pickup time.
BRONZE_CLUSTER = {
    "yellow": "tpep_pickup_datetime",
    "green": "lpep_pickup_datetime",
    "fhv": "pickup_datetime",
    "fhvheavy": "pickup_datetime",
}

# Deduplication key per source (conformed names).
DEDUP_KEYS = {
    "yellow": ["pickup_datetime", "pickup_location_id", "dropoff_location_id", "VendorID"],
    "green": ["pickup_datetime", "pickup_location_id", "dropoff_location_id", "VendorID"],
    "fhv": ["pickup_datetime", "pickup_location_id", "dropoff_location_id", "dispatching_base_num"],
    "fhvheavy": ["pickup_datetime", "pickup_location_id", "dropoff_location_id", "hvfhs_license_num"],
}
WATERMARK_DELAY = "24 hours"

# Hive partition columns of the silver tables.
SILVER_PARTITIONS = {
    "yellow": ["taxi_type", "pickup_year", "pickup_month"],
    "green": ["taxi_type", "pickup_year", "pickup_month"],
    "fhv": ["taxi_type", "pickup_year", "pickup_month"],
    "fhvheavy": ["pickup_year", "pickup_month"],
}

# Per-flow Spark confs of the largest source.
FLOW_CONF = {
    "fhvheavy": {
        "spark.sql.shuffle.partitions": "800",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    },
}

# Airport location ids.
JFK_LOCATION_ID = 132
LAGUARDIA_LOCATION_ID = 138
NEWARK_LOCATION_ID = 1

# Green trip_type code -> description (anything else: Unknown).
TRIP_TYPE_DESC = {1: "Street-hail", 2: "Dispatch"}
TRIP_TYPE_OTHER = "Unknown"

# Payment code -> label shown by the payment dashboard (anything else: Unknown).
PAYMENT_LABELS = {1: "Credit Card", 2: "Cash", 3: "No Charge", 4: "Dispute"}
PAYMENT_OTHER = "Unknown"

# Layer of a dataset name: first substring that matches, else the fallback.
LAYERS = ("bronze", "silver", "gold")
LAYER_OTHER = "other"

# Freshness SLA in hours by layer; the fallback is the last value.
SLA_HOURS = {"bronze": 6, "silver": 12, "gold": 24}
SLA_DEFAULT_HOURS = 24
# Freshness severity: above 2x the threshold, above 1x, otherwise.
SLA_SEVERITY = ("CRITICAL", "WARNING", "OK")

# Event log vocabulary.
EVENT_UPDATE = "update_progress"
EVENT_FLOW = "flow_progress"
LEVEL_ERROR = "ERROR"
STATUS_COMPLETED = "COMPLETED"

# Update states that end a run.
TERMINAL_STATES = ("COMPLETED", "FAILED", "CANCELED")

# Error category by message substring (case-sensitive), first match wins.
ERROR_CATEGORIES = {"schema": "SCHEMA", "permission": "PERMISSION", "resource": "RESOURCE", "data": "DATA"}
ERROR_CATEGORY_OTHER = "OTHER"
# Error severity: any of these substrings -> CRITICAL; else any of these -> HIGH; else LOW.
ERROR_CRITICAL_WORDS = ("FATAL", "critical")
ERROR_HIGH_WORDS = ("schema", "permission")
ERROR_SEVERITY = ("CRITICAL", "HIGH", "LOW")

# Separator of quarantine reasons.
REASON_SEPARATOR = ", "

# Quarantine retention.
QUARANTINE_RETENTION_DAYS = 90

# Shape of the per-flow expectation list inside event-log details JSON.
EXPECTATIONS_DDL = (
    "ARRAY<STRUCT<name: STRING, dataset: STRING, passed_records: BIGINT, failed_records: BIGINT>>"
)

# Declared schemas.
QUARANTINE_DDL = (
    "pickup_datetime TIMESTAMP, dropoff_datetime TIMESTAMP, pickup_location_id LONG, "
    "dropoff_location_id LONG, taxi_type STRING, quarantine_reason STRING, _quarantined_at TIMESTAMP"
)

MART_DDL = {
    "daily_borough_metrics": (
        "trip_date DATE, borough STRING, taxi_type STRING, trip_count BIGINT, "
        "total_revenue DOUBLE, avg_distance DOUBLE"
    ),
    "hourly_demand": (
        "hour_of_day INT, day_of_week INT, borough STRING, taxi_type STRING, trip_count BIGINT"
    ),
    "airport_metrics": (
        "trip_date DATE, taxi_type STRING, jfk_pickups BIGINT, jfk_dropoffs BIGINT, "
        "laguardia_pickups BIGINT, laguardia_dropoffs BIGINT, newark_pickups BIGINT, "
        "newark_dropoffs BIGINT, total_airport_trips BIGINT"
    ),
    "zone_revenue": (
        "pickup_location_id INT, zone_name STRING, borough STRING, taxi_type STRING, "
        "trip_count BIGINT, total_revenue DOUBLE, avg_revenue DOUBLE, min_revenue DOUBLE, "
        "max_revenue DOUBLE"
    ),
    "payment_trends": (
        "trip_date DATE, payment_type BIGINT, taxi_type STRING, trip_count BIGINT, "
        "total_revenue DOUBLE, avg_fare DOUBLE"
    ),
    "trip_type_summary": (
        "trip_date DATE, borough STRING, trip_type BIGINT, trip_count BIGINT, trip_type_desc STRING"
    ),
}

MART_PK = {
    "daily_borough_metrics": ["trip_date", "borough", "taxi_type"],
    "hourly_demand": ["hour_of_day", "day_of_week", "borough", "taxi_type"],
    "airport_metrics": ["trip_date", "taxi_type"],
    "zone_revenue": ["pickup_location_id", "taxi_type"],
    "payment_trends": ["trip_date", "payment_type", "taxi_type"],
    "trip_type_summary": ["trip_date", "borough", "trip_type"],
}

# Clustering columns of each gold table (its common filter columns).
MART_CLUSTER = {
    "daily_borough_metrics": ["trip_date", "borough"],
    "hourly_demand": ["hour_of_day", "day_of_week"],
    "airport_metrics": ["trip_date", "taxi_type"],
    "zone_revenue": ["borough", "taxi_type"],
    "payment_trends": ["trip_date", "payment_type"],
    "trip_type_summary": ["trip_date", "borough"],
}

# ---------------------------------------------------------------------------
# Our own choices (not reference values)
# ---------------------------------------------------------------------------

# Measures are summed exactly as decimals, then returned as DOUBLE: a double
# sum depends on the order rows reach the aggregate, a decimal sum does not.
EXACT_MEASURE = "DECIMAL(24,6)"
# Double-valued mart columns re-aggregated by serving queries.
EXACT_REAGG = "DECIMAL(38,10)"

# Upper bound on rows of a dimension we agree to broadcast.

