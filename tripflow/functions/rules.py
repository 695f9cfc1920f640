"""Declarative data-quality rules.

A rule is ``(name, SQL predicate, action)``; ``action`` is ``"drop"`` (the
row must satisfy it to reach silver) or ``"warn"`` (kept, only counted). A row
satisfies a rule iff the predicate is TRUE: NULL counts as a failure. The same
predicate text drives filtering, per-rule metrics and quarantine reasons.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

DROP = "drop"
WARN = "warn"


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: str
    action: str = WARN

    @property
    def passed_sql(self) -> str:
        return f"coalesce(({self.predicate}), false)"

    def passed(self) -> Column:
        """TRUE iff the row satisfies the rule (NULL predicate -> FALSE)."""
        return F.expr(self.passed_sql)


@dataclass(frozen=True)
class RuleSet:
    dataset: str
    rules: tuple[Rule, ...]

    @property
    def drop_rules(self) -> tuple[Rule, ...]:
        return tuple(r for r in self.rules if r.action == DROP)

    @property
    def warn_rules(self) -> tuple[Rule, ...]:
        return tuple(r for r in self.rules if r.action == WARN)

    def __iter__(self):
        return iter(self.rules)


def rule_set(dataset: str, drop: dict[str, str] | None = None,
             warn: dict[str, str] | None = None) -> RuleSet:
    rules = [Rule(n, p, DROP) for n, p in (drop or {}).items()]
    rules += [Rule(n, p, WARN) for n, p in (warn or {}).items()]
    return RuleSet(dataset, tuple(rules))


# ---------------------------------------------------------------------------
# Rule names and predicates, in their original order.
# ---------------------------------------------------------------------------

RESCUED_DATA_IS_NULL = {"rescued_data_is_null": "_rescued_data IS NULL"}

YELLOW_GREEN_DROP = {
    "valid_pickup_datetime": "pickup_datetime IS NOT NULL",
    "valid_dropoff_datetime": "dropoff_datetime IS NOT NULL",
    "valid_pickup_location": "pickup_location_id BETWEEN 1 AND 265",
    "valid_dropoff_location": "dropoff_location_id BETWEEN 1 AND 265",
    "valid_trip_duration": "trip_duration_mins BETWEEN 0 AND 1440",
    "valid_date_range": "pickup_datetime >= '2024-01-01' AND pickup_datetime < '2027-01-01'",
    "valid_fare_amount": "fare_amount BETWEEN 0 AND 10000",
    "valid_total_amount": "total_amount BETWEEN 0 AND 50000",
}
YELLOW_GREEN_WARN = {
    "valid_passenger_count": "passenger_count BETWEEN 0 AND 9",
    "valid_trip_distance": "trip_distance BETWEEN 0 AND 500",
    "no_zero_fare": "fare_amount > 0",
}

FHV_DROP = {
    "valid_pickup_datetime": "pickup_datetime IS NOT NULL",
    "valid_dropoff_datetime": "dropoff_datetime IS NOT NULL",
    "valid_pickup_location": "pickup_location_id BETWEEN 1 AND 265",
    "valid_dropoff_location": "dropoff_location_id BETWEEN 1 AND 265",
    "valid_trip_duration": "trip_duration_mins BETWEEN 0 AND 1440",
    "valid_date_range": "pickup_datetime >= '2024-01-01' AND pickup_datetime < '2027-01-01'",
}
FHV_WARN = {
    "valid_dispatching_base": "dispatching_base_num IS NOT NULL",
}

FHVHEAVY_DROP = {
    "valid_pickup_datetime": "pickup_datetime IS NOT NULL",
    "valid_dropoff_datetime": "dropoff_datetime IS NOT NULL",
    "valid_pickup_location": "pickup_location_id BETWEEN 1 AND 265",
    "valid_dropoff_location": "dropoff_location_id BETWEEN 1 AND 265",
    "valid_trip_duration": "trip_duration_mins BETWEEN 0 AND 1440",
    "valid_date_range": "pickup_datetime >= '2024-01-01' AND pickup_datetime < '2027-01-01'",
    "valid_base_fare": "base_passenger_fare BETWEEN 0 AND 10000",
}
FHVHEAVY_WARN = {
    "valid_trip_miles": "trip_miles BETWEEN 0 AND 500",
    "valid_driver_pay": "driver_pay >= 0",
    "valid_tips": "tips >= 0",
}

ZONE_DROP = {
    "valid_location_id": "location_id IS NOT NULL",
    "valid_borough": "borough IS NOT NULL",
    "valid_zone_name": "zone_name IS NOT NULL",
}

# Quarantine reasons: name -> SQL condition that adds the reason. A NULL
# condition adds nothing. Upper bounds here are ">=" while the drop rules
# above use inclusive BETWEEN; both are kept as they are.
TRIP_REASONS_COMMON = {
    "null_pickup_datetime": "pickup_datetime IS NULL",
    "null_dropoff_datetime": "dropoff_datetime IS NULL",
    "invalid_pickup_location": "NOT (pickup_location_id BETWEEN 1 AND 265)",
    "invalid_dropoff_location": "NOT (dropoff_location_id BETWEEN 1 AND 265)",
}
FARE_REASONS = {
    "negative_fare": "fare_amount < 0",
    "excessive_fare": "fare_amount >= 10000",
    "negative_total": "total_amount < 0",
    "excessive_total": "total_amount >= 50000",
}
BASE_FARE_REASONS = {
    "negative_base_fare": "base_passenger_fare < 0",
    "excessive_base_fare": "base_passenger_fare >= 10000",
}

# ---------------------------------------------------------------------------

RULES = {
    "bronze.yellow_trips_raw": rule_set("bronze.yellow_trips_raw", warn=RESCUED_DATA_IS_NULL),
    "bronze.green_trips_raw": rule_set("bronze.green_trips_raw", warn=RESCUED_DATA_IS_NULL),
    "bronze.fhv_trips_raw": rule_set("bronze.fhv_trips_raw", warn=RESCUED_DATA_IS_NULL),
    "bronze.fhvheavy_trips_raw": rule_set("bronze.fhvheavy_trips_raw", warn=RESCUED_DATA_IS_NULL),
    "yellow": rule_set("silver.yellow_trips", YELLOW_GREEN_DROP, YELLOW_GREEN_WARN),
    "green": rule_set("silver.green_trips", YELLOW_GREEN_DROP, YELLOW_GREEN_WARN),
    "fhv": rule_set("silver.fhv_trips", FHV_DROP, FHV_WARN),
    "fhvheavy": rule_set("silver.fhvheavy_trips", FHVHEAVY_DROP, FHVHEAVY_WARN),
    "zone": rule_set("silver.zone_lookup", ZONE_DROP),
}

REASONS = {
    "yellow": {**TRIP_REASONS_COMMON, **FARE_REASONS},
    "green": {**TRIP_REASONS_COMMON, **FARE_REASONS},
    "fhv": dict(TRIP_REASONS_COMMON),
    "fhvheavy": {**TRIP_REASONS_COMMON, **BASE_FARE_REASONS},
}


def bronze_rules(taxi_type: str) -> RuleSet:
    return RULES[f"bronze.{taxi_type}_trips_raw"]


def reasons_from_rules(rules: RuleSet) -> dict[str, str]:
    """Reasons derived from every drop rule: a row gets the rule's name when
    the rule is not TRUE. Used by the complete quarantine mode, which leaves
    no dropped row without a trace."""
    return {r.name: f"NOT coalesce(({r.predicate}), false)" for r in rules.drop_rules}
