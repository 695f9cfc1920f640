"""Layer composition: raw -> bronze -> silver -> gold, as lazy DataFrames.

These functions only build plans; ``tripflow.plans.pipeline`` materialises
them as tables in dependency order. Bronze adds the rescued-data column;
silver conforms, deduplicates (before the drop rules, as the source
pipeline does), then applies the drop rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.functions.rules import RULES
from tripflow.operators.conform import conform_for_quarantine, conform_trips, conform_zones
from tripflow.operators.dedup import dedup_trips
from tripflow.operators.quality import apply_rules, rule_metrics
from tripflow.operators.quarantine import quarantine_trips


def bronze(raw: DataFrame) -> DataFrame:
    """Raw rows + ``_rescued_data`` (NULL: typed parquet input needs no
    rescue; text inputs go through ``sources.files.rescue`` instead)."""
    if "_rescued_data" in raw.columns:
        return raw
    return raw.withColumn("_rescued_data", F.lit(None).cast("string"))


def conformed(bronze_df: DataFrame, taxi_type: str, as_of=None) -> DataFrame:
    return conform_trips(bronze_df, taxi_type, as_of)


def deduplicated(bronze_df: DataFrame, taxi_type: str, as_of=None) -> DataFrame:
    return dedup_trips(conformed(bronze_df, taxi_type, as_of), taxi_type)


def silver(bronze_df: DataFrame, taxi_type: str, as_of=None) -> DataFrame:
    return apply_rules(deduplicated(bronze_df, taxi_type, as_of), RULES[taxi_type])


def silver_metrics(bronze_df: DataFrame, taxi_type: str, as_of=None) -> DataFrame:
    """Per-rule counts over the rows the rules see (after dedup)."""
    return rule_metrics(deduplicated(bronze_df, taxi_type, as_of), RULES[taxi_type])


def silver_zones(raw_zones: DataFrame, as_of=None) -> DataFrame:
    return apply_rules(conform_zones(raw_zones, as_of), RULES["zone"])


def zone_metrics(raw_zones: DataFrame, as_of=None) -> DataFrame:
    return rule_metrics(conform_zones(raw_zones, as_of), RULES["zone"])


def quarantine(bronze_df: DataFrame, taxi_type: str, as_of=None, complete: bool = False) -> DataFrame:
    """Quarantine rows of one source, read from the same raw rows as bronze
    (before dedup). The complete mode evaluates every drop rule, so it needs
    the derived columns (duration) as well as the renames."""
    conf = conform_trips(bronze_df, taxi_type) if complete else conform_for_quarantine(bronze_df, taxi_type)
    return quarantine_trips(conf, taxi_type, as_of, complete)

