"""Conform raw source rows to the shared trip model (renames + derived
columns). Stateless, so it serves batch and streaming frames alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow import config
from tripflow.functions.expressions import processing_time


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename the columns present (case-insensitively, like Spark's own
    resolution); absent ones are skipped."""
    lower = {c.lower(): c for c in df.columns}
    present = {lower[k.lower()]: v for k, v in mapping.items() if k.lower() in lower}
    return df.withColumnsRenamed(present) if present else df


def conform_trips(df: DataFrame, taxi_type: str, as_of=None) -> DataFrame:
    """Raw (bronze) rows -> conformed trip rows.

    Adds ``taxi_type``, ``pickup_year``, ``pickup_month``,
    ``trip_duration_mins`` and ``_created_at``; every raw column passes
    through under its conformed name.
    """
    lower = {k.lower(): v for k, v in config.RENAMES[taxi_type].items()}
    derived = {"taxi_type", "pickup_year", "pickup_month", "trip_duration_mins", "_created_at"}  # these replace raw ones
    names = {c: lower.get(c.lower(), c) for c in df.columns if c.lower() not in derived}   # raw -> conformed
    raw = {v: k for k, v in names.items()}                      # conformed -> raw
    pickup, dropoff = f"`{raw['pickup_datetime']}`", f"`{raw['dropoff_datetime']}`"
    # one projection: renames and derived columns together (duration as in
    # FN-1)
    out = df.selectExpr(
        *[f"`{c}` AS `{n}`" for c, n in names.items()],
        f"'{taxi_type}' AS taxi_type",
        f"year({pickup}) AS pickup_year",
        f"month({pickup}) AS pickup_month",
        f"round((unix_timestamp({dropoff}) - unix_timestamp({pickup})) / 60, 2) AS trip_duration_mins",
    )
    return out.withColumn("_created_at", processing_time(as_of))


def conform_for_quarantine(df: DataFrame, taxi_type: str) -> DataFrame:
    """Renames plus the source tag: the columns quarantine reasons read."""
    return rename(df, config.RENAMES[taxi_type]).withColumn("taxi_type", F.lit(taxi_type))


def conform_zones(df: DataFrame, as_of=None) -> DataFrame:
    return rename(df, config.ZONE_RENAMES).withColumn("_created_at", processing_time(as_of))
