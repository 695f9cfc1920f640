"""Quarantine: rows that violate rules, with readable reasons.

Reference-compatible mode uses the per-source reason lists (which have no
reason for duration, date range or NULL amounts). ``complete=True`` derives
one reason per drop rule from the rule set itself, so every dropped row is
traced. Both are one projection + filter: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripflow import config
from tripflow.functions.expressions import processing_time, reasons_vector
from tripflow.functions.rules import REASONS, RULES, reasons_from_rules

def quarantine(df: DataFrame, reasons: dict[str, str], as_of=None) -> DataFrame:
    """Conformed rows -> the declared quarantine schema, violators only."""
    return (df.withColumn("_quarantined_at", processing_time(as_of))
            .withColumn("quarantine_reason", reasons_vector(reasons))
            .filter(F.col("quarantine_reason") != "")
            .to(StructType.fromDDL(config.QUARANTINE_DDL)))


def quarantine_trips(conformed: DataFrame, taxi_type: str, as_of=None, complete: bool = False) -> DataFrame:
    reasons = reasons_from_rules(RULES[taxi_type]) if complete else REASONS[taxi_type]
    return quarantine(conformed, reasons, as_of)
