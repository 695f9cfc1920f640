"""Dimension joins.

The fact side comes pre-aggregated per location (``operators.marts``), so what meets
the dimension is small whichever way it is joined. No side is hinted: Spark
broadcasts by its byte threshold, at run time too (AQE), and shuffles beyond it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def zone_side(zones: DataFrame) -> DataFrame:
    """The zone columns marts need."""
    return zones.select("location_id", "borough", "zone_name")


def attach_zones(df: DataFrame, zones: DataFrame, how: str = "left",
                 location_col: str = "pickup_location_id") -> DataFrame:
    """``df`` joined to zones on ``location_col = location_id`` (zone columns added,
    ``location_id`` dropped). ``zones`` should come from ``zone_side``."""
    return (df.join(zones, F.col(location_col) == zones["location_id"], how)
            .drop(zones["location_id"]))
