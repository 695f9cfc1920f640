"""Deduplication by business key.

Streaming: ``dropDuplicatesWithinWatermark`` on an event-time column (state
bounded by the watermark). Batch backfill: a keyed aggregate that keeps, per
key, the smallest row under a total order of the remaining columns. The
aggregate runs partially on the map side before the shuffle, so a hot key
(even a third of all rows) reaches the reducer as one row per map task; a
window ``row_number`` would instead sort the whole hot group in one task.
Every key contains the event time itself, so on data that is not late the
batch result equals the streaming result. (Spark plans its own
``dropDuplicates(keys)`` the same way, partial + final sort aggregate, but
keeps an arbitrary survivor; ours is deterministic.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow import config

_ROW = "__survivor"


def dedup_batch(df: DataFrame, keys: list[str], tie_break: list[str] | None = None) -> DataFrame:
    """One row per distinct ``keys`` (NULL equals NULL).

    The survivor is the minimum of ``tie_break`` + the other columns, compared
    left to right, ascending, NULLs first; hence deterministic. Output keeps
    the input column order.
    """
    rest = [c for c in df.columns if c not in keys]
    order = list(tie_break or []) + [c for c in rest if c not in (tie_break or [])]
    fields = ", ".join(f"`{c}`" for c in order)
    survivors = df.groupBy(*keys).agg(F.expr(f"min(struct({fields}))").alias(_ROW))
    return survivors.selectExpr(*[f"`{c}`" if c in keys else f"`{_ROW}`.`{c}` AS `{c}`" for c in df.columns])


def dedup_stream(df: DataFrame, keys: list[str], event_time: str = "pickup_datetime",
                 delay: str = config.WATERMARK_DELAY) -> DataFrame:
    """Streaming dedup within an event-time watermark; the helper event-time
    column is added, used, and dropped again."""
    return (df.withColumn("_event_time", F.col(event_time).cast("timestamp"))
            .withWatermark("_event_time", delay)
            .dropDuplicatesWithinWatermark(keys)
            .drop("_event_time"))


def dedup_trips(df: DataFrame, taxi_type: str, streaming: bool | None = None) -> DataFrame:
    keys = config.DEDUP_KEYS[taxi_type]
    streaming = df.isStreaming if streaming is None else streaming
    if streaming:
        return dedup_stream(df, keys)
    # _created_at is one instant per run: keep it out of the tie-break.
    tie = [c for c in df.columns if c not in keys and c != "_created_at"]
    return dedup_batch(df, keys, tie)
