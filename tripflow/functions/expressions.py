"""Scalar column expressions shared by operators (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripflow import config


def col_or_name(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def processing_time(as_of=None) -> Column:
    """Processing timestamp: ``current_timestamp()`` or an injected instant."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of.cast("timestamp")
    return F.lit(as_of).cast("timestamp")


def layer_of(name: str | Column) -> Column:
    """bronze / silver / gold / other by substring, first match wins."""
    c = col_or_name(name)
    return first_match(c, {layer: layer for layer in config.LAYERS}, config.LAYER_OTHER)


def first_match(c: Column, substrings: dict[str, str], other: str) -> Column:
    """Value of the first substring contained in ``c`` (dict order), else ``other``."""
    out = None
    for sub, value in substrings.items():
        out = F.when(c.contains(sub), value) if out is None else out.when(c.contains(sub), value)
    return out.otherwise(other)


def contains_any(c: Column, words) -> Column:
    cond = None
    for w in words:
        cond = c.contains(w) if cond is None else cond | c.contains(w)
    return cond


def sla_threshold_hours(name: str | Column) -> Column:
    c = col_or_name(name)
    out = None
    for layer, hours in config.SLA_HOURS.items():
        out = (F.when(c.contains(layer), hours) if out is None
               else out.when(c.contains(layer), hours))
    return out.otherwise(config.SLA_DEFAULT_HOURS)


def code_label(code: str | Column, labels: dict[int, str], other: str) -> Column:
    """Simple CASE: integer code -> label, everything else -> ``other``."""
    c = col_or_name(code)
    out = None
    for k, v in labels.items():
        out = F.when(c == k, v) if out is None else out.when(c == k, v)
    return out.otherwise(other)


def payment_label(code: str | Column = "payment_type") -> Column:
    return code_label(code, config.PAYMENT_LABELS, config.PAYMENT_OTHER)


def trip_type_desc(code: str | Column = "trip_type") -> Column:
    return code_label(code, config.TRIP_TYPE_DESC, config.TRIP_TYPE_OTHER)


def exact(c: str | Column, decimal_type: str = config.EXACT_MEASURE) -> Column:
    """Cast a measure to an exact decimal so that sums are order-independent.

    ``try_cast``: a value the decimal can't hold (NaN, infinity, >= 1e18)
    becomes NULL instead of failing the job."""
    return col_or_name(c).try_cast(decimal_type)


def reasons_vector(reasons: dict[str, str]) -> Column:
    """Ordered ', '-joined names of every reason whose condition is TRUE
    (a NULL condition adds nothing)."""
    parts = ", ".join(f"CASE WHEN {cond} THEN '{name}' END" for name, cond in reasons.items())
    return F.expr(f"concat_ws('{config.REASON_SEPARATOR}', {parts})")
