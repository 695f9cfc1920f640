"""tripflow: a PySpark-native medallion pipeline for trip records.

Raw trip streams are ingested (bronze), conformed, deduplicated and checked
by declarative rules (silver), violating rows are routed to a quarantine
table, and clean rows are aggregated into marts (gold). Audit views, serving
queries and storage jobs complete the picture. Every operator is a plain
function DataFrame(s) -> DataFrame built from Spark SQL expressions, so the
same code runs in batch backfills and in Structured Streaming.
"""

__version__ = "0.1.0"
