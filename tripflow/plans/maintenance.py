"""Monthly maintenance: compact every pipeline table except the zone tables
(4 bronze, 5 silver including quarantine, 6 gold) and purge quarantine rows
older than the retention period.

Each table is rewritten into a new folder (never in place) and published there
(``operators.tables``): readers, and the streams that feed it, go on from the compacted
rows, so that purged rows stay gone. A job that stops midway leaves the tables not yet
done as they were. Compaction is size-driven (AQE advisory partition size), so
nothing lists or sizes files on the driver.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tripflow import config
from tripflow.operators.storage import compact_frame, purge
from tripflow.plans.pipeline import current_paths, quarantine_tables, table


def maintained_tables() -> dict[str, tuple[list[str], list[str]]]:
    """table -> (partition columns, clustering columns)."""
    out: dict[str, tuple[list[str], list[str]]] = {}
    for t in config.TAXI_TYPES:
        out[f"bronze.{t}_trips_raw"] = ([], [config.BRONZE_CLUSTER[t]])
    for t in config.TAXI_TYPES:
        out[f"silver.{t}_trips"] = (config.SILVER_PARTITIONS[t], ["pickup_datetime"])
    out["silver.quarantine_trips"] = ([], ["pickup_datetime"])
    for m, cols in config.MART_CLUSTER.items():
        out[f"gold.{m}"] = ([], cols)
    return out


def run_maintenance(spark: SparkSession, paths: dict[str, str], as_of=None,
                    retention_days: int = config.QUARANTINE_RETENTION_DAYS,
                    target_file_mb: int = 256) -> dict[str, str]:
    """Compact the 15 tables, purge quarantine; return where each table's current data
    lies. A table that was never written is passed over."""
    def write_to(parts: list[str], cluster: list[str]):
        return lambda df, dst: compact_frame(df, dst, cluster_cols=cluster, partition_cols=parts or None,
                                             target_file_mb=target_file_mb)

    for name, layout in maintained_tables().items():
        at, write = table(spark, paths, name), write_to(*layout)
        if (v := at.version()) is None:
            continue
        if name == "silver.quarantine_trips":
            at.replace(lambda folder: _purged(spark, at.data_folder(v), folder, write, as_of, retention_days))
        elif v.parts is None:
            at.replace(lambda folder: write(at.read(version=v), folder))
        else:
            at.compacted(write)
    return current_paths(spark, paths["_root"])


def _purged(spark: SparkSession, src: str, dst: str, write, as_of, retention_days: int) -> None:
    """The quarantine flows without old rows, in another folder."""
    new = quarantine_tables(spark, dst)
    for t, flow in quarantine_tables(spark, src).items():
        if flow.version() is not None:
            flow.compacted(write, lambda df: purge(df, "_quarantined_at", as_of, retention_days), new[t])
