"""Storage jobs: table layout on write, compaction, retention, key checks and
row-level change feeds, all as plain DataFrame jobs over parquet.

A job never rewrites the directory it reads: it writes a new directory and
the caller re-points readers at it (a directory written by a streaming file
sink is read through its own ``_spark_metadata`` log and must not be edited
in place).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.functions.expressions import processing_time


_SALT = "__cluster_tiebreak"


def clustered(df: DataFrame, cols: list[str], partitions: int | None = None) -> DataFrame:
    """Range-partition then sort by ``cols``: each task writes one contiguous
    key range, so files get tight min/max statistics (row-group skipping on
    those columns). A row hash is the last range key: a single hot value of
    ``cols`` (a third of all rows) is then cut into several ranges by the
    sampler instead of landing in one task. Without ``partitions`` AQE sizes
    the partition count from the data."""
    salted = df.withColumn(_SALT, F.xxhash64(*[F.col(c) for c in df.columns]))
    keys = [*cols, _SALT]
    out = salted.repartitionByRange(partitions, *keys) if partitions else salted.repartitionByRange(*keys)
    return out.sortWithinPartitions(*cols).drop(_SALT)


def write_clustered(df: DataFrame, path: str, cols: list[str], mode: str = "overwrite",
                    partitions: int | None = None) -> None:
    clustered(df, cols, partitions).write.mode(mode).parquet(path)


def rebalanced(df: DataFrame, partition_cols: list[str], sort_cols: list[str] | None = None) -> DataFrame:
    """Shuffle rows by their hive partition values with AQE's rebalance:
    each task then writes into few partition directories (no small-file
    explosion of tasks x months), small partitions are coalesced and a hot
    partition value (a month with a third of all rows) is split across
    several tasks instead of landing in one."""
    out = df.hint("rebalance", *partition_cols)
    return out.sortWithinPartitions(*partition_cols, *(sort_cols or []))


def write_rebalanced(df: DataFrame, path: str, partition_cols: list[str],
                     sort_cols: list[str] | None = None, mode: str = "overwrite") -> None:
    rebalanced(df, partition_cols, sort_cols).write.mode(mode).partitionBy(*partition_cols).parquet(path)


def write_partitioned(df: DataFrame, path: str, partition_cols: list[str],
                      cluster_cols: list[str] | None = None, mode: str = "overwrite") -> None:
    """Hive-partitioned write (``partitionBy``), rebalanced on the partition
    columns and sorted by ``cluster_cols`` inside each file."""
    write_rebalanced(df, path, partition_cols, cluster_cols, mode)


def compact(spark: SparkSession, src: str, dst: str, files: int | None = None,
            cluster_cols: list[str] | None = None, partition_cols: list[str] | None = None,
            target_file_mb: int = 256) -> DataFrame:
    """Rewrite the table at ``src`` into fewer, larger files at ``dst``.

    By default the file size drives the layout: rows are range-clustered on
    ``cluster_cols`` (or rebalanced on ``partition_cols``) and AQE coalesces
    the shuffle into partitions of about ``target_file_mb``, so nothing has
    to list or size the input on the driver. ``files`` forces an exact
    count instead (small tables only: each file is one task's output).
    Invariant: the same multiset of rows.
    """
    compact_frame(spark.read.parquet(src), dst, files, cluster_cols, partition_cols, target_file_mb)
    return spark.read.parquet(dst)


def compact_frame(df: DataFrame, dst: str, files: int | None = None, cluster_cols: list[str] | None = None,
                  partition_cols: list[str] | None = None, target_file_mb: int = 256) -> None:
    """``compact`` of a frame, e.g. all parts of a table."""
    spark = df.sparkSession
    keys = list(partition_cols or []) + list(cluster_cols or [])
    if keys:
        out = clustered(df, keys, files)
    else:
        out = df.repartition(files) if files else df.hint("rebalance")
    w = out.write.mode("overwrite")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{int(target_file_mb)}m",
            "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        w.parquet(dst)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def purge(df: DataFrame, ts_col: str, as_of=None, days: int = 90) -> DataFrame:
    """Rows kept by ``DELETE WHERE ts < now - INTERVAL days DAYS``: a NULL
    timestamp is not deleted (the predicate is NULL)."""
    cutoff = processing_time(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")
    return df.filter(F.col(ts_col).isNull() | (F.col(ts_col) >= cutoff))


def _any_null(cols: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def pk_violations(df: DataFrame, pk: list[str]) -> DataFrame:
    """Key values that occur more than once or contain a NULL (must be
    empty for a valid primary key). One aggregate on the key columns."""
    return (df.groupBy(*pk).agg(F.count(F.lit(1)).alias("row_count"))
            .filter((F.col("row_count") > 1) | _any_null(pk)))


def pk_summary(df: DataFrame, pk: list[str], table: str) -> DataFrame:
    """One row: number of duplicated keys and of rows with a NULL key part."""
    counts = df.groupBy(*pk).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.count_if((F.col("n") > 1) & ~_any_null(pk)).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(_any_null(pk), F.col("n"))), F.lit(0)).cast("long").alias("null_key_rows"),
    ).select(F.lit(table).alias("table_name"), "duplicate_keys", "null_key_rows")


def change_feed(old: DataFrame, new: DataFrame, pk: list[str], null_safe_keys: bool = False) -> DataFrame:
    """Row-level changes from ``old`` to ``new`` keyed by ``pk``:
    ``insert``, ``delete``, ``update_preimage`` + ``update_postimage``.

    One full outer join on the key, then each joined row emits 0, 1 or 2
    change rows through ``inline``; values are compared null-safely. Keys are
    non-NULL by contract (``pk_violations``), so the join uses plain
    equality: when both versions come out of an aggregate on ``pk`` (marts),
    the join reuses that hash partitioning instead of shuffling again.
    ``null_safe_keys`` matches NULL keys too (at the price of that shuffle).
    """
    values = [c for c in new.columns if c not in pk]
    o = old.select(*pk, *values).select(*[F.col(c).alias(f"o_{c}") for c in pk + values],
                                        F.lit(True).alias("o_present"))
    n = new.select(*pk, *values).select(*[F.col(c).alias(f"n_{c}") for c in pk + values],
                                        F.lit(True).alias("n_present"))
    eq = (lambda a, b: a.eqNullSafe(b)) if null_safe_keys else (lambda a, b: a == b)
    cond = reduce(lambda a, b: a & b, [eq(F.col(f"o_{c}"), F.col(f"n_{c}")) for c in pk])
    j = o.join(n, cond, "full_outer")
    in_old = F.col("o_present").isNotNull()
    in_new = F.col("n_present").isNotNull()
    differs = reduce(lambda a, b: a | b, [~F.col(f"o_{c}").eqNullSafe(F.col(f"n_{c}")) for c in values]) \
        if values else F.lit(False)

    def image(side: str, kind: str) -> Column:
        return F.struct(F.lit(kind).alias("_change_type"),
                        *[F.col(f"{side}_{c}").alias(c) for c in pk + values])

    changes = F.array(
        F.when(in_new & ~in_old, image("n", "insert")),
        F.when(in_old & ~in_new, image("o", "delete")),
        F.when(in_old & in_new & differs, image("o", "update_preimage")),
        F.when(in_old & in_new & differs, image("n", "update_postimage")),
    )
    return j.select(F.inline(F.filter(changes, lambda x: x.isNotNull())))


def apply_change_feed(old: DataFrame, changes: DataFrame, pk: list[str]) -> DataFrame:
    """``old`` with ``changes`` applied (inverse of ``change_feed``): drop
    deleted and pre-image keys, add inserts and post-images."""
    gone = changes.filter(F.col("_change_type").isin("delete", "update_preimage")).select(*pk)
    added = changes.filter(F.col("_change_type").isin("insert", "update_postimage")).drop("_change_type")
    kept = old.join(gone, [old[c].eqNullSafe(gone[c]) for c in pk], "left_anti")
    return kept.unionByName(added.select(*old.columns))
