"""Spark session and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Confs every tripflow job relies on. Timestamps are compared as UTC wall
# clock; AQE re-plans joins and coalesces shuffle partitions at runtime.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # Watermark-dedup state lives in RocksDB (off-heap, spills to local disk,
    # changelog checkpoints): the in-memory provider does not scale to the
    # state of hundreds of millions of keys. Fixed at a checkpoint's first run.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


# Starting point for a large cluster (~100 TB input, ~1000 executors): plenty
# of initial shuffle partitions that AQE coalesces to ~256 MB each, skewed
# partitions split, 256 MB scan splits, Kryo, and a bigger broadcast bound
# only for tables proven small by tripflow's own check.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tripflow", extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with tripflow's base configuration.

    ``master`` is only set when given (a cluster submit provides its own).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    # getOrCreate may hand back an existing session: enforce the SQL confs.
    for k, v in conf.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names storage every executor can reach and that
    survives executor loss. Only when it is unset (local runs, tests) do we
    create a scratch folder and register it; on a cluster that would be a folder
    no executor shares, so there it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:  # set through SparkContext.setCheckpointDir
        root = spark.sparkContext.getCheckpointDir()
    if not root and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="tripflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, on whatever filesystem it names (local, HDFS,
    object stores), without running a failing read."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath))


def work_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A fresh path under the shared checkpoint folder for tables, stream
    sinks and stream checkpoints written by a job."""
    leaf = list(parts)
    if unique:
        leaf.append(uuid.uuid4().hex[:12])
    return os.path.join(checkpoint_root(spark), *leaf)
