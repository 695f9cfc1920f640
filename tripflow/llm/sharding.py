"""Sharding by jump consistent hashing.

A row's shard depends on its key and the number of shards alone, without a ring
table; with one shard more, the rows that move all move into the new one, about
one in ``n + 1``. ``slots`` numbers each shard's rows from 0 without a gap: rows
are dealt out by ranges of (shard, key), counted per range, and each range's
first number follows from a prefix sum, so that a shard of any size is
numbered by many tasks.

A null key counts as key 0. Null texts have no bytes. Rows alike in everything
share a key, so which of them gets which slot makes no difference. An empty
table gives no rows. Rows travel inside a struct, so further columns of any name pass;
the column that a function adds is replaced. Texts of any length are read once, whole.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripflow.llm.common import shuffle_partitions, staged

SHARDS = 40
ROW_BYTES = 16


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Lamping and Veach's jump consistent hash of 64-bit keys, for many keys at once."""
    key = np.asarray(keys).astype(np.uint64)
    shard, ahead = np.full(len(key), -1, np.int64), np.zeros(len(key), np.int64)
    live = np.arange(len(key)) if shards > 0 else np.empty(0, np.int64)
    while len(live):
        shard[live] = ahead[live]
        key[live] = key[live] * np.uint64(2862933555777941757) + np.uint64(1)
        step = float(1 << 31) / ((key[live] >> np.uint64(33)) + np.uint64(1)).astype(float)
        ahead[live] = ((shard[live] + 1) * step).astype(np.int64)
        live = live[ahead[live] < shards]
    return shard


def shard_of(key: Column, shards: int) -> Column:
    """The shard of a 64-bit key column."""
    if shards < 1:
        raise ValueError("at least one shard is needed")

    @F.pandas_udf("int")
    def jump(k: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(k.to_numpy(np.int64), shards).astype(np.int32))

    return jump(F.coalesce(key.cast("long"), F.lit(0).cast("long")))


def assign(df: DataFrame, key: str, shards: int, into: str = "shard") -> DataFrame:
    """``df`` with its rows' shard."""
    return df.withColumn(into, shard_of(F.col(key), shards))


def write_shards(df: DataFrame, key: str, shards: int, path: str) -> None:
    """``df`` as Parquet, one folder ``shard=N`` each, spread over tasks by shard and row."""
    n = shuffle_partitions(df.sparkSession)
    (assign(df, key, shards).repartitionByRange(n, "shard", F.xxhash64(key), F.monotonically_increasing_id())
     .write.partitionBy("shard").parquet(path))


def slots(df: DataFrame, order: list[str], shard: str = "shard", into: str = "slot") -> DataFrame:
    """``df`` with each row's number within its shard, by ``order``."""
    row = F.col("row")
    keys = [row[shard], *(row[c].asc_nulls_first() for c in order)]
    held = staged(df.select(F.struct("*").alias("row"), (F.monotonically_increasing_id() % 1024).alias("spread"))  # splits rows alike in all else
                  .repartitionByRange(shuffle_partitions(df.sparkSession), *keys, F.col("spread"))
                  .sortWithinPartitions(*keys).select("row", row[shard].alias("shard"), F.monotonically_increasing_id().alias("at")), "slots")
    held = held.withColumn("part", F.shiftright("at", 33))
    counts = held.groupBy("shard", "part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    # Ranges follow each other, so there are fewer rows here than tasks and shards together.
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("shard", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("base"))
    return held.join(F.broadcast(bases), ["shard", "part"]).select(
        *[row[c].alias(c) for c in df.columns if c != into], (F.col("at") + F.col("base")).cast("long").alias(into))


def op2_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` in 40 shards by ``doc_id``, and where a 41st would put them."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id", (F.octet_length(raw) + ROW_BYTES).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"))
    sharded = assign(assign(docs, "doc_id", SHARDS), "doc_id", SHARDS + 1, "grown_shard")
    return slots(sharded, ["doc_id", "text_crc32", "size"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
