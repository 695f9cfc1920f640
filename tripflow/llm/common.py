"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

import tripflow
from tripflow.session import work_path

#: Rows handed to Python at once. Texts can be long, so batches are short.
ARROW_ROWS = 256


def prepare(spark: SparkSession) -> None:
    """Settings that the operators' Python stages rely on: short batches, and
    workers that find this package wherever it is mounted."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    root = os.path.dirname(os.path.dirname(os.path.abspath(tripflow.__file__)))
    env = spark.sparkContext.environment
    if root not in (paths := env.get("PYTHONPATH", "").split(os.pathsep)):
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet under the shared folder of
    ``spark.checkpoint.dir`` and read back: lineage ends there, so a lost
    executor costs a read, not a recomputation."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def plain_scan(df: DataFrame) -> bool:
    """Whether ``df`` gives its rows in the same order each time: nothing is exchanged on the way."""
    return "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def prefix_sums(totals: DataFrame, order: str, total: str, base: str) -> DataFrame:
    """``totals`` plus ``base``: the sum of ``total`` over all rows of smaller
    ``order``. One row per task or shard of the caller, so the single sorted
    window holds at most as many rows as the job has tasks."""
    before = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn(base, F.coalesce(F.sum(total).over(before), F.lit(0)).cast("long"))


def groups(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.Table]:
    """Runs of rows that are equal in their first ``width`` columns, whole."""
    rest = None
    for b in batches:
        t = pa.Table.from_batches([b])
        t = t if rest is None else pa.concat_tables([rest, t]).combine_chunks()
        new = np.zeros(len(t), bool)
        for i in range(width):
            x = t.column(i).to_numpy()
            new[1:] |= x[1:] != x[:-1]
        cuts = np.flatnonzero(new)
        at = 0
        for c in cuts:
            if c - at > 1:
                yield t.slice(at, c - at)
            at = c
        rest = t.slice(at)
    if rest is not None and len(rest) > 1:
        yield rest
