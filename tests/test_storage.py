"""Storage jobs: change feed, compaction, retention purge, key checks,
partitioned layout."""

import datetime as dt
import glob
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tripflow import config
from tripflow.operators import storage
from tripflow.plans import catalog as C


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_change_feed_applied_to_old_gives_new(spark):
    pk = ["k"]
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, None, 3.0), (4, "d", None)],
                                "k INT, s STRING, x DOUBLE")
    new = spark.createDataFrame([(1, "a", 1.0), (2, "B", 2.0), (3, None, 3.0), (4, "d", 4.0), (5, "e", 5.0)],
                                "k INT, s STRING, x DOUBLE")
    cf = storage.change_feed(old, new, pk)
    kinds = sorted((r._change_type, r.k) for r in cf.collect())
    assert kinds == [("insert", 5), ("update_postimage", 2), ("update_postimage", 4),
                     ("update_preimage", 2), ("update_preimage", 4)]
    assert _same(storage.apply_change_feed(old, cf, pk), new)
    gone = storage.change_feed(new, old, pk)
    assert [r.k for r in gone.filter("_change_type = 'delete'").collect()] == [5]


def test_change_feed_query_reconstructs_new_version(spark):
    s = C._silver_all(spark, SF_SMALL)
    z = C._zones(spark, SF_SMALL)
    fn = C.MARTS["daily_borough_metrics"]
    old = fn({t: d.filter(F.col("pickup_datetime") < F.lit(C.CHANGE_OLD_BEFORE).cast("timestamp_ntz"))
              for t, d in s.items()}, z)
    new = fn({t: d.filter(F.col("pickup_datetime") >= F.lit(C.CHANGE_NEW_FROM).cast("timestamp_ntz"))
              for t, d in s.items()}, z)
    cf = C.q_change_feed(spark, SF_SMALL)
    assert {r._change_type for r in cf.select("_change_type").distinct().collect()} == \
        {"insert", "delete", "update_preimage", "update_postimage"}
    assert _same(storage.apply_change_feed(old, cf, config.MART_PK["daily_borough_metrics"]), new)


def test_compaction_keeps_rows_and_reduces_files(spark, scratch):
    src, dst = os.path.join(scratch, "v0"), os.path.join(scratch, "v1")
    df = C._silver(spark, SF_SMALL, "yellow")
    parts = config.SILVER_PARTITIONS["yellow"]
    df.repartition(16).write.partitionBy(*parts).parquet(src)
    out = storage.compact(spark, src, dst, files=1, cluster_cols=["pickup_datetime"], partition_cols=parts)
    n_src = len(glob.glob(f"{src}/**/*.parquet", recursive=True))
    n_dst = len(glob.glob(f"{dst}/**/*.parquet", recursive=True))
    assert n_dst < n_src
    assert _same(out, spark.read.parquet(src))


def test_purge_is_strict_and_keeps_null(spark):
    now = "2024-04-01 00:00:00"
    cutoff = dt.datetime(2024, 4, 1) - dt.timedelta(days=90)
    df = spark.createDataFrame([(1, cutoff), (2, cutoff - dt.timedelta(seconds=1)), (3, None)],
                               "id INT, ts TIMESTAMP")
    assert sorted(r.id for r in storage.purge(df, "ts", now, 90).collect()) == [1, 3]


def test_marts_have_valid_primary_keys(spark):
    summary = C.q_pk_violations(spark, SF_SMALL).collect()
    assert len(summary) == 6
    assert all(r.duplicate_keys == 0 and r.null_key_rows == 0 for r in summary)
    daily = C._mart("daily_borough_metrics")(spark, SF_SMALL)
    broken = daily.unionByName(daily.limit(1))
    assert storage.pk_violations(broken, config.MART_PK["daily_borough_metrics"]).count() == 1


def test_partitioned_silver_prunes_partitions(spark, scratch):
    path = os.path.join(scratch, "silver")
    storage.write_partitioned(C._silver(spark, SF_SMALL, "yellow"), path,
                              config.SILVER_PARTITIONS["yellow"], ["pickup_datetime"])
    q = spark.read.parquet(path).filter("pickup_year = 2024 AND pickup_month = 1")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pickup_year" in plan
    assert q.count() == C._silver(spark, SF_SMALL, "yellow").filter("pickup_month = 1").count()


def test_compaction_sized_by_target_file_size(spark, scratch):
    src, dst = os.path.join(scratch, "v0"), os.path.join(scratch, "v1")
    df = C._silver(spark, SF_SMALL, "fhvheavy")
    df.repartition(24).write.parquet(src)
    out = storage.compact(spark, src, dst, cluster_cols=["pickup_datetime"])
    assert len(glob.glob(f"{dst}/*.parquet")) < len(glob.glob(f"{src}/*.parquet"))
    assert _same(out, spark.read.parquet(src))


def test_clustered_write_splits_a_hot_cluster_value(spark, scratch):
    """A third of the rows share one cluster value: range partitioning with
    the row-hash tie-break spreads it over several files."""
    from pyspark.sql import functions as F
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.col("id"))
    out = storage.clustered(df, ["k"], partitions=12)
    sizes = [r[1] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    hot = out.filter("k = 0").groupBy(F.spark_partition_id()).count().count()
    assert hot >= 3 and max(sizes) < 20_000
    assert out.columns == ["k", "id"]
