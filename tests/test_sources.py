"""File sources: CSV sample format, schema evolution, rescued data."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tripflow.sources import fixtures
from tripflow.sources.files import (RAW_SCHEMAS, SAMPLE_CSV_SCHEMA, align, merge_schema, read_evolving,
                                    read_trip_csv, rescue, schema_of, union_evolving)


SPLITS: dict = {}  # settings to put back


def test_csv_sample_roundtrip(spark, scratch):
    raw = fixtures.raw_trips(spark, SF_SMALL, "yellow").drop("payment_type")
    path = os.path.join(scratch, "csv")
    raw.write.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(path)
    back = read_trip_csv(spark, path)
    assert back.schema == schema_of(SAMPLE_CSV_SCHEMA)
    assert back.exceptAll(raw).count() == 0 and raw.exceptAll(back).count() == 0


def test_merge_schema_appends_new_columns():
    known = schema_of("a BIGINT, b STRING")
    new = schema_of("A BIGINT, c DOUBLE, b BIGINT")
    merged = merge_schema(known, new)
    assert [(f.name, f.dataType.simpleString()) for f in merged.fields] == \
        [("a", "bigint"), ("b", "string"), ("c", "double")]


def test_align_and_union_evolving(spark):
    old = spark.createDataFrame([(1, "x")], "a BIGINT, b STRING")
    new = spark.createDataFrame([(2, "y", 1.5)], "a BIGINT, b STRING, c DOUBLE")
    u = union_evolving([old, new])
    assert sorted(u.collect(), key=lambda r: r.a)[0].c is None
    al = align(old, merge_schema(old.schema, new.schema))
    assert al.columns == ["a", "b", "c"] and al.first().c is None


def test_read_evolving_directory(spark, scratch):
    spark.createDataFrame([(1, "x")], "a BIGINT, b STRING").write.parquet(os.path.join(scratch, "gen=1"))
    spark.createDataFrame([(2, "y", 1.5)], "a BIGINT, b STRING, c DOUBLE").write.parquet(os.path.join(scratch, "gen=2"))
    df = read_evolving(spark, scratch)
    assert set(df.columns) >= {"a", "b", "c"}
    assert df.filter("c IS NULL").count() == 1


def test_rescue_keeps_unparsable_and_extra_columns(spark):
    text = spark.createDataFrame([("1", "2.5", None, "extra!"), ("x", "3.0", "7", None)],
                                 "id STRING, amount STRING, n STRING, surprise STRING")
    out = {r.amount: r for r in rescue(text, "id BIGINT, amount DOUBLE, n BIGINT").collect()}
    assert out[2.5].id == 1 and out[2.5]._rescued_data == '{"surprise":"extra!"}'
    assert out[3.0].id is None and out[3.0].n == 7 and out[3.0]._rescued_data == '{"id":"x"}'
    clean = rescue(text.drop("surprise").filter("id = '1'"), "id BIGINT, amount DOUBLE, n BIGINT")
    assert clean.first()._rescued_data is None


def test_fixture_raw_schemas_match_declared(spark):
    for t, ddl in RAW_SCHEMAS.items():
        got = fixtures.raw_trips(spark, SF_SMALL, t).schema
        want = schema_of(ddl)
        assert [(f.name, f.dataType) for f in got.fields] == [(f.name, f.dataType) for f in want.fields], t


def test_event_stream_reads_whole_table(spark, scratch):
    q = (fixtures.stream_events(spark, SF_SMALL).writeStream.format("parquet")
         .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True)
         .start(os.path.join(scratch, "out")))
    q.awaitTermination()
    assert spark.read.parquet(os.path.join(scratch, "out")).count() == \
        spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    assert F is not None


def test_parquet_rescue_keeps_drifted_values(spark, scratch):
    from tripflow.sources.files import read_parquet_rescued
    good = spark.createDataFrame([(1, 2.5, "a")], "id BIGINT, amount DOUBLE, s STRING")
    drifted = spark.createDataFrame([("2", "3.5", "b", "x"), ("n/a", None, "c", None)],
                                    "id STRING, amount STRING, s STRING, extra STRING")
    good.write.parquet(os.path.join(scratch, "f1"))
    drifted.write.parquet(os.path.join(scratch, "f2"))
    with_schema = "id BIGINT, amount DOUBLE, s STRING"
    out = {r.s: r for r in read_parquet_rescued(spark, scratch, with_schema).collect()}
    assert (out["a"].id, out["a"].amount, out["a"]._rescued_data) == (1, 2.5, None)
    assert (out["b"].id, out["b"].amount, out["b"]._rescued_data) == (2, 3.5, '{"extra":"x"}')
    assert (out["c"].id, out["c"].amount, out["c"]._rescued_data) == (None, None, '{"id":"n/a"}')


def test_parquet_rescue_loses_no_values(spark, scratch):
    """Integers beyond 2^53 beside NULLs stay exact; a number for a timestamp and an
    integer out of range are rescued."""
    from tripflow.sources.files import read_parquet_rescued
    spark.createDataFrame([(9007199254740993, 1700000000000000, 3000000000, 9007199254740993), (None, None, None, None), (-5, 0, 7, 4)],
                          "big BIGINT, ts BIGINT, small BIGINT, d BIGINT").write.parquet(scratch)
    out = read_parquet_rescued(spark, scratch, "big BIGINT, ts TIMESTAMP, small INT, d DOUBLE").collect()
    by = {r.big: r for r in out}
    assert set(by) == {9007199254740993, None, -5} and all(r.ts is None for r in out)
    first = by[9007199254740993]
    assert (first.small, first.d) == (None, None)
    assert first._rescued_data == '{"ts":"1700000000000000","small":"3000000000","d":"9007199254740993"}'
    assert (by[-5].small, by[-5].d, by[-5]._rescued_data) == (7, 4.0, '{"ts":"0"}')
    assert by[None]._rescued_data is None


def test_task_code_needs_no_package_on_executors(tmp_path):
    """Python run inside tasks (the parquet rescue reader) must not import
    tripflow on the workers: run from a directory where it isn't importable."""
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled','false').getOrCreate()\n"
        "import __spark_entry__ as E\n"
        "print('ROWS', E.queries()['rescued_parquet'](s, %r).count())\n" % (repo, SF_SMALL))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=str(tmp_path), env=env, capture_output=True,
                         text=True, timeout=600)
    assert "ROWS 214" in out.stdout, out.stderr[-3000:]


def test_parquet_rescue_reads_row_groups_in_parallel(spark, scratch, monkeypatch):
    """One file with many row groups is read by several tasks, every row once."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyspark.sql import functions as F
    from tripflow.sources.files import read_parquet_rescued
    os.makedirs(scratch, exist_ok=True)
    table = pa.table({"id": pa.array(range(20_000), pa.int64()), "s": pa.array([str(i) for i in range(20_000)])})
    pq.write_table(table, os.path.join(scratch, "big.parquet"), row_group_size=1_000)
    out = read_parquet_rescued(spark, scratch, "id BIGINT, s STRING")
    for k, v in {"spark.sql.files.maxPartitionBytes": "32k", "spark.sql.files.openCostInBytes": "0"}.items():
        monkeypatch.setitem(SPLITS, k, spark.conf.get(k))
        spark.conf.set(k, v)
    assert out.count() == 20_000 and out.select("id").distinct().count() == 20_000
    per_task = out.groupBy(F.spark_partition_id()).count().collect()
    for k, v in SPLITS.items():
        spark.conf.set(k, v)
    assert len(per_task) >= 4


def test_schema_check_without_new_files_keeps_version(spark, scratch):
    from tripflow.sources.files import evolve_stream_schema, load_schema
    landing, loc = os.path.join(scratch, "landing"), os.path.join(scratch, "_schemas")
    spark.createDataFrame([(1, "a")], "id BIGINT, s STRING").write.parquet(landing)
    first = evolve_stream_schema(spark, landing, loc)
    # a cutoff in the future: no file counts as new, the recorded schema stands
    again = evolve_stream_schema(spark, landing, loc)
    assert again == first == load_schema(spark, loc)
    versions = sorted(int(r.value.split("\t")[0]) for r in spark.read.text(loc).collect())
    assert versions == [0, 0]


def test_rescue_of_numbers_keeps_what_does_not_fit(spark):
    rows = [(1.5, 2.0, 9007199254740993, 300, 0.1), (2.0, float("nan"), 4, 5, 1e300), (None, float("inf"), None, None, None)]
    df = spark.createDataFrame(rows, "a DOUBLE, b DOUBLE, c BIGINT, d INT, e DOUBLE")
    out = rescue(df, "a BIGINT, b DOUBLE, c DOUBLE, d TINYINT, e BIGINT").collect()
    assert [(r.a, r.c, r.d, r.e, r._rescued_data) for r in out] == [
        (None, None, None, None, '{"a":"1.5","c":"9007199254740993","d":"300","e":"0.1"}'),
        (2, 4.0, 5, None, '{"e":"1.0E300"}'), (None, None, None, None, None)]


def test_groups_of_files_by_types(spark, scratch):
    from tripflow.sources.files import landed_files, read_landed, schema_groups
    for i, ddl in enumerate(["a BIGINT", "a STRING", "a BIGINT, x INT", "a STRING, y INT", "a BIGINT"]):
        cols = [F.lit(str(i) if "STRING" in ddl else i).cast("string" if "STRING" in ddl else "bigint").alias("a")]
        cols += [F.lit(i).alias(n) for n in ("x", "y") if f" {n} INT" in ddl]
        spark.range(1).select(*cols).coalesce(1).write.parquet(os.path.join(scratch, f"f{i}"))
    files = landed_files(spark, scratch)
    assert sorted(len(f) for _, f in schema_groups(spark, files)) == [2, 3] and schema_groups(spark, []) == []
    got = read_landed(spark, files, "a BIGINT")
    assert set(got.columns) == {"a", "x", "y", "_rescued_data"} and sorted(r.a for r in got.collect()) == [0, 1, 2, 3, 4]
    assert read_landed(spark, [], "a BIGINT").isEmpty()
