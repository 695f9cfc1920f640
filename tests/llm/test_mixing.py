"""Mixing against its SQL and a plain version; awkward inputs."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import oracle_compare as oc
from conftest import SF_SMALL
from tripflow.llm import common, mixing

SCHEMA = "doc_id long, source string, text string"


@pytest.fixture(autouse=True)
def prepared(spark):
    common.prepare(spark)


def plain_targets(sizes: dict) -> dict:
    """Shares the excess out by hand, round after round."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, got, open_ = 1.5 * sum(sizes.values()), dict.fromkeys(names, 0.0), set(names)
    while open_ and left > 1e-9:
        level = left / sum(weight[s] for s in open_)
        for s in sorted(open_, key=str):
            part = min(level * weight[s], 2 * sizes[s] - got[s])
            got[s] += part
            left -= part
        open_ = {s for s in open_ if got[s] < 2 * sizes[s] - 1e-9}
    return got


def taken(spark, rows, **options):
    return mixing.repeats(spark.createDataFrame(rows, SCHEMA), ["doc_id"], **options)


def test_op11_matches_its_sql(spark):
    res = oc.compare(mixing.op11_mixing(spark, SF_SMALL), oc.duck(SF_SMALL), mixing.OP11_SQL)
    assert res["columns_match"] and res["match"], res


@pytest.mark.parametrize("counts", [
    {"a": 10, "b": 10, "c": 10}, {"a": 1, "b": 1000, "c": 1, "d": 1, "e": 5}, {None: 50, "z": 0, "é": 7},
    {"only": 9}, {"a": 0}, {f"s{i:02}": i * i for i in range(23)}])
def test_targets_against_plain(spark, counts):
    rows = [(i, s, "w " * n) for i, (s, n) in enumerate(counts.items())]
    got = {r.source: r.target for r in taken(spark, rows).select("source", "target").collect()}
    want = plain_targets(counts)
    assert got == pytest.approx(want)


def test_taken_words_come_near_their_targets(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"s{i % 7}", "x\ty " * (1 + i % 9)) for i in range(6000)]
    df = taken(spark, rows)
    per = df.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("t"), F.first("target").alias("target")).collect()
    assert all(abs(r.t - r.target) < 0.07 * r.target for r in per)
    assert df.filter("copies > 2 or copies < 0").isEmpty()
    assert sorted(df.select("key.doc_id", "copies").collect()) == sorted(taken(spark, rows).select("key.doc_id", "copies").collect())


def test_mix_emits_every_copy_and_all_columns(spark):
    rows = [(i, f"s{i % 4}", "word " * (i % 5)) for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(c) for c in ("key", "row", "own", "at", "copies", "size", "of", "rate")})
    got = mixing.mix(df, ["doc_id"])
    assert got.columns == df.columns
    want = {r.doc_id: r.copies for r in mixing.repeats(df, ["doc_id"]).select("key.doc_id", "copies").collect() if r.copies}
    assert Counter(r.doc_id for r in got.collect()) == want


def test_awkward_rows(spark):
    rows = [(0, None, None), (1, None, ""), (2, "a", "one"), (2, "a", "one"), (None, "b", "x " * 20000), (None, None, "\xa0 \x85"), (3, "a", "\x0b\x0c\x1c")]
    got = taken(spark, rows).collect()
    assert len(got) == 7
    assert [r.size for r in sorted(got, key=lambda r: str((r.key.doc_id, r.size)))] == \
        [len(re.findall(mixing.WORDS, t or "")) for _, _, t in sorted(rows, key=lambda r: str((r[0], len(re.findall(mixing.WORDS, r[2] or "")))))]
    assert {r.copies for r in got if r.key.doc_id == 2} and len({r.copies for r in got if r.key.doc_id == 2}) == 1
    assert mixing.mix(spark.createDataFrame(rows, SCHEMA), ["doc_id"]).schema == spark.createDataFrame(rows, SCHEMA).schema


def test_empty_table(spark):
    assert taken(spark, []).isEmpty()
    assert mixing.mix(spark.createDataFrame([], SCHEMA), ["doc_id"]).isEmpty()
