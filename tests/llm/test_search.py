"""Ranked search against its SQL and a plain version; awkward inputs."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import oracle_compare as oc
from conftest import SF_SMALL
from tripflow.llm import common, search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


@pytest.fixture(autouse=True)
def prepared(spark):
    common.prepare(spark)


def words(text):
    return TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def plain(docs, items):
    """(item id, rank, doc id, score), rows being told apart by place."""
    counts = [(i, Counter(words(t))) for i, t in docs]
    n_docs, total = sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(w for _, c in counts for w in c)
    out = []
    for item, text in items:
        scored = []
        for at, (doc, c) in enumerate(counts):
            score, n = 0, sum(c.values())
            for w in set(words(text)) & set(c):
                m = 100 - 90 + (90 * n * n_docs) // total
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((1000000000 * c[w]) // (1000 * c[w] + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, at, doc))
        out += [(item, k, x[4], -x[0]) for k, x in enumerate(sorted(scored)[:10], 1)]
    return sorted(out, key=str)


def found(spark, docs, items, parts=5):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)
    b = spark.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(r) for r in search.rank(d, b).select("item", "rank", "doc", "score").collect()), key=str)


def test_op12_matches_its_sql(spark):
    res = oc.compare(search.op12_term_pipeline(spark, SF_SMALL), oc.duck(SF_SMALL), search.OP12_SQL)
    assert res["columns_match"] and res["exact"] and res["spark_rows"], res


@pytest.mark.parametrize("seed,n_docs,n_items", [(1, 300, 40), (2, 900, 300), (3, 7, 5)])
def test_against_plain(spark, seed, n_docs, n_items):
    """Uneven terms, many ties, more items than a block holds, several blocks of documents."""
    r = random.Random(seed)
    vocabulary = [f"T{i}" for i in range(60)] + ["é", "ñu"]
    text = lambda most: " ".join(vocabulary[min(61, int(r.expovariate(0.08)))] for _ in range(r.randint(0, most)))
    docs = [(i, text(r.choice([3, 30, 200]))) for i in range(n_docs)]
    items = [(i, text(12)) for i in range(n_items)]
    assert found(spark, docs, items) == plain(docs, items)


def test_ties_go_to_the_smaller_id_and_none_is_lost(spark):
    docs = [(i, "alpha beta") for i in range(50)] + [(100 + i, f"other{i} words") for i in range(200)]
    got = found(spark, docs, [(1, "Alpha"), (2, "words, alpha")])
    assert got == plain(docs, [(1, "Alpha"), (2, "words, alpha")])
    assert [r[2] for r in sorted(got) if r[0] == 1] == list(range(10))


def test_awkward_rows(spark):
    docs = [(0, None), (1, ""), (2, "..,"), (3, "a-b A_B\x00a"), (3, "a-b A_B\x00a"), (None, "a b"), (None, "a b"), (4, "a long " * 9000),
            (5, " x\u0085 ×")] + [(10 + i, f"z{i}") for i in range(9)]
    items = [(None, "a"), (1, "a"), (1, "a"), (2, None), (3, ""), (4, "nowhere"), (5, " X\u0085 × long b")]
    assert [r[1:] for r in found(spark, docs, items)] == [r[1:] for r in plain(docs, items)]
    clash = {c: F.lit(c) for c in "row id n t tf term q docs scores best ib block item rank doc score stage".split()}
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns(clash)
    b = spark.createDataFrame(items, "item_id long, text string").withColumns(clash)
    assert sorted((r.score for r in search.rank(d, b).collect())) == sorted(r[3] for r in plain(docs, items))


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a")]) == [] and found(spark, [(1, "a"), (2, "b")], []) == []
