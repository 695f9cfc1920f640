"""Collocations against their SQL and a plain version; awkward inputs."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import oracle_compare as oc
from conftest import SF_SMALL
from tripflow.llm import collocations, common

SCHEMA = "lang string, text string"
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@pytest.fixture(autouse=True)
def prepared(spark):
    common.prepare(spark)


def plain(rows, least, most, longest=5):
    texts = {}
    for lang, text in rows:
        texts.setdefault("und" if lang is None else lang, []).append(text or "")
    out = []
    for lang, some in texts.items():
        f, n = Counter(), 0
        for text in some:
            folded = text.translate({c: c + 32 for c in range(65, 91)})
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded):
                w = re.findall(r"[^\x20\x09]+", piece)
                n += len(w)
                f.update(tuple(w[i:i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
        found = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        inside = set()
        for q, c in found.items():
            inside |= {q[i:j] for i in range(len(q)) for j in range(i + 1, len(q) + 1) if j - i < len(q) and c >= f[q[i:j]]}
        scored = []
        for p, a in found.items():
            if p not in inside:
                s, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-s, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]], n))
        out += [(lang, i, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r, n) in enumerate(sorted(scored)[:most], 1)]
    return sorted(out)


def mined(spark, rows, **options):
    return sorted(tuple(r) for r in collocations.mine(spark.createDataFrame(rows, SCHEMA).repartition(3), **options).select(COLUMNS).collect())


def some_texts(seed, n):
    """Words of uneven frequency, phrases that repeat, several languages."""
    r = random.Random(seed)
    vocabulary = [f"w{i}é" if i % 5 == 0 else f"W{i}" for i in range(25)]
    fixed = [" ".join(r.choices(vocabulary, k=r.randint(2, 7))) for _ in range(6)]
    out = []
    for i in range(n):
        parts = [r.choice(fixed) if r.random() < 0.4 else vocabulary[min(24, int(r.expovariate(0.2)))] for _ in range(r.randint(0, 25))]
        out.append((r.choice(["a", "a", "b", None]), "".join(p + r.choice([" ", " ", " ", ". ", "\t", ",", "\n"]) for p in parts)))
    return out


def test_op13_matches_its_sql(spark):
    res = oc.compare(collocations.op13_collocations(spark, SF_SMALL), oc.duck(SF_SMALL), collocations.OP13_SQL)
    assert res["columns_match"] and res["exact"] and res["spark_rows"], res


@pytest.mark.parametrize("seed,most,block", [(1, 2000, 50), (2, 7, 40), (3, 3, 1 << 18), (4, 12, 9)])
def test_against_plain(spark, seed, most, block):
    """Blocks of few words cut texts inside pieces; few wanted phrases end the search early."""
    rows = some_texts(seed, 120)
    assert mined(spark, rows, least=6, most=most, block=block, shares=(1 / 8, 1.0)) == plain(rows, 6, most)


def test_ties_at_the_end_are_settled(spark):
    """Many phrases of equal score and count: the first by their bytes stay."""
    rows = [("x", f"{a}1 {a}2. lone{i}") for i in range(4) for a in ("é", "z", "b", "a", "ä")]
    got = mined(spark, rows, least=4, most=3)
    assert got == plain(rows, 4, 3) and [r[2] for r in got] == ["a1 a2", "b1 b2", "z1 z2"]


def test_awkward_rows(spark):
    rows = [(None, None), ("a", ""), ("a", " \t\n.,"), ("", "e e e e"), ("a", "long word " * 3000), ("a", "X\x00y \x1c z"), ("a", "X\x00y \x1c z")]
    assert mined(spark, rows, least=2, block=100) == plain(rows, 2, 2000)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in "p f n block id word words rank tokens score".split()})
    assert sorted(tuple(r) for r in collocations.mine(df, least=2).select(COLUMNS).collect()) == plain(rows, 2, 2000)


def test_empty_table(spark):
    assert collocations.mine(spark.createDataFrame([], SCHEMA)).isEmpty()
