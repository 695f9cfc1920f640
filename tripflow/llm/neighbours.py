"""Nearest neighbours by an inverted multi-index.

Both halves of a vector are quantised on their own, each by a codebook of ``words``
centroids; a cell is a pair of centroids. A query walks the cells by the sum of
its squared distances to both centroids, smallest first, with a heap, until the
cells' entries reach ``share`` of all (``least`` at any rate); the entries of these
cells are reranked by their exact Euclidean distance on the original vectors, in
double precision.

The codebooks are fitted on at most ``SAMPLE`` distinct vectors, those of the
smallest hash; every vector is indexed. The table of cell sizes has at most
``words ** 2`` rows and goes to all tasks. Cells are dealt to blocks by their
hash, and a cell beyond ``PART`` entries by its entries too; a query goes, with the
list of its cells, to the blocks that hold some of them. Equal vectors are indexed
once with their ``k + 1`` smallest ids, which is all that a result can show of them.

Vectors that are null, zero or hold null or non-finite components, and rows without
id, take no part. Vectors of another length than a query's are no candidates for
it. Repeated rows are candidates of their own. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripflow.llm.common import shuffle_partitions, staged
from tripflow.llm.vectors import doubles, matrix, usable

SAMPLE = 20_000
PART = 4096
SHARE = 0.5
LEAST = 4096
FOUND = "qid long, vec_ids array<long>, score double"


def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x ** 2).sum(1)[:, None] + (c ** 2).sum(1) - 2 * x @ c.T, 0)


def codebook(x: np.ndarray, words: int, rounds: int = 10, seed: int = 3) -> np.ndarray:
    """Lloyd's k-means from random distinct rows."""
    c = x[np.random.default_rng(seed).choice(len(x), min(words, len(x)), replace=False)].copy()
    for _ in range(rounds):
        own = _squares(x, c).argmin(1)
        n = np.bincount(own, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        c[n > 0] = sums[n > 0] / n[n > 0, None]
    return c


def walk(near: np.ndarray, far: np.ndarray, sizes: dict[tuple[int, int], int], wanted: int) -> list[tuple[int, int]]:
    """The non-empty cells in the order of their centroids' summed distances
    until they hold ``wanted`` entries: the multi-sequence algorithm."""
    by_a, by_b = np.argsort(near, kind="stable").tolist(), np.argsort(far, kind="stable").tolist()
    a, b = np.sort(near).tolist(), np.sort(far).tolist()
    heap, done, out, held = [(a[0] + b[0], 0, 0)], [-1] * len(a), [], 0
    while heap and held < wanted:
        _, i, j = heapq.heappop(heap)
        done[i] = j
        cell = by_a[i], by_b[j]
        if n := sizes.get(cell):
            out.append(cell)
            held += n
        if i + 1 < len(a) and done[i + 1] == j - 1:  # its neighbour on the other side is out already
            heapq.heappush(heap, (a[i + 1] + b[j], i + 1, j))
        if j + 1 < len(b) and (i == 0 or done[i - 1] > j):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
    return out


def _block(cell: np.ndarray | int, part: np.ndarray | int, blocks: int):
    mixed = (np.asarray(cell, np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (np.asarray(part, np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    return ((mixed ^ (mixed >> np.uint64(29))) % np.uint64(blocks)).astype(np.int64)


def _rerank(k: int):
    def run(queries: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(entries):
            entries = entries.sort_values("cell", kind="stable")
            x, cells, ids = np.stack(entries["vector"]), entries["cell"].to_numpy(), entries["vec_ids"].to_numpy()
            for qid, q, own in zip(queries["qid"], queries["vector"], queries["cells"]):
                own = np.sort(own)
                low, high = np.searchsorted(cells, own, "left"), np.searchsorted(cells, own, "right")
                at = np.concatenate([np.arange(a, b) for a, b in zip(low, high)])
                d = np.sqrt(((x[at] - q) ** 2).sum(1))
                if len(d) > k:
                    best = d <= np.partition(d, k - 1)[k - 1]  # ties stay in
                    at, d = at[best], d[best]
                out += [(qid, ids[i], s) for i, s in zip(at, d)]
        return pd.DataFrame(out, columns=["qid", "vec_ids", "score"])
    return run


def _search(points: DataFrame, k: int, share: float, least: int, words: int | None) -> DataFrame:
    """``qid``, ``vec_ids``, ``score`` for vectors of one length. ``points``: ``cid``,
    ``vector``, ``vec_ids``, ``asked``."""
    spark, blocks = points.sparkSession, shuffle_partitions(points.sparkSession)
    total = points.count()
    sample = matrix(points.select("cid", "vector").orderBy(F.xxhash64("vector"), "cid").limit(SAMPLE)
                    .select("vector").toArrow().column(0).combine_chunks())
    half = (sample.shape[1] + 1) // 2
    words = words or int(np.clip(np.sqrt(len(sample)), 1, 128))
    first, second = codebook(sample[:, :half], words), codebook(sample[:, half:], words)

    def cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column(1))
            at = _squares(x[:, :half], first).argmin(1) * len(second) + _squares(x[:, half:], second).argmin(1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at, pa.int64())], names=[*b.schema.names, "cell"])

    schema = "cid long, vector array<double>, vec_ids array<long>, asked boolean, cell long"
    index = staged(points.select("cid", "vector", "vec_ids", "asked").mapInArrow(cell, schema), "multi_index")
    sizes = {r["cell"]: r["n"] for r in index.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # words ** 2 at most
    by_pair = {divmod(c, len(second)): n for c, n in sizes.items()}
    wanted = max(least, int(np.ceil(share * total)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, cid = b.column(4).to_numpy(), b.column(0).to_numpy()
            parts = np.array([-(-sizes[c] // PART) for c in at.tolist()])
            yield pa.RecordBatch.from_pydict({
                "block": _block(at, cid % parts, blocks), "cell": b.column(4), "vector": b.column(1), "vec_ids": b.column(2)})

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column(1))
            near, far = _squares(x[:, :half], first), _squares(x[:, half:], second)
            for i, (qid, own) in enumerate(zip(b.column(0).to_pylist(), b.column(4).to_pylist())):
                cells = {i * len(second) + j for i, j in walk(near[i], far[i], by_pair, wanted)} | {own}
                to: dict[int, list[int]] = {}
                for c in cells:
                    for block in set(_block(c, np.arange(-(-sizes[c] // PART)), blocks).tolist()):
                        to.setdefault(block, []).append(c)
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array(list(to), pa.int64()), "qid": pa.array([qid] * len(to), pa.int64()),
                    "vector": pa.array([x[i]] * len(to), pa.list_(pa.float64())),
                    "cells": pa.array(list(to.values()), pa.list_(pa.int64()))})

    entries = index.mapInArrow(deal, "block long, cell long, vector array<double>, vec_ids array<long>")
    queries = (index.filter("asked").repartition(blocks, "cid")
               .mapInArrow(ask, "block long, qid long, vector array<double>, cells array<long>"))
    return queries.groupBy("block").cogroup(entries.groupBy("block")).applyInPandas(_rerank(k), FOUND)


def nearest(df: DataFrame, asked: Column, k: int = 10, share: float = SHARE, least: int = LEAST,
            words: int | None = None) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: for each row of ``df`` (``vec_id``,
    ``embedding``) with ``asked``, the ``k`` nearest found among all rows but itself."""
    rows = doubles(df.filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector"),
        F.coalesce(asked, F.lit(False)).alias("asked")), "vector")
    some = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    ids = (rows.withColumn("_n", some).filter(F.col("_n") <= k + 1).groupBy("vector")
           .agg(F.sort_array(F.collect_list("vec_id")).alias("vec_ids")))
    flags = rows.groupBy("vector").agg(F.max("asked").alias("asked"))
    points = staged(ids.join(flags, "vector").withColumn("cid", F.monotonically_increasing_id()), "points")
    lengths = [r[0] for r in points.select(F.size("vector").alias("n")).distinct().orderBy("n").collect()]
    empty = df.sparkSession.createDataFrame([], FOUND)
    found = empty
    for n in lengths:  # one, unless tables of several models were put together
        found = found.union(_search(points.filter(F.size("vector") == n), k + 1, share, least, words))
    each = found.select("qid", "score", F.explode("vec_ids").alias("vec_id"))
    top = Window.partitionBy("qid").orderBy("score", "vec_id")
    short = each.withColumn("_n", F.row_number().over(top)).filter(F.col("_n") <= k + 1).drop("_n")
    who = rows.filter("asked").join(points.select("vector", F.col("cid").alias("qid")), "vector").select(
        F.col("vec_id").alias("query_id"), "qid")
    per = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (who.distinct().join(short, "qid").filter("vec_id <> query_id")
            .withColumn("rank", F.row_number().over(per)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op3_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest of each row of ``embeddings`` whose id is divisible by 100."""
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0)
