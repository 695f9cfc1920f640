"""Connected components of a graph held as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node it reaches, of each node with
    an edge. ``edges`` has two long columns ``a`` and ``b``, in any order.

    Large-star and small-star steps (Kiveris et al.) by turns: each links a node's
    neighbours to the smallest of them, until the edges are stars. A step is a
    minimum per node and a join on the node; no neighbourhood is gathered, so a
    node may have any number of edges. Each round's edges go to the shared folder."""
    held = staged(_clean(edges), "edges")
    state = _state(held)
    while True:
        held = staged(_clean(_small_star(_large_star(held))), "edges")
        state, before = _state(held), state
        if state == before:
            return held.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
                held.select("a", "a").distinct())


def _clean(edges: DataFrame) -> DataFrame:
    low, high = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    return edges.filter("a <> b").select(low, high).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v <> m").select(F.col("m").alias("a"), F.col("v").alias("b"))
    return moved.union(least.select(F.col("m").alias("a"), F.col("u").alias("b")))
