"""Near-duplicate texts by DartMinHash signatures (Christiani).

A text's elements are its distinct shingles of five words, each with a weight.
Darts fall on an element's strip of weights as a Poisson process in time, one
process for each of the strip's intervals [0, 1), [1, 2), [2, 4), ...; hashes of
the element, the interval and the dart's number give a dart's time, its place in the interval and
its signature coordinate, so equal elements get equal darts in every text. A dart
counts if its place lies below the element's weight; each coordinate keeps its
earliest. Darts are thrown up to the time at which some ``k ln k + 2 k`` of them are
expected, and further only where a coordinate is still empty: a text costs in
proportion to its shingles and to ``k``, not to their product. Two
signatures agree in a coordinate with the probability of the texts' weighted
Jaccard similarity.

Texts that agree in a band of ``ROWS`` coordinates are tied to the bucket's
smallest, and what is so connected is a candidate group. Inside a group the
shingles themselves decide: two texts link if their Jaccard similarity is 0.8 or
more. A group beyond ``CHUNK`` texts is cut into chunks, and each pair of chunks
meets in a task of its own. Links connect texts to classes. A group yields ties to
roots, never its pairs.

Words are runs of letters and digits, lower-cased; a text of fewer than five has
one shingle, all its words. Texts without words are near only to equal texts, and
null and empty texts to none, not even to each other. Equal texts are compared once.
Rows with equal ``doc_id`` count as documents of their own; a null ``doc_id`` is
kept only where its class has no other.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.common import groups, shuffle_partitions, staged
from tripflow.llm.components import components

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 4
CHUNK = 500
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(float) + 0.5) * 2.0 ** -53


@lru_cache(maxsize=1)
def _alnum() -> np.ndarray:
    return np.fromiter((chr(i).isalnum() for i in range(0x110000)), bool, 0x110000)


@lru_cache(maxsize=4)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word: differences of one running polynomial sum."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    if not len(code):
        return np.empty(0, np.uint64)
    inside = np.concatenate(([False], _alnum()[code], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[::2], edges[1::2]
    power, inverse = powers(1 << max(12, int(len(code)).bit_length()))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((code.astype(np.uint64) + np.uint64(1)) * power[:len(code)])))
    return mix((sums[end] - sums[start]) * inverse[start])


def shingles(text: str | None, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles' hashes, ascending, and how often each stands there."""
    w = word_hashes(text or "")
    if not len(w):
        return w, np.empty(0, np.int64)
    n = min(size, len(w))
    h = np.full(len(w) - n + 1, n, np.uint64)
    for i in range(n):
        h = mix(h * _GOLD + w[i:len(w) - n + 1 + i])
    return np.unique(h, return_counts=True)


def dart_minhash(elements: np.ndarray, weights: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """The signature of a weighted set: for each coordinate its earliest dart."""
    until = (k * np.log(k) + 2 * k) / weights.sum()
    own = mix(elements ^ mix(np.array([seed], np.uint64)))
    while True:
        times, coordinates, darts = [], [], []
        low, high, interval = 0.0, 1.0, 1
        while (held := np.flatnonzero(weights > low)).size:
            key, weight, width = mix(own[held] + np.array([interval], np.uint64) * _GOLD), weights[held], high - low
            at, number = np.zeros(len(held)), 0
            while len(key):
                block = int(until * width) + 3
                h = mix(key[:, None] + np.arange(number + 1, number + block + 1, dtype=np.uint64) * _GOLD)
                time = at[:, None] - np.cumsum(np.log(_uniform(h)), 1) / width
                place = low + width * _uniform(mix(h + np.uint64(1)))
                hit = (time <= until) & (place < weight[:, None])
                times.append(time[hit])
                darts.append(h[hit])
                coordinates.append((mix(h[hit] + np.uint64(2)) % np.uint64(k)).astype(np.int64))
                more = time[:, -1] <= until
                key, weight, at, number = key[more], weight[more], time[more, -1], number + block
            low, high, interval = high, 2 * high, interval + 1
        time, coordinate, dart = np.concatenate(times), np.concatenate(coordinates), np.concatenate(darts)
        order = np.lexsort((dart, time))
        filled, first = np.unique(coordinate[order], return_index=True)
        if len(filled) == k:
            return dart[order][first]
        until *= 2


def bands(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit hash per band of ``rows`` coordinates; the band's number is part of it."""
    parts = signature.reshape(-1, rows)
    h = np.arange(1, len(parts) + 1, dtype=np.uint64)
    for i in range(rows):
        h = mix(h * _GOLD + parts[:, i])
    return h.view(np.int64)


def signatures(texts: DataFrame, n_bands: int = BANDS, rows: int = ROWS, weighted: bool = False) -> DataFrame:
    """``key`` and ``bands`` (empty without words) of ``texts`` (``key``, ``text``);
    with ``weighted`` a shingle weighs as often as it occurs, else one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text in b.column(1):
                elements, counts = shingles(text.as_py())
                weights = counts.astype(float) if weighted else np.ones(len(elements))
                out.append(bands(dart_minhash(elements, weights, n_bands * rows), rows) if len(elements) else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.int64()))], names=["key", "bands"])

    return texts.select("key", "text").mapInArrow(run, "key string, bands array<long>")


def connect(sets: list[np.ndarray], similarity: float = SIMILARITY) -> np.ndarray:
    """Each set's component, as one member's number, under the links of all pairs.

    A set compared with all others has shown all its links; once that holds for
    every set outside the largest component, no link between components is left."""
    n, size = len(sets), np.array([len(s) for s in sets])
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    row, ends = np.repeat(np.arange(n), size), np.cumsum(size)
    root, seen = np.arange(n), np.zeros(n, bool)
    held = np.zeros(code.max(initial=-1) + 1, bool)
    while True:
        rest = np.flatnonzero(~seen & (root != np.bincount(root, minlength=n).argmax())) if seen.any() else np.arange(1)
        if not len(rest):
            return root
        p = rest[0]
        seen[p] = True
        mine = code[ends[p] - size[p]:ends[p]]
        held[mine] = True
        both = np.bincount(row[held[code]], minlength=n)
        held[mine] = False
        near = both >= similarity * (size + size[p] - both) - 1e-9
        near &= (size > 0) & (size[p] > 0)
        near[p] = True
        root[np.isin(root, root[near])] = root[near].min()


def links(members: DataFrame, similarity: float, chunk: int) -> DataFrame:
    """``a``, ``b``: ties that connect the near texts of each candidate group.
    ``members``: ``grp``, ``cid``, ``text``."""
    spark = members.sparkSession
    sizes = members.groupBy("grp").agg(F.ceil(F.count("*") / chunk).cast("int").alias("chunks"))
    cut = (members.join(sizes, "grp").withColumn("chunk", F.pmod(F.xxhash64("cid"), "chunks").cast("int"))
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
           .filter("chunks = 1 or chunk <> other")  # two chunks together hold each one's own pairs too
           .select("grp", F.least("chunk", "other").alias("c1"), F.greatest("chunk", "other").alias("c2"), "cid", "text")
           .repartition(shuffle_partitions(spark), "grp", "c1", "c2").sortWithinPartitions("grp", "c1", "c2", "cid"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups(batches, 3):
            cid = t.column("cid").to_numpy()
            root = connect([shingles(x.as_py())[0] for x in t.column("text")], similarity)
            tied = root != np.arange(len(root))
            yield pa.RecordBatch.from_pydict({"a": cid[root[tied]], "b": cid[tied]})

    return cut.mapInArrow(run, "a long, b long")


def deduplicate(docs: DataFrame, similarity: float = SIMILARITY, chunk: int = CHUNK, weighted: bool = False) -> DataFrame:
    """``docs`` (``doc_id``, ``text``) with ``class_id``, the smallest ``doc_id`` of
    the row's class, ``class_rows``, ``kept`` (of a class, the rows with that id)
    and ``class_key``, which tells classes apart (null: a class of its own)."""
    docs = docs.drop("class_id", "class_rows", "kept", "class_key", "_key")
    some = F.length("text") > 0
    key = F.md5("text")
    # Copies come together by their text's hash; what moves is their signature.
    per_doc = docs.filter(some).select(key.alias("key"), "text", F.col("doc_id").cast("long").alias("doc_id"))
    signed = signatures(per_doc.groupBy("key").agg(F.first("text").alias("text")), weighted=weighted)
    texts = staged(signed.withColumn("cid", F.monotonically_increasing_id()), "signatures")
    rows = texts.select("cid", F.explode("bands").alias("band"))
    buckets = rows.groupBy("band").agg(F.min("cid").alias("least"), F.count("*").alias("n")).filter("n > 1")
    ties = rows.join(buckets.drop("n"), "band").filter("cid <> least").select(F.col("least").alias("a"), F.col("cid").alias("b"))
    candidates = components(ties.distinct()).withColumnsRenamed({"node": "cid", "component": "grp"})
    named = texts.select("key", "cid").join(candidates, "cid")
    bodies = per_doc.groupBy("key").agg(F.first("text").alias("text")).join(named, "key")
    tied = staged(links(bodies.select("grp", "cid", "text"), similarity, chunk), "near")
    near = components(tied).withColumnsRenamed({"node": "cid", "component": "near"})
    placed = texts.select("key", "cid").join(near, "cid", "left").select(
        "key", F.coalesce("near", "cid").alias("class_key"))
    ids = per_doc.groupBy("key").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
    classes = placed.join(ids, "key").groupBy("class_key").agg(
        F.min("first").alias("class_id"), F.sum("copies").alias("class_rows"))
    known = placed.join(classes, "class_key").withColumnRenamed("key", "_key")
    own = F.col("doc_id").cast("long")
    return (docs.withColumn("_key", F.when(some, key)).join(known, "_key", "left")
            .withColumn("class_id", F.when(F.col("class_key").isNull(), own).otherwise(F.col("class_id")))
            .withColumn("class_rows", F.coalesce("class_rows", F.lit(1)).cast("long"))
            .withColumn("kept", F.col("class_key").isNull() | own.eqNullSafe(F.col("class_id"))).drop("_key"))


def representatives(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row of each class, with the smallest ``doc_id``; the columns of ``docs``."""
    kept = deduplicate(docs.select("doc_id", "text", F.struct("*").alias("_docs")), similarity).filter("kept")
    alone = F.struct(F.col("class_key").isNull().alias("alone"), F.coalesce(
        "class_key", F.monotonically_increasing_id()).alias("key"))
    return kept.withColumn("_class", alone).dropDuplicates(["_class"]).select("_docs.*")


def op10_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates among all ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return deduplicate(docs).select("doc_id", "class_id", "class_rows", "kept")
