"""Near-duplicate embeddings by spherical-cap filters.

Filter directions form a structured random product code: a vector is cut into two
halves, each half has its own random unit codewords, and every pair of codewords is
a direction. List decoding walks only the pairs of codewords whose sum of inner
products reaches the cap's height, so a vector finds all its caps among
``words ** 2`` directions without looking at the rest. The height is ``alpha``, which
random vectors exceed for ``DENSE`` directions on average; a vector that exceeds it for
fewer than ``caps`` has its own height lowered to its ``caps``-th best direction. So all
directions beyond a vector's height are its caps, and there are at least ``caps``. Of 20,000 random
pairs at a cosine of exactly 0.98 in 64 dimensions, with codewords for 50,000 classes, all share a cap
at 24 caps, all but 2 at 16 and all but 14 at 12; with codewords for a million classes all of 5,000 at 24.
Vectors of a label that share a cap meet and are verified by cosine in double precision.

Equal vectors of a label are one class: classes meet, and their sizes count. A
pair that shares several caps is counted in the first of them. Only (bucket, class) is
shuffled to find the buckets that hold several classes; vectors follow into these alone.
Directions are ``SPREAD`` times the classes, so that unlike vectors rarely meet (up to
``MOST`` codewords a half, 67 million classes; beyond, buckets grow, none is lost). Buckets beyond
``CHUNK`` classes are cut into chunks, and each pair of chunks meets in a task of
its own. A bucket yields one row per linked class (its partners' number, and a
root to which it is tied), not its pairs.

Vectors that are null, zero or hold null or non-finite components, vectors without
label or ``vec_id``, and vectors of different lengths link with nothing; rows of
the first kinds are returned with no links, as their own component. Repeated rows
count as vectors of their own. An empty table gives none. Rows travel inside a struct, so
further columns of any name pass; ``n_links``, ``component_id`` and ``kept`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, IntegerType, StructField, StructType

from tripflow.llm.common import shuffle_partitions, staged
from tripflow.llm.components import components
from tripflow.llm.vectors import usable

COSINE = 0.98
CHUNK = 2000
SEED = 20
DENSE, SPREAD, MOST = 4, 16, 1 << 15


def codewords(dims: int, words: int, seed: int = SEED) -> list[np.ndarray]:
    """Random unit vectors for both halves of the dimensions, scaled so that a
    pair of them is a unit direction."""
    out = []
    for half, n in enumerate(((dims + 1) // 2, dims // 2)):
        c = np.random.default_rng([seed, dims, half]).standard_normal((min(words, 2 ** min(n, 30)), n))
        out.append(c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-300) / np.sqrt(2))
    return out


def decode(vectors: np.ndarray, codes: list[np.ndarray], caps: int) -> list[np.ndarray]:
    """The directions whose caps hold each unit vector, as numbers of codeword pairs."""
    first, second = codes
    n, dims = len(second), vectors.shape[1]
    least = min(caps, len(first) * n)
    alpha = NormalDist().inv_cdf(1 - min(0.5, DENSE / (len(first) * n))) / np.sqrt(dims)
    a, b = vectors[:, :first.shape[1]] @ first.T, vectors[:, first.shape[1]:] @ second.T
    best = [-np.sort(np.partition(-x, min(least, x.shape[1]) - 1, 1)[:, :least], 1) for x in (a, b)]
    # The c best sums are among those of the i-th and the j-th best with i * j <= c.
    i, j = np.array([(i, j) for i in range(best[0].shape[1]) for j in range(best[1].shape[1]) if (i + 1) * (j + 1) <= least]).T
    low = -np.partition(-(best[0][:, i] + best[1][:, j]), least - 1, 1)[:, least - 1]
    out = []
    for x, y, height, top_x, top_y in zip(a, b, np.minimum(alpha, low), best[0][:, 0], best[1][:, 0]):
        own, other = np.flatnonzero(x + top_y >= height), np.flatnonzero(top_x + y >= height)
        p, q = np.nonzero(x[own][:, None] + y[other][None, :] >= height)
        out.append(own[p] * n + other[q])
    return out


def _rows(column: pa.ListArray, dims: int) -> np.ndarray:
    """Unit vectors in double precision from an Arrow column of lists of ``dims`` numbers."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dims)
    x = x / np.abs(x).max(1, keepdims=True)  # lest squares overflow or vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _linked(block: dict, cosine: float) -> dict | None:
    """A bucket's (or two chunks') linked classes: partners' number and a root."""
    v = block["vector"]
    near = v @ v.T >= cosine
    np.fill_diagonal(near, False)
    left, right = block["left"], block["right"]
    near &= (left[:, None] & right[None, :]) | (right[:, None] & left[None, :])
    some = np.flatnonzero(near.any(1))
    if not len(some):
        return None
    near = near[np.ix_(some, some)]
    own = [c[c < block["code"]] for c in (block["caps"][i] for i in some)]  # caps in which a pair has met before
    known, at = np.unique(np.concatenate(own), return_inverse=True)
    row = np.repeat(np.arange(len(some)), [len(c) for c in own])
    for low in range(0, len(known), 4096):
        here = (at >= low) & (at < low + 4096)
        held = np.zeros((len(some), min(4096, len(known) - low)), np.float32)
        held[row[here], at[here] - low] = 1
        near &= held @ held.T == 0
    root = np.arange(len(some))
    while True:
        least = np.minimum(root, np.where(near, root[None, :], len(some)).min(1, initial=len(some)))
        if (least == root).all():
            break
        root = least
    cid, left = block["cid"][some], near.any(1)
    return {"cid": cid[left], "n_links": (near @ block["size"][some])[left], "root": cid[root][left]}


def links(classes: DataFrame, cosine: float, caps: int, words: int, chunk: int) -> DataFrame:
    """``cid``, ``n_links``, ``root``: one row per class and bucket in which it links.

    ``classes``: ``cid``, ``label``, ``vector``, ``size``."""
    spark = classes.sparkSession

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[int, list[np.ndarray]] = {}
        for b in batches:
            lengths = b.column(2).value_lengths().to_numpy()
            for dims in np.unique(lengths).tolist():
                part = b.take(pa.array(np.flatnonzero(lengths == dims)))
                codes.setdefault(dims, codewords(dims, words))
                own = decode(_rows(part.column(2), dims), codes[dims], caps)
                cuts = np.cumsum([0, *map(len, own)]).astype(np.int32)
                held = pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate(own).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(np.full(len(part), dims, np.int32)), held],
                                                 names=["cid", "label", "dims", "caps"])

    decoded = staged(classes.select("cid", "label", "vector").mapInArrow(found, StructType([
        classes.schema["cid"], classes.schema["label"], StructField("dims", IntegerType()),
        StructField("caps", ArrayType(IntegerType()))])), "caps")
    rows = decoded.select("cid", "label", "dims", F.explode("caps").alias("code"))
    key = ["label", "dims", "code"]
    buckets = rows.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")
    chunks = F.ceil(F.col("n") / chunk).cast("int")
    met = staged(rows.join(buckets, key).withColumn("chunks", chunks).withColumn("chunk", F.pmod(F.xxhash64("cid"), "chunks").cast("int"))
                 .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
                 .select("cid", *key, "chunk", F.least("chunk", "other").alias("c1"), F.greatest("chunk", "other").alias("c2")), "met")
    group = [*key, "c1", "c2"]
    several = met.select("cid").distinct()  # classes without company stay where they are
    sides = classes.select("cid", "vector", "size").join(several, "cid").join(decoded.select("cid", "caps"), "cid")
    full = (met.join(sides, "cid").repartition(shuffle_partitions(spark), *group).sortWithinPartitions(*group, "cid")
            .select(*group, "chunk", "cid", "size", "vector", "caps"))

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def check(t: pa.Table, cuts: np.ndarray) -> Iterator[pa.RecordBatch]:
            dims, code, c1, c2, chunk_, cid, size = (t.column(c).to_numpy() for c in ("dims", "code", "c1", "c2", "chunk", "cid", "size"))
            vectors, held = t.column("vector").combine_chunks(), t.column("caps").combine_chunks()
            ends, values = np.cumsum([0, *held.value_lengths().to_numpy()]), held.flatten().to_numpy()
            hits = []
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                hit = _linked({"vector": _rows(vectors.slice(a, b - a), int(dims[a])), "left": chunk_[a:b] == c1[a], "right": chunk_[a:b] == c2[a],
                               "cid": cid[a:b], "size": size[a:b], "code": code[a],
                               "caps": [values[ends[i]:ends[i + 1]] for i in range(a, b)]}, cosine) if b - a > 1 else None
                if hit:
                    hits.append(hit)
            if hits:
                yield pa.RecordBatch.from_pydict({k: pa.array(np.concatenate([h[k] for h in hits]), pa.int64()) for k in hits[0]})

        rest = None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = t if rest is None else pa.concat_tables([rest, t])
            new = np.ones(len(t), bool)
            new[1:] = np.any([x[1:] != x[:-1] for x in (t.column(i).to_numpy() for i in range(len(group)))], 0)
            cuts = np.flatnonzero(new)  # the last group may go on
            if len(cuts) > 1:
                yield from check(t, cuts)
            rest = t.slice(int(cuts[-1])) if len(t) else t
        if rest is not None and len(rest):
            yield from check(rest, np.array([0, len(rest)]))

    return full.mapInArrow(verified, "cid long, n_links long, root long")


def deduplicate(df: DataFrame, cosine: float = COSINE, caps: int = 24, chunk: int = CHUNK) -> DataFrame:
    """``df`` (``vec_id``, ``embedding``, ``label``) with ``n_links``,
    ``component_id`` and ``kept``."""
    df = df.drop("n_links", "component_id", "kept")
    ok = usable(F.col("embedding")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    kind = df.schema["embedding"].dataType.elementType
    kind = kind if isinstance(kind, (FloatType, DoubleType)) else DoubleType()
    own = F.when(ok, F.col("embedding").cast(ArrayType(kind)))
    rows = df.select(F.struct("*").alias("row"), F.col("vec_id").alias("id"), F.when(ok, F.col("label")).alias("label"), own.alias("vector"))
    classes = staged(rows.filter("vector is not null").groupBy("label", "vector").agg(F.min("id").alias("first"), F.count("*").alias("size"))
                     .withColumn("cid", F.monotonically_increasing_id()), "classes")
    words = int(max(64, min(MOST, np.ceil(np.sqrt(SPREAD * classes.count())))))
    pairs = staged(links(classes, cosine, caps, words, chunk), "links")
    numbers = pairs.groupBy("cid").agg(F.sum("n_links").alias("others"))
    member = components(pairs.select(F.col("cid").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "cid")
    placed = (classes.join(member, "cid", "left").join(numbers, "cid", "left")
              .withColumn("component", F.coalesce("component", "cid")))
    least = placed.groupBy("component").agg(F.min("first").alias("component_id"))
    result = placed.join(least, "component").select(
        "label", "vector", "component_id", (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    component = F.coalesce(F.col("component_id").cast("long"), F.col("id").cast("long"))
    return rows.join(result, ["label", "vector"], "left").select(
        "row.*", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def op8_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates among all ``embeddings`` of a label, at a cosine of 0.98."""
    return deduplicate(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")).select(
        "vec_id", "n_links", "component_id", "kept")


OP8_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
    AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (
  SELECT vec_id AS node, vec_id AS found FROM embeddings
  UNION
  SELECT r.node, p.b FROM reach r JOIN pairs p ON p.a = r.found)
SELECT e.vec_id, (SELECT count(*) FROM pairs p WHERE p.a = e.vec_id)::BIGINT AS n_links,
  m.component_id, e.vec_id = m.component_id AS kept
FROM embeddings e JOIN (SELECT node, min(found) AS component_id FROM reach GROUP BY node) m ON m.node = e.vec_id
"""
