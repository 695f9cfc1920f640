"""An interpolated modified Kneser-Ney model of code points.

The units are the text's own code points, and every n-gram of every order is kept:
the tables are sharded by n-gram and grow with the corpus. Nothing of them reaches
the driver. An n-gram is a pair of numbers, its context (21 bits a point) and its last point.

1. The trusted texts' n-grams of the highest order are counted; lower orders follow from them.
2. Tasks pack texts into blocks of some million points and write each block's different n-grams.
   The lower order gets probabilities for all of these n-grams' ends, seen or not.
3. An n-gram of the highest order, its context and its end share the points in the middle. So
   blocks' n-grams and the model meet in shards dealt by the middle: a count join per shard
   gives each n-gram's cost, by the order below where the trusted texts lack it.
4. Each block's costs return to its texts, which are read again and travel compressed, and are summed.

A text is never scored by a model that has seen it: texts are dealt into two folds by
their md5, copies into the same, and each fold is scored by the model of the other
fold's trusted texts, so that trusted and new texts compare. Without such texts there is no score.
All languages share a model: texts that quote another language are common among the trusted.

Costs are whole numbers of ``2 ** -24``, so sums don't depend on the order of
rows. NUL stands for the start of a text; a text's own counts as U+FFFD.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripflow.llm.common import staged

ORDER = 4
PIECE = 1 << 20  # points of a text that are taken at once; a block holds four times as many
UNIT = 1 << 24
BITS = 21  # of a code point
CODES = 1 << 63
PRIME = (1 << 31) - 1
ENTRIES, ROUND = 1 << 18, 1 << 28  # n-grams of a shard, and of all shards that share one copy of the model
GRAM = ["fold", "ctx", "last"]


def points(text: str) -> np.ndarray:
    """The code points, with as many starts before as a context has."""
    own = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.concatenate((np.zeros(ORDER - 1, np.uint32), np.where(own == 0, np.uint32(0xFFFD), own)))


def blocks(batches: Iterator[pa.RecordBatch], piece: int) -> Iterator[tuple[int, int, list[str], list[np.ndarray]]]:
    """The rows (``fold``, ``key``, ``text``) of a task by blocks of one fold: an id, the fold,
    and keys and points of the texts, long ones in pieces. The same rows give the same blocks."""
    held: dict[int, tuple[list[str], list[np.ndarray]]] = {}
    size: dict[int, int] = {}
    block = TaskContext.get().partitionId() << 32
    for b in batches:
        for fold, key, text in zip(*b.columns):
            of, s = fold.as_py(), points(text.as_py())
            for i in range(0, len(s) - ORDER + 1, piece):
                keys, items = held.setdefault(of, ([], []))
                keys.append(key.as_py())
                items.append(s[i:i + piece + ORDER - 1])
                size[of] = size.get(of, 0) + len(items[-1])
                if size[of] >= 4 * piece:
                    size.pop(of)
                    yield block, of, *held.pop(of)
                    block += 1
    for of in sorted(held):
        yield block, of, *held[of]
        block += 1


def digest(keys: list[str], items: list[np.ndarray]) -> str:
    return hashlib.md5("".join(f"{k}{len(x)}," for k, x in zip(keys, items)).encode()).hexdigest()


def distinct(items: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different n-grams of ``items`` in ascending order (a column each), how many there
    are of each, and each place's n-gram."""
    whole = np.concatenate(items)
    rank = np.zeros(0x110000, np.int64)
    rank[whole] = 1
    alphabet = np.flatnonzero(rank)
    rank[alphabet] = np.arange(len(alphabet))
    seq, a = rank[whole], len(alphabet)
    n = len(seq) - ORDER + 1
    pairs = None
    if a ** ORDER < CODES:
        code = seq[:n].copy()
        for k in range(1, ORDER):
            code = code * a + seq[k:k + n]
    else:  # too many for one number: numbers for the pairs
        pairs, at = np.unique(seq[:-1] * a + seq[1:], return_inverse=True)
        code = at[:n] * len(pairs) + at[2:2 + n]
    inside = np.ones(n, bool)
    ends = np.cumsum([len(x) for x in items])[:-1]
    for k in range(1, ORDER):
        inside[ends - k] = False
    code = code[inside]
    some, count = np.unique(code, return_counts=True)
    if pairs is None:
        grams = np.stack([some // a ** k % a for k in range(ORDER - 1, -1, -1)])
    else:
        left, right = pairs[some // len(pairs)], pairs[some % len(pairs)]
        grams = np.stack([left // a, left % a, right // a, right % a])
    return alphabet[grams].astype("<u4"), count, np.searchsorted(some, code)


def packed(rows: np.ndarray) -> np.ndarray:
    """Rows of points as one number a column."""
    out = np.zeros(rows.shape[1], np.int64)
    for r in rows:
        out = (out << BITS) | r.astype(np.int64)
    return out


def shards_of(middle: np.ndarray, shards: int) -> np.ndarray:
    return middle % PRIME % shards


def _taught(docs: DataFrame) -> DataFrame:
    """How often each n-gram of the highest order is in ``docs``, for the other fold's model."""
    piece = PIECE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, fold, _, items in blocks(batches, piece):
            grams, count, _ = distinct(items)
            columns = [np.full(len(count), 1 - fold, np.int32), packed(grams[:-1]), grams[-1].astype(np.int32), count.astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], [*GRAM, "c"])

    return docs.mapInArrow(run, "fold int, ctx long, last int, c long").groupBy(*GRAM).agg(F.sum("c").alias("c"))


def _wanted(docs: DataFrame) -> DataFrame:
    """A row for each block: its different n-grams, all first points, then all second ones and so on."""
    piece = PIECE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, fold, keys, items in blocks(batches, piece):
            grams = distinct(items)[0]
            yield pa.RecordBatch.from_pylist([{"block": block, "fold": fold, "digest": digest(keys, items),
                                               "m": grams.shape[1], "grams": grams.tobytes()}], schema)

    schema = pa.schema([("block", pa.int64()), ("fold", pa.int32()), ("digest", pa.string()), ("m", pa.int64()), ("grams", pa.binary())])
    return docs.mapInArrow(run, "block long, fold int, digest string, m long, grams binary")


def _ends(wanted: DataFrame) -> DataFrame:
    """The different n-grams of the order below in ``wanted``, with count 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for fold, grams in zip(b.column(0).to_pylist(), b.column(1)):
                some = np.unique(packed(np.frombuffer(grams.as_buffer(), "<u4").reshape(ORDER, -1)[1:]))
                columns = [np.full(len(some), fold, np.int32), some >> BITS, (some & ((1 << BITS) - 1)).astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], GRAM)

    return (wanted.select("fold", "grams").mapInArrow(run, "fold int, ctx long, last int").distinct()
            .withColumn("c", F.lit(0).cast("long")))


def _discount(i: int) -> Column:
    """Chen and Goodman's discount for counts of ``i`` (3: and more), from ``n1`` to ``n4``."""
    own, up = F.col(f"n{i}"), F.col(f"n{i + 1}")
    y = F.when(F.col("n1") > 0, F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(0.0)
    raw = F.when(own > 0, i - (i + 1) * y * up / own).otherwise(y * i)
    return F.least(F.greatest(raw, F.lit(0.0)), F.lit(float(i))).alias(f"d{i}")


def _cuts(counts: DataFrame) -> DataFrame:
    of = counts.groupBy("fold").agg(*[F.sum((F.col("c") == i).cast("long")).alias(f"n{i}") for i in range(1, 5)])
    return F.broadcast(of.select("fold", *[_discount(i) for i in (1, 2, 3)]))  # one row for each model


def _end(k: int) -> Column:
    """The context of an n-gram's end, of ``k`` points."""
    return F.col("ctx").bitwiseAND(F.lit((1 << BITS * k) - 1).cast("long"))


#: A context's total, and how many of its n-grams were seen once, twice and more often.
SUMS = {"total": F.sum, "s1": lambda c: F.sum((c == 1).cast("long")), "s2": lambda c: F.sum((c == 2).cast("long")),
        "s3": lambda c: F.sum((c > 2).cast("long"))}


def _left() -> Column:
    """The share of a context that its discounts leave to the order below; all of an unseen one."""
    left = F.col("s1") * F.col("d1") + F.col("s2") * F.col("d2") + F.col("s3") * F.col("d3")
    return F.when(F.col("total") > 0, left / F.col("total")).otherwise(1.0).alias("left")


def _interpolated(counts: DataFrame, k: int, below: DataFrame | None) -> DataFrame:
    """``fold``, ``ctx``, ``last``, ``p`` of all n-grams of order ``k`` in ``counts`` (the same and ``c``,
    which may be 0). A context's window holds at most a row for each code point there is."""
    by = Window.partitionBy("fold", "ctx")
    rows = counts.withColumns({n: f(F.col("c")).over(by) for n, f in SUMS.items()}).join(_cuts(counts), "fold")
    cut = F.when(F.col("c") <= 0, 0.0).when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
    own = F.when(F.col("total") > 0, (F.col("c") - cut) / F.col("total")).otherwise(0.0)
    rows = rows.select(*GRAM, own.alias("own"), _left())
    if below is None:
        return rows.select(*GRAM, (F.col("own") + F.col("left") / 0x110000).alias("p"))
    below = below.select(F.col("fold").alias("_fold"), F.col("ctx").alias("_ctx"), F.col("last").alias("_last"), F.col("p").alias("_p"))
    same = (F.col("fold") == F.col("_fold")) & (_end(k - 2) == F.col("_ctx")) & (F.col("last") == F.col("_last"))
    return rows.join(below, same).select(*GRAM, (F.col("own") + F.col("left") * F.col("_p")).alias("p"))


def _model(taught: DataFrame, ends: DataFrame) -> DataFrame:
    """What shards need: ``kind`` 0 has n-grams of the highest order, 1 their contexts (``v``: the
    share left to the order below), 2 the n-grams of the order below; with the points in the ``middle``."""
    seen = taught.select("fold", _end(ORDER - 2).alias("ctx"), "last", F.lit(1).cast("long").alias("c"))
    orders = {ORDER - 1: staged(seen.unionByName(ends).groupBy(*GRAM).agg(F.sum("c").alias("c")), "grams")}
    for k in range(ORDER - 2, 0, -1):  # how many different points stand before it
        orders[k] = staged(orders[k + 1].groupBy("fold", _end(k - 1).alias("ctx"), "last")
                           .agg(F.sum((F.col("c") > 0).cast("long")).alias("c")), "grams")
    p = None
    for k in range(1, ORDER):
        p = staged(_interpolated(orders[k], k, p), "probabilities")
    contexts = taught.groupBy("fold", "ctx").agg(*[f(F.col("c")).alias(n) for n, f in SUMS.items()]).join(_cuts(taught), "fold")
    middle = _end(ORDER - 2).alias("middle")
    return (_interpolated(taught, ORDER, p).select("fold", middle, F.lit(0).alias("kind"), "ctx", "last", F.col("p").alias("v"))
            .union(contexts.select("fold", middle, F.lit(1), "ctx", F.lit(0), _left()))
            .union(p.select("fold", F.col("ctx").alias("middle"), F.lit(2), "ctx", "last", "p")))


def _costs(wanted: DataFrame, model: DataFrame, shards: int, rounds: int) -> DataFrame:
    """``block``, ``digest``, ``shard``, ``costs`` of the block's n-grams of that shard, in their order."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                grams = np.frombuffer(row["grams"], "<u4").reshape(ORDER, -1)
                shard = shards_of(packed(grams[1:-1]), shards)
                order = np.argsort(shard, kind="stable")
                some, first = np.unique(shard[order], return_index=True)
                at = (row["block"] >> 32) % rounds
                yield pa.RecordBatch.from_pylist([
                    {"place": ((at * shards + int(s)) << 1) + row["fold"], "block": row["block"], "digest": row["digest"],
                     "grams": np.ascontiguousarray(grams[:, part]).tobytes()}
                    for s, part in zip(some, np.split(order, first[1:]))], cut)

    def price(asked: pa.Table, known: pa.Table) -> pa.Table:
        kind, ctx, last, v = (known.column(n).to_numpy() for n in ("kind", "ctx", "last", "v"))
        rows = [np.frombuffer(g.as_buffer(), "<u4").reshape(ORDER, -1) for g in asked.column("grams")]
        if not rows:
            return priced.empty_table()
        grams = np.concatenate(rows, 1)

        def find(some: np.ndarray, ask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            at = np.searchsorted(some, ask)
            here = at < len(some)
            here[here] = some[at[here]] == ask[here]
            return np.where(here, at, 0), here

        def value(of: np.ndarray, some: np.ndarray, head: np.ndarray, tail: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Values of the n-grams (head, tail) among rows ``of``, whose heads are all in ``some``."""
            names = (np.searchsorted(some, ctx[of]) << BITS) | last[of]
            order = np.argsort(names)
            i, has = find(some, head)
            j, hit = find(names[order], (i << BITS) | tail)
            hit &= has
            out = np.zeros(len(head))
            out[hit] = v[of][order][j[hit]]
            return out, hit

        head, middle, tail = packed(grams[:-1]), packed(grams[1:-1]), grams[-1].astype(np.int64)
        below, hit = value(kind == 2, np.unique(ctx[kind == 2]), middle, tail)
        if not hit.all():
            raise RuntimeError("an n-gram's end has no probability")
        order = np.argsort(ctx[kind == 1])
        contexts, left = ctx[kind == 1][order], v[kind == 1][order]
        at, seen = find(contexts, head)
        p = below.copy()
        p[seen] *= left[at[seen]]
        own, hit = value(kind == 0, contexts, head, tail)
        p[hit] = own[hit]
        cost = np.rint(-np.log(p) * UNIT).astype("<i4")
        cuts = np.cumsum([r.shape[1] for r in rows])[:-1]
        shard = (asked.column("place").to_numpy() >> 1) % shards
        return pa.table([asked.column("block"), asked.column("digest"), pa.array(shard.astype(np.int32)),
                         pa.array([c.tobytes() for c in np.split(cost, cuts)], pa.binary())], schema=priced)

    cut = pa.schema([("place", pa.int64()), ("block", pa.int64()), ("digest", pa.string()), ("grams", pa.binary())])
    priced = pa.schema([("block", pa.int64()), ("digest", pa.string()), ("shard", pa.int32()), ("costs", pa.binary())])
    asked = wanted.select("block", "fold", "digest", "grams").mapInArrow(split, "place long, block long, digest string, grams binary")
    copies = F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))).alias("at")
    shard = F.col("middle") % PRIME % shards
    known = model.select("*", copies).select(((F.col("at") * shards + shard) * 2 + F.col("fold")).cast("long").alias("place"),
                                             "kind", "ctx", "last", "v")
    return asked.groupBy("place").cogroup(known.groupBy("place")).applyInArrow(
        price, "block long, digest string, shard int, costs binary")


def _sums(docs: DataFrame, costs: DataFrame, shards: int) -> DataFrame:
    """``key``, ``total``, ``size`` of the texts of ``docs``, or of their pieces."""
    piece = PIECE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, keys, items in blocks(batches, piece):
            text = np.concatenate(items).tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
            yield pa.RecordBatch.from_pylist([{"block": block, "digest": digest(keys, items), "keys": keys,
                                               "sizes": [len(x) for x in items], "texts": zstandard.compress(text, 3)}], whole)

    def add(texts: pa.Table, priced: pa.Table) -> pa.Table:
        row, = texts.to_pylist()
        if set(priced.column("digest").to_pylist()) != {row["digest"]}:
            raise RuntimeError("the rows came in another order when read again: not a scan of files")
        text = zstandard.decompress(row["texts"]).decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass")
        items = np.split(np.frombuffer(text, "<u4"), np.cumsum(row["sizes"])[:-1])
        grams, _, places = distinct(items)
        shard = shards_of(packed(grams[1:-1]), shards)
        order = np.argsort(shard, kind="stable")
        parts = dict(zip(priced.column("shard").to_pylist(), priced.column("costs").to_pylist()))
        cost = np.empty(len(order), np.int64)
        cost[order] = np.concatenate([np.frombuffer(parts[s], "<i4") for s in sorted(parts)])
        sizes = np.array(row["sizes"]) - ORDER + 1
        total = np.add.reduceat(cost[places], np.cumsum(sizes) - sizes)
        return pa.table([pa.array(row["keys"], pa.string()), pa.array(total), pa.array(sizes)], schema=summed)

    whole = pa.schema([("block", pa.int64()), ("digest", pa.string()), ("keys", pa.list_(pa.string())),
                       ("sizes", pa.list_(pa.int64())), ("texts", pa.binary())])
    summed = pa.schema([("key", pa.string()), ("total", pa.int64()), ("size", pa.int64())])
    texts = docs.mapInArrow(run, "block long, digest string, keys array<string>, sizes array<long>, texts binary")
    return texts.groupBy("block").cogroup(costs.groupBy("block")).applyInArrow(add, "key string, total long, size long")


def scores(docs: DataFrame, trusted: DataFrame | None = None) -> DataFrame:
    """``key``, ``log_perplexity`` of each different text of ``docs`` (``key``: the text's
    md5, ``text``, never empty), by the model of ``trusted`` (the same columns).

    ``docs`` is read twice and has to give its rows in the same order, as a scan of files does. Without
    ``trusted`` it may be any table: it is written first, and its rows marked ``trusted`` train."""
    spark = docs.sparkSession
    if trusted is None:
        docs = staged(docs.select("key", "trusted", "text"), "texts")
        trusted = docs.filter("trusted")
    fold = (F.conv(F.substring("key", 1, 1), 16, 10).cast("int") % 2).alias("fold")
    setting = "spark.sql.files.minPartitionNum"  # else it follows the executors, of which some may be lost in between
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, before or str(spark.sparkContext.defaultParallelism))
    try:
        taught = staged(_taught(trusted.select(fold, "key", "text")), "grams")
        folds = [r.fold for r in taught.select("fold").distinct().collect()]  # two at most
        texts = docs.select(fold, "key", "text").filter(F.col("fold").isin(folds))
        wanted = staged(_wanted(texts), "wanted")
        asked, known = wanted.agg(F.coalesce(F.sum("m"), F.lit(0)).alias("m")).first().m, taught.count()
        rounds = max(1, ceil(asked / ROUND))
        shards = max(1, ceil(max(asked / rounds, known) / ENTRIES))
        sums = _sums(texts, _costs(wanted, _model(taught, _ends(wanted)), shards, rounds), shards)
        return staged(sums.groupBy("key").agg((F.sum("total") / F.sum("size") / UNIT).alias("log_perplexity")), "scores")
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)
