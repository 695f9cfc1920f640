"""Mixing sources to target weights.

Words are summed per source; the targets share out a multiple of all words by the
sources' weights, and none passes a multiple of its own source's words: what a full
source leaves goes to the others by weight, again and again (``targets``). A source's
rate is its target over its words. A document is taken ``floor(rate)`` times and once
more with the fraction as probability, drawn from a hash of the seed and its key, so
that reruns agree (``repeats``, ``mix``).

Null texts and texts without words have size 0; they count as documents but weigh
nothing. A source of no words has target 0 and rate 0. Null sources are one source,
the last. Rows of equal key draw alike; repeated rows are all kept and each drawn for.
Very long texts are single documents: what they add or leave out is off the target by
their own size at most. An empty table gives no rows. Columns beside key, source and
text pass through under any name.

Everything is DataFrame functions. A hot source meets its rate in a join that Spark
may split; only numbers (three per round of sharing out) reach the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.common import prefix_sums, shuffle_partitions, staged

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SEED = 11
WORDS = r"[^\x20\x09-\x0D]+"
_BITS = 52  # as many as a double keeps


def words(text: Column) -> Column:
    """The number of words of a text; 0 of null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def ranked(df: DataFrame, order: Column, into: str) -> DataFrame:
    """``df`` with its rows' number from 0 by ``order``, numbered by ranges in many tasks."""
    held = staged(df.select(F.struct("*").alias("row"), order.alias("key"))
                  .repartitionByRange(shuffle_partitions(df.sparkSession), F.col("key").asc_nulls_last())
                  .sortWithinPartitions(F.col("key").asc_nulls_last())
                  .select("row", F.monotonically_increasing_id().alias("at")), "ranked")
    part = F.shiftright("at", 33)
    counts = held.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.min("at").alias("first"))
    bases = prefix_sums(counts, "part", "n", "base")  # a row per task that wrote
    return (held.withColumn("part", part).join(F.broadcast(bases), "part")
            .select("row.*", (F.col("at") - F.col("first") + F.col("base")).alias(into)))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``sources`` (source, source_size) with their target. Weights repeat over the
    sources by code point, null last."""
    n = len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("at") % n + 1).cast("int"))
    held = staged(ranked(sources, F.col("source"), "at").select("source", "source_size", weight.cast("long").alias("weight")), "sources")
    full = F.col("source_size") * most

    def level(capped: Column) -> tuple[float, int]:
        """Words a weight for the sources that are not full, and how many are."""
        total, taken, rest, count = held.agg(
            F.sum("source_size"), F.sum(F.when(capped, full)), F.sum(F.when(~capped, F.col("weight"))), F.count_if(capped)).first()
        return ((share * (total or 0) - (taken or 0)) / rest if rest else float("inf")), count

    now, count = level(F.lit(False))
    while True:  # every further round fills a source at least
        then, more = level(full <= F.lit(now) * F.col("weight"))
        if more == count:
            break
        now, count = then, more
    even = F.lit(now) * F.col("weight")
    return held.select("source", "source_size", F.when(full <= even, full.cast("double")).otherwise(even).alias("target"))


def draw(keys: list[Column], seed: int = SEED) -> Column:
    """A number of [0, 1) from the seed and a row's key."""
    text = F.concat_ws(":", F.lit(seed), *[F.coalesce(k.cast("string"), F.lit("-")) for k in keys])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, _BITS // 4), 16, 10).cast("long") / F.lit(float(1 << _BITS))


def repeats(docs: DataFrame, keys: list[str], source: str = "source", text: str = "text", seed: int = SEED,
            weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Each row's number of copies: its columns ``keys`` as ``key`` (a struct), ``size``,
    ``source_size``, ``target`` and ``copies``. Texts are read once."""
    sized = staged(docs.select(F.struct(*keys).alias("key"), F.col(source).alias("source"), words(F.col(text)).alias("size")), "sizes")
    rates = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    once_more = draw([F.col("key")[k] for k in keys], seed) < rate - F.floor(rate)
    joined = sized.join(rates.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
    return joined.select("key", "source", "size", "source_size", "target", (F.floor(rate) + once_more.cast("long")).alias("copies"))


def mix(docs: DataFrame, keys: list[str], source: str = "source", text: str = "text", **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken. ``keys`` name a row."""
    taken = repeats(docs, keys, source, text, **options).filter("copies > 0").groupBy("key").agg(F.max("copies").alias("copies"))
    rows = docs.select(F.struct("*").alias("row"), F.struct(*keys).alias("own"))
    return (rows.join(taken, F.col("own").eqNullSafe(F.col("key")))
            .select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*"))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``, mixed: the words that the mix takes of each."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return repeats(docs, ["doc_id"]).select(
        F.col("key.doc_id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


OP11_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, CAST([3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS BIGINT) AS weight FROM per),
filled AS (  -- if this source and all that fill up no later are full
  SELECT a.source, a.source_size, a.weight,
         CAST(coalesce(sum(2 * b.source_size), 0) AS DOUBLE) AS taken,
         (SELECT sum(weight) FROM weighed) - coalesce(sum(b.weight), 0) AS rest
  FROM weighed a LEFT JOIN weighed b ON b.source_size * a.weight <= a.source_size * b.weight GROUP BY ALL),
levels AS (
  SELECT 1.5 * (SELECT sum(source_size) FROM per) / (SELECT sum(weight) FROM weighed) AS level
  UNION ALL SELECT (1.5 * (SELECT sum(source_size) FROM per) - taken) / rest FROM filled
  WHERE rest > 0 AND (1.5 * (SELECT sum(source_size) FROM per) - taken) / rest * weight >= 2 * source_size),
level AS (SELECT max(level) AS level FROM levels),
aims AS (
  SELECT source, source_size, CASE WHEN 2 * source_size <= level * weight THEN CAST(2 * source_size AS DOUBLE)
         ELSE level * weight END AS target FROM weighed, level),
rates AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM aims)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN
         CAST('0x' || substr(md5('11:' || coalesce(CAST(doc_id AS VARCHAR), '-')), 1, 13) AS BIGINT) / 4503599627370496.0
         < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM sized JOIN rates ON sized.source IS NOT DISTINCT FROM rates.source
"""
