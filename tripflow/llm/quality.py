"""A quality classifier: perplexity under an interpolated modified Kneser-Ney model.

The model (``language_model``) is one of code points, trained on all trusted texts
(labelled of good quality and not toxic); every text is scored by it.

Perplexities of texts of ``n`` code points lie about their language's median, with
deviations that fall as ``1 / sqrt(n)``. So one rule holds for every language and length: a
text is rejected if its deviation, times ``sqrt(n)`` and in units of its language's median
absolute deviation, exceeds its language's level, plus ``SLACK`` in log-perplexity. The level is the
``QUANTILE`` quantile of the language's trusted texts' deviations, averaged with that of all trusted
texts, which weighs as much as ``1 / (1 - QUANTILE)`` texts: so many hold one beyond the quantile. A
language's unit is averaged alike, at a weight of ``PRIOR`` texts; a language without trusted texts has
the middle, unit and level of all.
Quantiles are read off histograms of fixed steps, so they are the same whatever the order of rows.

Null and empty texts have no perplexity and are kept; so are texts where no trusted ones can train.
Rows with equal or null keys are scored each on their own; a null key is never trusted. An
empty table gives none.

Rows travel inside a struct, so further columns of any name pass; the four columns that
``classify`` adds are replaced. Very long texts are cut into n-grams a piece at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripflow.llm.common import plain_scan, staged
from tripflow.llm.language_model import scores

QUANTILE, SLACK = 0.999, 0.02
PRIOR = 30  # texts that a language's own fit has to outweigh
STEP = 1000  # histogram steps in a unit of log-perplexity


def _quantile(rows: DataFrame, keys: list[str], value: Column, share: float, name: str) -> DataFrame:
    """The quantile of ``value`` for each of ``keys``, and ``m``, their rows; off a histogram."""
    steps = rows.groupBy(*keys, F.floor(value * STEP).alias("step")).agg(F.count("*").alias("n"))
    by = Window.partitionBy(*keys)  # one row for each step
    known = steps.withColumn("m", F.sum("n").over(by)).withColumn("upto", F.sum("n").over(by.orderBy("step")))
    return (known.filter(F.col("upto") >= share * F.col("m")).groupBy(*keys)
            .agg(((F.min("step") + 1) / STEP).alias(name), F.first("m").alias("m")))


def limits(trusted: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """``lang``, ``middle``, ``spread``, ``level`` from trusted rows (``lang``, ``n_symbols``,
    ``log_perplexity``); a null language holds for those without trusted rows."""
    rows = trusted.filter("log_perplexity is not null and lang is not null").select(
        "lang", F.sqrt("n_symbols").alias("root"), F.col("log_perplexity").alias("y"))
    middle = _quantile(rows, ["lang"], F.col("y"), 0.5, "middle")
    off = staged(rows.join(F.broadcast(middle), "lang").withColumn("off", (F.col("y") - F.col("middle")) * F.col("root")), "deviations")
    spread = _quantile(off, ["lang"], F.abs("off"), 0.5, "spread")
    every = (_quantile(rows, [], F.col("y"), 0.5, "middle0").drop("m")
             .join(F.broadcast(_quantile(off, [], F.abs("off"), 0.5, "spread0").drop("m"))))
    known = middle.drop("m").join(F.broadcast(spread), "lang").join(F.broadcast(every)).select(
        "lang", "middle", ((F.col("m") * F.col("spread") + PRIOR * F.col("spread0")) / (F.col("m") + PRIOR)).alias("spread"))
    fit = staged(known.union(every.select(F.lit(None).cast("string"), "middle0", "spread0")), "limits")
    units = off.join(F.broadcast(fit.select("lang", "spread")), "lang").withColumn("units", F.col("off") / F.col("spread"))
    own = _quantile(units, ["lang"], F.col("units"), quantile, "own")
    level = _quantile(units, [], F.col("units"), quantile, "level0").drop("m")
    weight = 1 / (1 - quantile)
    both = (F.col("m") * F.col("own") + weight * F.col("level0")) / (F.col("m") + weight)
    return fit.join(F.broadcast(own), "lang", "left").join(F.broadcast(level)).select(
        "lang", "middle", "spread", F.coalesce(both, "level0").alias("level"))


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, slack: float = SLACK) -> DataFrame:
    """``docs`` (``doc_id``, ``text``, ``lang``) with ``n_symbols``, ``log_perplexity``,
    ``threshold`` and ``kept``; ``labels``: ``doc_id``, ``quality``, ``toxic``."""
    docs = docs.drop("n_symbols", "log_perplexity", "threshold", "kept")
    good = labels.filter("quality = 1 and coalesce(toxic, 0) = 0").select("doc_id").distinct()
    good = good.hint("merge").withColumn("trusted", F.lit(True))  # one plan at every size: texts meet the ids by a shuffle
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select(F.struct("*").alias("row"), "doc_id", text.alias("body"), F.length(text).cast("long").alias("n_symbols"),
                        F.coalesce(F.col("lang"), F.lit("")).alias("lang"), F.md5(text).alias("key"))
    ids = keyed.filter("n_symbols > 0").select("doc_id", F.col("body").alias("text"), "n_symbols", "lang", "key")
    if plain_scan(docs):  # else the texts are written first
        scored = scores(ids.select("key", "text"), ids.join(good, "doc_id").select("key", "text"))
    else:
        scored = scores(ids.join(good, "doc_id", "left").select("key", F.coalesce("trusted", F.lit(False)).alias("trusted"), "text"))
    fit = staged(limits(ids.drop("text").join(good, "doc_id", "left_semi").join(scored, "key"), quantile), "limits")
    here = F.struct("middle", "spread", "level")
    small = fit.count() <= 100_000  # else the join is left to its statistics
    own = fit.filter("lang is not null").select("lang", here.alias("own"))
    other = F.broadcast(fit.filter("lang is null").select(here.alias("other")))
    out = (keyed.select("row", "n_symbols", "lang", "key").join(scored, "key", "left")
           .join(F.broadcast(own) if small else own, "lang", "left").join(other, how="left"))
    by = F.coalesce("own", "other")
    root = F.sqrt(F.greatest("n_symbols", F.lit(1)).cast("double"))
    limit = F.when(F.col("n_symbols") > 0, by["middle"] + by["level"] * by["spread"] / root + slack)
    return out.select("row.*", "n_symbols", "log_perplexity", limit.alias("threshold"),
                      F.coalesce(F.col("log_perplexity") <= limit, F.lit(True)).alias("kept"))


def op6_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The perplexity of all ``documents`` and which are kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text")
    scored = classify(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).drop("text")
    return scored.withColumn("perplexity", F.exp("log_perplexity"))
