"""The corpus pipeline: documents to packed sequences, in four stages.

1. ``quality``: documents whose perplexity is too high for their language go.
2. ``near_dedup``: of each class of near-duplicates one document stays.
3. ``pii``: personal data and the terms that give it away are blanked.
4. ``packing``: the texts' ids are cut into sequences of 2048.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept
and returns the columns of ``docs``, the last one boundary records with their
ids. Between stages the rows are Parquet. Rows travel inside a struct, so columns
of any name pass through. An empty table passes all stages; null texts are kept by the
first three and packed as empty ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm import common, minhash, packing, pii, quality


def _wrapped(docs: DataFrame, *columns: str) -> DataFrame:
    return docs.select(F.struct("*").alias("_row"), *columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those that the Kneser-Ney classifier rejects."""
    common.prepare(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.classify(_wrapped(docs, "doc_id", "lang", "text"), labels).filter("kept").select("_row.*")


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    common.prepare(spark)
    return minhash.representatives(_wrapped(docs, "doc_id", "text")).select("_row.*")


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with sanitised texts, and ``n_chars`` as they are then."""
    common.prepare(spark)
    out = pii.sanitise(_wrapped(docs, "text")).select("_row.*", F.col("text").alias("_clean"))
    clean = {"text": F.col("_clean"), "n_chars": F.length("_clean").cast("long")}
    return out.withColumns({c: x for c, x in clean.items() if c in docs.columns}).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boundary records of all documents' ids."""
    common.prepare(spark)
    return packing.pack(docs)


STAGES = [("quality", quality_stage), ("near_dedup", near_dedup_stage), ("pii", pii_stage), ("packing", packing_stage)]

#: SQL has neither the tokenizer nor the language model; the tests compare each
#: stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.staged(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
