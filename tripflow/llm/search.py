"""Ranked lexical search by pipelined term partitioning.

Every term belongs to one of a few successive owner stages, the rarest terms to the
first (``STAGE_ENDS``). An item's bundles, one for each block of documents, carry its
sparse accumulators from stage to stage. There they meet the owner's postings in a
cogroup by (block of items, block of documents), add the integer contributions of
the terms that they share and go on. Between two stages each item's tenth best sum so far is
a lower bound of its last score: an accumulator that the terms to come can't lift to it goes,
and items whose terms to come are worth less than it open no new one. Ties stay, so the result
is exact. At the end the survivors meet their documents' ids and are ranked.

A group holds ``ITEM_BLOCK`` items and ``DOC_BLOCK`` documents at most, whatever the tables'
sizes; postings of a frequent term are spread over all blocks of documents. Term counts of a
document are taken where it is read.

Null and empty texts have no terms; items without terms, or whose terms no document has,
get no rows. Items and documents are told apart by row: repeated rows (and null or
repeated ids) are each ranked; equal scores by ascending id, null last. A very long text is one
document. Empty tables give no rows. Only ids and texts are read, so other columns may have
any name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripflow.llm.common import staged
from tripflow.llm.mixing import ranked

MOST = 10
DOC_BITS = 13
DOC_BLOCK = 1 << DOC_BITS
ITEM_BITS = 8
ITEM_BLOCK = 1 << ITEM_BITS
#: A term belongs to the first stage whose part of all documents holds it.
STAGE_ENDS = (1 / 256, 1 / 32, 1 / 4, 1.0)

_SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_FOLDED = bytes.maketrans(bytes(range(65, 91)) + _SEPARATORS, bytes(range(97, 123)) + b" " * len(_SEPARATORS))
_BUNDLES = "ib bigint, block bigint, q bigint, docs array<int>, scores array<bigint>, best array<bigint>"


def terms(text: str | None) -> list[bytes]:
    """The terms of a text, with repeats."""
    return (text or "").encode().translate(_FOLDED).split()


def counted_terms(rows: DataFrame) -> DataFrame:
    """Of (row, id, text): each row's terms with their count ``tf`` and its number of terms ``n``;
    and, for rows with terms, the empty term, which alone has the id."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, tfs, ns, sizes = [], [], [], []
            for text in batch.column(2).to_pylist():
                words = terms(text)
                own = Counter(words)
                if own:
                    found.append(b"")
                    tfs.append(0)
                    found += own.keys()
                    tfs += own.values()
                ns.append(len(words))
                sizes.append(len(own) + bool(own))
            at = np.repeat(np.arange(len(sizes)), sizes)
            first = np.ones(len(at), bool)
            first[1:] = at[1:] != at[:-1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at, mask=~first)),
                 pa.array(np.array(ns, np.int64)[at]), pa.array(found, pa.binary()).cast(pa.string()),
                 pa.array(tfs, pa.int64())], names=["row", "id", "n", "term", "tf"])

    return rows.mapInArrow(count, f"row bigint, id {rows.schema['id'].dataType.simpleString()}, n bigint, term string, tf bigint")


def _numbered(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("id"), F.col(text).alias("text"))


def _step(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    """A block's bundles, after this stage's postings of the block."""
    held: dict[int, np.ndarray] = {}
    rest: dict[int, int] = {}
    for q, docs, scores, need, after in zip(*(left.column(c).to_pylist() if c in ("q", "need", "rest") else left.column(c)
                                              for c in ("q", "docs", "scores", "need", "rest"))):
        docs, scores = docs.values.to_numpy(), scores.values.to_numpy()
        keep = slice(None) if need is None else scores >= need
        held[q] = sums = np.full(DOC_BLOCK, -1, np.int64)
        sums[docs[keep]] = scores[keep]
        rest[q] = after
    for docs, adds, items in zip(right.column("docs"), right.column("adds"), right.column("items").to_pylist()):
        docs, adds = docs.values.to_numpy(), adds.values.to_numpy()
        for item in items:
            q = item["q"]
            if (sums := held.get(q)) is None:
                if not item["opens"]:
                    continue
                held[q] = sums = np.full(DOC_BLOCK, -1, np.int64)
                rest[q] = item["rest"]
            if item["opens"]:
                sums[docs] = np.maximum(sums[docs], 0) + adds
            else:
                known = sums[docs] >= 0
                sums[docs[known]] += adds[known]
    out = []
    for q, sums in held.items():
        docs = np.flatnonzero(sums >= 0)
        scores = sums[docs]
        best = np.sort(scores)[::-1][:MOST]
        if len(best) == MOST:  # what can't reach the tenth of this block alone can't reach that of all
            keep = scores + rest[q] >= best[-1]
            docs, scores = docs[keep], scores[keep]
        if len(docs):
            out.append((q, docs.astype(np.int32), scores, best))
    ib, block = (k.as_py() for k in key)
    kinds = (pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()))
    columns = [pa.array([x[i] for x in out], t) for i, t in enumerate(kinds)]
    return pa.table([pa.array([ib] * len(out), pa.int64()), pa.array([block] * len(out), pa.int64()), *columns],
                    names=["ib", "block", "q", "docs", "scores", "best"])


def _tenth(bundles: DataFrame) -> DataFrame:
    """Each item's tenth best sum, if it has ten."""
    order = Window.partitionBy("q").orderBy(F.desc("score"))
    best = bundles.select("q", F.explode("best").alias("score")).withColumn("rank", F.row_number().over(order))
    return best.filter(F.col("rank") <= MOST).filter(F.col("rank") == MOST).select("q", F.col("score").alias("tenth"))


def rank(docs: DataFrame, items: DataFrame, doc_key: str = "doc_id", item_key: str = "item_id",
         text: str = "text", item_text: str = "text") -> DataFrame:
    """The ten best documents of each item: ``item``, ``rank``, ``doc``, ``score``."""
    asked = staged(counted_terms(_numbered(items, item_key, item_text)), "items")
    words = ranked(asked.filter("term <> ''").select("term").distinct(), F.col("term"), "at").select("term", (F.col("at") + 1).alias("t"))
    words = staged(words.unionByName(asked.sparkSession.sql("SELECT '' AS term, 0L AS t")), "terms")
    # Only what some item asks for is kept of the documents, and a row for each document.
    held = staged(counted_terms(_numbered(docs, doc_key, text)).join(words, "term").select("row", "id", "n", "t", "tf"), "counted")
    found, total = held.filter("t = 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    owned = held.filter("t > 0").groupBy("t").agg(F.count("*").alias("df"))
    ends = [F.when(F.col("df") <= F.lit(found * end), i) for i, end in enumerate(STAGE_ENDS)]
    weight = F.floor(1000 * F.log(F.lit(2.0 * found + 2) / (2 * F.col("df") + 1))).cast("long")
    owned = staged(owned.select("t", weight.alias("w"), F.coalesce(*ends).alias("stage")), "owners")
    m = f"(100 - 90 + ((90 * n * {found}L) div {max(total, 1)}L))"
    adds = F.expr(f"w * ((1000000000L * tf) div (1000 * tf + 8 * {m}))")
    postings = (held.filter("t > 0").join(owned, "t")
                .select("stage", "t", F.shiftright("row", DOC_BITS).alias("block"),
                        F.struct(F.col("row").bitwiseAND(DOC_BLOCK - 1).cast("int").alias("doc"), adds.alias("add")).alias("p"))
                .groupBy("stage", "block", "t").agg(F.collect_list("p").alias("p"))
                .select("stage", "block", "t", F.col("p.doc").alias("docs"), F.col("p.add").alias("adds")))
    postings = staged(postings, "postings")
    most = postings.groupBy("t", "stage").agg(F.max(F.array_max("adds")).alias("most"))
    ask = staged(asked.filter("term <> ''").select(F.col("row").alias("q"), "term").join(words, "term").join(most, "t")
                 .select("q", "t", "stage", "most"), "asked")
    bundles = _piped(ask, postings)
    names = held.filter("t = 0").select("row", F.col("id").alias("doc"))
    of = asked.filter("term = ''").select(F.col("row").alias("q"), F.col("id").alias("item"))
    last = (bundles.join(_tenth(bundles), "q", "left").select("q", "block", "tenth", F.explode(F.arrays_zip("docs", "scores")).alias("x"))
            .select("q", (F.shiftleft("block", DOC_BITS) + F.col("x.docs")).alias("row"), F.col("x.scores").alias("score"), "tenth")
            .filter((F.col("score") > 0) & (F.col("score") >= F.coalesce("tenth", F.lit(0)))))
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc"), "row")
    return (last.join(names, "row").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= MOST)
            .join(of, "q").select("item", "rank", "doc", "score"))


def _piped(ask: DataFrame, postings: DataFrame) -> DataFrame:
    """The bundles after all stages."""
    spark = ask.sparkSession
    bundles, tenth = spark.createDataFrame([], _BUNDLES), spark.createDataFrame([], "q bigint, tenth bigint")
    ib = F.shiftright("q", ITEM_BITS).alias("ib")
    for stage in range(len(STAGE_ENDS)):
        worth = [F.coalesce(F.sum(F.when(F.col("stage") >= s, F.col("most"))), F.lit(0)) for s in (stage, stage + 1)]
        bounds = staged(ask.groupBy("q").agg(worth[0].alias("now"), worth[1].alias("rest")).join(tenth, "q", "left"), "bounds")
        opens = F.col("tenth").isNull() | (F.col("now") >= F.col("tenth"))
        wanted = (ask.filter(F.col("stage") == stage).join(bounds, "q").groupBy(ib, "t")
                  .agg(F.collect_list(F.struct("q", opens.alias("opens"), "rest")).alias("items")))
        here = postings.filter(F.col("stage") == stage).join(wanted, "t").select("ib", "block", "docs", "adds", "items")
        carried = bundles.join(bounds, "q").select("ib", "block", "q", "docs", "scores", (F.col("tenth") - F.col("now")).alias("need"), "rest")
        bundles = staged(carried.groupBy("ib", "block").cogroup(here.groupBy("ib", "block")).applyInArrow(_step, _BUNDLES), "bundles")
        tenth = _tenth(bundles)
    return bundles


def op12_term_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of all ``documents`` for each ``benchmark`` item."""
    found = rank(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")


OP12_SQL = r"""
WITH folded AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
docs AS (SELECT doc_id, w, CAST(len(w) AS BIGINT) AS n FROM folded WHERE len(w) > 0),
stats AS (SELECT CAST(count(*) AS BIGINT) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM docs),
items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
places AS (SELECT doc_id, n, unnest(w) AS term FROM docs),
postings AS (SELECT doc_id, n, term, CAST(count(*) AS BIGINT) AS tf FROM places
             WHERE term IN (SELECT term FROM items) GROUP BY doc_id, n, term),
weights AS (SELECT term, CAST(floor(1000 * ln((2.0 * nn + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM postings, stats GROUP BY term, nn),
scores AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * nn) // ll)))) AS BIGINT) AS score
  FROM items JOIN postings USING (term) JOIN weights USING (term), stats GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 10
"""
