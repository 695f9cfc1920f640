"""Packing by concatenate and cut.

First pass: each task encodes its documents and writes, next to the ids, where
a document starts within the task. The tasks' token totals give each task's
place in the stream of all ids by a prefix sum, so a document's global offset is
its task's base plus its start there. Second pass: the stream is cut into
windows of ``size`` ids; a document yields one boundary record for each window
that it touches. All windows but the last are full.

Nothing is shuffled but one total per task: documents follow each other as the
table's splits do. Null texts count as empty; a document has at least its end id.
Repeated rows are packed as often as they stand there; an empty table gives no
sequence. Input columns besides ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm import tokens
from tripflow.llm.common import prefix_sums, staged

SIZE = 2048
ENCODED = "part int, local_start long, n long, doc_id long, ids binary"
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, pad long, ids binary")


def encode(docs: DataFrame, tokenizer: str | None = None, end_id: int = tokens.END_ID) -> DataFrame:
    """The first pass: every document's ids and its start within its task."""
    tokenizer = tokenizer or tokens.tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encoder, at = TaskContext.get().partitionId(), tokens.encoder(tokenizer, end_id), 0
        for b in tokens.gathered(batches):
            ids = encoder.encode(b.column(1))
            n = np.array([len(x) for x in ids], "i8") // encoder.dtype.itemsize
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part] * len(ids), pa.int32()), "local_start": at + np.cumsum(n) - n, "n": n,
                "doc_id": b.column(0), "ids": pa.array(ids, pa.binary())})
            at += int(n.sum())

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ENCODED)
    return staged(rows, "packing")


def cut(encoded: DataFrame, size: int = SIZE, width: int = 2, ids_too: bool = True) -> DataFrame:
    """The second pass: boundary records. ``pad`` is what the piece's sequence
    lacks to ``size`` (none where its length is a power of two). Without ``ids_too`` the
    records have null ids: who only wants the records spares the ids' way out of Python."""
    totals = encoded.groupBy("part").agg(F.sum("n").alias("total"))
    # One row per task of the first pass: bounded by the number of its tasks.
    bases = prefix_sums(totals, "part", "total", "base").select("part", "base")
    whole = encoded.agg(F.sum("n").alias("stream"))
    placed = (encoded.join(F.broadcast(bases), "part").join(F.broadcast(whole))
              .select("doc_id", (F.col("base") + F.col("local_start")).alias("at"), "n", "ids", "stream"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, n = (b.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            row = np.repeat(np.arange(len(n)), (at + n - 1) // size - at // size + 1)
            first = np.r_[True, row[1:] != row[:-1]] if len(row) else np.empty(0, bool)
            nth = np.arange(len(row)) - np.flatnonzero(first)[np.cumsum(first) - 1]
            seq = at[row] // size + nth
            start = np.maximum(seq * size, at[row])
            end = np.minimum((seq + 1) * size, (at + n)[row])
            ids = b.column(3)
            raw = [memoryview(ids[int(r)].as_buffer())[(s - a) * width:(e - a) * width]
                   for r, s, e, a in zip(row, start, end, at[row])]
            crc = [zlib.crc32(np.frombuffer(x, f"<u{width}").astype("<u4").tobytes()) for x in raw]
            held = np.minimum(size, b.column(4).to_numpy(zero_copy_only=False)[row] - seq * size)
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column(0).take(pa.array(row)), "start": start - at[row], "length": end - start,
                "ids_crc32": pa.array(crc, pa.int64()), "doc_tokens": n[row], "sequence_id": seq,
                "offset": start - seq * size, "pad": np.where(held & (held - 1), size - held, 0),
                "ids": pa.array([bytes(x) for x in raw], pa.binary()) if ids_too else pa.nulls(len(raw), pa.binary())})

    return placed.mapInArrow(run, PIECES)


def pack(docs: DataFrame, size: int = SIZE, tokenizer: str | None = None, end_id: int = tokens.END_ID,
         ids_too: bool = True) -> DataFrame:
    """Boundary records of ``docs`` with the ids of each piece."""
    tokenizer = tokenizer or tokens.tokenizer_path()
    return cut(encode(docs, tokenizer, end_id), size, tokens.encoder(tokenizer, end_id).dtype.itemsize, ids_too)


def sequences(pieces: DataFrame) -> DataFrame:
    """The sequences: ``sequence_id``, ``ids`` (little-endian, as wide as the
    pieces'), ``pad``. A sequence has at most ``size`` pieces."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (pieces.groupBy("sequence_id").agg(parts.alias("parts"), F.max("pad").alias("pad"))
            .select("sequence_id", F.concat_ws("", F.transform("parts", lambda p: F.hex(p["ids"]))).alias("x"), "pad")
            .select("sequence_id", F.unhex("x").alias("ids"), "pad"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` packed into sequences of 2048 ids."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), ids_too=False).drop("ids")
