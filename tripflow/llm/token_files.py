"""Token-ID output: flat files of unsigned ids and 64-bit document offsets.

Layout under one folder, shard ``p`` being the p-th range of ``doc_id``:

* ``ids-{p:06d}.bin``      ids of the shard's documents, one after the other,
  little-endian, 16 bits wide where the vocabulary fits, else 32;
* ``docs-{p:06d}.bin``     the documents' keys, 64-bit signed; a null key is
  the smallest integer;
* ``offsets-{p:06d}.bin``  n + 1 unsigned 64-bit integers: where each document
  starts among the ids of *all* shards, and where the last one ends;
* ``manifest``             Parquet, one row per shard: documents, tokens and
  the shard's base.

Texts are encoded once. The task that encodes a range writes its ids and
lengths; the ranges' totals give each shard's base by a prefix sum; a second
pass adds the base to the shard's lengths, eight bytes a document. A file is
written under a name of the attempt's own and renamed when it is whole, so a
repeated or speculative task only replaces a file by an equal one.

Null texts count as empty, and an empty document has the end id alone. Rows with
equal keys stand in the order of their texts' hashes. An empty table gives a
folder with an empty manifest. Other columns of the input are not read.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm import tokens
from tripflow.llm.common import prefix_sums, shuffle_partitions
from tripflow.session import work_path

NULL_KEY = -(1 << 63)
MANIFEST = "shard int, width int, docs long, tokens long"
DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _filesystem(uri: str):
    from pyarrow import fs
    if "://" in uri or uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


def _whole(root: str, name: str, write) -> None:
    """``write(stream)`` into a file that gets its name when it is complete."""
    system, folder = _filesystem(root)
    own = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(own) as out:
        write(out)
    system.move(own, f"{folder}/{name}")


def mapped(root: str, name: str, dtype: str) -> np.ndarray:
    """A file's integers: memory-mapped where the folder is mounted, read elsewhere."""
    system, folder = _filesystem(root)
    path = f"{folder}/{name}"
    if system.type_name == "local":
        return np.memmap(path, dtype, "r") if os.path.getsize(path) else np.empty(0, dtype)
    with system.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype)


def write(docs: DataFrame, root: str, tokenizer: str | None = None, end_id: int = tokens.END_ID,
          shards: int | None = None) -> DataFrame:
    """Encode ``docs`` (``doc_id``, ``text``) into ``root``; returns the manifest."""
    spark = docs.sparkSession
    tokenizer = tokenizer or tokens.tokenizer_path()
    system, folder = _filesystem(root)
    system.create_dir(folder, recursive=True)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, encoder = TaskContext.get().partitionId(), tokens.encoder(tokenizer, end_id)
        keys, lengths = [], []

        def ids(out) -> None:
            for b in tokens.gathered(batches):
                for x in encoder.encode(b.column(1)):
                    out.write(x)
                    lengths.append(len(x) // encoder.dtype.itemsize)
                keys.extend(NULL_KEY if k is None else k for k in b.column(0).to_pylist())

        _whole(root, f"ids-{shard:06d}.bin", ids)
        _whole(root, f"docs-{shard:06d}.bin", lambda out: out.write(np.array(keys, "<i8").tobytes()))
        _whole(root, f"lengths-{shard:06d}.bin", lambda out: out.write(np.array(lengths, "<u8").tobytes()))
        if keys:
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int32()), "width": pa.array([encoder.dtype.itemsize], pa.int32()),
                "docs": [len(keys)], "tokens": [sum(lengths)]})

    key = F.col("doc_id").cast("long")
    rows = (docs.select(key.alias("doc_id"), F.col("text"))
            .repartitionByRange(shards or shuffle_partitions(spark), F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
            .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")))
    parts = f"{root}/parts"
    rows.mapInArrow(encode, MANIFEST).write.parquet(parts)
    manifest = prefix_sums(spark.read.schema(MANIFEST).parquet(parts), "shard", "tokens", "base")
    manifest.write.parquet(f"{root}/manifest")

    def offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in b.to_pylist():
                n = mapped(root, f"lengths-{x['shard']:06d}.bin", "<u8")
                at = np.concatenate(([0], np.cumsum(n, dtype="<u8"))).astype("<u8") + np.uint64(x["base"])
                _whole(root, f"offsets-{x['shard']:06d}.bin", lambda out, at=at: out.write(at.tobytes()))
            yield pa.RecordBatch.from_pydict({"shard": b.column(b.schema.get_field_index("shard"))})

    _by_shard(read_manifest(spark, root)).mapInArrow(offsets, "shard int").write.format("noop").mode("overwrite").save()
    return read_manifest(spark, root)


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(MANIFEST + ", base long").parquet(f"{root}/manifest")


def _by_shard(manifest: DataFrame) -> DataFrame:
    """One row per shard, dealt out so that tasks take a few shards each."""
    return manifest.repartition(shuffle_partitions(manifest.sparkSession), "shard")


def read(spark: SparkSession, root: str) -> DataFrame:
    """Every document in the files: ``doc_id``, ``start``, ``n_tokens`` and
    ``ids_crc32`` over its ids as 32-bit integers."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in b.to_pylist():
                p, base = x["shard"], x["base"]
                ids = mapped(root, f"ids-{p:06d}.bin", f"<u{x['width']}")
                at = mapped(root, f"offsets-{p:06d}.bin", "<u8").astype("<i8")
                keys = mapped(root, f"docs-{p:06d}.bin", "<i8")
                for i in range(0, len(keys), 8192):
                    some = keys[i:i + 8192]
                    crc = [zlib.crc32(ids[at[j] - base:at[j + 1] - base].astype("<u4").tobytes())
                           for j in range(i, i + len(some))]
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(some, pa.int64(), mask=some == NULL_KEY), "start": at[i:i + len(some)],
                        "n_tokens": np.diff(at[i:i + len(some) + 1]), "ids_crc32": pa.array(crc, pa.int64())})

    return _by_shard(read_manifest(spark, root)).mapInArrow(documents, DOCUMENTS)


def read_ids(spark: SparkSession, root: str) -> DataFrame:
    """``doc_id`` and the ids themselves, as an array of integers."""

    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in b.to_pylist():
                p, base = x["shard"], x["base"]
                ids = mapped(root, f"ids-{p:06d}.bin", f"<u{x['width']}")
                at = mapped(root, f"offsets-{p:06d}.bin", "<u8").astype("<i8") - base
                keys = mapped(root, f"docs-{p:06d}.bin", "<i8")
                for i in range(0, len(keys), 256):
                    some = keys[i:i + 256]
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(some, pa.int64(), mask=some == NULL_KEY),
                        "ids": pa.array([ids[at[j]:at[j + 1]].astype("<i8") for j in range(i, i + len(some))],
                                        pa.list_(pa.int64()))})

    return _by_shard(read_manifest(spark, root)).mapInArrow(arrays, "doc_id long, ids array<long>")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` written to token files and read back from them."""
    root = work_path(spark, "token_files")
    write(spark.read.parquet(f"{sf_dir}/documents.parquet"), root)
    return read(spark, root)
