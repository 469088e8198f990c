"""Token-ID output: documents as wavelet-matrix shards in ascending doc_id order, and reading them back.

Documents are dealt by ranges of doc_id and sorted within a range (ties: by the hash of the text, so a
doc_id that fills many rows spreads over ranges). Each task streams its range and closes a shard as soon
as it holds SHARD_TOKENS, so a shard's memory does not follow the size of a range. A shard is one
self-contained block of bytes (see wavelet.py), stored as one row of a Parquet table, because executors
reach the shared store only through Spark's writers and readers.

Edge cases: a null text is empty and gives only the end id; a null doc_id sorts first and comes back as
null; repeated rows are stored as often as they come; an empty table gives a store without shards; extra
columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import wavelet
from .common import materialize, partitions, scratch_root, table, tidied
from .tokens import encoder, gathered, slices, tokenizer_path

SHARD_TOKENS = 1 << 21
SHARD_SCHEMA = "part int, seq int, n_docs int, n_tokens long, payload binary"


def _shards(path: str, spaces: str, end_id: int, shard_tokens: int):
    def run(it):
        part, seq = TaskContext.get().partitionId(), 0
        enc, end = encoder(path, spaces), np.array([end_id], "<u4").tobytes()
        ids, docs, lengths, held = [], [], [], 0

        def close():
            nonlocal seq, held
            data = wavelet.build(np.frombuffer(b"".join(ids), "<u4"), docs, lengths)
            row = ([part], [seq], [len(docs)], [held], [data])
            seq, held = seq + 1, 0
            ids.clear(), docs.clear(), lengths.clear()
            types = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
            names = ("part", "seq", "n_docs", "n_tokens", "payload")
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, types, strict=True)], names)

        for b in gathered(it):
            texts = [t or "" for t in b.column("text").to_pylist()]
            for k, e in zip(b.column("doc_id").to_pylist(), enc.encode(texts), strict=True):
                ids.append(e + end)
                docs.append(k)
                lengths.append(len(e) // 4 + 1)
                held += lengths[-1]
                if held >= shard_tokens:
                    yield close()
        if docs:
            yield close()
        enc.shrink()

    return tidied(run)


def write_tokens(docs: DataFrame, out: str, tokenizer: str, spaces: str, end_id: int = 2, shard_tokens: int = SHARD_TOKENS) -> str:
    """Write the shards of docs (doc_id, text) to the folder out."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    tie = F.xxhash64("text")
    dealt = rows.repartitionByRange(partitions(docs.sparkSession), F.col("doc_id").asc_nulls_first(), tie)
    dealt = dealt.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), tie)
    shards = dealt.mapInArrow(_shards(tokenizer, spaces, end_id, shard_tokens), SHARD_SCHEMA)
    shards.write.option("compression", "none").parquet(out)
    return out


def _digests(it):
    for b in it:
        for part, seq, data in zip(*(b.column(c).to_pylist() for c in ("part", "seq", "payload")), strict=True):
            rows = [(part, seq, d, a, len(ids), zlib.crc32(ids.tobytes())) for d, a, ids in wavelet.documents(data)]
            names = ("part", "seq", "doc_id", "at", "n_tokens", "ids_crc32")
            types = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def read_digests(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each stored document, from the shards' own bytes."""
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)
    rows = shards.mapInArrow(tidied(_digests), "part int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long")
    sizes = shards.select("part", "seq", "n_tokens")
    # Totals of the ranges first (a row per range), then of the shards within each range.
    before = F.coalesce(F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("total")).select("part", before.alias("base"))
    w = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", "seq", F.coalesce(F.sum("n_tokens").over(w), F.lit(0)).alias("off")).join(parts, "part")
    out = rows.join(offsets, ["part", "seq"])
    return out.select("doc_id", (F.col("base") + F.col("off") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def op4_token_store(spark, sf_dir: str) -> DataFrame:
    import uuid

    path = f"{scratch_root(spark)}/tokens-{uuid.uuid4().hex}"
    write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_path("word_bpe_49k.json"), "drop")
    return read_digests(spark, path)


def encode_documents(docs: DataFrame, tokenizer: str, spaces: str, end_id: int = 2) -> tuple[DataFrame, str]:
    """A written table (doc_id, ids binary of little-endian uint32 with the end id)."""

    def run(it):
        enc, end = encoder(tokenizer, spaces), np.array([end_id], "<u4").tobytes()
        for whole in it:
            for b in slices(whole):
                texts = [t or "" for t in b.column("text").to_pylist()]
                found = pa.array([e + end for e in enc.encode(texts)], pa.binary())
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), found], ["doc_id", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return materialize(rows.mapInArrow(run, "doc_id long, ids binary"), "ids")
