"""Concatenate and cut: all documents end to end, cut into windows of one length."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesdq.llm import shared, tokens

END_ID = 2
#: Most partitions whose offsets (24 bytes each) are broadcast; beyond, they are joined like any table.
BROADCAST_PARTITIONS = 1 << 20


def tokenized(df: DataFrame, key: str, text: str, path: str, end_id: int) -> DataFrame:
    """Per row: key, partition, its tokens' place within the partition (``before``), their number and their ids."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, place = tokens.encoder(path, end_id).encode, TaskContext.get().partitionId(), 0
        for whole in parts:
            for batch in tokens.batches(whole, "text"):
                ids = encode(batch.column("text"))
                sizes = np.array([len(x) // 4 for x in ids], np.int64)
                before = place + np.cumsum(sizes) - sizes
                place += int(sizes.sum())
                columns = [batch.column("key"), pa.array(np.full(len(ids), part, np.int32)), before, sizes, ids]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) if not isinstance(c, pa.Array) else c for c in columns],
                    ["key", "part", "before", "doc_tokens", "ids"],
                )

    source = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return source.mapInArrow(run, "key long, part int, before long, doc_tokens long, ids binary")


def concatenate_and_cut(
    df: DataFrame, length: int = 4096, key: str = "doc_id", text: str = "text", tokenizer: str | None = None, end_id: int = END_ID
) -> DataFrame:
    """Pack all rows' tokens into sequences of ``length``; one row per piece, with its ids.

    First pass: rows are tokenized where they are read and written with their place within their partition. The
    partitions' totals, one number each, are summed up to global offsets. Second pass: each row knows its global place
    and is cut at the multiples of ``length``, without a shuffle. A piece is a boundary record: sequence, offset in it, document,
    start in the document, length and ids (little-endian unsigned 32-bit). All sequences are full but the last.

    A null or empty text is the end id alone. Repeated rows are packed once each, a null key stays null, other columns
    are left out. An empty table gives no rows. The order is that of the partitions read; what was written once
    is what the second pass reads, so a lost executor cannot shift offsets.
    """
    written = shared.stored(tokenized(df, key, text, tokenizer or tokens.default_path(), end_id), "tokens")
    totals = written.groupBy("part").agg(F.sum("doc_tokens").alias("n"))
    before = F.expr("sum(n) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    offsets = totals.select("part", F.coalesce(before, F.lit(0)).alias("base"))
    if df.rdd.getNumPartitions() <= BROADCAST_PARTITIONS:
        offsets = F.broadcast(offsets)
    placed = written.join(offsets, "part").withColumn("begin", F.col("base") + F.col("before"))
    windows = F.expr(f"sequence(begin div {length}, (begin + doc_tokens - 1) div {length})")
    pieces = placed.select("key", "begin", "doc_tokens", "ids", F.explode(windows).alias("sequence_id"))
    pieces = pieces.withColumn("start", F.expr(f"greatest(0L, sequence_id * {length} - begin)"))
    pieces = pieces.withColumn("length", F.expr(f"least(doc_tokens, (sequence_id + 1) * {length} - begin) - start"))
    return pieces.select(
        F.col("key").alias(key),
        "start",
        "length",
        F.expr("substring(ids, cast(4 * start + 1 as int), cast(4 * length as int))").alias("ids"),
        "doc_tokens",
        "sequence_id",
        F.expr(f"begin + start - sequence_id * {length}").alias("offset"),
    )


def digests(pieces: DataFrame) -> DataFrame:
    """Pieces with the unsigned CRC-32 of their ids instead of the ids."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op7_concatenate_and_cut(spark, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences of 4096 tokens."""
    return digests(concatenate_and_cut(spark.read.parquet(f"{sf_dir}/documents.parquet")))
