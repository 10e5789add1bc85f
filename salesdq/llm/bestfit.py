"""Best-fit-decreasing packing of token ids into matrices of one width."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesdq.llm import shared, tokens

END_ID, PAD_ID = 2, 0
BLOCK_TOKENS = 4 << 20
#: Most partitions whose offsets (24 bytes each) are broadcast; beyond, they are joined like any table.
BROADCAST_PARTITIONS = 1 << 20

PACKED = (
    "part int, row long, n_tokens int, ids binary, cu_seqlens array<int>, resets array<int>, "
    "docs array<long>, starts array<long>, doc_tokens array<long>"
)


class Capacities:
    """Open bins by free capacity, under a segment tree that finds the least capacity that suffices."""

    def __init__(self, width: int):
        self.leaves = 1 << width.bit_length()
        self.any = [False] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(self.leaves)]

    def put(self, capacity: int, number: int) -> None:
        self.bins[capacity].append(number)
        node = capacity + self.leaves
        while node and not self.any[node]:
            self.any[node] = True
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """Remove a bin of the smallest capacity of at least ``least``: its capacity and number."""
        node = least + self.leaves
        if not self.any[node]:
            while node > 1 and (node & 1 or not self.any[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.any[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        number = self.bins[capacity].pop()
        if not self.bins[capacity]:
            self.any[node] = False
            while node > 1 and not self.any[node ^ 1]:
                node >>= 1
                self.any[node] = False
        return capacity, number


def best_fit(lengths: list[int], width: int) -> list[list[int]]:
    """Bins as lists of piece numbers: the longest pieces first, each into the bin that it leaves fullest."""
    free, bins = Capacities(width), []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = free.take(lengths[i])
        capacity, number = found or (width, len(bins))
        if found is None:
            bins.append([])
        bins[number].append(i)
        if capacity > lengths[i]:
            free.put(capacity - lengths[i], number)
    return bins


def pack(df: DataFrame, path: str, width: int = 4096, key: str = "doc_id", text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """Write rows' token ids packed into rows of ``width`` ids below ``path``, and return them as read back.

    Each task tokenizes its rows and packs them block by block (about BLOCK_TOKENS tokens, so memory is bounded and nothing is
    shuffled): documents longer than ``width`` are cut into pieces of that length and a rest, without loss; pieces are
    packed best-fit-decreasing. A matrix row holds ``ids`` (little-endian unsigned 32-bit, padded with PAD_ID), ``n_tokens``
    without padding, ``cu_seqlens`` (0 and each segment's end), ``resets`` (where positions start at 0 again), and for each segment
    its document, its start in the document and the document's tokens. ``row_id`` is gapless.

    A null or empty text is the end id alone. Repeated rows are packed once each; null keys stay null; other columns are
    left out. An empty table gives no rows.
    """
    spark, vocabulary = df.sparkSession, tokenizer or tokens.default_path()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, rows = tokens.encoder(vocabulary, END_ID).encode, TaskContext.get().partitionId(), 0
        docs: list[tuple[int, bytes]] = []

        def flush() -> pa.RecordBatch:
            nonlocal rows
            cut = [(k, at, ids) for k, ids in docs for at in range(0, len(ids) // 4, width)]
            lengths = [min(width, len(ids) // 4 - at) for _, at, ids in cut]
            out = []
            for members in best_fit(lengths, width):
                ends = np.cumsum([lengths[i] for i in members]).tolist()
                ids = b"".join(cut[i][2][4 * cut[i][1] : 4 * (cut[i][1] + lengths[i])] for i in members)
                ids += np.full(width - ends[-1], PAD_ID, "<u4").tobytes()
                sizes = [len(cut[i][2]) // 4 for i in members]
                firsts = [0, *ends[:-1]]
                out.append((part, rows, ends[-1], ids, [0, *ends], firsts, [cut[i][0] for i in members], [cut[i][1] for i in members], sizes))
                rows += 1
            docs.clear()
            columns = [pa.array(c, t) for c, t in zip(zip(*out), TYPES)]
            return pa.RecordBatch.from_arrays(columns, NAMES)

        held = 0
        for whole in parts:
            for batch in tokens.batches(whole, "text"):
                ids = encode(batch.column("text"))
                docs += zip(batch.column("key").to_pylist(), ids)
                held += sum(map(len, ids)) // 4
                if held >= BLOCK_TOKENS:
                    yield flush()
                    held = 0
        if docs:
            yield flush()

    source = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    source.mapInArrow(run, PACKED).write.parquet(path)
    written = spark.read.schema(PACKED).parquet(path)
    counts = written.groupBy("part").agg(F.count("*").alias("n"))
    before = F.expr("sum(n) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    offsets = counts.select("part", F.coalesce(before, F.lit(0)).alias("base"))
    if df.rdd.getNumPartitions() <= BROADCAST_PARTITIONS:
        offsets = F.broadcast(offsets)
    return written.join(offsets, "part").withColumn("row_id", F.col("base") + F.col("row")).drop("part", "row", "base")


INTS, LONGS = pa.list_(pa.int32()), pa.list_(pa.int64())
TYPES = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), INTS, INTS, LONGS, LONGS, LONGS]
NAMES = [x.split()[0] for x in PACKED.split(", ")]


def op3_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """All documents packed into rows of 4096 ids; the ids as their unsigned CRC-32."""
    packed = pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), shared.folder(spark, "packed"))
    return packed.select(
        F.col("row_id").alias("sequence_id"),
        "n_tokens",
        F.crc32("ids").alias("ids_crc32"),
        "cu_seqlens",
        "resets",
        F.col("docs").alias("doc_ids"),
        "starts",
        "doc_tokens",
    )
