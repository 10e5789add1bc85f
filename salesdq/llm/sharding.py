"""Two-pass external shuffle of a table into shards of equal row counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesdq.llm import shared

BUCKET_BYTES = 32 << 20
#: Most buckets for which counts (16 bytes each) and copied rows (8 bytes, up to eight for each bucket) are broadcast; beyond, they
#: are joined like any table. The result is the same.
BROADCAST_BUCKETS = 1 << 20
#: Copies of a row that fill more than this share of a bucket are dealt out over all buckets, so many of them at a time.
COPIES_SHARE, COPIES = 8, 10_000


def shuffle_to_shards(
    df: DataFrame,
    path: str,
    shards: int,
    key: str = "doc_id",
    payload: str = "text",
    seed: int = 42,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """Write all rows in a random order as ``shards`` folders ``shard=k`` below ``path``, and return them as read back.

    Pass one scatters the rows by a seeded hash into buckets of about ``bucket_bytes`` each, one bucket per partition.
    Pass two brings each bucket into a fixed order, shuffles it (Fisher-Yates, seeded by the bucket's number) and writes
    it. Buckets are laid end to end, and the row at place p of N goes to shard floor(p * shards / N): counts differ by
    one at most. ``slot`` is the place within the shard, gapless from 0.

    The hash takes all columns, so neither a hot key nor copies of one text fill a bucket. Rows that agree in everything
    are interchangeable: where they would fill more than an eighth of a bucket, one of them and their number stand for
    them, and the copies, numbered, are hashed by their number as well. A null key or payload is an ordinary value. An empty table gives no rows. Other
    columns are kept, under any name (maps have no hash: a table with some has no copies); columns named shard or slot are
    replaced. The result depends on rows, seed and bucket size, not on partitions or on what is broadcast: a
    lost task writes the same again.
    """
    spark = df.sparkSession
    df = df.drop("shard", "slot")
    columns = df.columns
    hashed = [F.col(key), F.col(payload), *[F.col(f"`{f.name}`") for f in df.schema if f.name not in (key, payload) and not _has_map(f.dataType)]]
    digest = F.xxhash64(F.lit(seed), *hashed)
    weight = F.coalesce(F.octet_length(payload), F.lit(0)) + F.lit(64)
    size, rows = df.select(F.sum(weight), F.count("*")).first()
    buckets = max(1, -(-(size or 0) // bucket_bytes))
    few = buckets <= BROADCAST_BUCKETS

    other = F.xxhash64(F.lit(~seed), *hashed)  # rows count as copies if both hashes agree, over all columns
    sizes = df.select(digest.alias("h"), other.alias("o"), weight.cast("long").alias("b")).groupBy("h")
    sizes = sizes.agg(F.count("*").alias("n"), F.sum("b").alias("b"), F.min("o").alias("least"), F.max("o").alias("most"))
    copied = (F.col("n") > 1) & (F.col("least") == F.col("most")) & F.lit(not any(_has_map(f.dataType) for f in df.schema))
    # at most COPIES_SHARE of them for each bucket
    hot = shared.stored(sizes.where(copied & (F.col("b") * COPIES_SHARE > bucket_bytes)).select("h", "n"), "copies")
    whole = df.select(digest.alias("h"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias("r"))
    if hot.isEmpty():
        scattered = whole
    else:
        known = F.broadcast(hot) if few else hot
        first = whole.join(known, "h").groupBy("h", "n").agg(F.first("r").alias("r"))
        numbered = _numbered(first.select("h", "n", "r"), seed).select("h", "r")
        scattered = whole.join(known.select("h"), "h", "left_anti").unionByName(numbered)
    bucket = F.pmod("h", F.lit(buckets)).cast("int")

    each = df.select(digest.alias("h"))
    if scattered is not whole:
        each = each.join(known.select("h"), "h", "left_anti").unionByName(_numbered(hot, seed).select("h"))
    counts = each.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))
    before = F.expr("sum(n) OVER (ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    offsets = counts.select("bucket", F.coalesce(before, F.lit(0)).alias("offset"))
    if few:
        offsets = F.broadcast(offsets)

    gathered = scattered.select(bucket.alias("bucket"), F.struct("h", "r").alias("e")).repartitionById(buckets, "bucket")
    # shuffled in the bucket's own partition, whose number is part of the seed, before anything else is joined
    gathered = gathered.groupBy("bucket").agg(F.sort_array(F.collect_list("e")).alias("e")).select("bucket", F.shuffle("e", seed).alias("e"))
    shuffled = gathered.join(offsets, "bucket").select("offset", F.posexplode("e").alias("i", "e"))
    shard = f"cast(((offset + i) * {shards} + {shards - 1}) div {max(rows, 1)} as int)"
    slot = F.expr(f"offset + i - ({shard} * {rows}L) div {shards}")
    placed = shuffled.select("e.r.*", F.expr(shard).alias("shard"), slot.alias("slot"))
    placed.write.partitionBy("shard").parquet(path)
    return spark.read.schema(placed.schema).parquet(path)


def _has_map(kind: T.DataType) -> bool:
    return "map<" in kind.simpleString()


def _numbered(copies: DataFrame, seed: int) -> DataFrame:
    """A row for each of the n copies of a row, h hashed anew with its number; COPIES of them at a time are made in one place."""
    starts = copies.withColumn("start", F.explode(F.expr(f"sequence(0L, n - 1, {COPIES}L)")))
    parted = starts.repartition(F.col("h"), F.col("start"))
    each = parted.withColumn("k", F.explode(F.expr(f"sequence(start, least(start + {COPIES}L, n) - 1)")))
    return each.withColumn("h", F.xxhash64(F.lit(seed), "h", "k"))


def text_size(text: Column) -> Column:
    """UTF-8 bytes of a text (null: none) plus 1."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(1)


def text_crc32(text: Column) -> Column:
    """Unsigned CRC-32 of a text's UTF-8 bytes (null: of none)."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def op1_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents in 16 shards under the law of equal counts."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    sharded = shuffle_to_shards(documents, shared.folder(spark, "shards"), 16)
    return sharded.select(
        "doc_id",
        text_size(F.col("text")).alias("size"),
        text_crc32(F.col("text")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
