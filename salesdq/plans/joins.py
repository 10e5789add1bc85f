"""Joins and shuffles that stay balanced when one key, or NULL, holds much of the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Estimates count compressed file bytes; a broadcast side is held uncompressed.
COMPRESSION = 4
# Estimated bytes of input for each partition of ``dealt_by_size``; the most partitions, as a multiple of the session's shuffle partitions.
DEALT_BYTES, MOST_DEALT = 512 * 1024, 32
# An estimate from here on stands for a size that Catalyst does not know.
UNKNOWN_BYTES = 1 << 60


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df``; plans the query but runs nothing."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(df: DataFrame) -> int:
    raw = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40, "p": 1 << 50}
    text = raw.strip().lower().removesuffix("b")
    if text and text[-1] in units:
        return int(text[:-1]) * units[text[-1]]
    return int(text)


def fits_broadcast(df: DataFrame) -> bool:
    """Whether ``df`` is well within the session's limit for broadcasting a join side."""
    limit = broadcast_limit(df)
    return limit > 0 and estimated_bytes(df) * COMPRESSION <= limit


def broadcast_if_small(one: DataFrame, bound: DataFrame) -> DataFrame:
    """``one``, marked for broadcast if ``bound``, which has at least as many rows, fits."""
    return F.broadcast(one) if fits_broadcast(bound) else one


def join_many_to_one(many: DataFrame, one: DataFrame, key: str, *, bound: DataFrame) -> DataFrame:
    """Inner join of ``many`` rows per ``key`` to a side with one row (or a few).

    ``bound`` is a scan that has at least as many rows as ``one``. Where it fits
    the session's broadcast limit with headroom, ``one`` is broadcast: its own
    estimate is no guide, because Catalyst multiplies sizes across the joins that
    built it.

    Otherwise both sides are shuffled and a hot key is left to the adaptive skew
    split. ``one`` comes out of an aggregation on the same key, so Spark would
    not exchange it again, and without an exchange on both sides the split does
    not apply: a second join column, always 0, brings it about.
    """
    if fits_broadcast(bound):
        return many.join(F.broadcast(one), key)
    zero = F.pmod(F.xxhash64(key), F.lit(1))
    return many.withColumn("_slot", zero).join(one.withColumn("_slot", zero), [key, "_slot"]).drop("_slot")


def null_safe_lookup(
    many: DataFrame, one: DataFrame, key: str, *, spread_by: list[str | Column]
) -> DataFrame:
    """Left join on a key that may be NULL in ``many``.

    A NULL key matches nothing, yet all such rows would hash to one task. A
    second join column deals them out over more slots than there are shuffle partitions; it is 0 for every key that can match. On
    the other side the 0 is computed from the key: a literal would be folded into
    a filter, and the rows partitioned by the key alone again. The second column
    also makes Spark exchange both sides, which the adaptive skew split needs to
    divide a hot key.
    """
    slots = max(1024, 16 * int(many.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    slot = F.when(
        F.col(key).isNull(), F.pmod(F.xxhash64(*spread_by), F.lit(slots))
    ).otherwise(F.lit(0).cast("long"))
    zero = F.pmod(F.xxhash64(key), F.lit(1))
    return (
        many.withColumn("_slot", slot)
        .join(one.withColumn("_slot", zero), [key, "_slot"], "left")
        .drop("_slot")
    )


def dealt_by_size(df: DataFrame, *keys: str | Column, bound: DataFrame) -> DataFrame:
    """``df`` by ``keys`` over a number of partitions that grows with ``bound``, an input of about as many rows.

    Shuffle partitions of a number that Spark chooses are laid together up to the advisory size, in compressed bytes, or
    until every core has one. That can be millions of rows, all of them in the hash table of one task where keys hardly recur. These
    partitions stay as they are, so what a task holds does not grow with the input.
    """
    session = df.sparkSession
    size, shuffled = estimated_bytes(bound), int(session.conf.get("spark.sql.shuffle.partitions"))
    wanted = shuffled if size >= UNKNOWN_BYTES else max(session.sparkContext.defaultParallelism, -(-size // DEALT_BYTES))
    return df.repartition(min(wanted, MOST_DEALT * shuffled), *keys)
