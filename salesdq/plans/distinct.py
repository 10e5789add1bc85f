"""Distinct counts estimated from sketches that can be kept and merged.

An exact distinct count holds every value of a group. A theta sketch holds the 2^lg_nodes smallest hashes of them, whatever the number of
values; the sketch of a whole is the union of the sketches of its parts, in any order and with any overlap. Up to
2^lg_nodes values it counts exactly; beyond, its relative standard error is 1 / sqrt(2^lg_nodes - 1). (A HyperLogLog sketch is smaller, but
what it estimates depends on the order in which parts are merged.)
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LG_NODES = 12  # 4,096 hashes: 1.6 percent


def check_kind(count: str) -> None:
    if count not in ("exact", "sketch"):
        raise ValueError(f"count must be 'exact' or 'sketch', not {count!r}")


def standard_error(lg_nodes: int = LG_NODES) -> float:
    return (2**lg_nodes - 1) ** -0.5


def sketches(
    df: DataFrame, group: Sequence[str], columns: Mapping[str, str], lg_nodes: int = LG_NODES, also: Sequence[Column] = ()
) -> DataFrame:
    """``group`` and, under each name of ``columns``, a sketch of that column's values; NULL is none. ``also`` adds aggregates.

    Tasks sketch what they read and send one sketch per group, so a hot group is combined before the shuffle.
    """

    def value(column: str) -> Column:
        known = isinstance(df.schema[column].dataType, (T.IntegerType, T.LongType, T.StringType, T.BinaryType))
        return F.col(column) if known else F.col(column).cast("string")

    made = [F.theta_sketch_agg(value(column), lg_nodes).alias(name) for name, column in columns.items()]
    return df.groupBy(*group).agg(*made, *also)


def merged(parts: Sequence[DataFrame], group: Sequence[str], names: Sequence[str], lg_nodes: int = LG_NODES) -> DataFrame:
    """Sketches of the whole from those of its parts; a group may be in any number of them."""
    every = reduce(DataFrame.unionByName, [p.select(*group, *names) for p in parts])
    return every.groupBy(*group).agg(*[F.theta_union_agg(name, lg_nodes).alias(name) for name in names])


def estimates(sketched: DataFrame, names: Sequence[str], lg_nodes: int = LG_NODES) -> DataFrame:
    """The counts in place of the sketches.

    A sketch in the making may hold more hashes than it has to; a union with itself leaves the smallest, so the count depends on
    the values alone.
    """
    return sketched.withColumns({name: F.theta_sketch_estimate(F.theta_union(name, name, lg_nodes)) for name in names})
