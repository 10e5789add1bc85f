"""Best rows per group and running totals, without one task per group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesdq.plans.joins import estimated_bytes

# Up to so many rows, by the size of the table that bounds them, a running total is one window per group.
SLICE_ROWS = 500_000
# A range of a larger table holds this many rows of the sample that cuts it, or more.
RANGE_SAMPLE = 32


def top_k(df: DataFrame, group: list[str], order: list[Column], k: int, rank: str, *, ties: bool) -> DataFrame:
    """The first ``k`` rows per group, numbered in column ``rank``.

    With ``ties`` equal rows share a rank. The filter on the rank lets Spark
    keep only each task's own leaders before it shuffles by group.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    position = F.rank() if ties else F.row_number()
    return df.withColumn(rank, position.over(window)).filter(F.col(rank) <= k)


def top_ties(df: DataFrame, group: list[str], measure: str) -> DataFrame:
    """All rows that reach their group's highest ``measure``.

    Equal to ``rank() = 1``, NULL measures and NULL groups included, but a maximum
    is combined before the shuffle and the join back goes by (group, measure), so
    a group of any size, or with any number of ties, is spread over tasks that the
    adaptive skew split can divide.
    """
    keys = [*group, measure]
    best = df.groupBy(*[F.col(c).alias(f"_best_{c}") for c in group]).agg(
        F.max(measure).alias(f"_best_{measure}")
    )
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_best_{c}")) for c in keys))
    return df.join(best, same, "left_semi")


def _sort_parts(df: DataFrame, column: str, descending: bool) -> list[Column]:
    """Columns that sort ascending as ``column`` sorts in the given direction.

    A wide decimal is unpacked anew in each of the many comparisons of a sort, so
    it is split into its whole part and its fraction, two plain integers.
    """
    value, kind = F.col(column), df.schema[column].dataType
    if isinstance(kind, T.DecimalType):
        numbers = [value.cast("bigint"), (value % 1 * 10**kind.scale).cast("bigint")]
    else:
        numbers = [value]
    if not descending:
        return numbers
    return [value.isNull(), *[-n for n in numbers]]


def running_total(
    df: DataFrame,
    group: str,
    order: list[tuple[str, bool]],
    value: str,
    *,
    running: str,
    total: str,
    slice_rows: int | None = None,
    bound: DataFrame | None = None,
) -> DataFrame:
    """Add the running and the overall sum of ``value`` per group.

    ``order`` lists (column, descending) and must end in a column that makes it
    unique; descending columns are numeric, and NULL sorts lowest. ``group`` is
    not NULL. ``bound`` is a scan of at least as many rows. If it, or else ``df``
    by its own estimate, cannot have more than ``slice_rows`` (SLICE_ROWS) rows, a
    window per group does. Otherwise the sums go over ranges of (group, position),
    however few or many groups there are:

    1. Of each slice_rows / RANGE_SAMPLE rows one, chosen by hash, is a sample.
       Evenly spaced rows of the sorted sample cut the rows into ranges, at most
       one for each shuffle partition. They only place the cuts; every row stays in the result.
    2. Sums per range and group, a row for each range that a group reaches
       into, are added up to what lies before it.
    3. That row joins the range's own rows as their first, and a window per
       group and range runs from there. Each range is one task.

    The cuts are an array that the plan computes for itself, as long as there
    are partitions. They depend on the rows alone, so both passes over the rows, and a
    recomputed task, cut the same way.
    """
    # 2 bytes or more for each row as stored
    if estimated_bytes(df if bound is None else bound) // 2 <= (slice_rows or SLICE_ROWS):
        return _windowed_total(df, group, order, value, running, total)
    return _ranged_total(df, group, order, value, running, total, slice_rows or SLICE_ROWS)


def _windowed_total(
    df: DataFrame, group: str, order: list[tuple[str, bool]], value: str, running: str, total: str
) -> DataFrame:
    by_group = Window.partitionBy(group)
    up_to = by_group.orderBy(*[F.desc(c) if descending else F.asc(c) for c, descending in order])
    up_to = up_to.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({running: F.sum(value).over(up_to), total: F.sum(value).over(by_group)})


def _range_cuts(placed: DataFrame, order: list[tuple[str, bool]], every: int, ranges: int) -> Column:
    """Positions that cut the rows into at most ``ranges`` about equal parts, as one sorted array."""
    chosen = F.pmod(F.xxhash64(*[c for c, _ in order]), F.lit(every)) == 0
    # rows / every of them, 32 bytes or so each
    sample = placed.filter(chosen).select("_position")
    numbered = sample.select(
        "_position",
        F.row_number().over(Window.orderBy("_position")).alias("_n"),
        F.count(F.lit(1)).over(Window.partitionBy()).alias("_all"),
    )
    step = F.greatest(F.lit(1), F.ceil(F.col("_all") / F.lit(ranges)))
    spaced = numbered.filter(F.pmod("_n", step) == 0)
    return spaced.agg(F.sort_array(F.collect_list("_position")).alias("cuts")).scalar()


def _numbered_ranges(placed: DataFrame, cuts: Column, ranges: int) -> DataFrame:
    """Column _range: how many of the cuts are at or before _position, by binary search."""
    found = placed.withColumns({"_cuts": cuts, "_range": F.lit(0)})
    step = 1 << ranges.bit_length()
    while step:
        cut = F.get("_cuts", F.col("_range") + F.lit(step - 1))  # NULL behind the last
        found = found.withColumn("_range", F.col("_range") + F.when(cut <= F.col("_position"), F.lit(step)).otherwise(F.lit(0)))
        step //= 2
    return found.drop("_cuts")


def _ranged_total(
    df: DataFrame, group: str, order: list[tuple[str, bool]], value: str, running: str, total: str, slice_rows: int
) -> DataFrame:
    parts = [F.col(group), *[part for column, descending in order for part in _sort_parts(df, column, descending)]]
    placed = df.withColumn("_position", F.struct(*[p.alias(f"p{i}") for i, p in enumerate(parts)]))
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = _range_cuts(placed, order, max(1, slice_rows // RANGE_SAMPLE), ranges)
    ranged = _numbered_ranges(placed, cuts, ranges)

    by_group = Window.partitionBy(group)  # a row for each range
    before = by_group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy(group, "_range").agg(F.sum(value).alias("_sum"))
    starts = sums.select(
        group,
        "_range",
        F.lit(False).alias("_is_row"),
        F.sum("_sum").over(before).alias("_add"),
        F.sum("_sum").over(by_group).alias("_total"),
    )
    rows = ranged.withColumns({"_is_row": F.lit(True), "_add": F.col(value)})
    both = rows.unionByName(starts, allowMissingColumns=True).repartitionById(ranges + 1, "_range")
    up_to = Window.partitionBy("_range", group).orderBy("_is_row", "_position")
    up_to = up_to.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        both.withColumns({running: F.sum("_add").over(up_to), total: F.first("_total").over(up_to)})
        .filter("_is_row")
        .select(*df.columns, running, total)
    )
