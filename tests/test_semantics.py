"""The arithmetic, NULL and calendar rules the reports rest on."""

import datetime as dt
from decimal import ROUND_HALF_UP
from decimal import Decimal as D
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salesdq.functions import (
    any_null,
    calendar_week,
    full_name,
    is_missing,
    month_label,
    month_start,
    null_count,
    percent,
    rounded_ratio,
    weekday_name,
    weighted_stddev_pop,
)


def _exact(a, b, digits):
    if a is None or not b:
        return None
    value = Fraction(a) / Fraction(b)
    units = (abs(value) * 10**digits * 2 + 1) // 2
    return (D(int(units)) * (1 if value >= 0 else -1)).scaleb(-digits)


def test_rounded_ratio_rounds_once_and_half_away_from_zero(spark):
    rows = [
        (D("78.374999999999"), D("100.00")),
        (D("1.00"), D("8.00")),
        (D("-1.00"), D("8.00")),
        (D("1.00"), D("-8.00")),
        (D("0.00"), D("3.00")),
        (D("5.00"), D("0.00")),
        (None, D("3.00")),
        (D("3.00"), None),
        (D("12345678901234567890123.45"), D("7.00")),
    ]
    df = spark.createDataFrame(rows, "a decimal(38,12), b decimal(18,2)")
    for digits in (0, 2, 3):
        got = [r[0] for r in df.select(rounded_ratio(F.col("a"), F.col("b"), digits)).collect()]
        assert got == [_exact(a, b, digits) for a, b in rows]


@settings(max_examples=20, deadline=None)
@given(
    st.lists(
        st.tuples(st.integers(-(10**15), 10**15), st.integers(-(10**12), 10**12)), min_size=20, max_size=60
    )
)
def test_rounded_ratio_of_whole_numbers_is_exact(spark, pairs):
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    got = [r[0] for r in df.select(rounded_ratio(F.col("a"), F.col("b"), 6)).collect()]
    assert got == [_exact(a, b, 6) for a, b in pairs]


def test_percent_of_sums_beyond_53_bits(spark):
    df = spark.createDataFrame(
        [(D("33333333333333333333.33"), D("99999999999999999999.99"))], "a decimal(38,2), b decimal(38,2)"
    )
    assert df.select(percent(F.col("a"), F.col("b"))).first()[0] == D("33.33")


def test_weighted_deviation_equals_the_fan_out(spark):
    values = [(200000, 3), (200001, 1), (None, 4), (500000, 2)]
    df = spark.createDataFrame(values, "x int, w int")
    x, w = F.col("x").cast("decimal(18,0)"), F.when(F.col("x").isNotNull(), F.col("w"))
    fan_out = df.select(F.explode(F.array_repeat("x", F.col("w"))).alias("x"))
    want = fan_out.agg(F.stddev_pop("x")).first()[0]
    got = df.agg(weighted_stddev_pop(F.sum(w), F.sum(w * x), F.sum(w * x * x))).first()[0]
    assert got == pytest.approx(want, rel=1e-12)


def test_weighted_deviation_does_not_cancel(spark):
    big = 10**9
    df = spark.createDataFrame([(big, 10**6), (big + 1, 10**6)], "x bigint, w bigint")
    x, w = F.col("x").cast("decimal(18,0)"), F.col("w")
    got = df.agg(weighted_stddev_pop(F.sum(w), F.sum(w * x), F.sum(w * x * x))).first()[0]
    assert got == 0.5


def test_weighted_deviation_survives_more_than_38_digits(spark):
    rows = [(D(10) ** 14, D(10) ** 22, D(10) ** 31)]
    df = spark.createDataFrame(rows, "w decimal(38,0), s decimal(38,0), q decimal(38,0)")
    got = df.select(weighted_stddev_pop(F.col("w"), F.col("s"), F.col("q"))).first()[0]
    assert got == pytest.approx((10**17 - 10**16) ** 0.5, rel=1e-9)


def test_weighted_deviation_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None, None)], "x int, w int")
    got = df.agg(weighted_stddev_pop(F.sum("w"), F.sum("x"), F.sum("x"))).first()[0]
    assert got is None


def test_names_and_missing_values(spark):
    df = spark.createDataFrame(
        [("A", "B"), ("A", None), (None, "B"), ("A", ""), ("A", "  ")], "FirstName string, LastName string"
    )
    got = df.select(
        full_name(), is_missing("LastName"), is_missing("LastName", True),
        any_null(["FirstName", "LastName"]), null_count(["FirstName", "LastName"]),
    ).collect()
    assert [tuple(r) for r in got] == [
        ("A B", False, False, False, 0),
        (None, True, True, True, 1),
        (None, False, False, True, 1),
        ("A ", False, True, False, 0),
        ("A   ", False, True, False, 0),
    ]


def _week(day: dt.date, begins: int) -> int:
    """Week 1 holds 1 January; a new week begins on every such weekday after it."""
    first = dt.date(day.year, 1, 1)
    days = (first + dt.timedelta(n) for n in range(1, (day - first).days + 1))
    return 1 + sum(d.weekday() == begins for d in days)


def test_calendar(spark):
    days = [dt.date(1994, 1, 1) + dt.timedelta(n) for n in range(0, 3650, 3)]
    days += [dt.date(y, m, d) for y in range(1994, 2004) for m, d in ((1, 1), (12, 31), (6, 30), (7, 1))]
    df = spark.createDataFrame([(dt.datetime.combine(d, dt.time(23, 59)),) for d in days], "t timestamp_ntz")
    got = df.select("t", calendar_week("t"), calendar_week("t", 2), weekday_name("t"), month_start("t").alias("m"))
    got = got.withColumn("label", month_label("m")).collect()
    for t, week, from_monday, weekday, month, label in got:
        assert week == _week(t.date(), 6), t
        assert from_monday == _week(t.date(), 0), t
        assert weekday == t.strftime("%A")
        assert month == t.date().replace(day=1)
        assert label == t.strftime("%Y-%m")


def test_half_up_helper_agrees_with_decimal():
    assert _exact(D("0.125"), D(1), 2) == D("0.125").quantize(D("0.01"), ROUND_HALF_UP)
