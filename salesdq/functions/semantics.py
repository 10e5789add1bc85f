"""Column expressions that pin down the arithmetic and NULL rules of the reports.

Everything here is a plain Column built from Spark's own functions, so it is
compiled into the surrounding stage and never leaves the JVM.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Declared types of money: prices as stored, and amounts whose sums are DECIMAL(38,2) however often they are summed up.
PRICE, MONEY = "decimal(18,2)", "decimal(28,2)"


def amount(price: str = "UnitPrice", quantity: str = "Quantity") -> Column:
    """Line amount; NULL as soon as one factor is NULL. Prices of any numeric type count as PRICE."""
    return (F.col(price).cast(PRICE) * F.col(quantity)).cast(MONEY)


def rounded_ratio(num: Column, den: Column, digits: int = 2) -> Column:
    """``num / den`` rounded half away from zero to ``digits``, NULL on a zero ``den``.

    Both operands are whole numbers or decimals. Decimal division in Spark keeps
    six fractional digits of wide operands, so ``round(a / b, 2)`` would round
    twice. Here the remainder is taken off first, and what is left divides evenly.
    """
    scale = 10**digits
    twice = F.abs(num) * F.lit(Decimal(2 * scale)) + F.abs(den)
    divisor = F.nullif(F.abs(den), F.lit(0)) * F.lit(Decimal(2))
    units = ((twice - twice % divisor) / divisor).cast("decimal(38,0)")
    signed = F.when((num < 0) != (den < 0), -units).otherwise(units)
    return (signed * F.lit(Decimal(1).scaleb(-digits))).cast(f"decimal(38,{digits})")


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part`` as a percentage of ``whole``."""
    return rounded_ratio(part * F.lit(100), whole, digits)


def weighted_stddev_pop(weight: Column, total: Column, squares: Column) -> Column:
    """Population standard deviation from sum(w), sum(w*x) and sum(w*x*x) of integers.

    The variance numerator is taken in exact decimal arithmetic, where nothing
    cancels; only a product beyond 38 digits falls back to doubles.
    """
    wide = "decimal(38,0)"
    w, s1, s2 = weight.cast(wide), total.cast(wide), squares.cast(wide)
    exact = F.try_subtract(F.try_multiply(w, s2), F.try_multiply(s1, s1)).cast("double")
    wd = weight.cast("double")
    approx = wd * squares.cast("double") - F.pow(total.cast("double"), F.lit(2.0))
    numerator = F.greatest(F.coalesce(exact, approx), F.lit(0.0))
    return F.sqrt(numerator) / F.nullif(wd, F.lit(0.0))


def whole_units(column: str, kind: T.DataType, digits: int | None = None) -> tuple[Column, int]:
    """``column`` as a whole number of its smallest units, DECIMAL(18,0), and how many digits that shifts it.

    Whole numbers shift by none, a DECIMAL by its own scale. A binary fraction has no smallest unit; ``digits`` names
    one, to which it is rounded half away from zero.
    """
    if isinstance(kind, T.IntegralType):
        return F.col(column).cast("decimal(18,0)"), 0
    if isinstance(kind, T.DecimalType):
        if kind.precision > 18:
            raise ValueError(f"{column} has more than 18 digits")
        return (F.col(column).cast(kind) * F.lit(10**kind.scale)).cast("decimal(18,0)"), kind.scale
    if isinstance(kind, T.FractionalType) and digits is not None:
        return (F.col(column).cast(f"decimal(18,{digits})") * F.lit(10**digits)).cast("decimal(18,0)"), digits
    raise ValueError(f"{column} is {kind.simpleString()}: name the digits it is to be rounded to")


def full_name(first: str = "FirstName", last: str = "LastName") -> Column:
    """First and last name joined by a blank; NULL if either is NULL."""
    return F.concat(F.col(first), F.lit(" "), F.col(last))


def is_missing(column: str, blank_is_missing: bool = False) -> Column:
    """True for NULL and, on request, for a string of nothing but blanks."""
    missing = F.col(column).isNull()
    if blank_is_missing:
        # coalesce keeps the predicate two-valued, so it can be negated and summed
        missing = missing | F.coalesce(F.trim(F.col(column)) == "", F.lit(False))
    return missing


def any_null(columns: list[str] | tuple[str, ...]) -> Column:
    """True if at least one of ``columns`` is NULL."""
    return reduce(lambda a, b: a | b, (F.col(c).isNull() for c in columns))


def null_count(columns: list[str] | tuple[str, ...]) -> Column:
    """How many of ``columns`` are NULL in the row."""
    return reduce(lambda a, b: a + b, (F.col(c).isNull().cast("int") for c in columns))


def month_start(ts: str) -> Column:
    """First day of the month, as DATE: a four-byte grouping key."""
    return F.trunc(F.to_date(F.col(ts)), "MM")


def month_label(month: str) -> Column:
    """'yyyy-MM' of a date, applied after grouping rather than per input row."""
    return F.date_format(F.col(month), "yyyy-MM")


def weekday_name(ts: str) -> Column:
    """Full English weekday name."""
    return F.date_format(F.col(ts), "EEEE")


def calendar_week(ts: str, first_day: int = 1) -> Column:
    """Week of the year, where weeks begin on ``first_day`` (1 is Sunday, 7 Saturday)
    and week 1 holds 1 January.

    This is not the ISO week of ``weekofyear``: every year restarts at 1, so it
    pairs with the calendar year.
    """
    day = F.to_date(F.col(ts))
    lead_in = F.pmod(F.dayofweek(F.trunc(day, "YEAR")) - F.lit(first_day), F.lit(7))
    return (F.floor((F.dayofyear(day) - F.lit(1) + lead_in) / F.lit(7)) + F.lit(1)).cast("int")
