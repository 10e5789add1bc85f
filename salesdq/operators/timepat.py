"""Sales over time: hours, weekdays, months, weeks and customers' pauses.

Lines are summed per period through their invoices, and only these bounded series
(24 hours, 31 days, 54 weeks, the months on record) meet a window.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesdq.functions import (
    calendar_week,
    month_label,
    month_start,
    percent,
    rounded_ratio,
    weekday_name,
)
from salesdq.plans import period_sales, report, top_k

# fixed values: first and last hour of each named part of the day
DAY_PARTS = ((6, 11, "morning"), (12, 17, "afternoon"), (18, 22, "evening"))


def _by_period(
    invoices: DataFrame, lines: DataFrame, periods: dict[str, Column], count: str = "lines"
) -> DataFrame:
    """The periods, _volume (sales lines, or the invoices they are on) and _revenue."""
    if count not in ("lines", "invoices"):
        raise ValueError(f"count must be 'lines' or 'invoices', not {count!r}")
    by_invoice = count == "invoices"
    volume = F.count(F.lit(1)) if by_invoice else F.sum("Lines")
    return (
        period_sales(invoices, lines, periods, per_invoice=by_invoice)
        .groupBy(*periods)
        .agg(volume.alias("_volume"), F.sum("Revenue").alias("_revenue"))
    )


def _monthly(invoices: DataFrame, lines: DataFrame) -> DataFrame:
    monthly = _by_period(invoices, lines, {"_month": month_start("InvoiceDate")})
    return monthly.select("_month", F.col("_revenue").alias("Revenue"))


@report("HourOfDay")
def hourly_sales(invoices: DataFrame, lines: DataFrame, *, count: str = "lines") -> DataFrame:
    """Sales by hour of the day. InvoiceCount counts lines unless count='invoices'."""
    hourly = _by_period(invoices, lines, {"HourOfDay": F.hour("InvoiceDate")}, count)
    return hourly.select(
        "HourOfDay", F.col("_volume").alias("InvoiceCount"), F.round("_revenue", 2).alias("Revenue")
    )


@report("-InvoiceCount", "DayOfWeek")
def weekday_sales(invoices: DataFrame, lines: DataFrame, *, count: str = "lines") -> DataFrame:
    """Sales by weekday. InvoiceCount counts lines unless count='invoices'."""
    daily = _by_period(invoices, lines, {"DayOfWeek": weekday_name("InvoiceDate")}, count)
    return daily.select(
        "DayOfWeek", F.col("_volume").alias("InvoiceCount"), F.col("_revenue").alias("TotalRevenue")
    )


@report("RevenueMonth")
def rolling_3month(invoices: DataFrame, lines: DataFrame, *, rows: int = 3) -> DataFrame:
    """Monthly revenue and its average over the last ``rows`` months that had sales."""
    recent = Window.orderBy("_month").rowsBetween(1 - rows, Window.currentRow)
    average = rounded_ratio(F.sum("Revenue").over(recent), F.count("Revenue").over(recent), 6)
    return _monthly(invoices, lines).select(
        month_label("_month").alias("RevenueMonth"), "Revenue", average.alias("Rolling3MonthAvg")
    )


@report("RevenueMonth")
def revenue_drop(invoices: DataFrame, lines: DataFrame, *, ratio: float = 0.7) -> DataFrame:
    """Months that earned less than ``ratio`` of the previous month on record."""
    lagged = _monthly(invoices, lines).withColumn(
        "PrevMonthRevenue", F.lag("Revenue").over(Window.orderBy("_month"))
    )
    previous = F.col("PrevMonthRevenue")
    return lagged.filter(
        previous.isNotNull() & (F.col("Revenue") < F.lit(Decimal(str(ratio))) * previous)
    ).select(
        month_label("_month").alias("RevenueMonth"),
        "Revenue",
        "PrevMonthRevenue",
        percent(F.col("Revenue") - previous, previous).alias("RevenueChangePct"),
    )


@report("InvoiceDay", "HourOfDay")
def peak_hour_share(invoices: DataFrame, lines: DataFrame, *, k: int = 1) -> DataFrame:
    """The best hour of each day, all of them on a tie, and its share of the day. With ``k`` above 1 the best ``k``, and their Rank."""
    periods = {"InvoiceDay": F.to_date("InvoiceDate"), "HourOfDay": F.hour("InvoiceDate")}
    hourly = (
        _by_period(invoices, lines, periods)
        .withColumnRenamed("_revenue", "HourlyTotal")
        .withColumn("DailyTotal", F.sum("HourlyTotal").over(Window.partitionBy("InvoiceDay")))
    )
    best = top_k(hourly, ["InvoiceDay"], [F.desc("HourlyTotal")], k, "_rank", ties=True)
    return best.select(
        "InvoiceDay",
        "HourOfDay",
        "HourlyTotal",
        "DailyTotal",
        percent(F.col("HourlyTotal"), F.col("DailyTotal")).alias("PeakHourPercentage"),
        *([F.col("_rank").alias("Rank")] if k > 1 else []),
    )


@report()
def weekend_split(
    invoices: DataFrame, lines: DataFrame, *, weekend: Sequence[str] = ("Saturday", "Sunday")
) -> DataFrame:
    """Invoices and revenue on weekends and on weekdays."""
    kind = F.when(weekday_name("InvoiceDate").isin(*weekend), "Weekend").otherwise("Weekday")
    split = _by_period(invoices, lines, {"DayType": kind}, "invoices")
    return split.select(
        "DayType", F.col("_volume").alias("InvoiceCount"), F.round("_revenue", 2).alias("TotalRevenue")
    )


@report("-DaysInactive", "CustomerId", "InvoiceDate")
def inactivity_gaps(invoices: DataFrame, *, min_days: int = 60) -> DataFrame:
    """Pauses of at least ``min_days`` (calendar days) between a customer's invoices.

    Only the first invoice of a day can end a pause, and only the last one of a
    day can begin it. Invoices are reduced to these two per customer and day, so
    the window holds at most one row per day on record, however busy a customer.
    """
    if min_days < 1:
        raise ValueError("a pause lasts at least one day")
    day = F.to_date("InvoiceDate").alias("_day")
    daily = invoices.groupBy("CustomerId", day).agg(
        F.min("InvoiceDate").alias("InvoiceDate"), F.max("InvoiceDate").alias("_last")
    )
    previous = F.lag("_last").over(Window.partitionBy("CustomerId").orderBy("_day"))
    gaps = daily.select("CustomerId", "InvoiceDate", previous.alias("PrevInvoice")).withColumn(
        "DaysInactive", F.datediff("InvoiceDate", "PrevInvoice")
    )
    return gaps.filter(F.col("DaysInactive") >= min_days)


@report("-TotalRevenue", "TimeWindow")
def time_of_day_revenue(
    invoices: DataFrame,
    lines: DataFrame,
    *,
    bands: Sequence[tuple[int, int, str]] = DAY_PARTS,
    otherwise: str = "night",
    count: str = "lines",
) -> DataFrame:
    """Sales by part of the day. InvoiceCount counts lines unless count='invoices'."""
    hour = F.hour("InvoiceDate")
    part = F
    for first, last, name in bands:
        part = part.when(hour.between(first, last), name)
    parts = _by_period(invoices, lines, {"TimeWindow": part.otherwise(otherwise)}, count)
    return parts.select(
        "TimeWindow", F.col("_volume").alias("InvoiceCount"), F.round("_revenue", 2).alias("TotalRevenue")
    )


@report("-MaxDaysAfterFirst", "CustomerId")
def first_purchase_activity(invoices: DataFrame) -> DataFrame:
    """First purchase of each customer, number of purchases, and how many days after
    the first the last and the nearest one lie (the nearest is the first itself)."""
    first = F.col("FirstPurchaseDate")
    spans = (
        invoices.filter(F.col("CustomerId").isNotNull())
        .groupBy("CustomerId")
        .agg(
            F.min("InvoiceDate").alias("FirstPurchaseDate"),
            F.max("InvoiceDate").alias("_last"),
            F.count(F.lit(1)).alias("TotalPurchases"),
        )
    )
    return spans.select(
        "CustomerId",
        "FirstPurchaseDate",
        "TotalPurchases",
        F.datediff("_last", first).alias("MaxDaysAfterFirst"),
        F.datediff(first, first).alias("MinDaysAfterFirst"),
    )


@report("-VolatilityIndexPct", "RevenueMonth")
def volatility_index(invoices: DataFrame, lines: DataFrame) -> DataFrame:
    """Spread of daily revenue per month; the index uses the rounded mean and deviation."""
    daily = _by_period(invoices, lines, {"_day": F.to_date("InvoiceDate")})
    monthly = daily.groupBy(F.trunc("_day", "MM").alias("_month")).agg(
        F.count(F.lit(1)).alias("ActiveDays"),
        rounded_ratio(F.sum("_revenue"), F.count("_revenue")).alias("AvgDailyRevenue"),
        F.round(F.stddev_pop("_revenue").cast("decimal(30,8)"), 2).alias("StdDevRevenue"),
    )
    return monthly.select(
        month_label("_month").alias("RevenueMonth"),
        "ActiveDays",
        "AvgDailyRevenue",
        "StdDevRevenue",
        percent(F.col("StdDevRevenue"), F.col("AvgDailyRevenue")).alias("VolatilityIndexPct"),
    )


@report("SalesYear", "WeekNumber")
def weekly_cumulative(invoices: DataFrame, lines: DataFrame, *, first_day: int = 1) -> DataFrame:
    """Revenue by calendar year and week, and its running sum; weeks begin on
    ``first_day`` (1 is Sunday) and are cut at the turn of the year."""
    week = calendar_week("InvoiceDate", first_day)
    periods = {"SalesYear": F.year("InvoiceDate"), "WeekNumber": week}
    weekly = _by_period(invoices, lines, periods).select(
        *periods, F.col("_revenue").alias("WeeklyTotal")
    )
    so_far = (
        Window.partitionBy("SalesYear")
        .orderBy("WeekNumber")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return weekly.withColumn("CumulativeRevenue", F.sum("WeeklyTotal").over(so_far))
