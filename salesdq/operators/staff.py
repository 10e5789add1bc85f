"""Support representatives: their customers, workload, revenue and best genres."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesdq.functions import amount, full_name, month_label, month_start, percent, rounded_ratio
from salesdq.functions.semantics import MONEY
from salesdq.plans import artist_totals, broadcast_if_small, report, top_k, totals_by_attributes
from salesdq.plans.facts import roll_up

TITLE = "Sales Support Agent"


def _reps(employees: DataFrame, title: str) -> DataFrame:
    """EmployeeId, FirstName, LastName of those with ``title`` in any letter case."""
    return employees.filter(F.lower("Title") == title.lower()).select(
        "EmployeeId", "FirstName", "LastName"
    )


def _customer_invoices(customers: DataFrame, invoices: DataFrame, how: str) -> DataFrame:
    """CustomerId, SupportRepId, Spent, Invoices: one row per customer."""
    spent = invoices.groupBy("CustomerId").agg(
        F.sum(F.col("Total").cast(MONEY)).alias("Spent"), F.count("InvoiceId").alias("Invoices")
    )
    return customers.select("CustomerId", "SupportRepId").join(spent, "CustomerId", how)


def _with_rep(per_rep: DataFrame, reps: DataFrame, how: str = "inner") -> DataFrame:
    return reps.join(per_rep, F.col("EmployeeId") == F.col("SupportRepId"), how)


@report()
def rep_customer_segments(
    customers: DataFrame,
    invoices: DataFrame,
    employees: DataFrame,
    *,
    title: str = TITLE,
    cuts: tuple[int, int] = (20, 50),
) -> DataFrame:
    """Customers of each representative by spending: above, within and below ``cuts``.

    Customers who never bought are low value. Representatives are told apart by
    name only, so namesakes are added up.
    """
    low, high = cuts
    segment = (
        F.when(F.col("Spent") > high, "high").when(F.col("Spent").between(low, high), "mid").otherwise("low")
    )
    per_rep = (
        _customer_invoices(customers, invoices, "left")
        .withColumn("_segment", segment)
        .groupBy("SupportRepId")
        .agg(
            *[
                F.count_if(F.col("_segment") == name).alias(f"{name}ValueCount")
                for name in ("high", "mid", "low")
            ],
            F.count("CustomerId").alias("totalCustomers"),
        )
    )
    sums = ("highValueCount", "midValueCount", "lowValueCount", "totalCustomers")
    return (
        _with_rep(per_rep, _reps(employees, title))
        .groupBy(full_name().alias("employeeName"))
        .agg(*[F.sum(c).alias(c) for c in sums])
    )


@report("employeeName", "invoiceMonth")
def rep_monthly_load(
    employees: DataFrame, customers: DataFrame, invoices: DataFrame, *, title: str = TITLE
) -> DataFrame:
    """Invoices and revenue per representative and month; those without any keep a
    row with no month."""
    monthly = invoices.groupBy("CustomerId", month_start("InvoiceDate").alias("_month")).agg(
        F.count("InvoiceId").alias("_n"), F.sum(F.col("Total").cast(MONEY)).alias("_total")
    )
    per_rep = (
        customers.select("CustomerId", "SupportRepId")
        .join(monthly, "CustomerId", "left")
        .groupBy("SupportRepId", "_month")
        .agg(F.sum("_n").alias("_n"), F.sum("_total").alias("_total"))
    )
    return (
        _with_rep(per_rep, _reps(employees, title), "left")
        .groupBy("FirstName", "LastName", "_month")
        .agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("invoiceCount"),
            F.sum("_total").alias("totalRevenue"),
        )
        .select(
            full_name().alias("employeeName"),
            month_label("_month").alias("invoiceMonth"),
            "invoiceCount",
            "totalRevenue",
        )
    )


@report()
def rep_customer_ltv(
    customers: DataFrame, invoices: DataFrame, employees: DataFrame, *, title: str = TITLE
) -> DataFrame:
    """Buying customers per representative, their revenue and the average of it."""
    per_rep = (
        _customer_invoices(customers, invoices, "inner")
        .groupBy("SupportRepId")
        .agg(
            F.count("CustomerId").alias("_customers"),
            F.count("Spent").alias("_spenders"),
            F.sum("Spent").alias("_spent"),
        )
    )
    return (
        _with_rep(per_rep, _reps(employees, title))
        .groupBy("FirstName", "LastName")
        .agg(
            F.sum("_customers").alias("totalCustomers"),
            F.sum("_spenders").alias("_spenders"),
            F.sum("_spent").alias("totalRevenue"),
        )
        .select(
            full_name().alias("employeeName"),
            "totalCustomers",
            "totalRevenue",
            rounded_ratio(F.col("totalRevenue"), F.col("_spenders"), 6).alias("avgCustomerLTV"),
        )
    )


def _rep_sales(
    employees: DataFrame, customers: DataFrame, invoices: DataFrame, lines: DataFrame, title: str
) -> DataFrame:
    """EmployeeId, TrackId, Revenue: the lines sold by representatives with ``title``.

    Representatives narrow customers, and those invoices, before the lines are
    touched.
    """
    reps = _reps(employees, title).select("EmployeeId")
    clients = customers.select("CustomerId", F.col("SupportRepId").alias("EmployeeId")).join(
        reps, "EmployeeId"
    )
    placed = invoices.select("InvoiceId", "CustomerId")
    served = placed.join(clients, "CustomerId").select("InvoiceId", "EmployeeId")
    detail = lines.select("InvoiceId", "TrackId", amount().alias("Revenue"))
    return detail.join(broadcast_if_small(served, placed), "InvoiceId").drop("InvoiceId")


@report("employeeName", "-revenue", "artistName")
def rep_artist_revenue(
    employees: DataFrame,
    customers: DataFrame,
    invoices: DataFrame,
    lines: DataFrame,
    tracks: DataFrame,
    albums: DataFrame,
    artists: DataFrame,
    *,
    title: str = TITLE,
) -> DataFrame:
    """Revenue per representative and artist name; namesake representatives stay apart."""
    sales = _rep_sales(employees, customers, invoices, lines, title)
    per_id = artist_totals(sales, tracks, albums, artists, by=["EmployeeId"])
    per_artist = roll_up(per_id, ["EmployeeId", "ArtistName"], ["Revenue"])
    return per_artist.join(_reps(employees, title), "EmployeeId").select(
        full_name().alias("employeeName"),
        F.col("ArtistName").alias("artistName"),
        F.col("Revenue").alias("revenue"),
    )


@report()
def rep_repeat_rate(
    customers: DataFrame,
    invoices: DataFrame,
    employees: DataFrame,
    *,
    title: str = TITLE,
    min_purchases: int = 2,
) -> DataFrame:
    """Share of each representative's buying customers with ``min_purchases`` invoices."""
    per_rep = (
        _customer_invoices(customers, invoices, "inner")
        .groupBy("SupportRepId")
        .agg(
            F.count_if(F.col("Invoices") >= min_purchases).alias("_repeat"),
            F.count(F.lit(1)).alias("_all"),
        )
    )
    return (
        _with_rep(per_rep, _reps(employees, title))
        .groupBy("FirstName", "LastName")
        .agg(F.sum("_repeat").alias("repeatCustomerCount"), F.sum("_all").alias("totalCustomers"))
        .select(
            full_name().alias("employeeName"),
            "repeatCustomerCount",
            "totalCustomers",
            percent(F.col("repeatCustomerCount"), F.col("totalCustomers"))
            .cast("decimal(5,2)")
            .alias("repeatCustomerRate"),
        )
    )


@report()
def rep_top_genre(
    employees: DataFrame,
    customers: DataFrame,
    invoices: DataFrame,
    lines: DataFrame,
    tracks: DataFrame,
    genres: DataFrame,
    *,
    title: str = TITLE,
    k: int = 1,
) -> DataFrame:
    """The genre sold most often by each representative, in lines; ties go by name. With ``k`` above 1 the best ``k``, and their Rank."""
    sales = _rep_sales(employees, customers, invoices, lines, title)
    sold = sales.select("EmployeeId", "TrackId", F.lit(1).alias("SoldLines"))
    per_genre = totals_by_attributes(
        sold, tracks.select("TrackId", "GenreId"), tracks, by=["EmployeeId"], sums=["SoldLines"]
    )
    named = roll_up(
        per_genre.join(genres.select("GenreId", F.col("Name").alias("topGenreName")), "GenreId"),
        ["EmployeeId", "topGenreName"],
        ["SoldLines"],
    )
    best = top_k(
        named, ["EmployeeId"], [F.desc("SoldLines"), F.asc("topGenreName")], k, "_rank", ties=False
    )
    return best.join(_reps(employees, title), "EmployeeId").select(
        full_name().alias("employeeName"),
        "topGenreName",
        F.col("SoldLines").alias("genrePurchaseCount"),
        *([F.col("_rank").alias("Rank")] if k > 1 else []),
    )
