"""Missing values: how many, where, when, and what they cost."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesdq.functions import amount, any_null, full_name, is_missing, null_count, percent, rounded_ratio
from salesdq.functions.semantics import MONEY, PRICE
from salesdq.plans import lines_per_invoice, period_sales, report
from salesdq.plans.facts import LINE_FIELDS

FIX_COLUMNS = ("CustomerId", "FirstName", "LastName", "Company", "City", "Country", "State")


def _predictable(target: str, evidence: Sequence[str]) -> Column:
    return F.col(target).isNull() & ~any_null(evidence)


@report()
def null_profile_global(
    customers: DataFrame,
    *,
    key: str = "CustomerId",
    company: str = "Company",
    state: str = "State",
    evidence: Sequence[str] = ("City", "Country"),
    digits: int = 3,
) -> DataFrame:
    """One row: how many customers lack a company, lack a state, and of the latter
    how many could be derived because the ``evidence`` columns are present."""
    counts = customers.agg(
        F.count(key).alias("TotalCustomerCount"),
        F.count_if(F.col(company).isNull()).alias("MissingCompanyNumber"),
        F.count_if(F.col(state).isNull()).alias("UnknownStateNumber"),
        F.count_if(_predictable(state, evidence)).alias("PredictableStateNumber"),
    )

    def ratio(column: str) -> Column:
        return rounded_ratio(F.col(column), F.col("TotalCustomerCount"), digits)

    return counts.select(
        "TotalCustomerCount",
        "MissingCompanyNumber",
        ratio("MissingCompanyNumber").alias("MissingCompanyRatio"),
        "UnknownStateNumber",
        ratio("UnknownStateNumber").alias("UnknownStateRatio"),
        "PredictableStateNumber",
        ratio("PredictableStateNumber").alias("PredictableStateRatio"),
    )


def _missing_by_group(
    df: DataFrame, group: str, key: str, fields: Sequence[str], names: Sequence[str], digits: int
) -> DataFrame:
    """group, _n, one count per field, _score = share of NULL cells in the group."""
    counts = df.groupBy(group).agg(
        F.count(key).alias("_n"),
        *[F.count_if(F.col(f).isNull()).alias(n) for f, n in zip(fields, names, strict=True)],
    )
    missing = reduce(lambda a, b: a + b, (F.col(n) for n in names))
    return counts.withColumn("_score", rounded_ratio(missing, F.col("_n") * len(fields), digits))


@report("-MissingScore", "Country")
def null_profile_by_group(
    customers: DataFrame,
    *,
    group: str = "Country",
    key: str = "CustomerId",
    fields: Sequence[str] = ("Company", "State"),
    names: Sequence[str] = ("MissingCompanyName", "MissingCompanyState"),
    digits: int = 2,
) -> DataFrame:
    """Per ``group``: rows, NULLs in each field, and the share of NULL cells."""
    scored = _missing_by_group(customers, group, key, fields, names, digits)
    return scored.select(
        F.col(group).alias("Country"),
        F.col("_n").alias("TotalCustomer"),
        *names,
        F.col("_score").alias("MissingScore"),
    )


@report("-missingScore", "country")
def group_missing_risk(
    customers: DataFrame,
    *,
    group: str = "Country",
    key: str = "CustomerId",
    fields: Sequence[str] = ("Company", "State"),
    names: Sequence[str] = ("missingCompanyNumber", "missingStateNumber"),
    cuts: tuple[float, float] = (0.5, 0.2),
) -> DataFrame:
    """The profile by group with a risk label; the label looks at the rounded score."""
    high, medium = (F.lit(Decimal(str(c))) for c in cuts)
    scored = _missing_by_group(customers, group, key, fields, names, 2)
    return scored.select(
        F.col(group).alias("country"),
        F.col("_n").alias("totalCustomer"),
        *names,
        F.col("_score").alias("missingScore"),
        F.when(F.col("_score") >= high, "high")
        .when(F.col("_score") >= medium, "medium")
        .otherwise("low")
        .alias("riskLevel"),
    )


@report()
def fix_candidates(
    customers: DataFrame,
    *,
    target: str = "State",
    evidence: Sequence[str] = ("City", "Country"),
    columns: Sequence[str] = FIX_COLUMNS,
) -> DataFrame:
    """Rows whose missing ``target`` could be filled from the ``evidence`` columns."""
    return customers.filter(_predictable(target, evidence)).select(*columns)


@report()
def audit_unassigned(customers: DataFrame, *, column: str = "SupportRepId") -> DataFrame:
    """Customers nobody looks after: number and unrounded percentage."""
    counts = customers.agg(
        F.count_if(F.col(column).isNull()).alias("unassignedCustomerCount"),
        F.count(F.lit(1)).alias("_n"),
    )
    rate = F.col("unassignedCustomerCount") * F.lit(100.0) / F.nullif(F.col("_n"), F.lit(0))
    return counts.select("unassignedCustomerCount", rate.alias("unassignedCustomerRate"))


@report()
def audit_orphan_invoices(invoices: DataFrame, *, column: str = "CustomerId") -> DataFrame:
    """Invoices without a customer; an id of a customer that does not exist is not counted."""
    return invoices.filter(F.col(column).isNull()).agg(F.count(F.lit(1)).alias("orphanInvoiceCount"))


@report()
def audit_blank_composer(
    tracks: DataFrame, *, column: str = "Composer", blank_is_missing: bool = True
) -> DataFrame:
    """Tracks whose composer is NULL or blank: number and unrounded percentage."""
    counts = tracks.agg(
        F.count_if(is_missing(column, blank_is_missing)).alias("nullComposerTrackCount"),
        F.count(F.lit(1)).alias("_n"),
    )
    rate = F.col("nullComposerTrackCount") * F.lit(100.0) / F.nullif(F.col("_n"), F.lit(0))
    return counts.select("nullComposerTrackCount", rate.alias("nullComposerRate"))


@report()
def audit_null_genre(tracks: DataFrame, *, column: str = "GenreId") -> DataFrame:
    """Tracks without a genre."""
    return tracks.filter(F.col(column).isNull()).agg(F.count(F.lit(1)).alias("nullGenreTrackCount"))


@report()
def audit_broken_lines(
    lines: DataFrame, *, columns: Sequence[str] = ("UnitPrice", "Quantity")
) -> DataFrame:
    """Lines whose amount is unknown; a missing track does not break a line."""
    return lines.filter(any_null(columns)).agg(F.count(F.lit(1)).alias("brokenInvoiceLines"))


@report()
def audit_attribute_summary(
    tracks: DataFrame, *, composer: str = "Composer", genre: str = "GenreId"
) -> DataFrame:
    """Tracks lacking composer (NULL or blank) or genre: numbers and percentages."""
    counts = tracks.agg(
        F.sum(is_missing(composer, True).cast("long")).alias("missingComposer"),
        F.sum(is_missing(genre).cast("long")).alias("missingGenre"),
        F.count(F.lit(1)).alias("totalTracks"),
    )
    return counts.select(
        "missingComposer",
        "missingGenre",
        "totalTracks",
        percent(F.col("missingComposer"), F.col("totalTracks")).alias("percentMissingComposer"),
        percent(F.col("missingGenre"), F.col("totalTracks")).alias("percentMissingGenre"),
    )


@report()
def revenue_loss_estimate(lines: DataFrame, *, default_quantity: int = 1) -> DataFrame:
    """Revenue of the complete lines, and an estimate for the others that prices a
    missing quantity at ``default_quantity``; without a price nothing is estimated."""
    broken = any_null(("UnitPrice", "Quantity"))
    estimate = (F.col("UnitPrice").cast(PRICE) * F.coalesce(F.col("Quantity"), F.lit(default_quantity))).cast(MONEY)
    return lines.agg(
        F.sum(broken.cast("long")).alias("AffectedRows"),
        F.sum(F.when(broken, 0).otherwise(amount())).alias("ValidRevenue"),
        F.sum(F.when(broken, estimate).otherwise(0)).alias("LostRevenueEstimate"),
    )


@report("-NullAffectedLines", "CustomerId")
def repeat_null_customers(
    customers: DataFrame,
    invoices: DataFrame,
    lines: DataFrame,
    *,
    fields: Sequence[str] = LINE_FIELDS,
    min_lines: int = 1,
) -> DataFrame:
    """Customers with incomplete lines on their invoices, and how many."""
    per_invoice = (
        lines.filter(any_null(fields)).groupBy("InvoiceId").agg(F.count(F.lit(1)).alias("_n"))
    )
    per_customer = (
        invoices.select("InvoiceId", "CustomerId")
        .join(per_invoice, "InvoiceId")
        .groupBy("CustomerId")
        .agg(F.sum("_n").alias("NullAffectedLines"))
        .filter(F.col("NullAffectedLines") >= min_lines)
    )
    names = customers.select("CustomerId", full_name().alias("CustomerName"))
    return names.join(per_customer, "CustomerId")


@report("-InvoiceDate", "InvoiceId")
def null_or_zero_invoices(invoices: DataFrame, lines: DataFrame) -> DataFrame:
    """Invoices whose lines add up to nothing or to zero."""
    suspicious = lines_per_invoice(lines, ("UnitPrice", "Quantity")).filter(
        F.col("Revenue").isNull() | (F.col("Revenue") == 0)
    )
    return (
        invoices.select("InvoiceId", "InvoiceDate")
        .join(suspicious, "InvoiceId")
        .select(
            "InvoiceId",
            "InvoiceDate",
            F.col("Revenue").alias("InvoiceTotal"),
            F.col("Lines").alias("LineCount"),
            "NullLines",
        )
    )


@report()
def null_count_by_field(lines: DataFrame, *, fields: Sequence[str] = LINE_FIELDS) -> DataFrame:
    """One row per field with its number of NULLs, from a single scan."""
    counts = lines.agg(*[F.count_if(F.col(f).isNull()).alias(f) for f in fields])
    return counts.unpivot([], list(fields), "FieldName", "NullCount")


@report()
def null_rate_by_table(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Per named table the percentage of rows with a NULL in any of its listed keys."""

    def rate(name: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        counts = df.agg(F.count_if(any_null(keys)).alias("_nulls"), F.count(F.lit(1)).alias("_n"))
        return counts.select(
            F.lit(name).alias("TableName"), percent(F.col("_nulls"), F.col("_n")).alias("NullRate")
        )

    return reduce(
        DataFrame.unionByName, (rate(name, df, keys) for name, (df, keys) in tables.items())
    )


@report("-NullFieldCount", "InvoiceLineId", settle=True)
def null_cluster_rows(
    lines: DataFrame, *, fields: Sequence[str] = LINE_FIELDS, key: str = "InvoiceLineId"
) -> DataFrame:
    """Every line with a NULL, and how many of its fields are NULL."""
    return lines.filter(any_null(fields)).select(key, null_count(fields).alias("NullFieldCount"))


@report("InvoiceDay")
def null_trend_daily(
    invoices: DataFrame, lines: DataFrame, *, fields: Sequence[str] = LINE_FIELDS
) -> DataFrame:
    """Lines and incomplete lines per invoice day."""
    day = {"InvoiceDay": F.to_date("InvoiceDate")}
    return (
        period_sales(invoices, lines, day, fields=fields)
        .groupBy("InvoiceDay")
        .agg(F.sum("Lines").alias("TotalLines"), F.sum("NullLines").alias("NullLineCount"))
    )


@report()
def all_null_invoices(
    invoices: DataFrame, lines: DataFrame, *, fields: Sequence[str] = LINE_FIELDS
) -> DataFrame:
    """Invoices on which every line is incomplete."""
    hopeless = lines_per_invoice(lines, fields).filter(F.col("Lines") == F.col("NullLines"))
    return (
        invoices.select("InvoiceId")
        .join(hopeless, "InvoiceId")
        .select("InvoiceId", F.col("Lines").alias("TotalLines"), "NullLines")
    )
