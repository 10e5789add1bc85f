"""Revenue by artist, genre and track, and what cannot be attributed."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesdq.functions import amount, any_null, month_label, month_start, percent, rounded_ratio
from salesdq.plans import (
    album_artists,
    all_albums,
    artist_totals,
    join_many_to_one,
    line_sales,
    null_safe_lookup,
    report,
    running_total,
    sales_per_track,
    top_k,
    top_ties,
    totals_by_attributes,
)
from salesdq.plans.facts import LINE_FIELDS, roll_up
from salesdq.plans.joins import null_safe_lookup


def _dated_sales(
    invoices: DataFrame, lines: DataFrame, periods: dict[str, Column]
) -> DataFrame:
    """TrackId, the period columns, Revenue: one row per line on an invoice."""
    dated = invoices.select("InvoiceId", *[c.alias(n) for n, c in periods.items()])
    detail = lines.select("InvoiceId", "TrackId", amount().alias("Revenue"))
    return detail.join(dated, "InvoiceId").drop("InvoiceId")


def metadata_status(labels: Sequence[str]) -> Column:
    """Label by missing genre and album; ``labels`` for both, genre, album, none missing."""
    genre, album = F.col("GenreId").isNull(), F.col("AlbumId").isNull()
    return (
        F.when(genre & album, labels[0])
        .when(genre, labels[1])
        .when(album, labels[2])
        .otherwise(labels[3])
    )


@report("RevenueMonth", "ArtistId")
def monthly_top_artist(
    invoices: DataFrame,
    lines: DataFrame,
    tracks: DataFrame,
    albums: DataFrame,
    artists: DataFrame,
    *,
    k: int = 1,
) -> DataFrame:
    """The ``k`` artists with the highest revenue of each month, all of them on a tie."""
    sales = _dated_sales(invoices, lines, {"_month": month_start("InvoiceDate")})
    monthly = artist_totals(sales, tracks, albums, artists, by=["_month"])
    if k == 1:
        best = top_ties(monthly, ["_month"], "Revenue").withColumn("MonthlyRank", F.lit(1))
    else:
        best = top_k(monthly, ["_month"], [F.desc("Revenue")], k, "MonthlyRank", ties=True)
    return best.select(
        "ArtistId",
        "ArtistName",
        month_label("_month").alias("RevenueMonth"),
        F.col("Revenue").alias("MonthlyRevenue"),
        "MonthlyRank",
    )


@report("-RevenueSharePercentage", "GenreName", "ArtistName")
def genre_revenue_share(
    lines: DataFrame, tracks: DataFrame, genres: DataFrame, albums: DataFrame, artists: DataFrame
) -> DataFrame:
    """Each artist's share of the revenue of a genre. The genre's total includes
    tracks that lead to no artist, so shares need not add up to 100."""
    per_album = totals_by_attributes(
        line_sales(lines), tracks.select("TrackId", "GenreId", "AlbumId"), tracks
    )
    made = null_safe_lookup(
        per_album.filter(F.col("GenreId").isNotNull()), album_artists(albums, artists), "AlbumId", spread_by=["GenreId"]
    )
    per_artist = roll_up(made, ["GenreId", "ArtistId", "ArtistName"], ["Revenue"])
    # one row per genre and artist, and one for all tracks that lead to no artist
    whole = F.sum("Revenue").over(Window.partitionBy("GenreId"))
    per_artist = per_artist.withColumn("TotalGenreRevenue", whole).filter(F.col("ArtistId").isNotNull())
    shares = join_many_to_one(
        per_artist,
        genres.select("GenreId", F.col("Name").alias("GenreName")),
        "GenreId",
        bound=genres,
    )
    return shares.select(
        "ArtistName",
        "GenreName",
        F.col("Revenue").alias("ArtistRevenue"),
        "TotalGenreRevenue",
        percent(F.col("Revenue"), F.col("TotalGenreRevenue")).alias("RevenueSharePercentage"),
    )


@report("-RevenuePerTrack", "ArtistName")
def revenue_per_track(
    lines: DataFrame, tracks: DataFrame, albums: DataFrame, artists: DataFrame
) -> DataFrame:
    """Revenue per artist and per sold track; tracks that never sold do not count."""
    sold = sales_per_track(lines).select("TrackId", "Revenue", F.lit(1).alias("TrackCount"))
    totals = artist_totals(sold, tracks, albums, artists, sums=("TrackCount", "Revenue"))
    return totals.select(
        "ArtistName",
        "TrackCount",
        F.col("Revenue").alias("TotalRevenue"),
        rounded_ratio(F.col("Revenue"), F.col("TrackCount")).alias("RevenuePerTrack"),
    )


@report("ArtistName", "CumulativePercentage", "TrackName")
def catalog_pareto(
    lines: DataFrame,
    tracks: DataFrame,
    albums: DataFrame,
    artists: DataFrame,
    *,
    limit: float = 80,
    slice_rows: int | None = None,
) -> DataFrame:
    """The best-selling tracks of each artist while they add up to ``limit`` percent.

    Equal revenues go by TrackId. The rounded percentage decides, so an artist
    whose best track alone exceeds the limit has no row.
    """
    per_track = (
        tracks.select("TrackId", F.col("Name").alias("TrackName"), "AlbumId")
        .join(sales_per_track(lines).select("TrackId", "Revenue"), "TrackId")
        .join(album_artists(albums, artists), "AlbumId")
        .select("ArtistId", "ArtistName", "TrackId", "TrackName", F.col("Revenue").alias("TrackRevenue"))
    )
    summed = running_total(
        per_track,
        "ArtistId",
        [("TrackRevenue", True), ("TrackId", False)],
        "TrackRevenue",
        running="_cumulative",
        total="ArtistTotalRevenue",
        bound=tracks,
        slice_rows=slice_rows,
    )
    share = percent(F.col("_cumulative"), F.col("ArtistTotalRevenue"))
    return summed.select(
        "ArtistName", "TrackName", "TrackRevenue", "ArtistTotalRevenue", share.alias("CumulativePercentage")
    ).filter(F.col("CumulativePercentage") <= F.lit(Decimal(str(limit))))


@report(lambda: F.desc(F.col("Revenue_H2") - F.col("Revenue_H1")), "ArtistName")
def half_year_trend(
    invoices: DataFrame,
    lines: DataFrame,
    tracks: DataFrame,
    albums: DataFrame,
    artists: DataFrame,
    *,
    by_year: bool = False,
    key: str = "name",
) -> DataFrame:
    """Revenue of the first and second half of the year per artist, and its direction.

    All years are pooled unless ``by_year``. With key='name' artists of one name
    share a row that shows the larger of their revenues; key='id' keeps them apart.
    """
    if key not in ("name", "id"):
        raise ValueError(f"key must be 'name' or 'id', not {key!r}")
    half = F.when(F.month("InvoiceDate") <= 6, "H1").otherwise("H2")
    periods = {"_half": half} | ({"SalesYear": F.year("InvoiceDate")} if by_year else {})
    sales = _dated_sales(invoices, lines, periods)
    halves = artist_totals(sales, tracks, albums, artists, by=list(periods))
    keys = (["ArtistId"] if key == "id" else []) + ["ArtistName"] + (["SalesYear"] if by_year else [])

    def best(name: str) -> Column:
        return F.max(F.when(F.col("_half") == name, F.col("Revenue")).otherwise(0))

    pivoted = halves.groupBy(*keys).agg(best("H1").alias("Revenue_H1"), best("H2").alias("Revenue_H2"))
    return pivoted.withColumn(
        "Trend",
        F.when(F.col("Revenue_H2") > F.col("Revenue_H1"), "Increased")
        .when(F.col("Revenue_H2") < F.col("Revenue_H1"), "Decreased")
        .otherwise("No Change"),
    )


@report()
def incomplete_lines(
    lines: DataFrame, tracks: DataFrame, *, fields: Sequence[str] = LINE_FIELDS
) -> DataFrame:
    """Lines with a NULL in ``fields``, with the track's name and the first gap found."""
    names = tracks.select("TrackId", F.col("Name").alias("TrackName"))
    broken = lines.filter(any_null(fields))
    impact = (
        F.when(F.col("TrackId").isNull(), "Missing Track")
        .when(F.col("UnitPrice").isNull(), "Missing Price")
        .when(F.col("Quantity").isNull(), "Missing Quantity")
        .otherwise("OK")
    )
    return null_safe_lookup(broken, names, "TrackId", spread_by=["InvoiceId", "InvoiceLineId"]).select(
        "InvoiceLineId",
        "InvoiceId",
        "TrackId",
        "TrackName",
        "UnitPrice",
        "Quantity",
        impact.alias("RevenueImpactType"),
    )


@report()
def revenue_by_metadata_status(
    lines: DataFrame,
    tracks: DataFrame,
    *,
    labels: Sequence[str] = ("Missing Genre & Album", "Missing Genre", "Missing Album", "Complete"),
) -> DataFrame:
    """Revenue of known tracks by what their metadata lacks."""
    status = tracks.select("TrackId", metadata_status(labels).alias("MetadataStatus"))
    totals = totals_by_attributes(line_sales(lines), status, tracks)
    return totals.withColumnRenamed("Revenue", "TotalRevenue")


@report("-Revenue")
def revenue_attribution(
    lines: DataFrame,
    tracks: DataFrame,
    albums: DataFrame,
    artists: DataFrame,
    *,
    labels: Sequence[str] = ("Missing Album", "Missing Artist", "Complete"),
) -> DataFrame:
    """All revenue by whether it leads to an album and an artist; unknown tracks
    count as missing an album."""
    per_album = roll_up(
        sales_per_track(lines).join(tracks.select("TrackId", "AlbumId"), "TrackId", "left"),
        ["AlbumId"],
        ["Revenue"],
    )
    known = all_albums(albums, artists).withColumn("_album", F.lit(True))
    status = (
        F.when(F.col("_album").isNull(), labels[0])
        .when(F.col("KnownArtist").isNull(), labels[1])
        .otherwise(labels[2])
    )
    return (
        per_album.join(known, "AlbumId", "left")
        .groupBy(status.alias("AttributionStatus"))
        .agg(F.sum("Revenue").alias("Revenue"))
    )
