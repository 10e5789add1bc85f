"""Sales lines brought to the level of a report.

Every report that meets the line table starts here. Where the other table fits a
broadcast, lines are joined as they are scanned and aggregated once. Beyond that
size they are reduced to one row per key before the join: this combines a hot key
inside each map task and leaves few rows per key to the join. Where the key is all
that is grouped by, the join needs no further shuffle; with more columns (a month
beside the track) the sums are exchanged once more. Money is DECIMAL, so the order
of summation cannot matter.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesdq.functions import amount, any_null
from salesdq.plans.joins import fits_broadcast, null_safe_lookup

LINE_FIELDS = ("TrackId", "UnitPrice", "Quantity")


def roll_up(df: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Sum already aggregated columns over coarser keys."""
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def line_sales(lines: DataFrame) -> DataFrame:
    """TrackId, Revenue of every line."""
    return lines.select("TrackId", amount().alias("Revenue"))


def sales_per_track(lines: DataFrame) -> DataFrame:
    """TrackId, Revenue, SoldLines; lines without a track form the NULL row."""
    return lines.groupBy("TrackId").agg(
        F.sum(amount()).alias("Revenue"), F.count(F.lit(1)).alias("SoldLines")
    )


def lines_per_invoice(lines: DataFrame, fields: Sequence[str] = LINE_FIELDS) -> DataFrame:
    """InvoiceId, Revenue, Lines, NullLines (lines with a NULL in ``fields``)."""
    return lines.groupBy("InvoiceId").agg(
        F.sum(amount()).alias("Revenue"),
        F.count(F.lit(1)).alias("Lines"),
        F.count_if(any_null(fields)).alias("NullLines"),
    )


def period_sales(
    invoices: DataFrame,
    lines: DataFrame,
    periods: Mapping[str, Column],
    *,
    fields: Sequence[str] = LINE_FIELDS,
    per_invoice: bool = False,
) -> DataFrame:
    """The ``periods`` of invoice dates, Revenue, Lines and NullLines of lines on invoices.

    One row per invoice that has lines; one row per line where the invoice table
    fits a broadcast and ``per_invoice`` does not insist. Sums come out the same.
    """
    dated = invoices.select("InvoiceId", *[c.alias(name) for name, c in periods.items()])
    if per_invoice or not fits_broadcast(dated):
        return lines_per_invoice(lines, fields).join(dated, "InvoiceId").drop("InvoiceId")
    detail = lines.select(
        "InvoiceId",
        amount().alias("Revenue"),
        F.lit(1).alias("Lines"),
        any_null(fields).cast("long").alias("NullLines"),
    )
    return detail.join(dated, "InvoiceId").drop("InvoiceId")  # small by its own estimate: Spark broadcasts it


def album_artists(albums: DataFrame, artists: DataFrame) -> DataFrame:
    """AlbumId, ArtistId, ArtistName of the albums whose artist is known."""
    named = artists.select("ArtistId", F.col("Name").alias("ArtistName"))
    return albums.select("AlbumId", "ArtistId").join(named, "ArtistId")


def all_albums(albums: DataFrame, artists: DataFrame) -> DataFrame:
    """AlbumId, KnownArtist of every album; KnownArtist is NULL if there is no such artist."""
    known = artists.select("ArtistId", F.col("ArtistId").alias("KnownArtist"))
    traced = null_safe_lookup(
        albums.select("AlbumId", "ArtistId"), known, "ArtistId", spread_by=["AlbumId"]
    )
    return traced.select("AlbumId", "KnownArtist")


def totals_by_attributes(
    sales: DataFrame,
    attributes: DataFrame,
    tracks: DataFrame,
    *,
    by: Sequence[str] = (),
    sums: Sequence[str] = ("Revenue",),
) -> DataFrame:
    """Sums of ``sales``, any number of rows per TrackId, by ``by`` and the columns
    that ``attributes``, a projection or an inner join of ``tracks``, adds to TrackId.
    Sales without a known track drop out."""
    keys = [*by, *[c for c in attributes.columns if c != "TrackId"]]
    if fits_broadcast(tracks):
        traced = sales.join(F.broadcast(attributes), "TrackId")
    else:
        traced = roll_up(sales, ["TrackId", *by], sums).join(attributes, "TrackId")
    return roll_up(traced, keys, sums)


def artist_totals(
    sales: DataFrame,
    tracks: DataFrame,
    albums: DataFrame,
    artists: DataFrame,
    *,
    by: Sequence[str] = (),
    sums: Sequence[str] = ("Revenue",),
) -> DataFrame:
    """Sums of ``sales``, any number of rows per TrackId, by ArtistId, ArtistName and ``by``.

    With a small track table each row finds its artist at once. Otherwise sales
    are summed up again at each step of track, album and artist, so no join sees
    more than one row per key and value of ``by``.
    """
    made_by = album_artists(albums, artists)
    made_on = tracks.select("TrackId", "AlbumId")
    if fits_broadcast(tracks):
        path = made_on.join(made_by, "AlbumId").drop("AlbumId")
        return totals_by_attributes(sales, path, tracks, by=by, sums=sums)
    per_album = totals_by_attributes(sales, made_on, tracks, by=by, sums=sums)
    return roll_up(per_album.join(made_by, "AlbumId"), ["ArtistId", "ArtistName", *by], sums)
