"""Composer coverage, and filling gaps with the most frequent value of the group."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesdq.functions import percent
from salesdq.plans import (
    album_artists,
    join_many_to_one,
    line_sales,
    null_safe_lookup,
    report,
    top_ties,
    totals_by_attributes,
)
from salesdq.sources import sink

TRACK_COLUMNS = ("TrackId", "Name", "FinalComposer", "AlbumId", "GenreId", "Milliseconds", "UnitPrice")


def group_modes(tracks: DataFrame, group: str, target: str, ties: str) -> DataFrame:
    """group, _mode: the most frequent non-NULL ``target`` of each group.

    With ties='all' a group has one row per value that shares the lead, with
    ties='first' only the smallest of them.
    """
    if ties not in ("all", "first"):
        raise ValueError(f"ties must be 'all' or 'first', not {ties!r}")
    counts = (
        tracks.filter(F.col(target).isNotNull() & F.col(group).isNotNull())
        .groupBy(group, target)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    leaders = top_ties(counts, [group], "_n").select(group, F.col(target).alias("_mode"))
    if ties == "first":
        leaders = leaders.groupBy(group).agg(F.min("_mode").alias("_mode"))
    return leaders


@report()
def impute_candidates(
    tracks: DataFrame, *, group: str = "AlbumId", target: str = "Composer", ties: str = "first"
) -> DataFrame:
    """A suggestion for each track without ``target`` whose group has one; of tied values the smallest.

    With ties='all' tied values each give a suggestion: tracks times values, which only a group known to be small
    can bear.
    """
    gaps = tracks.filter(F.col(target).isNull()).select("TrackId", "Name", group)
    modes = group_modes(tracks, group, target, ties)
    suggested = join_many_to_one(gaps, modes, group, bound=tracks)
    return suggested.select(
        "TrackId", F.col("Name").alias("TrackName"), F.col("_mode").alias("SuggestedComposer")
    )


@report("-MissingComposerCount", "ArtistName")
def missing_in_category(
    tracks: DataFrame,
    albums: DataFrame,
    artists: DataFrame,
    genres: DataFrame,
    *,
    category: str = "Classical",
    target: str = "Composer",
) -> DataFrame:
    """Tracks of one genre without ``target``, counted by artist name."""
    wanted = genres.filter(F.col("Name") == category).select("GenreId")
    per_album = (
        tracks.filter(F.col(target).isNull())
        .select("GenreId", "AlbumId")
        .join(wanted, "GenreId")
        .groupBy("AlbumId")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return (
        per_album.join(album_artists(albums, artists), "AlbumId")
        .groupBy("ArtistName")
        .agg(F.sum("_n").alias("MissingComposerCount"))
    )


@report()
def dq_snapshot(
    tracks: DataFrame, *, target: str = "Composer", snapshot_date: datetime.date | None = None
) -> DataFrame:
    """One dated row on the completeness of ``target``; today unless a date is given."""
    day: Column = F.current_date() if snapshot_date is None else F.lit(snapshot_date)
    counts = tracks.agg(
        F.count(F.lit(1)).alias("TotalTracks"),
        F.sum(F.col(target).isNull().cast("long")).alias("MissingComposer"),
    )
    return counts.select(
        day.alias("SnapshotDate"),
        "TotalTracks",
        "MissingComposer",
        percent(F.col("MissingComposer"), F.col("TotalTracks")).alias("MissingPercentage"),
    )


@report()
def impute_enriched_view(
    tracks: DataFrame,
    *,
    group: str = "AlbumId",
    target: str = "Composer",
    ties: str = "first",
    keep: Sequence[str] = TRACK_COLUMNS,
) -> DataFrame:
    """All tracks with ``target`` filled from the group's most frequent value.

    One row per track; of tied values the smallest fills. With ties='all' every
    track of a group appears once per tied value, the tracks that had a value
    included: tracks times values, which only a group known to be small can bear.
    """
    modes = group_modes(tracks, group, target, ties)
    filled = null_safe_lookup(tracks, modes, group, spread_by=["TrackId"])
    return filled.withColumn("FinalComposer", F.coalesce(F.col(target), F.col("_mode"))).select(*keep)


def impute_load(
    tracks: DataFrame,
    destination: str,
    *,
    group: str = "AlbumId",
    target: str = "Composer",
    ties: str = "first",
) -> DataFrame:
    """Write the enriched tracks to ``destination`` and return what was stored.

    The load replaces the destination, so repeating it does not double the rows.
    """
    enriched = impute_enriched_view(tracks, group=group, target=target, ties=ties)
    return sink.load(enriched, destination)


@report()
def revenue_by_presence(
    lines: DataFrame,
    tracks: DataFrame,
    *,
    target: str = "Composer",
    labels: tuple[str, str] = ("Missing Composer", "Has Composer"),
) -> DataFrame:
    """Revenue of tracks with and without ``target``."""
    status = F.when(F.col(target).isNull(), labels[0]).otherwise(labels[1])
    presence = tracks.select("TrackId", status.alias("ComposerStatus"))
    return totals_by_attributes(line_sales(lines), presence, tracks)


@report("-DistinctComposerCount", "AlbumId")
def attribute_consistency(
    albums: DataFrame,
    tracks: DataFrame,
    artists: DataFrame,
    *,
    target: str = "Composer",
    labels: tuple[str, str, str] = ("Highly Consistent", "Moderately Consistent", "Low Consistency"),
) -> DataFrame:
    """Distinct composers per album, for albums that have any."""
    distinct = (
        tracks.filter(F.col(target).isNotNull())
        .groupBy("AlbumId")
        .agg(F.count_distinct(target).alias("DistinctComposerCount"))
    )
    titles = albums.select("AlbumId", F.col("Title").alias("AlbumTitle"), "ArtistId")
    names = artists.select("ArtistId", F.col("Name").alias("ArtistName"))
    n = F.col("DistinctComposerCount")
    return (
        titles.join(distinct, "AlbumId")
        .join(names, "ArtistId")
        .select(
            "AlbumId",
            "AlbumTitle",
            "ArtistName",
            "DistinctComposerCount",
            F.when(n == 1, labels[0]).when(n == 2, labels[1]).otherwise(labels[2]).alias("ConsistencyLevel"),
        )
    )


@report("LengthCategory")
def missing_by_length_band(
    tracks: DataFrame,
    *,
    target: str = "Composer",
    length: str = "Milliseconds",
    cuts: tuple[int, int] = (120000, 300000),
) -> DataFrame:
    """Missing ``target`` by track length; an unknown length counts as long."""
    short, medium = cuts
    band = (
        F.when(F.col(length) < short, "Short")
        .when(F.col(length).between(short, medium), "Medium")
        .otherwise("Long")
    )
    counts = tracks.groupBy(band.alias("LengthCategory")).agg(
        F.count(F.lit(1)).alias("TotalTracks"),
        F.count_if(F.col(target).isNull()).alias("MissingComposerCount"),
    )
    return counts.withColumn(
        "MissingPercentage", percent(F.col("MissingComposerCount"), F.col("TotalTracks"))
    )
