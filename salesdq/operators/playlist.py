"""Collections of products: revenue, variety, scores and gaps per playlist.

A playlist entry joined to the sales of its track fans out to one row per sale.
No report builds that product: sales are summed per track first, and the counts
of the fan-out are carried as weights. The playlist table holds one row per
PlaylistId; entries are (PlaylistId, TrackId) pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesdq.functions import any_null, percent, rounded_ratio, weighted_stddev_pop, whole_units
from salesdq.operators.revenue import metadata_status
from salesdq.plans import (
    album_artists,
    all_albums,
    dealt_by_size,
    distinct,
    join_many_to_one,
    null_safe_lookup,
    report,
    sales_per_track,
    top_k,
)
from salesdq.plans.facts import roll_up

# In so many places the tracks of one artist in one playlist are summed up first, so that many of them are shared out.
SLOTS = 64


def _track_sales(tracks: DataFrame, lines: DataFrame, *columns: str) -> DataFrame:
    """TrackId, ``columns``, Revenue, SoldLines; both NULL for unsold tracks."""
    return tracks.select("TrackId", *columns).join(sales_per_track(lines), "TrackId", "left")


def _entries(
    entries: DataFrame, per_track: DataFrame, tracks: DataFrame, *, pairs_unique: bool | None = None
) -> DataFrame:
    """Entries with the facts of their track.

    Given ``pairs_unique``, each pair appears once, with its number in _copies; if
    it is False the entries are grouped, if True they are trusted to hold no pair
    twice, which saves the shuffle.
    """
    pairs = entries.select("PlaylistId", "TrackId")
    if pairs_unique:
        pairs = pairs.withColumn("_copies", F.lit(1))
    elif pairs_unique is False:
        pairs = pairs.groupBy("PlaylistId", "TrackId").agg(F.count(F.lit(1)).alias("_copies"))
    return join_many_to_one(pairs, per_track, "TrackId", bound=tracks)


def _named(per_playlist: DataFrame, playlists: DataFrame) -> DataFrame:
    names = playlists.select("PlaylistId", F.col("Name").alias("PlaylistName"))
    return names.join(per_playlist, "PlaylistId")


def _times_sold() -> Column:
    """Rows an entry contributes to the fan-out: its sales, or 1 if it has none."""
    return F.coalesce(F.col("SoldLines"), F.lit(1))


def _weight(weight: str) -> Column:
    if weight == "sales":
        return _times_sold()
    if weight == "track":
        return F.lit(1)
    raise ValueError(f"weight must be 'sales' or 'track', not {weight!r}")


def _moments(weight: Column, length: Column) -> list[Column]:
    """Weight, weighted sum and weighted square sum of the known track lengths, given in whole units."""
    w = F.when(length.isNotNull(), weight)
    return [F.sum(w).alias("_w"), F.sum(w * length).alias("_wx"), F.sum(w * length * length).alias("_wxx")]


def _lengths(tracks: DataFrame, digits: int | None) -> tuple[Column, Column]:
    """Track length in whole units, and the factor that turns a spread of them into the column's own unit."""
    units, shift = whole_units("Milliseconds", tracks.schema["Milliseconds"].dataType, digits)
    return units, F.lit(10.0**shift)


@report("-TotalPlaylistRevenue", "PlaylistId")
def playlist_revenue(
    playlists: DataFrame,
    entries: DataFrame,
    tracks: DataFrame,
    lines: DataFrame,
    *,
    weight: str = "sales",
) -> DataFrame:
    """Revenue of the tracks of each playlist. TrackCount counts an entry once per
    sale (once if unsold); weight='track' counts entries."""
    facts = _entries(entries, _track_sales(tracks, lines), tracks)
    totals = facts.groupBy("PlaylistId").agg(
        F.sum(_weight(weight)).alias("TrackCount"), F.sum("Revenue").alias("TotalPlaylistRevenue")
    )
    return _named(totals, playlists).select(
        "PlaylistId", "PlaylistName", "TrackCount", "TotalPlaylistRevenue"
    )


@report("-GenreVariety", "PlaylistId")
def playlist_genre_variety(
    playlists: DataFrame, entries: DataFrame, tracks: DataFrame, *, count: str = "exact", lg_nodes: int = distinct.LG_NODES
) -> DataFrame:
    """Different genres per playlist; tracks without a genre add none.

    count='sketch' estimates the number (``plans.distinct``).
    """
    distinct.check_kind(count)
    if count == "sketch":
        sketched = playlist_genre_sketches(entries, tracks, lg_nodes=lg_nodes)
        return playlist_variety_of(playlists, sketched, lg_nodes=lg_nodes, ordered=False)
    facts = _entries(entries, tracks.select("TrackId", "GenreId"), tracks)
    variety = facts.groupBy("PlaylistId").agg(F.count_distinct("GenreId").alias("GenreVariety"))
    return _named(variety, playlists)


def playlist_genre_sketches(entries: DataFrame, tracks: DataFrame, *, lg_nodes: int = distinct.LG_NODES) -> DataFrame:
    """PlaylistId and GenreVariety, a sketch of the genres met.

    A result to be kept: ``plans.distinct.merged`` joins it with the sketches of later entries, without
    reading the earlier ones again.
    """
    facts = _entries(entries, tracks.select("TrackId", "GenreId"), tracks)
    return distinct.sketches(facts, ["PlaylistId"], {"GenreVariety": "GenreId"}, lg_nodes)


@report("-GenreVariety", "PlaylistId")
def playlist_variety_of(
    playlists: DataFrame, genre_sketches: DataFrame, *, lg_nodes: int = distinct.LG_NODES
) -> DataFrame:
    """The variety report from kept sketches."""
    return _named(distinct.estimates(genre_sketches, ["GenreVariety"], lg_nodes), playlists)


@report("-QualityScore", "PlaylistId")
def playlist_quality_score(
    playlists: DataFrame,
    entries: DataFrame,
    tracks: DataFrame,
    lines: DataFrame,
    *,
    weights: tuple[float, float, float, float] = (0.4, 0.3, 0.2, 0.1),
    weight: str = "sales",
    pairs_unique: bool = False,
    length_digits: int | None = None,
) -> DataFrame:
    """Score from size, genre variety, revenue (in tens) and spread of track length
    (in minutes). DurationVariance is a standard deviation, rounded before scoring,
    in which a track weighs as often as it sold unless weight='track'.

    ``pairs_unique`` saves a shuffle where the entries are known to hold no pair twice. Lengths are taken with all
    digits of a DECIMAL; binary fractions only with ``length_digits``, the digits they are rounded to.
    """
    length, unit = _lengths(tracks, length_digits)
    per_track = _track_sales(tracks, lines, "GenreId", "Milliseconds")
    facts = _entries(entries, per_track, tracks, pairs_unique=pairs_unique)
    copies = F.col("_copies")
    per_genre = facts.groupBy("PlaylistId", "GenreId").agg(
        F.count(F.lit(1)).alias("_tracks"),
        F.sum(copies * F.col("Revenue")).alias("_revenue"),
        *_moments(copies * _weight(weight), length),
    )
    base = per_genre.groupBy("PlaylistId").agg(
        F.sum("_tracks").alias("TrackCount"),
        F.count("GenreId").alias("GenreDiversity"),
        *[F.sum(c).alias(c) for c in ("_revenue", "_w", "_wx", "_wxx")],
    )
    spread = weighted_stddev_pop(F.col("_w"), F.col("_wx"), F.col("_wxx")) / unit
    size, genres, revenue, deviation = (F.lit(w) for w in weights)
    scored = (
        _named(base, playlists)
        .withColumn("DurationVariance", _round2(F.coalesce(spread, F.lit(0.0))))
        .withColumn("TotalRevenue", F.coalesce(F.col("_revenue"), F.lit(0)))
    )
    score = (
        F.col("TrackCount") * size
        + F.col("GenreDiversity") * genres
        + F.col("TotalRevenue").cast("double") / F.lit(10.0) * revenue
        - F.col("DurationVariance").cast("double") / F.lit(60000.0) * deviation
    )
    return scored.select(
        "PlaylistId",
        "PlaylistName",
        "TrackCount",
        "GenreDiversity",
        "DurationVariance",
        "TotalRevenue",
        _round2(score).alias("QualityScore"),
    )


def _round2(value: Column) -> Column:
    """Two digits, half away from zero, after dropping the noise of binary fractions."""
    return F.round(value.cast("decimal(30,8)"), 2)


def _gaps(tracks: DataFrame, albums: DataFrame, artists: DataFrame) -> DataFrame:
    """Tracks that lack a genre, an album or an artist."""
    traced = null_safe_lookup(
        tracks.select("TrackId", "Name", "GenreId", "AlbumId"),
        all_albums(albums, artists),
        "AlbumId",
        spread_by=["TrackId"],
    )
    return traced.filter(any_null(("GenreId", "AlbumId", "KnownArtist")))


@report("-ProblematicTrackCount", "PlaylistId")
def playlist_problem_tracks(
    playlists: DataFrame,
    entries: DataFrame,
    tracks: DataFrame,
    albums: DataFrame,
    artists: DataFrame,
) -> DataFrame:
    """Entries per playlist whose track lacks a genre, an album or an artist."""
    problems = _entries(entries, _gaps(tracks, albums, artists).select("TrackId"), tracks)
    counts = problems.groupBy("PlaylistId").agg(F.count(F.lit(1)).alias("ProblematicTrackCount"))
    return _named(counts, playlists)


@report("PlaylistName", "PlaylistId")
def playlist_dominant_genre(
    playlists: DataFrame, entries: DataFrame, tracks: DataFrame, genres: DataFrame, *, k: int = 1
) -> DataFrame:
    """The most frequent genre of each playlist; ties go by genre name. With ``k`` above 1 the best ``k``, and their Rank."""
    facts = _entries(entries, tracks.select("TrackId", "GenreId"), tracks)
    per_id = facts.groupBy("PlaylistId", "GenreId").agg(F.count(F.lit(1)).alias("GenreTrackCount"))
    per_name = roll_up(
        per_id.join(genres.select("GenreId", F.col("Name").alias("DominantGenre")), "GenreId"),
        ["PlaylistId", "DominantGenre"],
        ["GenreTrackCount"],
    )
    best = top_k(
        per_name, ["PlaylistId"], [F.desc("GenreTrackCount"), F.asc("DominantGenre")], k, "_rank", ties=False
    )
    ranks = [F.col("_rank").alias("Rank")] if k > 1 else []
    return _named(best, playlists).select("PlaylistId", "PlaylistName", "DominantGenre", "GenreTrackCount", *ranks)


def _varieties(facts: DataFrame, entries: DataFrame, moments: list[Column]) -> DataFrame:
    """GenreDiversity, ArtistDiversity and the sums of ``moments`` per playlist.

    Genres and artists hardly recur within a playlist, so hash tables over both hold about as many rows as a task reads: they are
    made in partitions whose number grows with the entries. A playlist's tracks of one artist are first summed up in SLOTS places. Each
    artist is then counted in the group of one of its genres, which leaves a row per playlist and genre.
    """
    sums = ("_w", "_wx", "_wxx")
    pair, slot = ["PlaylistId", "ArtistId", "GenreId"], F.pmod(F.xxhash64("TrackId"), F.lit(SLOTS)).alias("_slot")
    spread = dealt_by_size(facts.select("*", slot), *pair, "_slot", bound=entries).groupBy(*pair, "_slot").agg(*moments)
    per_pair = roll_up(dealt_by_size(spread, "PlaylistId", "ArtistId", bound=entries), pair, sums)
    place = F.row_number().over(Window.partitionBy("PlaylistId", "ArtistId").orderBy("GenreId"))
    counted = per_pair.withColumn("_artists", (F.col("ArtistId").isNotNull() & (place == 1)).cast("long"))
    per_genre = roll_up(counted, ["PlaylistId", "GenreId"], ["_artists", *sums])
    return per_genre.groupBy("PlaylistId").agg(
        F.count("GenreId").alias("GenreDiversity"),
        F.sum("_artists").alias("ArtistDiversity"),
        *[F.sum(c).alias(c) for c in sums],
    )


@report("-BalanceScore", "PlaylistId")
def playlist_balance_score(
    playlists: DataFrame,
    entries: DataFrame,
    tracks: DataFrame,
    albums: DataFrame,
    artists: DataFrame,
    *,
    weights: tuple[float, float, float] = (0.4, 0.4, 0.2),
    count: str = "exact",
    lg_nodes: int = distinct.LG_NODES,
    length_digits: int | None = None,
) -> DataFrame:
    """Score from genre and artist variety and spread of track length (in minutes);
    only tracks that lead to an artist count. The deviation is scored unrounded.

    count='sketch' estimates both varieties (``plans.distinct``). Lengths are taken as ``playlist_quality_score`` takes them.
    """
    distinct.check_kind(count)
    length, unit = _lengths(tracks, length_digits)
    traced = (
        tracks.select("TrackId", "GenreId", "Milliseconds", "AlbumId")
        .join(album_artists(albums, artists).select("AlbumId", "ArtistId"), "AlbumId")
        .drop("AlbumId")
    )
    facts = _entries(entries, traced, tracks)
    if count == "sketch":  # one pass: nothing distinct is kept apart
        columns = {"GenreDiversity": "GenreId", "ArtistDiversity": "ArtistId"}
        sketched = distinct.sketches(facts, ["PlaylistId"], columns, lg_nodes, also=_moments(F.lit(1), length))
        base = distinct.estimates(sketched, list(columns), lg_nodes)
    else:
        base = _varieties(facts, entries, _moments(F.lit(1), length))
    genre, artist, deviation = (F.lit(w) for w in weights)
    spread = weighted_stddev_pop(F.col("_w"), F.col("_wx"), F.col("_wxx")) / unit
    score = (
        F.col("GenreDiversity") * genre
        + F.col("ArtistDiversity") * artist
        - F.col("DurationVariance") / F.lit(60000.0) * deviation
    )
    return (
        _named(base, playlists)
        .withColumn("DurationVariance", spread)
        .select(
            "PlaylistId",
            "PlaylistName",
            "GenreDiversity",
            "ArtistDiversity",
            "DurationVariance",
            _round2(score).alias("BalanceScore"),
        )
    )


@report("-RevenuePerPlaylistUse", "PlaylistId")
def playlist_unique_value(
    entries: DataFrame,
    tracks: DataFrame,
    lines: DataFrame,
    playlists: DataFrame,
    *,
    pairs_unique: bool = False,
) -> DataFrame:
    """Average revenue of a playlist's sold tracks, as it is and divided by the number
    of playlists each track is in."""
    count = F.count if pairs_unique else F.count_distinct
    uses = entries.groupBy("TrackId").agg(count("PlaylistId").alias("_uses"))
    used = _track_sales(tracks, lines).join(uses, "TrackId")
    per_use = used.withColumn("_per_use", rounded_ratio(F.col("Revenue"), F.col("_uses"), 6))
    sums = (
        _entries(entries, per_use, tracks)
        .groupBy("PlaylistId")
        .agg(
            F.sum("Revenue").alias("_revenue"),
            F.sum("_per_use").alias("_per_use"),
            F.count("Revenue").alias("_sold"),
        )
    )
    return _named(sums, playlists).select(
        "PlaylistId",
        "PlaylistName",
        rounded_ratio(F.col("_revenue"), F.col("_sold")).alias("AvgTrackRevenue"),
        rounded_ratio(F.col("_per_use"), F.col("_sold")).alias("RevenuePerPlaylistUse"),
    )


@report("PlaylistId", "MetadataStatus", "TrackId")
def playlist_incomplete_tracks(
    playlists: DataFrame,
    entries: DataFrame,
    tracks: DataFrame,
    albums: DataFrame,
    artists: DataFrame,
    *,
    labels: Sequence[str] = ("missing genre & album", "missing genre", "missing album", "complete"),
) -> DataFrame:
    """The entries behind ``playlist_problem_tracks``. The label looks at genre and
    album only, so a track that merely lacks its artist is listed as complete."""
    gaps = _gaps(tracks, albums, artists).select(
        "TrackId", F.col("Name").alias("TrackName"), metadata_status(labels).alias("MetadataStatus")
    )
    listed = _entries(entries, gaps, tracks)
    return _named(listed, playlists).select(
        "PlaylistId", "PlaylistName", "TrackId", "TrackName", "MetadataStatus"
    )


@report("-TopTrackRevenuePercentage", "PlaylistId")
def playlist_top_track_share(
    entries: DataFrame,
    playlists: DataFrame,
    tracks: DataFrame,
    lines: DataFrame,
    *,
    pairs_unique: bool = False,
) -> DataFrame:
    """How much of a playlist's revenue its best track earns; unsold tracks earn 0."""
    facts = _entries(entries, _track_sales(tracks, lines), tracks, pairs_unique=pairs_unique)
    earned = facts.select(
        "PlaylistId", F.coalesce(F.col("Revenue") * F.col("_copies"), F.lit(0)).alias("_earned")
    )
    totals = earned.groupBy("PlaylistId").agg(
        F.sum("_earned").alias("PlaylistTotalRevenue"),
        F.max("_earned").alias("_best"),
        F.min("_earned").alias("_worst"),
    )
    # every track but the best counts 0, which tops a best track with negative revenue
    best = F.when(F.col("_worst") < F.col("_best"), F.greatest("_best", F.lit(0))).otherwise(F.col("_best"))
    return (
        _named(totals, playlists)
        .withColumn("TopTrackRevenue", best)
        .select(
            "PlaylistId",
            "PlaylistName",
            "PlaylistTotalRevenue",
            "TopTrackRevenue",
            percent(F.col("TopTrackRevenue"), F.col("PlaylistTotalRevenue")).alias(
                "TopTrackRevenuePercentage"
            ),
        )
    )


@report("AvgAlbumIdAsAgeProxy", "PlaylistId")
def playlist_age_proxy(
    entries: DataFrame,
    playlists: DataFrame,
    tracks: DataFrame,
    albums: DataFrame,
    *,
    column: str = "AlbumId",
) -> DataFrame:
    """Mean of a numeric ``column`` over a playlist's tracks that have an album. By
    default the album number itself, standing in for the age of a track."""
    traced = tracks.join(albums.select("AlbumId"), "AlbumId").select(
        "TrackId", F.col(column).alias("_value")
    )
    sums = (
        _entries(entries, traced, tracks)
        .groupBy("PlaylistId")
        .agg(F.sum("_value").alias("_sum"), F.count("_value").alias("_n"))
    )
    return _named(sums, playlists).select(
        "PlaylistId",
        "PlaylistName",
        rounded_ratio(F.col("_sum"), F.col("_n")).alias("AvgAlbumIdAsAgeProxy"),
    )
