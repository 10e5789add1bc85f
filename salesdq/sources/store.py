"""The ten tables the reports read."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from salesdq.functions.semantics import PRICE

# fixed values: the columns each table provides
TABLE_COLUMNS = {
    "Customer": (
        "CustomerId", "FirstName", "LastName", "Company", "City", "State", "Country", "Email", "SupportRepId",
    ),
    "Employee": ("EmployeeId", "FirstName", "LastName", "Title"),
    "Invoice": ("InvoiceId", "CustomerId", "InvoiceDate", "Total"),
    "InvoiceLine": ("InvoiceLineId", "InvoiceId", "TrackId", "UnitPrice", "Quantity"),
    "Track": ("TrackId", "Name", "AlbumId", "GenreId", "Composer", "Milliseconds", "UnitPrice"),
    "Album": ("AlbumId", "Title", "ArtistId"),
    "Artist": ("ArtistId", "Name"),
    "Genre": ("GenreId", "Name"),
    "Playlist": ("PlaylistId", "Name"),
    "PlaylistTrack": ("PlaylistId", "TrackId"),
}


MONEY_COLUMNS = ("UnitPrice", "Total")


def read_table(spark: SparkSession, source: str, file_format: str | None = None) -> DataFrame:
    """All rows of a catalog table, or of files (Parquet, ORC) when ``file_format`` is given."""
    if file_format is None:
        return spark.table(source)
    return spark.read.format(file_format).load(source)


def conform(df: DataFrame, table: str, columns: Mapping[str, str] | None = None) -> DataFrame:
    """Rename a user's columns to those of ``table`` and drop the others.

    ``columns`` maps the expected name to the user's; names left out are taken as
    they are. Prices and totals become PRICE, whatever numeric type they had.
    Nothing is copied: this is a projection the scan absorbs.
    """
    renamed = columns or {}

    def column(name: str):
        found = df[renamed.get(name, name)]
        return (found.cast(PRICE) if name in MONEY_COLUMNS else found).alias(name)

    return df.select(*[column(name) for name in TABLE_COLUMNS[table]])


@dataclass(frozen=True)
class Store:
    """One DataFrame per table, all lazy."""

    customer: DataFrame
    employee: DataFrame
    invoice: DataFrame
    invoice_line: DataFrame
    track: DataFrame
    album: DataFrame
    artist: DataFrame
    genre: DataFrame
    playlist: DataFrame
    playlist_track: DataFrame

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str) -> Store:
        """The tables of a catalog database."""
        return cls(*[conform(spark.table(f"{database}.{name}"), name) for name in TABLE_COLUMNS])

    @classmethod
    def from_files(cls, spark: SparkSession, directory: str, file_format: str = "parquet") -> Store:
        """The tables of a directory with one folder or file per table."""
        suffix = f".{file_format}"
        return cls(
            *[
                conform(read_table(spark, f"{directory}/{name}{suffix}", file_format), name)
                for name in TABLE_COLUMNS
            ]
        )
