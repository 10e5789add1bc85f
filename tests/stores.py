"""Small stores: one written by hand around the reports' edge cases, and random
ones in which NULLs, ties and hot keys are common."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal as D

# fixed values: column types, in Spark's and DuckDB's common notation
SCHEMAS = {
    "customer": "CustomerId int, FirstName string, LastName string, Company string, City string, State string,"
    " Country string, Email string, SupportRepId int",
    "employee": "EmployeeId int, FirstName string, LastName string, Title string",
    "invoice": "InvoiceId int, CustomerId int, InvoiceDate timestamp_ntz, Total decimal(18,2)",
    "invoice_line": "InvoiceLineId int, InvoiceId int, TrackId int, UnitPrice decimal(18,2), Quantity int",
    "track": "TrackId int, Name string, AlbumId int, GenreId int, Composer string, Milliseconds int,"
    " UnitPrice decimal(18,2)",
    "album": "AlbumId int, Title string, ArtistId int",
    "artist": "ArtistId int, Name string",
    "genre": "GenreId int, Name string",
    "playlist": "PlaylistId int, Name string",
    "playlist_track": "PlaylistId int, TrackId int",
}
AGENT = "Sales Support Agent"


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def hand_store() -> dict[str, list[tuple]]:
    customers = [
        # Alpha: score exactly 0.5; Beta: 0.2 (2 of 10 cells); Gamma: 99/200 = 0.495, shown as 0.50
        (1, "Ann", "Lee", None, "Bern", "BE", "Alpha", "a@x", 1),
        (2, "Bob", None, "Co", "Bern", None, "Alpha", "b@x", 1),
        (3, "Cid", "Ray", None, None, None, "Beta", None, 2),
        (4, "Dee", "Kay", "Co", "Rome", "RM", "Beta", "d@x", 2),
        (5, "Eve", "May", "Co", "Rome", "RM", "Beta", "e@x", 3),
        (6, "Fay", "Joy", "Co", "Rome", "RM", "Beta", "f@x", None),
        (7, "Gus", "Poe", "Co", "Rome", "RM", "Beta", "g@x", 5),
        (8, "Hal", "Fox", "Co", "Oslo", None, None, "h@x", 1),
    ]
    customers += [
        (100 + n, "G", f"N{n}", None if n < 99 else "Co", "Rome", "RM", "Gamma", "n@x", None) for n in range(100)
    ]
    employees = [
        (1, "Jane", "Peacock", "Sales Support Agent"),
        (2, "Jane", "Peacock", "SALES support agent"),
        (3, "Steve", "Johnson", "sales support agent"),
        (4, "Idle", "Agent", AGENT),
        (5, "Nancy", "Edwards", "Sales Manager"),
        (6, "No", None, AGENT),
    ]
    invoices = [
        (1, 1, ts("2021-01-01 05:59:59"), D("20.00")),
        (2, 2, ts("2021-01-02 06:00:00"), D("50.00")),
        (3, 3, ts("2021-01-31 11:59:59"), D("50.01")),
        (4, 4, ts("2021-02-01 12:00:00"), D("10.00")),
        (5, 4, ts("2021-04-01 17:30:00"), D("9.99")),
        (6, 5, ts("2021-06-30 18:00:00"), D("1.00")),
        (7, 5, ts("2021-07-01 22:59:59"), D("1.00")),
        # pauses of 59, 60 and 61 days by the calendar, and two invoices at one instant
        (8, 7, ts("2021-01-10 23:00:00"), D("5.00")),
        (9, 7, ts("2021-03-10 01:00:00"), D("5.00")),
        (10, 7, ts("2021-05-09 00:30:00"), D("5.00")),
        (11, 7, ts("2021-07-09 23:30:00"), D("5.00")),
        (12, 7, ts("2021-07-09 23:30:00"), D("5.00")),
        (13, 7, ts("2021-12-31 23:00:00"), D("5.00")),
        (14, None, ts("2022-01-01 00:00:00"), D("3.00")),
        (15, None, ts("2022-05-01 00:00:00"), D("3.00")),
        (16, 99999, ts("2022-05-02 10:00:00"), D("3.00")),
        (17, 8, None, D("7.00")),
        (18, 8, ts("2022-06-05 09:00:00"), None),
        (19, 8, ts("2023-01-02 10:00:00"), D("0.00")),
    ]
    lines = [
        (1, 1, 1, D("10.00"), 1),
        (2, 1, 2, D("0.99"), 3),
        (3, 2, None, D("0.99"), 1),
        (4, 2, 1, None, 2),
        (5, 2, 1, D("0.99"), None),
        (6, 3, None, None, None),
        (7, 4, 3, D("7.00"), 1),
        (8, 5, 3, D("10.00"), 1),
        (9, 6, 4, D("0.00"), 5),
        (10, 7, 5, D("2.50"), 2),
        (11, 8, 6, D("5.00"), 1),
        (12, 9, 7, D("5.00"), 1),
        (13, 10, 8, D("1.00"), 1),
        (14, 11, 9, D("1.00"), 1),
        (15, 12, 10, D("1.00"), 1),
        (16, 13, 11, D("100.00"), 1),
        (17, 14, 12, D("3.33"), 1),
        (18, 15, 404, D("4.00"), 1),
        (19, 16, 13, D("1.25"), 1),
        (20, 17, 1, D("6.00"), 1),
        (21, 18, 2, D("2.00"), 2),
        (22, 404, 2, D("8.00"), 1),
        (23, None, 2, D("8.00"), 1),
        (24, 19, 14, None, 1),
        (25, 13, 15, D("-3.00"), 1),
        (25, 13, 15, D("-3.00"), 1),
    ]
    tracks = [
        (1, "One", 1, 1, "Bach", 119999, D("0.99")),
        (2, "Two", 1, 1, "Mozart", 120000, D("0.99")),
        (3, "Three", 1, 2, None, 300000, D("0.99")),
        (4, "Four", 2, None, None, 300001, D("0.99")),
        (5, "Five", None, 3, "Bach", None, D("0.99")),
        (6, "Six", None, None, None, 200000, D("0.99")),
        (7, "Seven", 3, 1, "Bach", 200000, D("0.99")),
        (8, "Eight", 3, 1, "Haydn", 200000, D("0.99")),
        (9, "Nine", 3, 1, "Haydn", 200000, D("0.99")),
        (10, "Ten", 3, 2, "", 200000, D("0.99")),
        (11, "Eleven", 4, 2, "   ", 200000, D("0.99")),
        (12, "Twelve", 5, 3, "Orff", 200000, D("0.99")),
        (13, "Thirteen", 404, 1, None, 200000, D("0.99")),
        (14, "Fourteen", 6, 1, None, 200000, D("0.99")),
        (15, "Fifteen", 7, 404, "Bach", 200000, D("0.99")),
        (16, "Unsold", 7, 1, None, 250000, D("0.99")),
        (17, "Unsold too", 3, 3, None, 350000, D("0.99")),
    ]
    albums = [
        (1, "Tied", 1),
        (2, "Nobody", 1),
        (3, "Three names", 2),
        (4, "Blank", 3),
        (5, "No artist", None),
        (6, "Lost artist", 404),
        (7, "Refunds", 4),
    ]
    artists = [(1, "Same"), (2, "Same"), (3, "Solo"), (4, "Back")]
    genres = [(1, "Classical"), (2, "Rock"), (3, "Jazz"), (4, "Classical")]
    playlists = [(1, "Mix"), (2, "Mix"), (3, "Unsold"), (4, "Single"), (5, "Empty"), (6, "Refunds"), (7, "All")]
    entries = [(1, t) for t in (1, 2, 3, 4, 5, 6, 13)] + [(2, t) for t in (7, 8, 9, 10, 11, 3)]
    entries += [(3, 16), (3, 17), (4, 4), (6, 15), (6, 404)] + [(7, t) for t in range(1, 18)]
    return dict(
        customer=customers, employee=employees, invoice=invoices, invoice_line=lines, track=tracks,
        album=albums, artist=artists, genre=genres, playlist=playlists, playlist_track=entries,
    )


def random_store(seed: int) -> dict[str, list[tuple]]:
    """Every key column has one value that about a third of the rows share."""
    rng = random.Random(seed)

    def key(n: int, null: float = 0.1):
        roll = rng.random()
        if roll < null:
            return None
        return 1 if roll < 0.4 else rng.randint(1, n + 2)

    def maybe(value, null: float = 0.15):
        return None if rng.random() < null else value

    def cents(top: int) -> D:
        return D(rng.randint(0, top)) / 100

    people, albums, artists, tracks, invoices = 60, 25, 8, 90, 160
    day0 = dt.datetime(2021, 1, 1)
    store = {
        "customer": [
            (
                c, rng.choice("AB"), maybe(rng.choice("XY")), maybe("co"), maybe("city"), maybe("st"),
                maybe(rng.choice(["P", "Q", "R"])), maybe("e"), key(5),
            )
            for c in range(1, people + 1)
        ],
        "employee": [
            (e, rng.choice("AB"), rng.choice("XY"), rng.choice([AGENT, AGENT.upper(), "Boss", None]))
            for e in range(1, 7)
        ],
        "invoice": [
            (
                i, key(people),
                maybe(day0 + dt.timedelta(minutes=30 * rng.randint(0, 48 * 900)), 0.03), maybe(cents(3000), 0.05),
            )
            for i in range(1, invoices + 1)
        ],
        "invoice_line": [
            (n, key(invoices, 0.02), key(tracks), maybe(cents(400) * rng.choice([1, 1, 1, 0, -1]), 0.1),
             maybe(rng.randint(1, 3), 0.1))
            for n in range(1, 900)
        ],
        "track": [
            (
                t, f"T{t % 40}", key(albums), key(4), maybe(rng.choice(["a", "b", "c", "", " "]), 0.3),
                maybe(rng.choice([119999, 120000, 250000, 300000, 300001])), cents(200),
            )
            for t in range(1, tracks + 1)
        ],
        "album": [(a, f"L{a % 9}", key(artists)) for a in range(1, albums + 1)],
        "artist": [(a, f"N{a % 5}") for a in range(1, artists + 1)],
        "genre": [(1, "Classical"), (2, "Rock"), (3, "Rock"), (4, "Jazz")],
        "playlist": [(p, f"P{p % 7}") for p in range(1, 13)],
    }
    # pairs may repeat, and one track is on most playlists
    pairs = [(key(12, 0), key(tracks, 0)) for _ in range(400)] + [(p, 1) for p in range(1, 11)]
    store["playlist_track"] = sorted(pairs)
    return store


def to_spark(spark, store):
    return {name: spark.createDataFrame(rows, SCHEMAS[name]) for name, rows in store.items()}


def to_duckdb(connection, store):
    for name, rows in store.items():
        columns = SCHEMAS[name].replace("timestamp_ntz", "timestamp").replace(" string", " varchar")
        connection.execute(f"create or replace table s_{name} ({columns})")
        marks = ", ".join("?" * len(rows[0]))
        connection.executemany(f"insert into s_{name} values ({marks})", rows)
    connection.execute("create or replace view s_purchase as select * from s_invoice")
    connection.execute("create or replace view s_purchase_line as select * from s_invoice_line")
