"""Options, invariants and loads the SQL comparison does not reach."""

import datetime as dt
from decimal import Decimal as D

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from stores import SCHEMAS, hand_store, random_store, to_spark

from salesdq.operators import impute, playlist, profile, revenue, staff, timepat
from salesdq.plans import distinct
from salesdq.sources import sink, versions
from salesdq.sources import store as store_module
from salesdq.sources.store import TABLE_COLUMNS, Store, conform, read_table


@pytest.fixture(scope="module")
def hand(spark):
    return Store(**to_spark(spark, hand_store()))


@pytest.fixture(scope="module")
def noise(spark):
    return Store(**to_spark(spark, random_store(5)))


def rows(df):
    return [tuple(r) for r in df.collect()]


# --- boundaries, written out

def test_risk_looks_at_the_rounded_score(hand):
    got = {r["country"]: (r["missingScore"], r["riskLevel"]) for r in profile.group_missing_risk(hand.customer).collect()}
    assert got["Alpha"] == (D("0.50"), "high")
    assert got["Beta"] == (D("0.20"), "medium")
    assert got["Gamma"] == (D("0.50"), "high")  # 99 of 200 cells
    assert got[None] == (D("0.50"), "high")


def test_reports_come_sorted(hand):
    scores = [(r["MissingScore"], r["Country"]) for r in profile.null_profile_by_group(hand.customer).collect()]
    assert scores == sorted(scores, key=lambda s: (-s[0], s[1] or ""))
    unsorted = profile.null_profile_by_group(hand.customer, ordered=False)
    assert "Sort" not in unsorted._jdf.queryExecution().logical().toString()


def test_segments_at_the_cuts(hand):
    got = rows(staff.rep_customer_segments(hand.customer, hand.invoice, hand.employee))
    # namesakes 1 and 2 share a row: spending of 20, 50 and 7 and 50.01, 19.99
    assert sorted(got) == [("Jane Peacock", 1, 2, 2, 5), ("Steve Johnson", 0, 0, 1, 1)]


def test_idle_representatives_keep_an_empty_row(hand):
    got = rows(staff.rep_monthly_load(hand.employee, hand.customer, hand.invoice))
    assert ("Idle Agent", None, 0, None) in got
    assert (None, None, 0, None) in got  # no last name, no name


def test_ties_suggest_every_leader(hand):
    got = rows(impute.impute_candidates(hand.track, ties="all"))
    assert sorted(got) == [
        (3, "Three", "Bach"), (3, "Three", "Mozart"), (16, "Unsold", "Bach"), (17, "Unsold too", "Haydn")]
    assert sorted(rows(impute.impute_candidates(hand.track)))[0] == (3, "Three", "Bach")


def test_ties_repeat_the_tracks_of_an_album(hand):
    everything = impute.impute_enriched_view(hand.track, ties="all")
    assert everything.count() == 17 + 3  # album 1 has three tracks and two leaders
    assert impute.impute_enriched_view(hand.track, ties="first").count() == 17


def test_length_bands(hand):
    got = {r["LengthCategory"]: r["TotalTracks"] for r in impute.missing_by_length_band(hand.track).collect()}
    assert got == {"Short": 1, "Medium": 13, "Long": 3}  # an unknown length is long


def test_snapshot_is_dated_today_by_default(spark, hand):
    today = spark.sql("select current_date()").first()[0]
    assert impute.dq_snapshot(hand.track).first()["SnapshotDate"] == today


def test_pauses_count_calendar_days(hand):
    got = rows(timepat.inactivity_gaps(hand.invoice))
    assert [(r[0], r[3]) for r in got] == [(8, 211), (7, 175), (None, 120), (7, 61), (7, 60)]


def test_a_pause_must_last_a_day(hand):
    with pytest.raises(ValueError):
        timepat.inactivity_gaps(hand.invoice, min_days=0)


def test_day_parts_at_their_edges(hand):
    got = {r[0]: r[1] for r in rows(timepat.time_of_day_revenue(hand.invoice, hand.invoice_line, count="invoices"))}
    assert set(got) == {"morning", "afternoon", "evening", "night"}
    hours = {i[2].hour: i for i in hand_store()["invoice"] if i[2]}
    assert {5, 6, 11, 12, 17, 18, 22, 23} <= set(hours)


def test_namesakes_in_half_years(hand):
    by_name = rows(revenue.half_year_trend(hand.invoice, hand.invoice_line, hand.track, hand.album, hand.artist))
    by_id = rows(revenue.half_year_trend(
        hand.invoice, hand.invoice_line, hand.track, hand.album, hand.artist, key="id"))
    assert len(by_id) == len(by_name) + 1
    with pytest.raises(ValueError):
        revenue.half_year_trend(hand.invoice, hand.invoice_line, hand.track, hand.album, hand.artist, key="x")


def test_best_artists_beyond_the_first(hand):
    args = (hand.invoice, hand.invoice_line, hand.track, hand.album, hand.artist)
    first = revenue.monthly_top_artist(*args)
    three = revenue.monthly_top_artist(*args, k=3)
    assert {r["MonthlyRank"] for r in first.collect()} == {1}
    assert rows(three.filter("MonthlyRank = 1")) == rows(first)
    assert three.count() > first.count()


def test_ranks_of_the_best_few(noise):
    genre = (noise.playlist, noise.playlist_track, noise.track, noise.genre)
    staff_args = (noise.employee, noise.customer, noise.invoice, noise.invoice_line, noise.track, noise.genre)
    ranks = set()
    for build, args in ((playlist.playlist_dominant_genre, genre), (staff.rep_top_genre, staff_args),
                        (timepat.peak_hour_share, (noise.invoice, noise.invoice_line))):
        best, three = build(*args), build(*args, k=3)
        assert "Rank" not in best.columns and three.columns == [*best.columns, "Rank"]
        assert sorted(rows(three.filter("Rank = 1").drop("Rank")), key=str) == sorted(rows(best), key=str)
        ranks |= {r["Rank"] for r in three.collect()}
    assert ranks == {1, 2, 3}


# reports of each module, and their tables by argument
RENAMED = {
    staff.rep_customer_ltv: ("customers", "invoices", "employees"),
    staff.rep_top_genre: ("employees", "customers", "invoices", "lines", "tracks", "genres"),
    revenue.catalog_pareto: ("lines", "tracks", "albums", "artists"),
    revenue.incomplete_lines: ("lines", "tracks"),
    playlist.playlist_quality_score: ("playlists", "entries", "tracks", "lines"),
    playlist.playlist_balance_score: ("playlists", "entries", "tracks", "albums", "artists"),
    timepat.weekly_cumulative: ("invoices", "lines"),
    timepat.inactivity_gaps: ("invoices",),
    impute.impute_candidates: ("tracks",),
}
TABLES = {"customers": "customer", "invoices": "invoice", "employees": "employee", "lines": "invoice_line", "tracks": "track", "genres": "genre",
          "albums": "album", "artists": "artist", "playlists": "playlist", "entries": "playlist_track"}


@pytest.mark.parametrize("build", list(RENAMED), ids=lambda f: f.__name__)
def test_columns_of_other_names(noise, build):
    tables = [getattr(noise, TABLES[t]) for t in RENAMED[build]]
    names = {t: {c: f"my {c.lower()}!" for c in df.columns} for t, df in zip(RENAMED[build], tables)}
    own = [df.withColumnsRenamed(names[t]).withColumn(df.columns[0], F.lit("clash")) for t, df in zip(RENAMED[build], tables)]
    assert sorted(rows(build(*own, columns=names)), key=str) == sorted(rows(build(*tables)), key=str) != []
    with pytest.raises(ValueError, match="no table"):
        build(*tables, columns={"nothing": {}})
    with pytest.raises(ValueError, match="no such columns"):
        build(*tables, columns={RENAMED[build][0]: {"Name": "missing"}})


def test_weights_of_the_quality_score(hand):
    args = (hand.playlist, hand.playlist_track, hand.track, hand.invoice_line)
    sales = {r["PlaylistId"]: r for r in playlist.playlist_quality_score(*args).collect()}
    track = {r["PlaylistId"]: r for r in playlist.playlist_quality_score(*args, weight="track").collect()}
    trusted = {r["PlaylistId"]: r for r in playlist.playlist_quality_score(*args, pairs_unique=True).collect()}
    assert sales == trusted
    assert sales[1]["DurationVariance"] != track[1]["DurationVariance"]
    assert sales[3]["DurationVariance"] == track[3]["DurationVariance"] == D("50000.00")
    with pytest.raises(ValueError):
        playlist.playlist_quality_score(*args, weight="x")


def test_repeated_pairs_change_no_distinct_count(hand):
    twice = hand.playlist_track.union(hand.playlist_track)
    once = playlist.playlist_quality_score(hand.playlist, hand.playlist_track, hand.track, hand.invoice_line)
    double = playlist.playlist_quality_score(hand.playlist, twice, hand.track, hand.invoice_line)
    assert {r["PlaylistId"]: r["TrackCount"] for r in once.collect()} == {
        r["PlaylistId"]: r["TrackCount"] for r in double.collect()}
    uses = playlist.playlist_unique_value(hand.playlist_track, hand.track, hand.invoice_line, hand.playlist)
    again = playlist.playlist_unique_value(twice, hand.track, hand.invoice_line, hand.playlist)
    assert rows(uses) == rows(again)


FRACTIONS = ["decimal(18,3)", "decimal(12,1)", "decimal(9,0)", "bigint", "double", "float"]


@pytest.mark.parametrize("kind", FRACTIONS)
def test_spread_of_lengths_with_a_fraction(spark, noise, kind):
    """Lengths of any exact type against DuckDB's deviation; binary fractions are refused unless digits are named."""
    length = (F.col("Milliseconds") * F.lit(D("0.9870")) + F.col("TrackId") * F.lit(D("0.125"))).cast(kind)
    tracks = noise.track.withColumn("Milliseconds", length)
    digits = {"double": 3, "float": 3}.get(kind)
    if digits:
        with pytest.raises(ValueError, match="digits"):
            playlist.playlist_quality_score(noise.playlist, noise.playlist_track, tracks, noise.invoice_line)
        with pytest.raises(ValueError, match="digits"):
            playlist.playlist_balance_score(noise.playlist, noise.playlist_track, tracks, noise.album, noise.artist)
    score = playlist.playlist_quality_score(
        noise.playlist, noise.playlist_track, tracks, noise.invoice_line, weight="track", length_digits=digits)
    balance = playlist.playlist_balance_score(
        noise.playlist, noise.playlist_track, tracks, noise.album, noise.artist, length_digits=digits)
    rounded = tracks.withColumn("x", F.col("Milliseconds").cast("decimal(18,3)").cast("double"))
    entries = noise.playlist_track.join(rounded, "TrackId")
    connection = duckdb.connect()
    connection.register("e", entries.select("PlaylistId", "x").toArrow())
    linked = entries.join(noise.album.join(noise.artist, "ArtistId").select("AlbumId"), "AlbumId")
    connection.register("a", linked.select("PlaylistId", "x").toArrow())
    for df, table in ((score, "e"), (balance, "a")):
        want = dict(connection.execute(f"select PlaylistId, coalesce(stddev_pop(x), 0) from {table} group by 1").fetchall())
        got = {r["PlaylistId"]: float(r["DurationVariance"] or 0) for r in df.collect()}
        assert got and all(abs(v - want[i]) < 0.006 for i, v in got.items())
    if kind == "decimal(18,3)":  # whole numbers would have lost this
        whole = tracks.withColumn("Milliseconds", F.col("Milliseconds").cast("bigint"))
        other = playlist.playlist_balance_score(noise.playlist, noise.playlist_track, whole, noise.album, noise.artist)
        assert sorted(rows(other), key=str) != sorted(rows(balance), key=str)


def test_lengths_of_too_many_digits_are_refused(noise):
    tracks = noise.track.withColumn("Milliseconds", F.col("Milliseconds").cast("decimal(30,5)"))
    with pytest.raises(ValueError, match="18 digits"):
        playlist.playlist_balance_score(noise.playlist, noise.playlist_track, tracks, noise.album, noise.artist)


# --- distinct counts by sketch

def wide_entries(spark):
    """Playlists of 10 to 100,000 different genres, each met several times; NULL genres count for nothing."""
    entries = spark.range(0, 400_000, 1, 8).select(F.col("id").alias("TrackId"), F.explode(F.array(*map(F.lit, (1, 2, 3)))).alias("PlaylistId"))
    genre = F.when(F.col("id") % 7 > 0, F.col("id") % 100_000)
    tracks = spark.range(0, 400_000, 1, 8).select(F.col("id").alias("TrackId"), genre.alias("GenreId"))
    sizes = F.element_at(F.array(F.lit(10), F.lit(3_000), F.lit(400_000)), F.col("PlaylistId"))
    names = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "empty")], "PlaylistId long, Name string")
    return names, entries.filter(F.col("TrackId") < sizes), tracks


@pytest.mark.parametrize("lg_nodes", [10, 12, 14])
def test_sketched_counts_keep_their_error(spark, lg_nodes):
    names, entries, tracks = wide_entries(spark)
    exact = {r[0]: r["GenreVariety"] for r in playlist.playlist_genre_variety(names, entries, tracks).collect()}
    close = {r[0]: r["GenreVariety"] for r in playlist.playlist_genre_variety(
        names, entries, tracks, count="sketch", lg_nodes=lg_nodes).collect()}
    assert set(exact) == set(close) == {1, 2, 3} and exact[3] > 90_000
    assert close[1] == exact[1]  # few values are counted exactly
    for i in exact:
        assert abs(close[i] - exact[i]) <= 3 * distinct.standard_error(lg_nodes) * exact[i]


def test_merged_sketches_equal_one_pass(spark):
    names, entries, tracks = wide_entries(spark)
    whole = playlist.playlist_genre_sketches(entries, tracks)
    parts = [playlist.playlist_genre_sketches(entries.filter(F.col("TrackId") % 5 <= k), tracks) for k in (1, 4)]  # they overlap
    parts.append(playlist.playlist_genre_sketches(entries.limit(0), tracks))
    merged = distinct.merged(parts, ["PlaylistId"], ["GenreVariety"])
    assert sorted(rows(playlist.playlist_variety_of(names, merged))) == sorted(rows(playlist.playlist_variety_of(names, whole)))
    deeper = distinct.merged([distinct.merged(parts[:1], ["PlaylistId"], ["GenreVariety"]), *parts[1:]], ["PlaylistId"], ["GenreVariety"])
    assert sorted(rows(playlist.playlist_variety_of(names, deeper))) == sorted(rows(playlist.playlist_variety_of(names, merged)))


def test_sketches_of_small_playlists_change_no_report(noise):
    args = (noise.playlist, noise.playlist_track, noise.track)
    both = [rows(playlist.playlist_genre_variety(*args, count=c)) for c in ("exact", "sketch")]
    assert both[0] == both[1] != []
    args = (*args, noise.album, noise.artist)
    both = [sorted(rows(playlist.playlist_balance_score(*args, count=c)), key=str) for c in ("exact", "sketch")]
    assert both[0] == both[1] != []
    with pytest.raises(ValueError):
        playlist.playlist_genre_variety(*args[:3], count="some")


def test_age_takes_any_numeric_column(hand):
    got = {r[0]: r[2] for r in rows(playlist.playlist_age_proxy(
        hand.playlist_track, hand.playlist, hand.track, hand.album, column="Milliseconds"))}
    assert got[3] == D("300000.00")


# --- invariants

def test_audits_of_complete_data_find_nothing(spark, noise):
    line = noise.invoice_line.dropna()
    assert rows(profile.null_cluster_rows(line)) == []
    assert [r[1] for r in rows(profile.null_count_by_field(line))] == [0, 0, 0]
    assert rows(profile.all_null_invoices(noise.invoice, line)) == []
    assert profile.revenue_loss_estimate(line).first()["AffectedRows"] == 0


def test_empty_tables_give_no_division_error(noise):
    none = noise.track.limit(0)
    assert profile.audit_attribute_summary(none).first()["percentMissingGenre"] is None
    assert profile.audit_blank_composer(none).first()["nullComposerRate"] is None
    assert profile.null_profile_global(noise.customer.limit(0)).first()["MissingCompanyRatio"] is None
    assert profile.null_rate_by_table({"t": (none, ["GenreId"])}).first()["NullRate"] is None
    assert impute.dq_snapshot(none).first()["MissingPercentage"] is None


def test_attributed_revenue_adds_up(noise):
    parts = revenue.revenue_attribution(noise.invoice_line, noise.track, noise.album, noise.artist)
    whole = noise.invoice_line.agg(F.sum(F.col("UnitPrice") * F.col("Quantity"))).first()[0]
    assert sum(r["Revenue"] for r in parts.collect()) == whole


def test_running_sums_never_fall(noise):
    positive = noise.invoice_line.filter("UnitPrice >= 0")
    got = revenue.catalog_pareto(positive, noise.track, noise.album, noise.artist, limit=100, ordered=False)
    last = {}
    for r in got.orderBy("ArtistTotalRevenue", "CumulativePercentage").collect():
        key = (r["ArtistName"], r["ArtistTotalRevenue"])
        assert r["CumulativePercentage"] >= last.get(key, 0)
        last[key] = r["CumulativePercentage"]


def test_imputation_keeps_known_values(noise):
    known = {r["TrackId"]: r["Composer"] for r in noise.track.collect() if r["Composer"] is not None}
    for r in impute.impute_enriched_view(noise.track).collect():
        if r["TrackId"] in known:
            assert r["FinalComposer"] == known[r["TrackId"]]


def test_bad_options_are_refused(noise):
    with pytest.raises(ValueError):
        impute.impute_candidates(noise.track, ties="some")
    with pytest.raises(ValueError):
        timepat.hourly_sales(noise.invoice, noise.invoice_line, count="x")
    with pytest.raises(ValueError):
        playlist.playlist_revenue(
            noise.playlist, noise.playlist_track, noise.track, noise.invoice_line, weight="x")


# --- loads

def test_loading_twice_stores_once(spark, hand, tmp_path):
    path = str(tmp_path / "staging")
    first = impute.impute_load(hand.track, path, ties="all").count()
    assert impute.impute_load(hand.track, path, ties="all").count() == first == 20
    assert impute.impute_load(hand.track, path).count() == hand.track.count()


def test_result_tables_have_their_declared_types(hand, tmp_path):
    for table, df in {
        "MissingValuesCustomer": profile.null_profile_global(hand.customer),
        "FixCandidateCustomers": profile.fix_candidates(hand.customer),
        "countryMissingRisk": profile.group_missing_risk(hand.customer.filter("Country is not null")),
    }.items():
        stored = sink.load_result(df, table, str(tmp_path / table))
        assert stored.count() == df.count() > 0
        assert [(f.name, f.dataType) for f in stored.schema] == [
            (f.name, f.dataType) for f in sink.RESULT_TABLES[table]]


def test_a_load_that_fails_midway_leaves_the_old_table(spark, hand, tmp_path):
    path = str(tmp_path / "tracks")
    before = impute.impute_load(hand.track, path).count()
    broken = hand.track.withColumn("Name", F.when(F.col("TrackId") > 3, F.raise_error(F.lit("midway"))).otherwise(F.col("Name")))
    with pytest.raises(Exception, match="midway"):
        impute.impute_load(broken, path)
    assert sink.read_loaded(spark, path).count() == before


def test_a_missing_or_repeated_key_leaves_the_table_alone(spark, hand, tmp_path):
    path = str(tmp_path / "risk")
    good = profile.group_missing_risk(hand.customer.filter("Country is not null"))
    before = sink.load_result(good, "countryMissingRisk", path).count()
    with pytest.raises(sink.KeyViolation):
        sink.load_result(profile.group_missing_risk(hand.customer), "countryMissingRisk", path)
    with pytest.raises(sink.KeyViolation):
        sink.load_result(good.union(good), "countryMissingRisk", path)
    assert sink.read_loaded(spark, path).count() == before
    assert versions.remove_unfinished(spark, path, older_than_hours=0) == 0  # what was refused is gone


def numbers(spark, n, value=0):
    return spark.range(n).select("id", F.lit(value).alias("v"))


STEPS = ("written", "check_key", "commit", "remove_old")


@pytest.mark.parametrize("step", STEPS)
def test_a_load_that_stops_at_any_step_leaves_a_whole_table(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        sink.read_loaded(spark, path)
    sink.load(numbers(spark, 5, 1), path, key=["id"])
    of = sink if step == "check_key" else versions
    work = getattr(of, step)

    def stop(*args):
        if step == "written":  # part of the files is there
            work(*args)
        raise OSError("stopped")

    monkeypatch.setattr(of, step, stop)
    with pytest.raises(OSError):
        sink.load(numbers(spark, 9, 2), path, key=["id"])
    monkeypatch.undo()
    want = {(9, 2)} if step == "remove_old" else {(5, 1)}
    assert rows(sink.read_loaded(spark, path).groupBy("v").count().select("count", "v")) == list(want)
    assert sink.load(numbers(spark, 7, 3), path, key=["id"]).count() == 7
    assert rows(sink.read_loaded(spark, path).groupBy("v").count().select("count", "v")) == [(7, 3)]
    assert versions.remove_unfinished(spark, path) == 0  # too young to be given up
    assert versions.remove_unfinished(spark, path, older_than_hours=0) == (step in STEPS[:3])
    assert len(list((tmp_path / "t" / "_versions").iterdir())) == 2


def test_readers_keep_their_version_during_a_load(spark, tmp_path):
    path = str(tmp_path / "t")
    sink.load(numbers(spark, 5, 1), path)
    reader = sink.read_loaded(spark, path)
    written = versions.written(numbers(spark, 9, 2), path, "parquet")
    assert sink.read_loaded(spark, path).count() == 5  # written, not committed
    versions.commit(spark, path, written)
    assert sink.read_loaded(spark, path).count() == 9
    assert rows(reader.distinct().orderBy("id")) == [(i, 1) for i in range(5)]
    sink.load(sink.read_loaded(spark, path).limit(3), path)  # a table may be made from itself
    assert sink.read_loaded(spark, path).count() == 3


def test_loads_at_one_time_leave_one_of_them(spark, tmp_path):
    path = str(tmp_path / "t")
    first, second = (versions.written(numbers(spark, n), path, "parquet") for n in (3, 4))
    (tmp_path / "t" / "_commits").mkdir()
    for version in (first, second):
        (tmp_path / "t" / "_commits" / f"{1:020d}.{version}").touch()
    assert versions.current(spark, path) == max(first, second)
    assert sink.read_loaded(spark, path).count() in (3, 4)
    with pytest.raises(ValueError):
        versions.remove_old(spark, path, 0)


def test_empty_results_are_loaded(spark, tmp_path):
    stored = sink.load(numbers(spark, 0), str(tmp_path / "t"))
    assert stored.count() == 0 and sink.read_loaded(spark, str(tmp_path / "t"), schema=stored.schema).count() == 0


def test_the_catalog_moves_to_the_next_version(spark, tmp_path, monkeypatch):
    where = str(tmp_path / "v")
    assert sink.load_catalog_table(numbers(spark, 5, 1), "moved", key=["id"], location=where).count() == 5
    with pytest.raises(sink.KeyViolation):
        sink.load_catalog_table(numbers(spark, 5).union(numbers(spark, 5)), "moved", key=["id"], location=where)
    with pytest.raises(ValueError, match="columns"):
        sink.load_catalog_table(spark.range(3), "moved", location=where)
    monkeypatch.setattr(versions, "commit", lambda *args: (_ for _ in ()).throw(OSError()))
    with pytest.raises(OSError):
        sink.load_catalog_table(numbers(spark, 8, 2), "moved", location=where)
    assert spark.table("moved").count() == 5
    monkeypatch.undo()
    for n in (8, 9):
        reader = spark.table("moved")
        before = reader.count()
        assert sink.load_catalog_table(numbers(spark, n, 2), "moved", location=where).count() == n
        assert spark.sql("select count(*) from moved").first()[0] == n
        assert before != n
    spark.sql("drop table moved")


def test_catalog_tables(spark, hand):
    stored = sink.load_catalog_table(
        profile.group_missing_risk(hand.customer.filter("Country is not null")),
        "country_risk", schema=sink.RESULT_TABLES["countryMissingRisk"], key=["country"])
    assert stored.count() == 3
    assert read_table(spark, "country_risk").schema["missingScore"].dataType == T.DoubleType()
    spark.sql("drop table country_risk")


def test_store_from_files_and_catalog(spark, hand, tmp_path):
    spark.sql("create database shop")
    for name in TABLE_COLUMNS:
        field = "".join(f"_{c.lower()}" if c.isupper() else c for c in name).lstrip("_")
        df = getattr(hand, field)
        df.write.parquet(f"{tmp_path}/{name}.parquet")
        df.write.saveAsTable(f"shop.{name}")
    try:
        for loaded in (Store.from_files(spark, str(tmp_path)), Store.from_catalog(spark, "shop")):
            got = profile.null_rate_by_table({"Customer": (loaded.customer, ["Email", "Country"])})
            assert rows(got) == rows(profile.null_rate_by_table({"Customer": (hand.customer, ["Email", "Country"])}))
            assert loaded.playlist_track.count() == hand.playlist_track.count()
    finally:
        spark.sql("drop database shop cascade")


def test_conform_renames_and_drops(spark):
    df = spark.createDataFrame([(1, "x", 2)], "genre_id int, Name string, other int")
    assert conform(df, "Genre", {"GenreId": "genre_id"}).columns == ["GenreId", "Name"]


def test_fixture_schemas_cover_the_store():
    fields = Store.__dataclass_fields__
    assert set(SCHEMAS) == set(fields)
    assert len(store_module.TABLE_COLUMNS) == len(fields)


def test_dates_may_be_given(hand):
    day = dt.date(2020, 2, 29)
    assert impute.dq_snapshot(hand.track, snapshot_date=day).first()["SnapshotDate"] == day
