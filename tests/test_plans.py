"""What the planner makes of the reports: scans, exchanges, limits, skew splits."""

import contextlib
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from salesdq.operators import impute, playlist, profile, revenue
from salesdq.plans import estimated_bytes, fits_broadcast, join_many_to_one, joins, null_safe_lookup, running_total, top_ties
from salesdq.sources import bindings

SF_DIR = "/root/testdata/sf0.001"
LOADS = {"null_profile_load", "fix_candidates_load", "group_missing_risk_load", "impute_load", "impute_load_first"}


@contextlib.contextmanager
def conf(spark, **settings):
    names = {k.replace("__", "."): str(v) for k, v in settings.items()}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name in names:
            spark.conf.unset(name)


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def store(spark):
    return bindings.store(spark, SF_DIR)


@pytest.fixture
def large(spark):
    with conf(spark, spark__sql__autoBroadcastJoinThreshold=-1):
        yield


def test_building_a_report_runs_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "building reports")
    try:
        for name, query in entry.report_queries().items():
            if name not in LOADS:  # a load is meant to run
                query(spark, SF_DIR)
        assert list(tracker.getJobIdsForGroup("build")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_no_python_in_any_plan(spark):
    for name, query in entry.report_queries().items():
        plan = planned(query(spark, SF_DIR))
        assert "Python" not in plan and "Pandas" not in plan, name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_field_counts_come_from_one_scan(store):
    plan = planned(profile.null_count_by_field(store.invoice_line))
    assert plan.count("FileScan") == 1
    scanned = plan[plan.index("FileScan") :].splitlines()[0]
    assert "l_shipdate" not in scanned and "l_orderkey" not in scanned


def test_filters_reach_the_scan(spark, store):
    title = spark.read.schema("c_custkey bigint, c_nationkey int").parquet(f"{SF_DIR}/customer.parquet")
    plan = planned(title.filter(F.col("c_nationkey").isNull()).select("c_custkey"))
    assert "PushedFilters: [IsNull(c_nationkey)]" in plan
    assert "IsNotNull(l_orderkey)" in planned(revenue.monthly_top_artist(
        store.invoice, store.invoice_line, store.track, store.album, store.artist))


@pytest.mark.parametrize("name", ["rep_top_genre", "playlist_dominant_genre"])
def test_best_per_group_is_limited_before_the_shuffle(spark, name):
    plan = planned(entry.queries()[name](spark, SF_DIR))
    assert plan.count("WindowGroupLimit") == 2  # partial and final


@pytest.mark.parametrize(
    "name", ["catalog_pareto", "genre_revenue_share", "playlist_quality_score", "monthly_top_artist"]
)
def test_lines_are_shuffled_once(spark, large, name):
    """However often a plan uses the sales per track, the line table is read once."""
    plan = final_plan(entry.queries()[name](spark, SF_DIR))
    assert plan.count("l_extendedprice#") >= 1
    scans = [line for line in plan.splitlines() if "FileScan" in line and "l_extendedprice" in line]
    assert len(scans) == 1, scans


def test_small_sides_are_broadcast_only_below_the_limit(spark, store):
    assert fits_broadcast(store.track)
    assert not fits_broadcast(spark.range(10**9))
    with conf(spark, spark__sql__autoBroadcastJoinThreshold=estimated_bytes(store.track)):
        assert not fits_broadcast(store.track)  # leaves headroom for compression
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="10MB"):
        assert fits_broadcast(store.track)
    with conf(spark, spark__sql__autoBroadcastJoinThreshold=-1):
        assert not fits_broadcast(store.track)
        plan = planned(playlist.playlist_genre_variety(store.playlist, store.playlist_track, store.track))
        assert "Broadcast" not in plan and "_slot" in plan


def test_varieties_are_counted_in_more_partitions_of_more_entries(spark, store, monkeypatch):
    """Tables over genres and artists of a playlist hold a share of the entries that does not grow with them."""
    args = (store.playlist, store.playlist_track, store.track, store.album, store.artist)
    size, counts = estimated_bytes(store.playlist_track), []
    want = sorted(map(str, playlist.playlist_balance_score(*args).collect()))
    assert want
    for parts in (10, 40):
        monkeypatch.setattr(joins, "DEALT_BYTES", -(-size // parts))
        df = playlist.playlist_balance_score(*args)
        plan = planned(df)
        assert "Expand" not in plan
        counts.append(sorted(map(int, re.findall(r", (\d+)\), REPARTITION_BY_NUM", plan))))
        assert sorted(map(str, df.collect())) == want
    assert counts == [[10, 10], [40, 40]]


def test_varieties_of_mixed_and_missing_genres(spark):
    """Artists of several genres count once, tracks without a genre count for their artist only."""
    frame = spark.createDataFrame
    tracks = [(i, "t", 1 + i % 2, None if i % 3 == 0 else f"g{i % 3}", 1000 * i) for i in range(1, 13)]
    tracks = frame(tracks, "TrackId long, Name string, AlbumId long, GenreId string, Milliseconds int")
    albums = frame([(1, "a", 7), (2, "b", 8)], "AlbumId long, Title string, ArtistId long")
    artists = frame([(7, "x"), (8, "y")], "ArtistId long, Name string")
    entries = [(1, i) for i in range(1, 13)] + [(2, 3), (2, 9), (2, 9), (3, 2), (3, 4)]
    playlists = frame([(1, "p"), (2, "q"), (3, "r"), (4, "s")], "PlaylistId long, Name string")
    got = playlist.playlist_balance_score(playlists, frame(entries, "PlaylistId long, TrackId long"), tracks, albums, artists)
    assert {r["PlaylistId"]: (r["GenreDiversity"], r["ArtistDiversity"]) for r in got.collect()} == {1: (2, 2), 2: (0, 1), 3: (2, 1)}


SKEW = dict(
    spark__sql__autoBroadcastJoinThreshold=-1,
    spark__sql__adaptive__autoBroadcastJoinThreshold=-1,
    spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="1KB",
    spark__sql__adaptive__skewJoin__skewedPartitionFactor=2,
    spark__sql__adaptive__advisoryPartitionSizeInBytes="16KB",
    spark__sql__adaptive__coalescePartitions__enabled="false",
)


def skewed_lines(spark, rows=60_000):
    """A third of the lines on one invoice and of one track."""
    hot = F.col("id") % 3 == 0
    return spark.range(0, rows, 1, 8).select(
        F.col("id").alias("InvoiceLineId"),
        F.when(hot, 7).otherwise(F.pmod(F.xxhash64("id"), F.lit(2000))).alias("InvoiceId"),
        F.when(F.col("id") % 3 == 1, 7).otherwise(F.pmod(F.xxhash64("id"), F.lit(500))).alias("TrackId"),
        (F.col("id") % 1000).cast("decimal(18,2)").alias("UnitPrice"),
        F.lit(1).alias("Quantity"),
    )


def test_a_hot_invoice_is_split_by_the_adaptive_join(spark):
    lines = skewed_lines(spark)
    invoices = spark.range(2000).select(
        F.col("id").alias("InvoiceId"),
        F.expr("timestamp_ntz'2021-01-01 00:00:00' + make_dt_interval(cast(id % 700 as int))").alias("InvoiceDate"),
    )
    tracks = spark.range(500).select(F.col("id").alias("TrackId"), (F.col("id") % 50).alias("AlbumId"))
    albums = spark.range(50).select(F.col("id").alias("AlbumId"), (F.col("id") % 9).alias("ArtistId"))
    artists = spark.range(9).select(F.col("id").alias("ArtistId"), F.col("id").cast("string").alias("Name"))
    with conf(spark, **SKEW):
        plan = final_plan(revenue.monthly_top_artist(invoices, lines, tracks, albums, artists))
    assert "SortMergeJoin(skew=true)" in plan


def test_rows_with_a_null_key_are_dealt_out(spark):
    many = spark.range(0, 20_000, 1, 8).select(
        F.when(F.col("id") % 3 > 0, F.col("id") % 100).alias("k"), F.col("id").alias("v")
    )
    one = spark.range(100).select(F.col("id").alias("k"), (F.col("id") * 10).alias("x"))
    with conf(spark, spark__sql__autoBroadcastJoinThreshold=-1,
              spark__sql__adaptive__autoBroadcastJoinThreshold=-1,
              spark__sql__adaptive__coalescePartitions__enabled="false"):
        joined = null_safe_lookup(many, one, "k", spread_by=["v"])
        assert joined.columns == ["k", "v", "x"]
        assert joined.count() == 20_000
        nulls = joined.filter("k is null").withColumn("p", F.spark_partition_id())
        assert nulls.filter("x is not null").count() == 0
        sizes = [r["count"] for r in nulls.groupBy("p").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * min(sizes)


def test_a_hot_key_meets_an_aggregated_side_in_split_tasks(spark):
    """The side with one row per key is partitioned by it already, and is exchanged nevertheless."""
    many = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    one = spark.range(60_000).groupBy(F.col("id").alias("k")).agg(F.sum(F.col("id") * 10).alias("x"))
    with conf(spark, **SKEW):
        joined = join_many_to_one(many, one, "k", bound=spark.range(10**9))
        assert "SortMergeJoin(skew=true)" in final_plan(joined)
        assert joined.columns == ["k", "v", "x"]
        assert joined.count() == many.count() and joined.filter("x != 10 * k").count() == 0


def scans_of_lines(plan):
    return [line for line in plan.splitlines() if "FileScan" in line and "l_extendedprice" in line]


@pytest.mark.parametrize("limit", ["10MB", "-1"])
def test_genre_shares_read_the_lines_once(spark, limit):
    with conf(spark, spark__sql__autoBroadcastJoinThreshold=limit):
        assert len(scans_of_lines(final_plan(entry.queries()["genre_revenue_share"](spark, SF_DIR)))) == 1


def test_broken_lines_are_exchanged_before_they_are_sorted(spark, store):
    """Sampling for the sort then reads shuffle files, not the line table."""
    plan = final_plan(profile.null_cluster_rows(store.invoice_line))
    assert plan.index("rangepartitioning") < plan.index("REPARTITION_BY_COL") < plan.index("FileScan")


def test_audits_push_their_filter(spark, tmp_path):
    spark.range(10).select(F.col("id").alias("CustomerId"), F.col("id").alias("GenreId"), F.col("id").alias("UnitPrice"),
                           F.col("id").alias("Quantity")).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    assert "IsNull(CustomerId)" in planned(profile.audit_orphan_invoices(table))
    assert "IsNull(GenreId)" in planned(profile.audit_null_genre(table))
    plan = planned(profile.audit_broken_lines(table))
    assert "Or(IsNull(UnitPrice),IsNull(Quantity))" in plan


@pytest.mark.parametrize("slice_rows", [1, 7, 100, 10**9])
def test_running_total_is_the_same_for_any_slicing(spark, slice_rows):
    rows = spark.range(0, 3_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 40).alias("g"),
        F.col("id"),
        F.when(F.col("id") % 11 != 0, (F.col("id") * 7919 % 23).cast("decimal(18,2)")).alias("v"),
    )
    got = running_total(
        rows, "g", [("v", True), ("id", False)], "v", running="r", total="t", slice_rows=slice_rows
    )
    rows.createOrReplaceTempView("running_rows")
    want = spark.sql(
        "select g, id, v, sum(v) over (partition by g order by v desc nulls last, id"
        " rows unbounded preceding) r, sum(v) over (partition by g) t from running_rows"
    )
    got = got.select("g", "id", "v", "r", "t")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def task_rows(df):
    """Rows that each task of the last exchange holds."""
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


@pytest.mark.parametrize("hot", ["all", "third"])
def test_a_hot_group_takes_no_task_longer_than_others(spark, hot):
    """Broadcasts off; all rows, or a third of them, in one group: its ranges are spread over the tasks."""
    group = F.lit(0).cast("long") if hot == "all" else F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000)
    rows = spark.range(0, 60_000, 1, 8).select(
        group.alias("g"), "id", F.col("id").cast("decimal(18,2)").alias("v"), F.lit("x").alias("name")
    )
    with conf(spark, **SKEW, spark__sql__shuffle__partitions=32):
        summed = running_total(rows, "g", [("v", True), ("id", False)], "v", running="r", total="t", slice_rows=500)
        assert summed.columns == ["g", "id", "v", "name", "r", "t"]
        plan = final_plan(summed)
        parts = task_rows(summed)
        rows.createOrReplaceTempView("hot_rows")
        want = spark.sql("select *, sum(v) over (partition by g order by v desc, id rows unbounded preceding) r,"
                         " sum(v) over (partition by g) t from hot_rows")
        assert summed.exceptAll(want).count() == 0 and summed.count() == 60_000
    assert "Join" not in plan and "Broadcast" not in plan
    middle = sorted(parts)[len(parts) // 2]
    assert len(parts) >= 30 and max(parts) <= 3 * middle


def test_the_hot_artist_of_the_report_is_split(spark):
    """The report itself, a third of the sold tracks by one artist."""
    lines = spark.range(0, 40_000, 1, 8).select(
        F.col("id").alias("InvoiceLineId"), F.col("id").alias("InvoiceId"), (F.col("id") % 20_000).alias("TrackId"),
        (F.col("id") % 997).cast("decimal(18,2)").alias("UnitPrice"), F.lit(1).alias("Quantity"))
    album = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 300)
    tracks = spark.range(20_000).select(F.col("id").alias("TrackId"), F.col("id").cast("string").alias("Name"), album.alias("AlbumId"))
    albums = spark.range(300).select(F.col("id").alias("AlbumId"), F.col("id").alias("ArtistId"))
    artists = spark.range(300).select(F.col("id").alias("ArtistId"), F.col("id").cast("string").alias("Name"))
    small = sorted(map(tuple, revenue.catalog_pareto(lines, tracks, albums, artists).collect()))
    with conf(spark, **SKEW, spark__sql__shuffle__partitions=32):
        large = revenue.catalog_pareto(lines, tracks, albums, artists, limit=1000, slice_rows=500, ordered=False)
        parts = task_rows(large)
        assert max(parts) <= 3 * sorted(parts)[len(parts) // 2]
        assert sorted(map(tuple, revenue.catalog_pareto(lines, tracks, albums, artists, slice_rows=500).collect())) == small


@pytest.mark.parametrize("rows", [0, 1, 5])
def test_running_total_of_next_to_nothing(spark, rows):
    df = spark.range(rows).select((F.col("id") % 2).alias("g"), "id", F.lit(None).cast("decimal(18,2)").alias("v"))
    for slice_rows in (1, 10**9):
        got = running_total(df, "g", [("id", False)], "v", running="r", total="t", slice_rows=slice_rows)
        assert sorted(map(tuple, got.collect())) == sorted((i % 2, i, None, None, None) for i in range(rows))


def test_leaders_of_a_group_need_no_window(spark):
    counts = spark.createDataFrame(
        [("a", "x", 2), ("a", "y", 2), ("a", "z", 1), ("b", "x", 1), ("c", "x", None), ("c", "y", None),
         (None, "x", 3), (None, "y", None)],
        "g string, v string, n int",
    )
    best = top_ties(counts, ["g"], "n")
    assert "Window" not in planned(best)
    assert best.columns == ["g", "v", "n"]
    assert {tuple(r) for r in best.collect()} == {
        ("a", "x", 2), ("a", "y", 2), ("b", "x", 1), ("c", "x", None), ("c", "y", None), (None, "x", 3)}


def test_a_hot_album_of_ties_is_split(spark):
    """One album with a third of the tracks, all of different composers."""
    tracks = spark.range(0, 3_000, 1, 8).select(
        F.col("id").alias("TrackId"), F.col("id").cast("string").alias("Name"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("AlbumId"),
        F.when(F.col("id") % 100 != 0, F.col("id").cast("string")).alias("Composer"),
    )
    with conf(spark, **SKEW):
        got = impute.impute_candidates(tracks, ties="all")
        # 10 gaps on the hot album (track 1 is on it too), one suggestion per composer there
        assert got.count() == 10 * 991
        first = impute.impute_candidates(tracks)
        assert first.count() == 10
