"""Every report against independent SQL: on the benchmark's tables, and with its
own default thresholds on small stores full of edge cases, both as small data is
planned and as large data is planned."""

import duckdb
import pytest
from compare import assert_same
from stores import hand_store, random_store, to_duckdb, to_spark

import __spark_entry__ as entry
from oracles.reports import REPORTS, report_sql
from salesdq.operators import profile

SF_DIR = "/root/testdata/sf0.001"
SOURCES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
# thresholds the reports have by default
DEFAULTS = dict(
    title="Sales Support Agent", low=20, high=50, purchases=2, category="Classical", drop=70, days=60
)
TUNED = ("title", "cuts", "min_purchases", "category", "ratio", "min_days", "pairs_unique")
STORES = {"hand": hand_store, "random": lambda: random_store(1)}


@pytest.fixture(scope="module")
def benchmark_tables():
    connection = duckdb.connect()
    for table in SOURCES:
        connection.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    return connection


@pytest.fixture(scope="module", params=list(STORES))
def small_store(request, spark):
    store = STORES[request.param]()
    connection = duckdb.connect()
    to_duckdb(connection, store)
    tables = {name: df.cache() for name, df in to_spark(spark, store).items()}
    for df in tables.values():
        df.count()  # a filled cache knows its size, which decides on broadcasts
    tables |= {"purchase": tables["invoice"], "purchase_line": tables["invoice_line"]}
    yield tables, connection
    for df in tables.values():
        df.unpersist()


@pytest.fixture
def planned_as_large(spark, monkeypatch):
    """No broadcasts by size, and slices of three rows."""
    monkeypatch.setattr("salesdq.plans.ranking.SLICE_ROWS", 3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_every_query_has_an_oracle():
    assert set(entry.report_queries()) == set(REPORTS) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() == 5


@pytest.mark.parametrize("name", list(REPORTS))
def test_on_benchmark_tables(spark, benchmark_tables, name):
    result = entry.queries()[name](spark, SF_DIR)
    rows = assert_same(result, benchmark_tables, entry.oracle_sql()[name], name)
    assert rows > 0
    described = benchmark_tables.execute("describe " + entry.oracle_sql()[name]).fetchall()
    spark_types = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
                   "timestamp_ntz": "TIMESTAMP"}
    assert {c: spark_types[t] for c, t in result.dtypes} == {row[0]: row[1] for row in described}


def _on_store(name, tables):
    if name == "null_rate_by_table":
        return entry._comparable(
            profile.null_rate_by_table(
                {
                    "InvoiceLine": (tables["invoice_line"], ("UnitPrice", "Quantity", "TrackId")),
                    "Track": (tables["track"], ("GenreId", "AlbumId")),
                    "Customer": (tables["customer"], ("Email", "Country")),
                }
            )
        )
    build, inputs, params = entry.QUERIES[name]
    kept = {k: v for k, v in params.items() if k not in TUNED}
    result = entry._comparable(build(*[tables[t] for t in inputs], **kept))
    return entry._settled(name, result)


@pytest.mark.parametrize("price", ["decimal(10,2)", "decimal(18,2)", "double"])
def test_types_depend_on_no_plan_and_no_price_type(spark, small_store, price):
    """Money has its declared type whether tables are small or large, and however prices are stored."""
    tables, _ = small_store
    retyped = {n: df.withColumns({c: df[c].cast(price) for c in ("UnitPrice", "Total") if c in df.columns})
               for n, df in tables.items()}
    found = []
    for limit in ("10MB", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            found.append({
                name: build(*[retyped[t] for t in inputs], **{k: v for k, v in params.items() if k not in TUNED}).dtypes
                for name, (build, inputs, params) in entry.QUERIES.items()})
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found[0] == found[1]
    sums = {name: t for name, types in found[0].items() for c, t in types if c in ("Revenue", "TotalRevenue", "MonthlyRevenue")}
    assert set(sums.values()) == {"decimal(38,2)"}, sums


def _check(name, small_store):
    tables, connection = small_store
    sql = report_sql(name, **DEFAULTS)
    # ids are INT here, BIGINT in the benchmark; the comparison is by value
    assert_same(_on_store(name, tables), connection, sql, name)


# stored and read back; the reports themselves are tried under their own names
LOADS = {"null_profile_load", "fix_candidates_load", "group_missing_risk_load", "impute_load", "impute_load_first"}
ON_STORES = [name for name in REPORTS if name not in LOADS]


@pytest.mark.parametrize("name", ON_STORES)
def test_on_small_stores(small_store, name):
    _check(name, small_store)


@pytest.mark.parametrize("name", ON_STORES)
def test_on_small_stores_planned_as_large(small_store, planned_as_large, name):
    _check(name, small_store)
