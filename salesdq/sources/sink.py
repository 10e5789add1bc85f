"""Storing report results as tables with a declared shape."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesdq.functions import any_null
from salesdq.sources import versions

# fixed values: the result tables, their columns and types
RESULT_TABLES = {
    "MissingValuesCustomer": T.StructType()
    .add("TotalCustomerCount", T.LongType())
    .add("MissingCompanyNumber", T.LongType())
    .add("MissingCompanyRatio", T.DoubleType())
    .add("UnknownStateNumber", T.LongType())
    .add("UnknownStateRatio", T.DoubleType())
    .add("PredictableStateNumber", T.LongType())
    .add("PredictableStateRatio", T.DoubleType()),
    "FixCandidateCustomers": T.StructType()
    .add("CustomerId", T.LongType())
    .add("FirstName", T.StringType())
    .add("LastName", T.StringType())
    .add("Company", T.StringType())
    .add("City", T.StringType())
    .add("Country", T.StringType())
    .add("State", T.StringType()),
    "countryMissingRisk": T.StructType()
    .add("country", T.StringType(), nullable=False)
    .add("totalCustomer", T.LongType())
    .add("missingCompanyNumber", T.LongType())
    .add("missingStateNumber", T.LongType())
    .add("missingScore", T.DoubleType())
    .add("riskLevel", T.StringType()),
}
RESULT_KEYS = {"countryMissingRisk": ("country",)}


class KeyViolation(ValueError):
    """A load would store a missing or repeated key."""


def check_key(df: DataFrame, key: Sequence[str]) -> None:
    """Raise unless ``key`` is present and unique; counts per key, fetches one offender."""
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_rows"))
    offender = per_key.filter((F.col("_rows") > 1) | any_null(key)).limit(1).collect()
    if offender:
        values = ", ".join(f"{k}={offender[0][k]!r}" for k in key)
        raise KeyViolation(f"{values} occurs {offender[0]['_rows']} time(s)")


def _shaped(df: DataFrame, schema: T.StructType | None) -> DataFrame:
    return df if schema is None else df.select(*[F.col(f.name).cast(f.dataType) for f in schema])


def load(
    df: DataFrame,
    destination: str,
    *,
    schema: T.StructType | None = None,
    key: Sequence[str] = (),
    file_format: str = "parquet",
    keep: int = versions.KEEP,
) -> DataFrame:
    """Replace the table at ``destination`` by ``df`` and return what was stored.

    With ``schema`` columns are cast to the declared types. The rows are written
    once, as a new version of the table; a key is checked on what was written;
    then the version is named the current one, in a single step (``sources.versions``).
    Whatever fails before leaves the table as it was, and whoever reads it meanwhile has the
    old version, whole. ``keep`` versions stay, so that readers can finish.
    """
    spark, shaped = df.sparkSession, _shaped(df, schema)
    version = versions.written(shaped, destination, file_format)
    stored = spark.read.format(file_format).schema(shaped.schema).load(versions.place(destination, version))
    _checked(stored, key, destination, version)
    versions.commit(spark, destination, version)
    versions.remove_old(spark, destination, keep)
    return stored


def read_loaded(
    spark: SparkSession, destination: str, *, schema: T.StructType | None = None, file_format: str = "parquet"
) -> DataFrame:
    """The current version of a table that ``load`` stored; it does not change under the reader."""
    version = versions.current(spark, destination)
    if version is None:
        raise FileNotFoundError(f"nothing was loaded to {destination}")
    reader = spark.read.format(file_format)
    return (reader if schema is None else reader.schema(schema)).load(versions.place(destination, version))


def _checked(stored: DataFrame, key: Sequence[str], destination: str, version: str) -> None:
    if not key:
        return
    try:
        check_key(stored, key)
    except KeyViolation:
        versions.discard(stored.sparkSession, destination, version)
        raise


def load_result(df: DataFrame, table: str, destination: str) -> DataFrame:
    """Store one of the declared result tables."""
    return load(df, destination, schema=RESULT_TABLES[table], key=RESULT_KEYS.get(table, ()))


def load_catalog_table(
    df: DataFrame,
    table: str,
    *,
    schema: T.StructType | None = None,
    key: Sequence[str] = (),
    location: str | None = None,
    keep: int = versions.KEEP,
) -> DataFrame:
    """Replace a catalog table by ``df`` and return the table.

    Versions lie below ``location`` (by default beside the warehouse's tables), and the catalog's entry
    points to the current one; a load writes and checks the next, then moves the entry to it by one
    change in the catalog. The table is never missing, never half written, and keeps its columns: a load with others is refused. As
    with any external table, dropping it leaves its files.
    """
    spark, shaped = df.sparkSession, _shaped(df, schema)
    exists = spark.catalog.tableExists(table)
    columns = [(f.name, f.dataType) for f in shaped.schema]
    if exists and [(f.name, f.dataType) for f in spark.table(table).schema] != columns:
        raise ValueError(f"{table} has other columns than what is to be loaded")
    if location is None:
        location = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{table}.versions"
    version = versions.written(shaped, location, "parquet")
    path = versions.place(location, version)
    _checked(spark.read.schema(shaped.schema).parquet(path), key, location, version)
    versions.commit(spark, location, version)
    if exists:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        spark.catalog.refreshTable(table)
    else:
        spark.catalog.createTable(table, path=path, source="parquet", schema=T.StructType([T.StructField(n, t) for n, t in columns]))
    versions.remove_old(spark, location, keep)
    return spark.table(table)
