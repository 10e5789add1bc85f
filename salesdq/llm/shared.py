"""Tables written between two steps, in the folder that all executors share."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def folder(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``; a folder of this machine only in local mode without that setting."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="corpus-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: While a table is written: shuffle files go when the query ends, as nothing reads them again; and batches of rows for Python workers end at
#: so many bytes, or 10,000 long texts at once would take up tens of MB in the worker and several times that in the JVM, in every task.
WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}


@contextmanager
def _writing(spark: SparkSession) -> Iterator[None]:
    """What is written inside is written under WRITING."""
    before = {name: spark.conf.get(name, None) for name in WRITING}
    for name, value in WRITING.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: its lineage ends there, and a lost executor costs no rerun."""
    spark = df.sparkSession
    path = folder(spark, name)
    with _writing(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, keys: list[str], buckets: int) -> tuple[DataFrame, str]:
    """Like ``stored``, as an external table of ``buckets`` buckets by ``keys``, so that a join on them shuffles only its other side;
    and the table's name, to be dropped from the catalog when it has served.

    ``df`` should be partitioned by the keys into as many partitions already; each then writes one bucket.
    """
    spark, table = df.sparkSession, f"{name}_{uuid.uuid4().hex}"
    with _writing(spark):
        df.write.bucketBy(buckets, *keys).option("path", folder(spark, name)).format("parquet").saveAsTable(table)
    return spark.table(table), table


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have: ``name``, behind as many underscores as it takes."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def row_key() -> Column:
    """A hash of doc_id and text, null-safe: rows agree in it if they agree in both."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def partitions(df: DataFrame) -> int:
    """Partitions for what is as large as ``df``: those it is read in, or the session's shuffle partitions if more."""
    return max(df.rdd.getNumPartitions(), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, unless their PYTHONPATH has it already."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    context = spark.sparkContext
    if root in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(context, "_corpus_shipped", False):
        return
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="corpus-"), "salesdq"), "zip", root, "salesdq")
    context.addPyFile(archive)
    context._corpus_shipped = True
