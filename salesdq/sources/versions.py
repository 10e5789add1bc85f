"""Tables as versions: folders that are written once, and a mark that names the current one.

A table's folder holds ``_versions/<version>``, each a whole copy, and ``_commits``, in which every finished load leaves an
empty file named ``<number>.<version>``. The file with the highest number names the table's current version. To create an empty
file is one step in any file system and in any object store; nothing is ever renamed or overwritten, so readers see
the old table or the new one, whole. The leading underscores keep a plain read of the table's folder from mixing versions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Versions that stay after a load: the current one, and one for those who still read the one before.
KEEP = 2


def _files(spark: SparkSession, path: str):
    """The file system and the path, as Hadoop has them."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def place(destination: str, version: str) -> str:
    return f"{destination.rstrip('/')}/_versions/{version}"


def _commits(spark: SparkSession, destination: str) -> list[tuple[int, str]]:
    """Numbers and versions, the current one last; of loads that took one number at a time the greater name counts."""
    files, folder = _files(spark, f"{destination.rstrip('/')}/_commits")
    if not files.exists(folder):
        return []
    names = (status.getPath().getName().split(".", 1) for status in files.listStatus(folder))
    return sorted((int(number), version) for number, version in names)


def current(spark: SparkSession, destination: str) -> str | None:
    """Name of the current version, or None."""
    commits = _commits(spark, destination)
    return commits[-1][1] if commits else None


def written(df: DataFrame, destination: str, file_format: str) -> str:
    """Write a version and return its name; nobody reads it until it is committed."""
    version = f"v-{uuid.uuid4().hex}"
    df.write.format(file_format).save(place(destination, version))
    return version


def commit(spark: SparkSession, destination: str, version: str) -> None:
    """Make a written version the current one."""
    commits = _commits(spark, destination)
    number = commits[-1][0] + 1 if commits else 1
    files, mark = _files(spark, f"{destination.rstrip('/')}/_commits/{number:020d}.{version}")
    files.create(mark, False).close()


def discard(spark: SparkSession, destination: str, version: str) -> None:
    """Remove a version that was not committed."""
    files, folder = _files(spark, place(destination, version))
    files.delete(folder, True)


def remove_old(spark: SparkSession, destination: str, keep: int = KEEP) -> None:
    """Remove committed versions but the last ``keep``; the marks go first, so none names what is no longer there."""
    if keep < 1:
        raise ValueError("the current version must stay")
    for number, version in _commits(spark, destination)[:-keep]:
        files, mark = _files(spark, f"{destination.rstrip('/')}/_commits/{number:020d}.{version}")
        files.delete(mark, False)
        discard(spark, destination, version)


def remove_unfinished(spark: SparkSession, destination: str, older_than_hours: float = 24.0) -> int:
    """Remove versions that a failed load left behind, and return their number; younger ones may belong to a load that still runs."""
    files, folder = _files(spark, f"{destination.rstrip('/')}/_versions")
    if not files.exists(folder):
        return 0
    finished = {version for _, version in _commits(spark, destination)}
    before = spark.sparkContext._jvm.java.lang.System.currentTimeMillis() - older_than_hours * 3_600_000
    left = [s for s in files.listStatus(folder) if s.getPath().getName() not in finished and s.getModificationTime() <= before]
    for status in left:
        files.delete(status.getPath(), True)
    return len(left)
