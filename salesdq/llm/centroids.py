"""Clustering of embeddings around integer centroids, exact, by a progressive search over Walsh-Hadamard coefficients.

The transform has entries of 1 and -1 only, so coefficients are integers, and squared differences of all of them add up to exactly
``width`` times the squared Euclidean distance. They are added up coarse to fine (by number of sign changes): what a centroid has
gathered so far only grows, so one that has gathered more than a finished rival is strictly worse and is left out; those left finish
all coefficients, ties included. Vectors are read anew in each round and never shuffled: a task returns a row of
sums for each centroid.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesdq.llm import shared

CLUSTERS, ROUNDS, WIDTH, SCALE = 16, 3, 64, 64
#: Components beyond this, either way, count as this: it keeps a task's sums of up to FLUSH vectors within 64 bits.
MOST, FLUSH = 1 << 40, 1 << 22
#: Up to this, coefficients, their squared differences and the sums of those fit 64 bits; beyond, Python's integers take over.
NATIVE = 1 << 21
LONGEST = (1 << 63) - 1
#: Vectors that are compared at a time.
SLICE = 4096


@lru_cache
def sequency(width: int) -> np.ndarray:
    """The transform's coefficients in order of their number of sign changes: coarse to fine."""
    rows = _butterflies(np.eye(width, dtype=np.int64))
    return np.argsort((rows[:, 1:] != rows[:, :-1]).sum(axis=1), kind="stable")


def _butterflies(v: np.ndarray) -> np.ndarray:
    n, width = v.shape
    half = 1
    while half < width:
        pairs = v.reshape(n, width // (2 * half), 2, half)
        a, b = pairs[:, :, 0], pairs[:, :, 1]
        v = np.stack([a + b, a - b], axis=2).reshape(n, width)
        half *= 2
    return v


def transform(vectors: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of integer rows, coarse to fine; the width is a power of two."""
    return _butterflies(vectors)[:, sequency(vectors.shape[1])]


def nearest(points: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest center of each point (ties: the smaller number), its squared distance, and how many centers each point finished.

    Both are transformed; centers are one or more.
    """
    n, width = points.shape
    levels = [w for w in (4, 8, 16, 32) if w < width] + [width]
    first = levels[0]
    gathered = sum((points[:, i, None] - centers[None, :, i]) ** 2 for i in range(first))
    leader = gathered.argmin(axis=1)
    bound = ((points - centers[leader]) ** 2).sum(axis=1)
    row, center = np.nonzero(gathered <= bound[:, None])
    so_far = gathered[row, center]
    for start, end in zip(levels, levels[1:]):
        so_far = so_far + ((points[row, start:end] - centers[center, start:end]) ** 2).sum(axis=1)
        alive = so_far <= bound[row]
        row, center, so_far = row[alive], center[alive], so_far[alive]
    order = np.lexsort((center, so_far, row))
    row, center, so_far = row[order], center[order], so_far[order]
    begins = np.searchsorted(row, np.arange(n))
    return center[begins], so_far[begins] // width, np.bincount(row, minlength=n)


def integers(vectors: pa.Array, width: int = WIDTH, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """Places of the rows that count (``width`` components, none null or not finite), and their floor(scale * x)."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    long = np.asarray(vectors.value_lengths().fill_null(-1)) == width
    at = np.flatnonzero(long & np.asarray(vectors.is_valid()))
    flat = vectors.take(pa.array(at)).flatten().cast(pa.float64())
    missing = np.asarray(flat.is_null()).reshape(-1, width).any(axis=1)
    values = np.asarray(flat.fill_null(0.0)).reshape(-1, width)
    good = ~missing & np.isfinite(values).all(axis=1)
    with np.errstate(over="ignore"):
        scaled = np.clip(np.floor(scale * values[good]), -MOST, MOST)
    return at[good], scaled.astype(np.int64)


def _assigned(v: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cluster and squared distance of each integer row, by slices."""
    labels, distances = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i in range(0, len(v), SLICE):
        part = v[i : i + SLICE]
        native = max(np.abs(part).max(), np.abs(centers).max()) <= NATIVE
        a, b = (part, centers) if native else (part.astype(object), centers.astype(object))
        label, distance, _ = nearest(transform(a), transform(b))
        labels.append(label)
        distances.append(distance if native else np.array([min(int(d), LONGEST) for d in distance], np.int64))
    return np.concatenate(labels), np.concatenate(distances)


def _source(vectors: DataFrame) -> DataFrame:
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))


def _first_centers(source: DataFrame, clusters: int, width: int) -> list[list[int]]:
    """The vectors with the least hashes; each task names its own few, so at most ``clusters`` rows reach the driver."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: list[tuple[str, list[int]]] = []
        for batch in parts:
            at, v = integers(batch.column("embedding"), width)
            ids = batch.column("vec_id").take(pa.array(at)).to_pylist()
            hashes = [hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest() for i in ids]
            limit = least[-1][0] if len(least) == clusters else "g"  # behind every hexadecimal text
            found = [(h, row.tolist()) for h, row in zip(hashes, v) if h <= limit]
            least = heapq.nsmallest(clusters, least + found)
        columns = [pa.array([h for h, _ in least], pa.string()), pa.array([v for _, v in least], pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["h", "v"])

    found = source.mapInArrow(run, "h string, v array<long>").orderBy("h", "v").limit(clusters)
    return [list(r["v"]) for r in found.collect()]


def _moved(source: DataFrame, centers: list[list[int]], width: int) -> list[list[int]]:
    """The centers after one round: floor of each cluster's mean; one without vectors stays."""
    fixed = np.array(centers, np.int64)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros_like(fixed), np.zeros(len(fixed), np.int64)

        def taken() -> pa.RecordBatch:
            met = np.flatnonzero(counts)
            columns = [np.repeat(met, width), np.tile(np.arange(width), len(met)), np.repeat(counts[met], width), sums[met].ravel()]
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64())
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["cluster", "i", "n", "s"])
            sums[:], counts[:] = 0, 0
            return batch

        for batch in parts:
            _, v = integers(batch.column("embedding"), width)
            if counts.sum() + len(v) > FLUSH:
                yield taken()
            label, _ = _assigned(v, fixed)
            for j in np.unique(label):
                mine = v[label == j]
                sums[j] += mine.sum(axis=0)
                counts[j] += len(mine)
        yield taken()

    partial = source.mapInArrow(run, "cluster int, i int, n long, s long").groupBy("cluster", "i")
    after = [list(c) for c in centers]
    for r in partial.agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect():  # one for each component
        after[r["cluster"]][r["i"]] = int(r["s"]) // r["n"]
    return after


def cluster_vectors(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, width: int = WIDTH) -> tuple[DataFrame, list[list[int]]]:
    """Per vector vec_id, cluster and distance (squared), stored; and the final centroids.

    Kept are vectors of exactly ``width`` components (a power of two), none null or not finite; component x counts as floor(64 * x).
    Centroids start as the kept vectors with the least SHA-256 of ``1:<vec_id>``; vectors that share an id and so a
    hash go by their components, and a null id is hashed as no digits at all. Every repeated row counts. Fewer vectors than ``clusters`` make fewer
    centroids; none give no rows. Components beyond 2^40 count as 2^40, distances beyond a long as the largest long. Other
    columns are left out.
    """
    source = _source(vectors)
    centers = _first_centers(source, clusters, width)
    schema = T.StructType().add("vec_id", T.LongType()).add("cluster", T.IntegerType()).add("distance", T.LongType())
    if not centers:
        return vectors.sparkSession.createDataFrame([], schema), []
    for _ in range(rounds):
        centers = _moved(source, centers, width)
    fixed = np.array(centers, np.int64)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            at, v = integers(batch.column("embedding"), width)
            label, distance = _assigned(v, fixed)
            columns = [batch.column("vec_id").take(pa.array(at)), pa.array(label, pa.int32()), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    return shared.stored(source.mapInArrow(run, schema), "assigned"), centers


def with_inertia(assigned: DataFrame, centers: list[list[int]]) -> DataFrame:
    """Adds the sums of distances over each cluster and over all, and the SHA-256 of the cluster's centroid."""
    spark = assigned.sparkSession
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # a row for each cluster
    whole = min(sum(int(r["s"]) for r in sums), LONGEST)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    rows = [(r["cluster"], min(int(r["s"]), LONGEST), whole, digests[r["cluster"]]) for r in sums]
    facts = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op11_centroid_clusters(spark, sf_dir: str) -> DataFrame:
    """Clusters of all embeddings: 16 centroids, 3 rounds."""
    return with_inertia(*cluster_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))


def _sql() -> str:
    """The same in DuckDB's SQL: every vector against every centroid, component by component."""
    steps = [r"""
kept as materialized (
  select row_number() over () as k, vec_id, embedding from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
parts as materialized (select k, i, floor(64 * x::double)::bigint as x from (
  select k, unnest(embedding) as x, unnest(range(64)) as i from kept)),
seeds as (select k, row_number() over (order by sha256('1:' || vec_id)) - 1 as c from kept),
c0 as materialized (select c, i, x from seeds join parts using (k) where c < 16)"""]
    for r in range(4):
        steps.append(f"""
d{r} as (select k, c, sum((p.x - q.x) * (p.x - q.x))::bigint as d from parts p join c{r} q using (i) group by k, c),
a{r} as materialized (select k, arg_min(c, (d, c)) as c, min(d) as d from d{r} group by k)""")
        if r < 3:
            steps.append(f"""
m{r} as (select c, i, sum(x)::bigint as s, count(*)::bigint as n from parts join a{r} using (k) group by c, i),
c{r + 1} as materialized (
  select c, i, coalesce((m.s - ((m.s % m.n) + m.n) % m.n) // m.n, o.x) as x from c{r} o left join m{r} m using (c, i))""")
    steps.append("""
digests as (select c, sha256(string_agg(x::varchar, ',' order by i)) as centroid_sha256 from c3 group by c)""")
    return f"""with {','.join(steps)}
select vec_id::bigint as vec_id, c::int as cluster, d as distance, (sum(d) over (partition by c))::bigint as cluster_inertia,
  (sum(d) over ())::bigint as inertia, centroid_sha256
from a3 join kept using (k) join digests using (c)"""


SQL = _sql()
