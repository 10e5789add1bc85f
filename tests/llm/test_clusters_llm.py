"""Clustering of vectors against a brute-force version in Python's integers."""

import hashlib
import math

import numpy as np
import pyarrow as pa
import pytest

from salesdq.llm import centroids


def brute_force(rows, clusters, rounds, width):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v):
            ints = [max(-centroids.MOST, min(centroids.MOST, math.floor(64 * float(x)))) for x in v]
            kept.append((i, ints))
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centers = [list(v) for _, v in order[:clusters]]

    def assign():
        out = []
        for i, v in kept:
            d, c = min((sum((a - b) ** 2 for a, b in zip(v, center)), c) for c, center in enumerate(centers))
            out.append((i, c, d, v))
        return out

    for _ in range(rounds):
        members = [[] for _ in centers]
        for _, c, _, v in assign():
            members[c].append(v)
        centers = [[sum(col) // len(vs) for col in zip(*vs)] if vs else old for old, vs in zip(centers, members)]
    final = assign() if kept else []
    inertia = {c: sum(d for _, k, d, _ in final if k == c) for c in range(len(centers))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    top = centroids.LONGEST
    return sorted(
        ((str(i), c, min(d, top), min(inertia[c], top), min(sum(inertia.values()), top), digest[c]) for i, c, d, _ in final)
    )


def table(spark, rows):
    return spark.createDataFrame([(i, v, 7, "x") for i, v in rows], "vec_id long, embedding array<double>, cluster int, distance string").repartition(3)


def result(df, clusters, rounds, width):
    out = centroids.with_inertia(*centroids.cluster_vectors(df, clusters, rounds, width))
    return sorted((str(r[0]), *r[1:]) for r in map(tuple, out.collect()))


@pytest.mark.parametrize("width", [2, 8, 64])
def test_transform_keeps_distances(width):
    rng = np.random.default_rng(width)
    v = rng.integers(-500, 500, (20, width))
    t = centroids.transform(v)
    a, b = v[:, None] - v[None], t[:, None] - t[None]
    assert ((b * b).sum(2) == width * (a * a).sum(2)).all()
    changes = [(np.diff(np.sign(r)) != 0).sum() for r in centroids.transform(np.eye(width, dtype=np.int64)).T]
    assert changes == list(range(width))  # coarse to fine


@pytest.mark.parametrize("kind", [np.int64, object])
def test_search_equals_all_distances_and_leaves_out_worse_ones(kind):
    rng = np.random.default_rng(1)
    centers = rng.integers(-300, 300, (16, 64)).astype(kind)
    centers[5] = centers[3]  # a tie for all
    points = np.concatenate([centers[rng.integers(0, 16, 200)] + rng.integers(-20, 20, (200, 64)), np.zeros((3, 64), kind)])
    label, distance, finished = centroids.nearest(centroids.transform(points), centroids.transform(centers))
    every = ((points[:, None] - centers[None]) ** 2).sum(2)
    assert (label == every.argmin(1)).all() and (distance == every.min(1)).all()
    assert finished.min() >= 1 and finished[:200].mean() < 4  # of 16


@pytest.mark.parametrize("clusters, rounds", [(4, 3), (16, 2), (40, 1)])
def test_clusters_equal_brute_force(spark, corpus, clusters, rounds):
    rng = np.random.default_rng(clusters)
    rows = [(i, (rng.normal(size=8) + 3 * (i % 5)).tolist()) for i in range(60)]
    same = rows[7][1]
    rows += [(100 + i, same) for i in range(40)]  # a vector that holds a third of the rows
    rows += [(8, rows[8][1]), (8, [0.0] * 8), (None, [0.5] * 8), (None, [0.5] * 8)]  # repeated and null ids
    rows += [(200, None), (201, []), (202, [1.0] * 7), (203, [1.0] * 7 + [None]), (204, [float("nan")] * 8), (205, [float("inf")] + [0.0] * 7)]
    assert result(table(spark, rows), clusters, rounds, 8) == brute_force(rows, clusters, rounds, 8)


def test_huge_components_and_few_vectors(spark, corpus):
    rows = [(1, [1e300, -1e300, 0.0, 0.0]), (2, [3e4, 0.0, 0.0, 0.0]), (3, [40000.0, -5e4, 1e9, 0.0]), (4, [0.25, -0.01, 0.0, 0.0])]
    assert result(table(spark, rows), 2, 2, 4) == brute_force(rows, 2, 2, 4)
    assert result(table(spark, rows[:1]), 16, 3, 4) == brute_force(rows[:1], 16, 3, 4)
    assert result(table(spark, rows).limit(0), 16, 3, 4) == []
    assert centroids.integers(pa.array([None, [1.0, None]], pa.list_(pa.float64())), 2)[0].tolist() == []
