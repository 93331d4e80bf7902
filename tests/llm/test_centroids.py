"""Centroid clustering against brute force in Python's integers."""

from __future__ import annotations

import hashlib
import math

import numpy as np

from tripweave.llm import centroids as C

SCHEMA = "vec_id long, embedding array<double>, cluster int, distance string"


def brute(rows, k=16, rounds=3, dims=64, scale=64):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if i is not None and v is not None and len(v) == dims and all(x is not None and math.isfinite(x) and math.isfinite(x * scale) for x in v)]
    cent = [v for _, v in sorted(kept, key=lambda r: (hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cent)) for _, v in kept]

    for _ in range(rounds):
        own = assign()
        for n in range(len(cent)):
            mine = [v for (_, v), (_, m) in zip(kept, own) if m == n]
            if mine:
                cent[n] = [sum(x) // len(mine) for x in zip(*mine)]
    own = assign()
    top = 2**63 - 1
    part = {}
    for d, n in own:
        part[n] = part.get(n, 0) + min(d, top)
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cent]
    return sorted((i, n, min(d, top), min(part[n], top), min(sum(part.values()), top), sha[n]) for (i, _), (d, n) in zip(kept, own))


def got(df, **kw):
    return sorted(tuple(r) for r in C.cluster(df, **kw).collect())


def test_the_smaller_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert got(df) == brute(rows)


def test_ties_repeated_and_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in rng.integers(-2, 3, 4) / 64]) for i in range(300)]
    rows += [(5, rows[5][1]), (5, [0.0, 0.0, 0.0, 1.0]), (None, [1.0] * 4), (400, None), (401, [1.0, None, 1.0, 1.0]), (402, [1.0] * 3), (403, []),
             (404, [float("nan")] * 4), (405, [float("inf"), 0.0, 0.0, 0.0]), (406, [1e308, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA).repartition(5)
    assert got(df, k=7, dims=4) == brute(rows, k=7, dims=4)
    few = df.filter("vec_id < 3")
    assert got(few, dims=4) == brute([r for r in rows if r[0] is not None and r[0] < 3], dims=4)
    assert got(df.limit(0), dims=4) == [] and got(df.filter("vec_id = 402"), dims=4) == []


def test_all_equal_and_a_hot_cluster(spark):
    rows = [(i, [0.5] * 4) for i in range(200)] + [(200 + i, [float(i), 0.0, 0.0, -float(i)]) for i in range(5)]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)
    assert got(df, k=4, dims=4) == brute(rows, k=4, dims=4)
    assert got(df.filter("vec_id < 200"), k=4, dims=4) == brute(rows[:200], k=4, dims=4)


def test_huge_components_are_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 3) * 10.0 ** rng.integers(-2, 35)]) for i in range(60)]
    rows += [(100, [1e300, -1e300, 3.0]), (101, [2.0**26, -(2.0**26), 0.5]), (102, [-7e18, 1.0, 1.0])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA).repartition(3)
    assert got(df, k=6, dims=3) == brute(rows, k=6, dims=3)


def test_bounds_spare_distances():
    """Pivot bounds give the same result as measuring all, with fewer exact distances on clustered vectors."""
    rng = np.random.default_rng(7)
    centers = rng.integers(-4000, 4000, (16, 64))
    rows = (centers[rng.integers(0, 16, 2000)] + rng.integers(-100, 100, (2000, 64))).astype(np.int64)
    pivots = C.far_apart(rows[:256], C.PIVOTS)
    cluster, squares, measured = C.nearest(rows, C._to_pivots(rows, pivots), centers, C._to_pivots(centers, pivots))
    full = ((rows[:, None, :] - centers) ** 2).sum(axis=2)
    assert (cluster == full.argmin(axis=1)).all() and (squares == full.min(axis=1)).all()
    assert measured < 2000 * 4
