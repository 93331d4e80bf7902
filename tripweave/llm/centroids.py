"""Operator 12: centroid clustering with a LAESA pivot table, in exact integers.

Vectors become integers floor(64 * x).  A few pivots are fixed once, far apart
from each other, and every vector's distances to them are stored beside it.  In
each round the driver holds only the centroids and their distances to the
pivots.  A task bounds the distance of a vector to a centroid from below by the
greatest difference of their distances to a pivot, measures the centroid of the
least bound exactly, and then only those whose bound does not exceed what was
found.  Bounds are doubles with room for rounding; distances are exact.

A round is one pass over the stored table: tasks send a sum per centroid and
component, Spark adds them up, and the driver gets ``k`` * ``dims`` sums.

Rules: vectors null, of another length, or with null, not finite or (scaled) not
finite components take no part, nor do rows without an id; repeated rows count
as often as they occur; equal hashes of starting rows (repeated ids) go by the
vectors' values; with fewer vectors than ``k`` there are that many centroids; an
empty table gives no rows.  Sums and distances of huge components are exact as
well (Python's integers); a distance or inertia beyond a long is held at its bound.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tripweave.llm.common import table
from tripweave.llm.vectors import matrices, usable
from tripweave.session import stored

SCALE, DIMS, K, ROUNDS, SEED = 64, 64, 16, 3, 1
#: Pivots, and the rows (smallest hashes) that they are chosen from.
PIVOTS, SAMPLE = 8, 256
#: Components below this keep squared distances of 64 and more dimensions within a long.
_NARROW = 2.0**26
_LIMB, _LONG = 30, 2**63 - 1
_ROUNDING = 1e-9


def _integers(rows: np.ndarray, wide: bool) -> np.ndarray:
    """Integer-valued doubles as integers: 64-bit, or Python's where one row of the table is beyond them."""
    return np.array([[int(x) for x in r] for r in rows], object).reshape(rows.shape) if wide else rows.astype(np.int64)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return (d * d).sum(axis=1)


def _root(squares: np.ndarray) -> np.ndarray:
    if squares.dtype != object:
        return np.sqrt(squares.astype(np.float64))
    return np.array([math.sqrt(x) if x < 1 << 1000 else math.inf for x in squares])


def _to_pivots(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.stack([_root(_squares(rows, p)) for p in pivots], axis=1)


def far_apart(rows: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` different rows, each the farthest from those taken before (first: the first row)."""
    chosen = [0]
    away = _root(_squares(rows, rows[0]))
    while len(chosen) < n and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, _root(_squares(rows, rows[chosen[-1]])))
    return rows[chosen]


def nearest(rows: np.ndarray, near: np.ndarray, centroids: np.ndarray, centroid_near: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(number of the nearest centroid, squared distance, exact distances taken); ties go to the smaller number.

    ``near`` and ``centroid_near`` are distances to the pivots.
    """
    n = len(rows)
    with np.errstate(invalid="ignore"):  # beyond doubles: a bound of nan keeps the centroid
        low = np.zeros((n, len(centroids)))
        for d, c in zip(near.T, centroid_near.T):
            low = np.maximum(low, np.abs(d[:, None] - c) - _ROUNDING * (d[:, None] + c))
    cluster = np.where(np.isnan(low), 0.0, low).argmin(axis=1)
    best = _squares(rows, centroids[cluster])
    reach = _root(best) * (1 + _ROUNDING)
    first, measured = cluster.copy(), n
    for c in range(len(centroids)):
        at = np.flatnonzero(~(low[:, c] > reach) & (first != c))
        measured += len(at)
        d = _squares(rows[at], centroids[c])
        closer = (d < best[at]) | ((d == best[at]) & (c < cluster[at]))
        at, d = at[closer], d[closer]
        cluster[at], best[at] = c, d
        reach[at] = _root(d) * (1 + _ROUNDING)
    return cluster, best, measured


def _measured(vectors: DataFrame, pivots: np.ndarray, wide: bool) -> DataFrame:
    """The pivot table: every vector with its distances to the pivots."""
    def run(batches):
        for batch in batches:
            for at, m in matrices(batch):
                near = _to_pivots(_integers(m, wide), pivots)
                yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(at)), pa.array(list(m)), pa.array(list(near))], names=["vec_id", "vector", "near"])

    return vectors.mapInArrow(run, "vec_id long, vector array<double>, near array<double>")


def _parts(batches, centroids: np.ndarray, pivots: np.ndarray, wide: bool):
    """(ids, integer rows, cluster, squared distance) of the batches of a pivot table."""
    centroid_near = _to_pivots(centroids, pivots)
    for batch in batches:
        near = np.stack(batch.column("near").to_numpy(zero_copy_only=False)) if batch.num_rows else None
        for at, m in matrices(batch):
            rows = _integers(m, wide)
            cluster, squares, _ = nearest(rows, near[at], centroids, centroid_near)
            yield batch.column("vec_id").take(pa.array(at)), rows, cluster, squares


def _limbs(value: int, n: int) -> list[int]:
    """``value`` as n digits of ``_LIMB`` bits, lowest first; the last one bears the sign."""
    return [(value >> _LIMB * j) & ((1 << _LIMB) - 1) for j in range(n - 1)] + [value >> _LIMB * (n - 1)]


def _means(known: DataFrame, centroids: np.ndarray, pivots: np.ndarray, wide: bool, limbs: int) -> np.ndarray:
    """The next centroids: floor(sum / count) of their vectors, or as they were where there are none."""
    k, dims = centroids.shape

    def run(batches):
        count = np.zeros(k, np.int64)
        total = np.zeros((k, dims), object if wide else np.int64)
        for _, rows, cluster, _ in _parts(batches, centroids, pivots, wide):
            count += np.bincount(cluster, minlength=k)
            for c in np.unique(cluster):
                total[c] += rows[cluster == c].sum(axis=0)
        for c in np.flatnonzero(count).tolist():
            digits = [x for v in total[c].tolist() for x in _limbs(v, limbs)] if limbs > 1 else total[c].tolist()
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([[int(count[c]), *digits]], pa.list_(pa.int64()))], names=["cluster", "sums"])

    each = known.mapInArrow(run, "cluster int, sums array<long>").select("cluster", F.posexplode("sums").alias("place", "part"))
    sums = each.groupBy("cluster", "place").agg(F.sum(F.col("part").cast("decimal(28,0)")).alias("total")).collect()
    out = centroids.copy()
    by_cluster: dict[int, dict[int, int]] = {}
    for r in sums:
        by_cluster.setdefault(r.cluster, {})[r.place] = int(r.total)
    for c, x in by_cluster.items():
        whole = [sum(x[1 + d * limbs + j] << _LIMB * j for j in range(limbs)) for d in range(dims)]
        out[c] = [v // x[0] for v in whole]
    return out


def cluster(df: DataFrame, k: int = K, rounds: int = ROUNDS, vector: str = "embedding", vec_id: str = "vec_id",
            scale: int = SCALE, dims: int = DIMS, seed: int = SEED, pivots: int = PIVOTS) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that takes part."""
    spark = df.sparkSession
    usual = usable(df, vector, vec_id).filter(F.size("vector") == dims)
    whole = usual.withColumn("vector", F.transform("vector", lambda x: x * F.lit(float(scale)))).filter(F.forall("vector", lambda x: F.abs(x) != float("inf")))

    def floored(batches):  # floor as a double: any size
        for batch in batches:
            for at, m in matrices(batch):
                yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(at)), pa.array(list(np.floor(m)))], names=["vec_id", "vector"])

    vectors = whole.mapInArrow(floored, "vec_id long, vector array<double>")
    order = [F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256), "vector"]
    sample = [r.vector for r in vectors.orderBy(*order).limit(max(SAMPLE, k)).collect()]
    figures = "cluster_inertia long, inertia long, centroid_sha256 string"
    if not sample:
        return spark.createDataFrame([], f"vec_id long, cluster int, distance long, {figures}")
    top = vectors.agg(F.max(F.array_max(F.transform("vector", F.abs)))).first()[0]
    wide = top >= _NARROW
    limbs = -(-(int(top).bit_length() + 64) // _LIMB) if wide else 1
    start = _integers(np.array(sample), wide)
    fixed = far_apart(start, pivots)
    known = stored(_measured(vectors, fixed, wide), "pivot_table")
    centroids = start[:k].copy()
    for _ in range(rounds):
        centroids = _means(known, centroids, fixed, wide, limbs)

    def run(batches):
        for ids, _, found, squares in _parts(batches, centroids, fixed, wide):
            held = pa.array([min(int(x), _LONG) for x in squares] if wide else squares, pa.int64())
            yield pa.RecordBatch.from_arrays([ids, pa.array(found.astype(np.int32)), held], names=["vec_id", "cluster", "distance"])

    final = stored(known.mapInArrow(run, "vec_id long, cluster int, distance long"), "assigned")
    inertia = {r.cluster: int(r.s) for r in final.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(28,0)")).alias("s")).collect()}
    total = min(sum(inertia.values()), _LONG)
    digest = [hashlib.sha256(",".join(str(int(x)) for x in c).encode()).hexdigest() for c in centroids]
    of = spark.createDataFrame([(c, min(s, _LONG), total, digest[c]) for c, s in inertia.items()], f"cluster int, {figures}")
    # one row per centroid, k of them at most
    return final.join(F.broadcast(of), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def oracle() -> str:
    """The same rows in DuckDB: one CTE per round, integers throughout."""
    square = "list_sum(list_transform(list_zip(v.q, c.q), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    parts = [
        f"v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings "
        f"WHERE vec_id IS NOT NULL AND len(embedding) = {DIMS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMS})",
        f"c0 AS (SELECT row_number() OVER (ORDER BY h, q) - 1 AS c, q FROM (SELECT sha256('{SEED}:' || vec_id) AS h, q FROM v) ORDER BY h, q LIMIT {K})",
    ]
    for r in range(ROUNDS + 1):
        parts.append(f"a{r} AS (SELECT vec_id, q, c, d FROM (SELECT v.vec_id, v.q, c.c, {square} AS d, "
                     f"row_number() OVER (PARTITION BY v.n ORDER BY {square}, c.c) AS place FROM (SELECT *, row_number() OVER () AS n FROM v) v, c{r} c) WHERE place = 1)")
        if r < ROUNDS:
            parts.append(f"s{r} AS (SELECT c, i, sum(x) AS s, count(*) AS n FROM (SELECT c, unnest(q) AS x, unnest(range({DIMS})) AS i FROM a{r}) GROUP BY c, i)")
            parts.append(f"m{r} AS (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS q FROM s{r} GROUP BY c)")
            parts.append(f"c{r + 1} AS (SELECT c.c, coalesce(m.q, c.q) AS q FROM c{r} c LEFT JOIN m{r} m ON m.c = c.c)")
    return (f"WITH {', '.join(parts)} SELECT a.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance, "
            f"CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia, "
            f"sha256(array_to_string(c.q, ',')) AS centroid_sha256 FROM a{ROUNDS} a JOIN c{ROUNDS} c ON c.c = a.c")
