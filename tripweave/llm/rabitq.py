"""Operator 7: approximate nearest neighbours by randomly rotated one-bit codes.

Index: the centroid is the mean of all vectors of a length.  A vector's
difference to it is scaled to length 1, rotated by a random orthogonal matrix
(from a fixed seed) and kept as one sign bit per dimension, packed, with two
scalars: the difference's length and the inner product of the unit vector with
its own code, which corrects the estimates.

Search: with the query rotated likewise, the inner product of its unit vector
and a candidate's is estimated from the code, with an error of at most
``EPSILON`` standard deviations.  A first pass over the codes finds, per query,
the k-th smallest upper bound of the distance; a second pass reranks, by exact
distances on the original vectors, all candidates whose lower bound does not
exceed it.  Every row is indexed and every code is looked at; only the bounds
decide, so copies and hot vectors need no cap.

Rules: vectors null, empty, zero or with null or non-finite components take no
part; vectors of another length are no candidates; ties go to the smaller id;
a vector equal to the centroid has a zero code scalar and an exact bound.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tripweave.llm.common import BlockFolder, table
from tripweave.llm.vectors import EVERY, by_length, matrices, query_blocks, smallest, usable
from tripweave.session import stored

SEED = 7
#: Half-width of the error bound, in standard deviations of the estimate.
EPSILON = 3.0
#: Exact distances that a task computes at one time.
PAIRS = 1 << 15


def rotation(n: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix; the same for the same size and seed."""
    q, r = np.linalg.qr(np.random.default_rng([seed, n]).standard_normal((n, n)))
    return q * np.sign(np.diag(r))


def encode(matrix: np.ndarray, centroid: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, lengths of the differences, and inner products of unit vectors with their codes."""
    apart = matrix - centroid
    norm = np.sqrt((apart * apart).sum(axis=1))
    unit = (apart / np.where(norm > 0, norm, 1)[:, None]) @ turn
    return np.packbits(unit > 0, axis=1), norm, np.abs(unit).sum(axis=1) / math.sqrt(matrix.shape[1])


def bounds(codes: np.ndarray, norm: np.ndarray, fit: np.ndarray, queries: np.ndarray, centroid: np.ndarray,
           turn: np.ndarray, epsilon: float = EPSILON) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of squared distances, queries by rows, from codes and scalars."""
    n = queries.shape[1]
    apart = queries - centroid
    length = np.sqrt((apart * apart).sum(axis=1))
    unit = (apart / np.where(length > 0, length, 1)[:, None]) @ turn
    signs = np.unpackbits(codes, axis=1, count=n).astype(np.float64) * 2 - 1
    fit = np.where(norm > 0, fit, 1)
    estimate = (unit @ signs.T) / math.sqrt(n) / fit
    error = epsilon * np.sqrt(np.maximum(0, 1 - fit * fit) / max(n - 1, 1)) / fit
    both = 2 * length[:, None] * norm
    middle = length[:, None] ** 2 + norm**2 - both * estimate
    # rounding of doubles, relative to the terms
    spare = both * error + 1e-9 * (length[:, None] ** 2 + norm**2)
    return middle - spare, middle + spare


INDEX = "vec_id long, vector array<double>, code binary, norm double, fit double"


def build(df: DataFrame, vector: str = "embedding", vec_id: str = "vec_id") -> tuple[DataFrame, dict[int, np.ndarray]]:
    """The index, one row per usable vector, and the centroid of each length of vector."""
    rows = usable(df, vector, vec_id).filter(F.exists("vector", lambda x: x != 0))

    def sums(batches):
        held: dict[int, tuple] = {}
        for batch in batches:
            for _, m in matrices(batch):
                n, s = held.get(m.shape[1], (0, 0))
                held[m.shape[1]] = (n + len(m), s + m.sum(axis=0))
        for size, (n, s) in held.items():
            yield pa.RecordBatch.from_arrays([
                pa.array([size] * size, pa.int32()), pa.array(np.arange(size, dtype=np.int32)), pa.array([n] * size, pa.int64()), pa.array(s)],
                names=["size", "at", "n", "total"])

    means = rows.select("vector").mapInArrow(sums, "size int, at int, n long, total double").groupBy("size", "at").agg(
        (F.sum("total") / F.sum("n")).alias("mean"))
    centroids: dict[int, dict[int, float]] = {}
    for r in means.collect():  # one number per dimension
        centroids.setdefault(r["size"], {})[r["at"]] = r["mean"]
    middle = {n: np.array([c[i] for i in range(n)]) for n, c in centroids.items()}

    def code(batches):
        turns = {n: rotation(n) for n in middle}
        for batch in batches:
            ids, vectors = batch.column("vec_id"), batch.column("vector")
            for at, m in matrices(batch):
                bits, norm, fit = encode(m, middle[m.shape[1]], turns[m.shape[1]])
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array(at)), vectors.take(pa.array(at)), pa.array([x.tobytes() for x in bits], pa.binary()),
                    pa.array(norm), pa.array(fit)], names=["vec_id", "vector", "code", "norm", "fit"])

    return stored(rows.mapInArrow(code, INDEX), "codes"), middle


def _parts(batch, block):
    """(places of queries, queries, their ids, numbers of rows, lower and upper bounds) for each length of vector."""
    code, norm, fit = (batch.column(c) for c in ("code", "norm", "fit"))
    norm, fit = norm.to_numpy(), fit.to_numpy()
    width = np.array([len(x) for x in code.to_pylist()])
    for n, (places, own, queries, centroid, turn) in block.items():
        at = np.flatnonzero(width == -(-n // 8))
        sizes = np.diff(batch.column("vector").offsets.to_numpy()) if "vector" in batch.schema.names else batch.column("size").to_numpy()
        at = at[sizes[at] == n]
        for i in range(0, len(at), 2048):
            part = at[i : i + 2048]
            codes = np.frombuffer(b"".join(code.take(pa.array(part)).to_pylist()), np.uint8).reshape(len(part), -1)
            yield places, own, queries, part, *bounds(codes, norm[part], fit[part], queries, centroid, turn)


def search(index: DataFrame, middle: dict[int, np.ndarray], queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): k nearest found of each query, by exact Euclidean distance."""
    spark = index.sparkSession
    schema = "query_id long, vec_id long, score double"
    found = BlockFolder(spark, schema, "nearest")
    light = index.select("vec_id", "code", "norm", "fit", F.size("vector").alias("size"))
    for rows in query_blocks(queries):
        ids = np.array([i for i, _ in rows])
        block = {n: (at, ids[at], q, middle[n], rotation(n)) for n, (at, q) in by_length(rows).items()}

        def uppers(batches, block=block, n=len(rows)):
            held: list[list] = [[] for _ in range(n)]
            for batch in batches:
                row_ids = batch.column("vec_id").to_numpy()
                for places, own, _, part, _, high in _parts(batch, block):
                    for i, q in enumerate(places):
                        h = high[i][row_ids[part] != own[i]]
                        held[q] = np.sort(np.concatenate([held[q], np.partition(h, k - 1)[:k] if len(h) > k else h]))[:k]
            q = np.repeat(np.arange(n), [len(h) for h in held]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(np.concatenate([np.array(h, float) for h in held]))], names=["q", "high"])

        # k upper bounds per query and partition; the k-th of all bounds the k-th distance
        kth = Window.partitionBy("q").orderBy("high")
        limits = np.full(len(rows), np.inf)
        for r in (light.mapInArrow(uppers, "q int, high double").withColumn("n", F.row_number().over(kth)).filter(F.col("n") == k)
                  .select("q", "high").collect()):
            limits[r.q] = r.high

        def rerank(batches, block=block, limits=limits, ids=ids):
            held: dict[int, list] = {}
            for batch in batches:
                row_ids = batch.column("vec_id").to_numpy()
                vectors = batch.column("vector")
                offsets, values = vectors.offsets.to_numpy(), vectors.values.to_numpy()
                for places, own, queries, part, low, _ in _parts(batch, block):
                    qi, ri = np.nonzero((low <= limits[places][:, None]) & (row_ids[part][None, :] != own[:, None]))
                    near = np.empty(len(qi))
                    for a in range(0, len(qi), PAIRS):
                        one, two = qi[a : a + PAIRS], part[ri[a : a + PAIRS]]
                        x = values[offsets[two][:, None] + np.arange(queries.shape[1])] - queries[one]
                        near[a : a + PAIRS] = np.sqrt((x * x).sum(axis=1))
                    cuts = np.searchsorted(qi, np.arange(len(places) + 1))
                    for i, q in enumerate(places):
                        a, b = cuts[i], cuts[i + 1]
                        if b > a:
                            mine = [*held.get(int(q), []), (row_ids[part][ri[a:b]], near[a:b])]
                            held[int(q)] = [_nearest(mine, k)]
            for q, ((i, d),) in held.items():
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), ids[q])), pa.array(i), pa.array(d)], names=["query_id", "vec_id", "score"])

        found.add(index.mapInArrow(rerank, schema))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.read().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _nearest(parts, k):
    ids, near = (np.concatenate(x) for x in zip(*parts))
    at = smallest(near, ids, k)
    return ids[at], near[at]


def op7_rotated_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    index, middle = build(vectors)
    queries = index.filter(F.col("vec_id") % EVERY == 0).select("vec_id", "vector").distinct()
    return search(index, middle, queries)
