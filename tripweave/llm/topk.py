"""Operator 1: exact top-k by distributed histogram selection.

Vectors are turned into integers floor(1024 * x); a score is an integer inner
product.  The stated queries go in blocks of bounded size.  For a block, every
candidate is scored, again and again, against a narrowing range per query: each
pass counts scores in ``BINS`` equal bins, the counts of all partitions are
added up by Spark, and the bin that holds the k-th highest score becomes the
next range, until it is one score wide or little more than k rows are left
above its lower edge.  A last pass keeps the rows above the k-th score and, of
those that tie with the lower edge, the k smallest ids a partition, so a score
shared by any number of rows never gathers in one place.

Rules: vectors null, empty or with null or non-finite components take no part,
nor do rows without an id; vectors of another length are no candidates of a
query; a repeated candidate row counts as often as it occurs, a query repeated
with the same vector is answered once; ties go to the smaller id; scores beyond
a long are held at its bounds (the lowest, as it has no counterpart, one above); components that are not
finite once scaled count as not finite.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tripweave.llm.common import BlockFolder, table
from tripweave.llm.vectors import EVERY, by_length, matrices, query_blocks, smallest, usable

SCALE, BINS = 1024, 256
#: Rows above the located edge, beyond k, at which the passes end: they are sorted out exactly.
SPARE = 64
_LONG = 2**63 - 1


def integers(x: np.ndarray) -> np.ndarray:
    """floor(1024 * x) as doubles, in which integers below 2^53 are exact."""
    return np.floor(x.astype(np.float64) * SCALE)


def products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer inner products, queries by rows: in doubles while they stay exact, else in Python's integers."""
    top = max(np.abs(queries).max(initial=0), 1) * max(np.abs(rows).max(initial=0), 1) * queries.shape[1]
    if top < 2.0**53:
        return (queries @ rows.T).astype(np.int64)
    exact = np.array([[int(x) for x in r] for r in queries], object) @ np.array([[int(x) for x in r] for r in rows], object).T
    return np.clip(exact, -_LONG, _LONG).astype(np.int64)


def _scored(batch, block):
    """(place of query, ids of rows, their scores) for each query and matrix of a batch, own rows left out."""
    ids = batch.column("vec_id").to_numpy()
    for rows, matrix in matrices(batch):
        if (found := block.get(matrix.shape[1])) is None:
            continue
        places, own, queries = found
        scores = products(queries, integers(matrix))
        row_ids = ids[rows]
        for i, q in enumerate(places):
            other = row_ids != own[i]
            yield q, row_ids[other], scores[i][other]


def _block(rows):
    own = np.array([i for i, _ in rows])
    return {n: (at, own[at], integers(m)) for n, (at, m) in by_length(rows).items()}


def _bin_width(low: list[int], high: list[int]) -> list[int]:
    return [max(1, -(-(h - x) // BINS)) for x, h in zip(low, high)]


def bins(scores: np.ndarray, low: int, high: int, width: int) -> np.ndarray:
    """The bin of each score in [low, high); differences of longs may need 64 bits without a sign."""
    inside = scores[(scores >= low) & (scores < high)]
    return ((inside.astype(np.uint64) - np.uint64(low % 2**64)) // np.uint64(width)).astype(np.int64)


def _edges(candidates: DataFrame, block, bounds: list[int], n: int, k: int) -> list[int]:
    """Per query a score that at most k + SPARE rows exceed and that the k-th highest score reaches."""
    low, high = [-b for b in bounds], [b + 1 for b in bounds]  # scores lie in [low, high); Python's integers, as ranges may pass a long
    above = [0] * n    # rows with scores from high on
    active = list(range(n))
    while active:
        width = _bin_width(low, high)
        search = set(active)

        def count(batches, low=tuple(low), high=tuple(high), width=width, search=search):
            held = np.zeros((n, BINS), np.int64)
            for batch in batches:
                for q, _, scores in _scored(batch, block):
                    if q in search:
                        held[q] += np.bincount(bins(scores, low[q], high[q], width[q]), minlength=BINS)
            q, b = np.nonzero(held)
            yield pa.RecordBatch.from_arrays([pa.array(q.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(held[q, b])], names=["q", "bin", "n"])

        got = candidates.mapInArrow(count, "q int, bin int, n long").groupBy("q", "bin").agg(F.sum("n").alias("n"))
        # one row per query: its bins' counts, at most BINS of them
        rows = got.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("bin", "n")), asc=False).alias("bins")).collect()
        next_active = []
        for r in rows:
            q, total = r.q, above[r.q]
            for b, m in ((x["bin"], x["n"]) for x in r.bins):
                if total + m >= k:
                    break
                total += m
            else:  # fewer than k rows in all: everything is kept
                continue
            start = low[q] + b * width[q]
            above[q] = total
            low[q], high[q] = start, min(high[q], start + width[q])
            if width[q] > 1 and m > k + SPARE:
                next_active.append(q)
        active = sorted(next_active)
    return low


def top_k(df: DataFrame, k: int = 10, vector: str = "embedding", vec_id: str = "vec_id", every: int = EVERY) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest scores among all other rows."""
    spark = df.sparkSession
    fit = F.forall(F.col(vector).cast("array<double>"), lambda x: F.abs(x * F.lit(float(SCALE))) != float("inf"))
    candidates = usable(df, vector, vec_id, fit)
    queries = usable(df, vector, vec_id, fit & (F.col(vec_id) % every == 0)).distinct()
    # Cauchy-Schwarz: no score lies beyond the product of the lengths
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + F.pow(F.floor(x * F.lit(float(SCALE))).cast("double"), F.lit(2.0))))
    longest = candidates.agg(F.max(length)).first()[0]
    schema = "query_id long, vec_id long, score long"
    found = BlockFolder(spark, schema, "top_k")
    for rows in query_blocks(queries) if longest is not None else ():
        own = np.array([i for i, _ in rows])
        block = _block(rows)
        norms = [float(np.sqrt((integers(v) ** 2).sum())) for _, v in rows]
        bounds = [int(min(np.ceil(x * longest * (1 + 1e-9)) + 1, _LONG)) if x * longest < 2.0**62 else _LONG for x in norms]
        edges = _edges(candidates, block, bounds, len(rows), k)

        def keep(batches, block=block, edges=edges, own=own):
            held: dict[int, list] = {}
            for batch in batches:
                for q, ids, scores in _scored(batch, block):
                    near = np.flatnonzero(scores >= edges[q])
                    if len(near):
                        held.setdefault(int(q), []).append((ids[near], scores[near]))
                        if sum(len(x) for x, _ in held[int(q)]) > 8 * (k + SPARE):
                            held[int(q)] = [_best(held[int(q)], k)]
            for q, parts in held.items():
                ids, scores = _best(parts, k)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), own[q])), pa.array(ids), pa.array(scores)], names=["query_id", "vec_id", "score"])

        found.add(candidates.mapInArrow(keep, schema))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.read().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _best(parts, k):
    ids, scores = (np.concatenate(x) for x in zip(*parts))
    at = smallest(-scores, ids, k)
    return ids[at], scores[at]


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
