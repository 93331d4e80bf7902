"""Vectors of a table as numpy blocks, and stated query sets in blocks; shared by the two searches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Rows that a task holds as one matrix, and queries that one pass over the candidates answers.
ROWS, QUERIES = 2048, 1024
#: Queries are the rows whose id is divisible by this.
EVERY = 100


def usable(df: DataFrame, vector: str, vec_id: str, condition: Column | None = None) -> DataFrame:
    """(vec_id long, vector array<double>): rows with an id and a vector, not empty, of finite numbers only."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    keep = F.col(vec_id).isNotNull() & (F.size(v) > 0) & fine
    out = df.filter(keep if condition is None else keep & condition)
    return out.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("vector"))


def matrices(batch: pa.RecordBatch, column: str = "vector") -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) for each length of vector in a batch, of up to ``ROWS`` rows."""
    lists = batch.column(column)
    offsets = lists.offsets.to_numpy()
    values = lists.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(offsets)
    for n in np.unique(sizes):
        rows = np.flatnonzero(sizes == n)
        for at in range(0, len(rows), ROWS):
            part = rows[at : at + ROWS]
            yield part, values[offsets[part][:, None] + np.arange(n)]


def query_blocks(queries: DataFrame, size: int = QUERIES) -> Iterator[list[tuple[int, np.ndarray]]]:
    """The stated query set, ``size`` queries at a time, by id: one bounded block is all that the driver holds.

    The ids alone set the blocks' bounds, so a block's rows are read by a range of ids.
    """
    after = None
    while True:
        rest = queries if after is None else queries.filter(F.col("vec_id") > after)
        rows = rest.orderBy("vec_id", F.xxhash64("vector")).limit(size + 1).collect()
        if len(rows) > size:  # whole ids only; a block grows where one id is repeated over its end
            last = rows[-1].vec_id
            if rows[0].vec_id == last:
                rows = rest.filter(F.col("vec_id") == last).collect()
            else:
                rows = [r for r in rows if r.vec_id < last]
            more = True
        else:
            more = False
        if rows:
            yield [(r.vec_id, np.array(r.vector)) for r in rows]
            after = rows[-1].vec_id
        if not more:
            return


def by_length(block: list[tuple[int, np.ndarray]]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Length of vector -> (places in the block, matrix of those queries)."""
    out: dict[int, list[int]] = {}
    for i, (_, v) in enumerate(block):
        out.setdefault(len(v), []).append(i)
    return {n: (np.array(at), np.stack([block[i][1] for i in at])) for n, at in out.items()}


def smallest(keys: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k smallest (key, id), in order."""
    if len(keys) > k:
        kth = np.partition(keys, k - 1)[k - 1]
        near = np.flatnonzero(keys <= kth)
    else:
        near = np.arange(len(keys))
    return near[np.lexsort((ids[near], keys[near]))[:k]]
