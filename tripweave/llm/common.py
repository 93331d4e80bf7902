"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tripweave.session import checkpoint_dir

#: Bytes of text that a task turns into numpy arrays at one time.
SLICE_BYTES = 1 << 20

_MEMORY: dict = {}


def worker_memory(owner, make=dict):
    """What a Python worker remembers between tasks, made on first use.

    Workers are reused: the memory of one owner takes the place of any other's.
    """
    if owner not in _MEMORY:
        _MEMORY.clear()
        _MEMORY[owner] = make()
    return _MEMORY[owner]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of ``batch`` whose ``column`` holds about ``max_bytes`` (one row at least)."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes.astype(np.int64)) // max_bytes
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


class BlockFolder:
    """Results of query blocks, each written before the next begins, into one folder that is read as a whole."""

    def __init__(self, spark: SparkSession, schema: str, name: str):
        self.spark, self.schema, self.blocks = spark, schema, 0
        self.path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}/{name}"

    def add(self, rows: DataFrame) -> None:
        rows.write.parquet(f"{self.path}/block={self.blocks}")
        self.blocks += 1

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/*") if self.blocks else self.spark.createDataFrame([], self.schema)


def texts_of(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """UTF-8 bytes of a text column; null is empty."""
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once a row, however often ``use`` names it, in lambdas as well."""
    return F.element_at(F.transform(F.array(value), use), 1)


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` doesn't have (columns compare without case)."""
    have = {c.lower() for c in df.columns}
    return stem if stem not in have else f"{stem}_{uuid.uuid4().hex[:8]}"


def mixed(h: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser over uint64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15 | 1


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, modulo 2^64."""
    known = worker_memory("powers")
    if "up" not in known or len(known["up"]) < n:
        m = max(n, 1 << 16)
        inverse = pow(_BASE, -1, 1 << 64)
        for key, base in (("up", _BASE), ("down", inverse)):
            p = np.full(m, base, np.uint64)
            p[0] = 1
            known[key] = np.multiply.accumulate(p)
    return known["up"][:n], known["down"][:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges [start, end) of ``data``: equal bytes, equal hash, wherever they lie."""
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    return mixed(h ^ (ends - starts).astype(np.uint64))


#: The white space \x20 and \x09-\x0D, as bytes.split() has it.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_spans(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All words of some texts: the joined bytes, each word's start and end there, and the number of its text."""
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    if not len(data):
        none = np.zeros(0, np.int64)
        return data, none, none, none
    inside = ~_SPACE[data]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
    return data, starts, ends, np.searchsorted(begins, starts, "right") - 1



def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Runs of rows with equal ``keys`` (integers) of a sorted stream, over the bounds of its batches."""
    tail: list[pa.RecordBatch] = []

    def whole(parts):
        return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        if tail and any(tail[-1].column(k)[-1].as_py() != c[0] for k, c in zip(keys, columns)):
            yield whole(tail)
            tail = []
        for a, b in zip(cuts[:-2], cuts[1:-1]):
            yield whole([*tail, batch.slice(a, b - a)])
            tail = []
        tail.append(batch.slice(cuts[-2], cuts[-1] - cuts[-2]))
    if tail:
        yield whole(tail)
