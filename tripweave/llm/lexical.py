"""Operator 13: ranked lexical search over classes of equal bags.

Only the terms of the items matter to a score, so a document is its bag: the
occurrences of item terms in it, and m, which follows from its length.

1. One pass over whole texts gives each document's length and its bag,
   restricted to the items' vocabulary.  Counts and document frequencies are
   taken over all of them.
2. Documents are grouped by a hash of bag and m, verified by the bags themselves.
   A class keeps its smallest id; copies and template pages become one row.
3. Each class is scored once against all items by their postings; a task keeps
   the ``k`` best classes per item (by score, then smallest id), Spark the ``k``
   best of those.  These classes hold the ``k`` best documents, since every
   class before another one has a document before all of its own.
4. Only the chosen classes are expanded, to their ``k`` smallest ids, and the
   documents ranked.

Items go in blocks of bounded postings, one pass over the documents each, and a
block's result is written before the next.  What is broadcast are a block's
chosen classes, ``k`` per item at most.

Rules: null text has no terms; items without a term, or that share none with a
document, give no rows; equal item rows are answered once, rows of one item_id
with different texts each on their own; repeated document rows count and rank as
often as they occur; rows without a doc_id count in the statistics and do not
rank.  A text of any length is read in pieces that are cut between terms.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tripweave.llm.common import SLICE_BYTES, BlockFolder, slices, table, texts_of
from tripweave.llm.vectors import smallest
from tripweave.session import stored

TOP = 20
#: Postings (item, term) and items of a block.
POSTINGS, ITEMS = 500_000, 2_000
#: Scores, and products that are added up, at one time in a task.
CELLS = 2_000_000
#: Fixed value: bytes that end a term, in UTF-8 as in code points.
_OUTSIDE = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
_INSIDE = np.array([not _OUTSIDE.match(bytes([b])) for b in range(256)])
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)


def pieces(texts: list[bytes], size: int = SLICE_BYTES) -> Iterator[list[tuple[int, bytes]]]:
    """(number of the text, part of it), about ``size`` bytes at a time; a cut never falls inside a term."""
    held, total = [], 0
    for i, t in enumerate(texts):
        at = 0
        while at < len(t):
            end = min(at + size, len(t))
            if end < len(t):
                cut = _OUTSIDE.search(t, end)
                end = cut.start() if cut else len(t)
            held.append((i, t[at:end]))
            total += end - at
            at = end
            if total >= size:
                yield held
                held, total = [], 0
    if held:
        yield held


def terms(parts: list[tuple[int, bytes]]) -> tuple[np.ndarray, pa.Array]:
    """The terms of some parts of texts, A-Z lower-cased: numbers of their texts, and the terms."""
    data = np.frombuffer(b" ".join(p for _, p in parts), np.uint8)
    inside = _INSIDE[data]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    begins = np.cumsum([0, *(len(p) + 1 for _, p in parts)])[:-1]
    owner = np.array([i for i, _ in parts], np.int64)[np.searchsorted(begins, starts, "right") - 1]
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    return owner, pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(_LOWER[data[inside]])])


def _item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item_id, terms, counts) of every different item row with a term."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, text):
                held: list[dict[bytes, int]] = [{} for _ in range(part.num_rows)]
                for some in pieces(texts_of(part, text)):
                    owner, found = terms(some)
                    for i, t in zip(owner.tolist(), found.to_pylist()):
                        held[i][t] = held[i].get(t, 0) + 1
                at = [i for i, x in enumerate(held) if x]
                yield pa.RecordBatch.from_arrays([part.column(item_id).take(pa.array(at, pa.int64())), pa.array([list(held[i]) for i in at], pa.list_(pa.binary())),
                                                  pa.array([list(held[i].values()) for i in at], pa.list_(pa.int64()))], names=["item_id", "terms", "counts"])

    rows = items.select(F.col(item_id).cast("long").alias(item_id), text).distinct()
    return rows.mapInArrow(run, "item_id long, terms array<binary>, counts array<long>")


class Block:
    """Some items, their vocabulary and the postings of its terms."""

    def __init__(self, rows):
        self.ids = [r.item_id for r in rows]
        self.terms = sorted({bytes(t) for r in rows for t in r.terms})
        place = {t: i for i, t in enumerate(self.terms)}
        code = np.array([place[bytes(t)] for r in rows for t in r.terms], np.int64)
        item = np.repeat(np.arange(len(rows)), [len(r.terms) for r in rows])
        often = np.array([n for r in rows for n in r.counts], np.int64)
        order = np.argsort(code, kind="stable")
        self.item, self.often = item[order], often[order]
        self.first = np.searchsorted(code[order], np.arange(len(self.terms) + 1))
        self.longest = int(np.bincount(item, often).max())


def _blocks(items: DataFrame) -> Iterator[Block]:
    """The items, a bounded block at a time on the driver."""
    total = items.agg(F.sum(F.size("terms")).alias("p"), F.count("*").alias("n")).first()
    if not total.n:
        return
    number = max(-(-total.p // POSTINGS), -(-total.n // ITEMS))
    part = F.pmod(F.xxhash64("item_id", "terms"), F.lit(number))
    for b in range(number):
        if rows := items.filter(part == b).collect():
            yield Block(rows)


def bags(docs: DataFrame, vocabulary: list[bytes], doc_id: str, text: str) -> DataFrame:
    """(doc_id, n, bag) of documents with a term: all its terms with repeats, and the vocabulary's as (codes, occurrences)."""
    def run(batches):
        known = pa.array(vocabulary, pa.binary())
        size = len(vocabulary)
        for batch in batches:
            for part in slices(batch, text):
                n = np.zeros(part.num_rows, np.int64)
                keys, often = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for some in pieces(texts_of(part, text)):
                    owner, found = terms(some)
                    n += np.bincount(owner, minlength=len(n))
                    code = pc.index_in(found, value_set=known)
                    hit = code.is_valid().to_numpy(zero_copy_only=False)
                    key, count = np.unique(owner[hit] * size + code.drop_null().to_numpy(), return_counts=True)
                    keys.append(key)
                    often.append(count)
                key, inverse = np.unique(np.concatenate(keys), return_inverse=True)
                tf = np.zeros(len(key), np.int64)
                np.add.at(tf, inverse, np.concatenate(often))
                code, tf = (key % size).astype("<u4"), tf.astype("<u4")
                cuts = np.searchsorted(key, np.arange(len(n) + 1) * size)
                rows = np.flatnonzero(n)
                held = [code[a:b].tobytes() + tf[a:b].tobytes() for a, b in zip(cuts[rows], cuts[rows + 1])]
                yield pa.RecordBatch.from_arrays([part.column(doc_id).take(pa.array(rows)), pa.array(n[rows]), pa.array(held, pa.binary())], names=["doc_id", "n", "bag"])

    rows = docs.select(F.col(doc_id).cast("long").alias(doc_id), text)
    return rows.mapInArrow(run, "doc_id long, n long, bag binary")


def _opened(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, code, occurrences) of a column of bags."""
    held = column.to_pylist()
    size = np.array([len(b) // 8 for b in held], np.int64)
    each = [np.frombuffer(b, "<u4").reshape(2, -1) for b in held]
    both = np.concatenate(each, axis=1).astype(np.int64) if each else np.zeros((2, 0), np.int64)
    return np.repeat(np.arange(len(held)), size), both[0], both[1]


def _frequencies(held: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term of the vocabulary."""
    def run(batches):
        df = np.zeros(size, np.int64)
        for batch in batches:
            df += np.bincount(_opened(batch.column("bag"))[1], minlength=size)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], names=["code", "df"])

    out = np.zeros(size, np.int64)
    for r in held.select("bag").mapInArrow(run, "code long, df long").groupBy("code").agg(F.sum("df").alias("df")).collect():
        out[r.code] = r.df
    return out


def scores(row: np.ndarray, code: np.ndarray, worth: np.ndarray, rows: int, block: Block) -> np.ndarray:
    """Sums of ``worth`` of (row, code) over the items' terms, rows by items, exact."""
    n = block.first[code + 1] - block.first[code]
    at = np.repeat(block.first[code] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    cell = np.repeat(row, n) * len(block.ids) + block.item[at]
    worth = np.repeat(worth, n)

    def added(x):
        return np.bincount(cell, x * block.often[at], rows * len(block.ids)).astype(np.int64)

    if block.longest * int(worth.max(initial=0)) < 2**53:  # doubles are exact
        return added(worth).reshape(rows, -1)
    return ((added(worth >> 24) << 24) + added(worth & 0xFFFFFF)).reshape(rows, -1)


def _best_classes(classes: DataFrame, block: Block, weight: np.ndarray, k: int) -> DataFrame:
    """(item, score, h, m, first): each task's ``k`` best classes per item."""
    items = len(block.ids)

    def run(batches):
        best = [(np.zeros(0, np.int64),) * 4] * items  # scores, smallest ids, hashes and m
        floor = np.ones(items, np.int64)
        for batch in batches:
            h, m, first = (batch.column(c).to_numpy() for c in ("h", "m", "first"))
            row, code, tf = _opened(batch.column("bag"))
            worth = weight[code] * (1_000_000_000 * tf // (1000 * tf + 12 * m[row]))
            work = np.bincount(row, block.first[code + 1] - block.first[code], minlength=len(h))
            part = np.maximum(np.cumsum(work) // CELLS, np.arange(len(h)) // max(1, CELLS // items))
            for a, b in _runs(part):
                c, d = np.searchsorted(row, [a, b])
                got = scores(row[c:d] - a, code[c:d], worth[c:d], b - a, block)
                where, item = np.nonzero(got >= floor)
                order = np.argsort(item, kind="stable")
                where, item = where[order], item[order]
                cuts = np.searchsorted(item, np.arange(items + 1))
                for i in np.unique(item).tolist():
                    at = where[cuts[i] : cuts[i + 1]]
                    both = [np.concatenate(x) for x in zip(best[i], (got[at, i], first[at + a], h[at + a], m[at + a]))]
                    keep = smallest(-both[0], both[1], k)
                    best[i] = tuple(x[keep] for x in both)
                    if len(keep) == k:
                        floor[i] = best[i][0][-1]
        n = [len(x[0]) for x in best]
        s, first, h, m = (np.concatenate([x[j] for x in best]) for j in range(4))
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(items), n)), pa.array(s), pa.array(h), pa.array(m), pa.array(first)], names=["item", "score", "h", "m", "first"])

    return classes.mapInArrow(run, "item long, score long, h long, m long, first long")


def _runs(part: np.ndarray) -> Iterator[tuple[int, int]]:
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
    return ((a, b) for a, b in zip(cuts, cuts[1:]) if b > a)


def _answered(spark: SparkSession, docs: DataFrame, block: Block, k: int, doc_id: str, text: str) -> DataFrame:
    held = stored(bags(docs, block.terms, doc_id, text), "bags")
    of = held.agg(F.count("*").alias("n"), F.sum(F.col("n").cast("decimal(38,0)")).alias("l")).first()
    if not of.n:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    df = _frequencies(held, len(block.terms))
    weight = np.array([math.floor(1000 * math.log((2 * of.n + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    m = F.expr(f"75 + cast((cast(25 as decimal(38,0)) * n * {of.n}) div {of.l} as long)")
    sized = held.filter(F.col("doc_id").isNotNull() & (F.length("bag") > 0)).select("doc_id", m.alias("m"), "bag")
    sized = sized.withColumn("h", F.xxhash64("m", "bag"))
    classes = stored(sized.groupBy("h", "m", "bag").agg(F.min("doc_id").alias("first")), "classes")
    name = ["h", "m", "first"]
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), "first", "h", "m")
    scored = _best_classes(classes, block, weight, k).withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k).drop("r")
    best = stored(scored, "best_classes")
    # k rows of three numbers per item of the block at most
    chosen = classes.join(F.broadcast(best.select(*name).distinct()), name)
    among = sized.join(F.broadcast(best.select("h").distinct()), "h")
    by_id = Window.partitionBy("h", "m", "bag").orderBy("doc_id")
    few = among.withColumn("r", F.row_number().over(by_id)).filter(F.col("r") <= k)
    members = few.join(chosen, ["h", "m", "bag"]).select(*name, "doc_id")
    rank = Window.partitionBy("item").orderBy(F.col("score").desc(), "doc_id")
    ranked = best.join(members, name).withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k)
    ids = spark.createDataFrame(list(enumerate(block.ids)), "item long, item_id long")
    return ranked.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` documents of the highest scores above 0."""
    spark = docs.sparkSession
    found = BlockFolder(spark, "item_id long, rank int, doc_id long, score long", "ranked")
    for block in _blocks(stored(_item_terms(items, item_id, text), "item_terms")):
        found.add(_answered(spark, docs, block, k, doc_id, text))
    return found.read()


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def oracle() -> str:
    """The same rows in DuckDB, without classes."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    term = rf"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {term} AS t FROM documents),
 st AS (SELECT count(*) AS n, sum(len(t)) AS l FROM d WHERE len(t) > 0),
 q AS (SELECT item_id, term, count(*) AS often FROM (SELECT item_id, unnest({term}) AS term FROM benchmark) GROUP BY item_id, term),
 tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY r, term),
 w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(st.n) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, st GROUP BY term),
 m AS (SELECT r, doc_id, 75 + (25 * len(t) * st.n) // st.l AS m FROM d, st WHERE len(t) > 0 AND doc_id IS NOT NULL),
 s AS (SELECT q.item_id, m.r, m.doc_id, sum(q.often * w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 12 * m.m))) AS score
       FROM q JOIN tf ON tf.term = q.term JOIN w ON w.term = q.term JOIN m ON m.r = tf.r GROUP BY q.item_id, m.r, m.doc_id),
 o AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM o WHERE rank <= {TOP}"""
