"""Operator 3: n-gram Jaccard join by chosen paths.

A document is the set of its word five-grams (lower case, white space folded; a
shorter text is one gram).  Documents with equal sets are one class from the
start.  A set carries ``SAMPLES`` minhash values, each a uniformly sampled token
of the set that similar sets share with a probability equal to their
similarity.

A run starts with all sets in one node.  Every node picks ``BRANCHES`` samples by
its own hash and splits its sets by their values, so sets stay together on a
path as long as they share the chosen tokens.  Nodes of up to ``SMALL`` sets are
leaves; larger ones are split again, up to ``DEPTH`` levels.  What is still large
then is dense and is compared in blocks, each pair of blocks a task's work.  Two
sets with the asked similarity meet in a leaf of one run with probability p
(``meeting``); the runs are as many as the target recall needs.

In a leaf, pairs are compared by their samples first, with a slack of four
standard deviations; what passes is verified on the whole sets, recomputed from
the texts.  Pairs never become rows: a leaf counts each set's links and gives
the leaf's links as a spanning forest.  A pair that meets in several leaves
counts in the smallest leaf they share, so the counts are exact.

Rules: null and blank texts have no grams, are similar to nothing and form
classes of their own; null ids get a null class; repeated rows count as copies.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from tripweave.llm.common import groups, mixed, slices, span_hashes, table, texts_of, word_spans
from tripweave.llm.components import components
from tripweave.session import stored

GRAM, SIMILARITY, RECALL = 5, 0.8, 0.9995
SAMPLES, BRANCHES, DEPTH, SMALL, BLOCK = 64, 2, 3, 128, 512
SALTS = 64
SEED = 11


def meeting(similarity: float = SIMILARITY, depth: int = DEPTH, branches: int = BRANCHES) -> float:
    """Least probability that two sets meet in a leaf of a run."""
    p = 1.0
    for _ in range(depth):
        p = 1 - (1 - similarity * p) ** branches
    return p


def runs_for(recall: float, similarity: float = SIMILARITY) -> int:
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - meeting(similarity))))


def grams(texts: list[bytes], n: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each text's word n-grams: (number of text, hash), by text."""
    data, starts, ends, owner = word_spans([b" ".join(t.split()) for t in texts])
    count = np.bincount(owner, minlength=len(texts)) if len(owner) else np.zeros(len(texts), np.int64)
    at = np.flatnonzero(np.arange(len(starts)) - (np.cumsum(count) - count)[owner] <= np.maximum(count - n, 0)[owner]) if len(owner) else owner
    last = np.minimum(at + n, np.cumsum(count)[owner[at]]) - 1
    h, own = span_hashes(data, starts[at], ends[last]), owner[at]
    order = np.lexsort((h, own))
    h, own = h[order], own[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (own[1:] != own[:-1])
    return own[new], h[new]


def _lowered(batch: pa.RecordBatch, text: str) -> list[bytes]:
    return texts_of(pa.RecordBatch.from_arrays([pc.utf8_lower(batch.column(text).cast(pa.string()))], names=["t"]), "t")


_RNG = np.random.default_rng(SEED)
_FACTORS = _RNG.integers(0, 2**63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RNG.integers(0, 2**63, SAMPLES, dtype=np.uint64)
_KEY = np.uint64(0xD6E8FEB86659FD93)


def _keys(own: np.ndarray, h: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each set, whatever the order of its tokens; texts without tokens are left out."""
    return (np.add.reduceat(mixed(h), begins).view(np.int64), np.add.reduceat(mixed(h ^ _KEY), begins).view(np.int64))


def sketches(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, k1, k2, n, sig): each document's set by key, its size and its samples; n is 0 and sig empty without grams."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                own, h = grams(_lowered(part, "text"))
                n = np.bincount(own, minlength=part.num_rows)
                have = np.flatnonzero(n)
                begins = (np.cumsum(n) - n)[have]
                k1, k2 = np.zeros(part.num_rows, np.int64), np.zeros(part.num_rows, np.int64)
                sig = [b""] * part.num_rows
                if len(have):
                    k1[have], k2[have] = _keys(own, h, begins)
                    values = np.stack([np.minimum.reduceat(h * f + s, begins) >> np.uint64(32) for f, s in zip(_FACTORS, _SHIFTS)], axis=1).astype("<u4")
                    for i, v in zip(have.tolist(), values):
                        sig[i] = v.tobytes()
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(k1), pa.array(k2), pa.array(n.astype(np.int32)), pa.array(sig, pa.binary())],
                                                 names=["doc_id", "k1", "k2", "n", "sig"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, k1 long, k2 long, n int, sig binary")


def _children(frontier: DataFrame) -> DataFrame:
    """(rep, key) of the next level: each node's chosen samples by the node's own hash."""
    first = F.pmod(F.xxhash64("node", F.lit(1)), F.lit(SAMPLES))
    step = F.pmod(F.xxhash64("node", F.lit(2)), F.lit(SAMPLES // 2)) * 2 + 1
    keys = []
    for j in range(BRANCHES):
        at = F.pmod(first + j * step, F.lit(SAMPLES)).cast("int")
        keys.append(F.xxhash64("node", at, F.substring(F.col("sig"), at * 4 + 1, F.lit(4))))
    return frontier.select("rep", F.explode(F.array(*keys)).alias("key"))


def leaves(sets: DataFrame, runs: int) -> DataFrame:
    """(rep, key, size): the leaves of all runs that hold two sets or more."""
    nodes = sets.select("rep", "sig", F.explode(F.array(*[F.xxhash64(F.lit("run"), F.lit(r)) for r in range(runs)])).alias("node"))
    out = None
    for level in range(1, DEPTH + 1):
        # a set may reach a node by two of its samples: once is enough
        below = stored(_children(nodes).distinct().withColumn("salt", F.pmod(F.xxhash64("rep"), F.lit(SALTS)).cast("int")), f"level{level}")
        # a node's size goes to the salts that its sets have, so a node of very many sets is spread over tasks
        sizes = below.groupBy("key").agg(F.count("*").alias("size"), F.bit_or(F.expr("shiftleft(1L, salt)")).alias("salts")).filter("size > 1")
        sizes = sizes.withColumn("salt", F.explode(F.filter(F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda i: F.getbit("salts", i) == 1))).drop("salts")
        sized = stored(below.join(sizes, ["key", "salt"]).select("rep", "key", "size"), f"nodes{level}")
        done = sized if level == DEPTH else sized.filter(F.col("size") <= SMALL)
        out = done if out is None else out.unionByName(done)
        if level < DEPTH:
            nodes = sized.filter(F.col("size") > SMALL).join(sets.select("rep", "sig"), "rep").select("rep", "sig", F.col("key").alias("node"))
    return out


def _cells(found: DataFrame, sets: DataFrame) -> DataFrame:
    """One row per set and cell: a leaf, or a pair of a dense leaf's blocks.  ``keys`` are all leaves of the set."""
    own = found.groupBy("rep").agg(F.collect_list(F.struct("key", "size")).alias("at"))  # runs * BRANCHES ** DEPTH at most
    rows = own.join(sets.select("rep", "k1", "k2", "sig"), "rep")
    keys = F.concat_ws(",", F.transform("at", lambda x: x["key"].cast("string")))
    rows = rows.select("rep", "k1", "k2", "sig", keys.alias("keys"), F.explode("at").alias("x")).select(
        "rep", "k1", "k2", "sig", "keys", "x.key", F.ceil(F.col("x.size") / BLOCK).cast("int").alias("blocks"))
    side = F.pmod(F.xxhash64("rep", F.lit("block")), F.col("blocks")).cast("int")
    rows = rows.withColumn("side", side).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.withColumn("a", F.least("side", "other")).withColumn("b", F.greatest("side", "other")).drop("blocks", "other")


def _candidates(part: pa.RecordBatch, threshold: float) -> np.ndarray:
    """Pairs (i < j) of a cell that look similar by their samples and that no smaller common leaf counts."""
    n = part.num_rows
    key = part.column("key")[0].as_py()
    sig = np.frombuffer(b"".join(part.column("sig").to_pylist()), "<u4").reshape(n, -1)
    like = np.zeros((n, n), bool)
    for i in range(n - 1):
        like[i, i + 1 :] = (sig[i + 1 :] == sig[i]).sum(axis=1) >= threshold * SAMPLES
    if part.column("a")[0].as_py() != part.column("b")[0].as_py():
        side = part.column("side").to_numpy()
        like &= side[:, None] != side[None, :]
    if like.any():
        before: dict[int, list[int]] = {}
        for i, text in enumerate(part.column("keys").to_pylist()):
            for k in map(int, text.split(",")):
                if k < key:
                    before.setdefault(k, []).append(i)
        for members in before.values():
            if len(members) > 1:
                like[np.ix_(members, members)] = False
    return np.argwhere(like)


def _similar(pairs: np.ndarray, sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """Which pairs of sorted distinct hash arrays reach the similarity."""
    size = np.array([len(s) for s in sets])
    if len(pairs) <= 4 * len(sets):
        common = np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in pairs.tolist()])
    else:  # many pairs: products of the sets' incidence, some thousand tokens at a time
        used = np.unique(pairs)
        tokens, code = np.unique(np.concatenate([sets[i] for i in used]), return_inverse=True)
        row = np.repeat(np.arange(len(used)), size[used])
        both = np.zeros((len(used), len(used)), np.float32)
        order = np.argsort(code, kind="stable")
        row, code = row[order], code[order]
        cuts = np.searchsorted(code, np.arange(0, len(tokens) + 4096, 4096))
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            m = np.zeros((len(used), 4096), np.float32)
            m[row[a:b], code[a:b] - 4096 * k] = 1
            both += m @ m.T
        place = np.full(len(sets), -1)
        place[used] = np.arange(len(used))
        common = both[place[pairs[:, 0]], place[pairs[:, 1]]]
    union = size[pairs[:, 0]] + size[pairs[:, 1]] - common
    return common >= similarity * union - 1e-9


def links(cells: DataFrame, docs: DataFrame, similarity: float) -> DataFrame:
    """(rep, links, root): per cell, each linked set's number of links and the smallest set of its part of the cell."""
    slack = 4 * math.sqrt(similarity * (1 - similarity) / SAMPLES)
    threshold = max(similarity - slack, 1 / SAMPLES)
    order = ["key", "a", "b"]

    def promising(batches):
        for part in groups(batches, order):
            pairs = _candidates(part, threshold)
            if len(pairs):
                yield part.take(pa.array(np.unique(pairs)))

    dealt = cells.repartition(*order).sortWithinPartitions(*order)
    kept = stored(dealt.mapInArrow(promising, cells.schema), "cells")
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), F.col("text")).filter("rep IS NOT NULL AND text IS NOT NULL")

    def verify(batches):
        for part in groups(batches, order):
            # an id that is repeated with other texts: only the text of this set counts, once
            own, h = grams(_lowered(part, "text"))
            sets = np.split(h, np.cumsum(np.bincount(own, minlength=part.num_rows))[:-1])
            k1, reps, seen, rows = part.column("k1").to_pylist(), part.column("rep").to_pylist(), set(), []
            for i, s in enumerate(sets):
                if len(s) and reps[i] not in seen and int(mixed(s).sum().view(np.int64)) == k1[i]:
                    seen.add(reps[i])
                    rows.append(i)
            part, sets, reps = part.take(pa.array(rows, pa.int64())), [sets[i] for i in rows], [reps[i] for i in rows]
            if len(rows) < 2:
                continue
            pairs = _candidates(part, threshold)
            pairs = pairs[_similar(pairs, sets, similarity)] if len(pairs) else pairs
            if not len(pairs):
                continue
            count = np.bincount(pairs.ravel(), minlength=len(rows))
            root = list(range(len(rows)))

            def top(i):
                while root[i] != i:
                    root[i] = root[root[i]]
                    i = root[i]
                return i

            for i, j in pairs.tolist():
                x, y = top(i), top(j)
                if x != y:
                    x, y = (x, y) if reps[x] < reps[y] else (y, x)
                    root[y] = x
            linked = np.flatnonzero(count).tolist()
            yield pa.RecordBatch.from_arrays([
                pa.array([reps[i] for i in linked], pa.int64()), pa.array(count[linked]), pa.array([reps[top(i)] for i in linked], pa.int64())],
                names=["rep", "links", "root"])

    full = kept.join(texts, "rep").repartition(*order).sortWithinPartitions(*order)
    return full.mapInArrow(verify, "rep long, links long, root long")


def join(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, class_id, n_links, n_copies) for every row.

    ``class_id`` is the smallest id of all documents that links connect,
    ``n_links`` the number of other, different sets at the similarity or above,
    ``n_copies`` the number of rows with the same set.
    """
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = stored(sketches(own), "sketches")
    real = F.col("n") > 0
    classes = stored(rows.filter(real & F.col("doc_id").isNotNull()).groupBy("k1", "k2", "n").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("n_copies"), F.first("sig").alias("sig")), "sets")
    found = leaves(classes, runs_for(recall, similarity))
    linked = stored(links(_cells(found, classes), own, similarity), "links")
    count = linked.groupBy("rep").agg(F.sum("links").alias("n_links"))
    roots = components(linked, "rep", "root").withColumnRenamed("id", "rep")
    labelled = classes.drop("sig").join(count, "rep", "left").join(roots, "rep", "left").select(
        "k1", "k2", "n", "n_copies", F.coalesce("root", "rep").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    keyed = rows.select("doc_id", "k1", "k2", "n").join(labelled, ["k1", "k2", "n"], "left")
    alone = F.col("doc_id").isNull() | (F.col("n") == 0)
    return keyed.select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                        F.when(alone, 0).otherwise(F.col("n_links")).cast("long").alias("n_links"),
                        F.when(alone, 1).otherwise(F.col("n_copies")).cast("long").alias("n_copies"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents").select("doc_id", "text"))
