"""The two vector searches against brute force."""

from __future__ import annotations

import numpy as np
import pytest

from tripweave.llm import rabitq, topk
from tripweave.llm.vectors import query_blocks, usable

SCHEMA = "vec_id long, embedding array<float>, score int"


def rows_of(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding")
    return df, [(r.vec_id, np.array(r.embedding, float)) for r in df.collect()]


def brute(rows, rate, k=10):
    out = []
    for q, v in sorted((r for r in rows if r[0] % 100 == 0), key=lambda r: r[0]):
        near = sorted((rate(v, w), i) for i, w in rows if i != q and len(w) == len(v))[:k]
        out += [(q, n + 1, i, s) for n, (s, i) in enumerate(near)]
    return out


def score(v, w):
    return -int(np.floor(v * 1024) @ np.floor(w * 1024))


def test_topk_equals_brute_force(spark):
    df, rows = rows_of(spark, "/root/testdata/sf0.1")
    got = sorted((r.query_id, r["rank"], r.vec_id, -r.score) for r in topk.top_k(df).collect())
    assert got == brute(rows, score)


ODD = [(i, [float(i % 7 - 3), 1.0, float(i % 3)], 5) for i in range(0, 450)] + [
    (1000, None, 1), (1001, [1.0, None, 2.0], 1), (1002, [float("nan"), 0.0, 0.0], 1), (1003, [], 1), (None, [1.0, 2.0, 3.0], 1),
    (1004, [float("inf"), 0.0, 0.0], 1), (1100, [1.0, 2.0], 1), (1101, [3.0, 4.0], 1), (7, [-3.0, 1.0, 1.0], 1), (1200, [0.0, 0.0, 0.0], 1)]


def test_topk_ties_odd_rows_and_lengths(spark):
    df = spark.createDataFrame(ODD, SCHEMA).repartition(5)
    rows = [(i, np.array(v)) for i, v, _ in ODD if i is not None and v and None not in v and np.isfinite(v).all()]
    got = sorted((r.query_id, r["rank"], r.vec_id, -r.score) for r in topk.top_k(df).collect())
    assert got == brute(rows, score)
    assert topk.top_k(df.limit(0)).count() == 0


def test_topk_huge_components(spark):
    df = spark.createDataFrame([(0, [3e30, 1.0], 1), (1, [2e30, 1.0], 1), (2, [-1e30, 0.0], 1), (3, [1.0, 1.0], 1)], SCHEMA)
    got = [(r["rank"], r.vec_id, r.score) for r in topk.top_k(df).collect()]
    low, high = -(2**63 - 1), 2**63 - 1
    # the products with 1 and with 3 lie beyond a long, above; the one with 2 below
    assert sorted(got) == [(1, 1, high), (2, 3, high), (3, 2, low)]


def test_topk_scores_near_the_bounds_of_a_long(spark):
    big = 2.0**31 * 1.4
    rows = [(0, [big, 0.0])] + [(i, [(-1) ** i * (big - i * 2.0**20), 0.0]) for i in range(1, 41)] + [(99, [1e300, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = sorted((r["rank"], r.vec_id) for r in topk.top_k(df, k=30).collect())
    clip = lambda x: max(-(2**63 - 1), min(2**63 - 1, x))
    score_of = {i: clip(int(np.floor(big * 1024)) * int(np.floor(v[0] * 1024))) for i, v in rows if i}
    want = sorted(score_of, key=lambda i: (-score_of[i], i))[:30]
    assert got == [(n + 1, i) for n, i in enumerate(want)]
    assert sum(s < -(2**62) for s in score_of.values()) > 10
    assert topk.top_k(spark.createDataFrame([(0, [1.0]), (1, [1e308])], "vec_id long, embedding array<double>")).count() == 0


def test_bins_of_ranges_wider_than_a_long():
    scores = np.array([-(2**63 - 1), -(2**62) - 1, 0, 2**62, 2**63 - 1])
    low, high = -(2**63 - 1), 2**63
    width = topk._bin_width([low], [high])[0]
    assert topk.bins(scores, low, high, width).tolist() == [(int(s) - low) // width for s in scores]


def test_query_blocks_cover_the_set_once(spark):
    df = spark.createDataFrame(ODD, SCHEMA)
    q = usable(df, "embedding", "vec_id")
    seen = [i for block in query_blocks(q, 40) for i, _ in block]
    assert sorted(seen) == sorted(i for i, v, _ in ODD if i is not None and v and None not in v and np.isfinite(v).all())


def distance(v, w):
    return float(np.sqrt(((w - v) * (w - v)).sum()))


def test_codes_reach_recall(spark):
    df, rows = rows_of(spark, "/root/testdata/sf0.1")
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in rabitq.op7_rotated_codes(spark, "/root/testdata/sf0.1").collect()]
    want = brute(rows, distance)
    assert len(got) == len(want)
    recall = len({(q, i) for q, _, i, _ in got} & {(q, i) for q, _, i, _ in want}) / len(want)
    assert recall >= 0.99
    vec = dict(rows)
    assert all(s == pytest.approx(distance(vec[q], vec[i]), rel=1e-12) for q, _, i, s in got)


def test_codes_prune():
    rng = np.random.default_rng(1)
    m = rng.standard_normal((4000, 64))
    m[:1000] = m[0] + 0.1 * rng.standard_normal((1000, 64))
    turn, c = rabitq.rotation(64), m.mean(axis=0)
    assert np.allclose(turn @ turn.T, np.eye(64))
    low, high = rabitq.bounds(*rabitq.encode(m, c, turn), m[:5], c, turn)
    exact = ((m[:5, None] - m[None]) ** 2).sum(axis=2)
    assert ((low <= exact) & (exact <= high)).mean() > 0.99
    kth = np.sort(high, axis=1)[:, 9]
    assert (low <= kth[:, None]).mean() < 0.5


def test_codes_odd_rows(spark):
    df = spark.createDataFrame(ODD, SCHEMA).repartition(4)
    index, middle = rabitq.build(df)
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in rabitq.search(
        index, middle, index.filter("vec_id % 100 = 0").select("vec_id", "vector").distinct()).collect())
    rows = [(i, np.array(v)) for i, v, _ in ODD if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    assert [x[:3] for x in got] == [x[:3] for x in brute(rows, distance)]
    empty, none = rabitq.build(df.limit(0))
    assert rabitq.search(empty, none, empty.select("vec_id", "vector")).count() == 0
