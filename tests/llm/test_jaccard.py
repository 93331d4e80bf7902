"""The chosen-path join and the components against brute force."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np

from tests.llm.conftest import odd_rows
from tripweave.llm import jaccard as J
from tripweave.llm.components import components


def shingles(text):
    w = (text or "").lower().split()
    return frozenset(" ".join(w[i : i + 5]) for i in range(max(len(w) - 4, 1))) if w else frozenset()


def roots(ids, pairs):
    top = {i: i for i in ids}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i
    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        top[b] = a
    return {i: find(i) for i in ids}


def brute(rows, similarity=0.8):
    members = defaultdict(list)
    for d, t in rows:
        if d is not None and shingles(t):
            members[shingles(t)].append(d)
    sets = list(members)
    posting = defaultdict(set)
    for i, s in enumerate(sets):
        for x in s:
            posting[x].add(i)
    pairs = set()
    for i, s in enumerate(sets):
        for j in {j for x in s for j in posting[x] if j > i}:
            if len(s & sets[j]) >= similarity * len(s | sets[j]) - 1e-9:
                pairs.add((i, j))
    rep = [min(members[s]) for s in sets]
    root = roots(rep, [(rep[i], rep[j]) for i, j in pairs])
    n = Counter(i for p in pairs for i in p)
    out = Counter()
    for i, s in enumerate(sets):
        for d in members[s]:
            out[d, root[rep[i]], n[i], len(members[s])] += 1
    for d, t in rows:
        if d is None or not shingles(t):
            out[d, d, 0, 1] += 1
    return out


def check(spark, rows):
    got = Counter(tuple(r) for r in J.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect())
    assert got == brute(rows)
    return got


def test_documents_of_the_smaller_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    got = Counter(tuple(r) for r in J.op3_jaccard_join(spark, "/root/testdata/sf0.01").collect())
    assert got == brute([tuple(r) for r in df.collect()])
    assert sum(n for (d, c, *_), n in got.items() if d != c) > 10


def test_odd_rows_and_short_texts(spark):
    check(spark, odd_rows() + [(20, "A  b"), (21, "a B c"), (22, "One two three four five six"), (23, "one two\nthree FOUR five six"), (23, "other text entirely of its own")])
    assert J.join(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_dense_groups_and_chains(spark, monkeypatch):
    """Near copies beyond a block, a chain of neighbours, and a passage that dissimilar texts share."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    base = [word() for _ in range(200)]
    rows = []
    for i in range(90):
        w = list(base)
        w[rng.randrange(200)] = word()
        rows.append((i, " ".join(w)))
    chain = [word() for _ in range(150)]
    for i in range(100, 112):
        chain = chain[4:] + [word() for _ in range(4)]
        rows.append((i, " ".join(chain)))
    passage = [word() for _ in range(60)]
    rows += [(i, " ".join(passage + [word() for _ in range(80)])) for i in range(200, 260)]
    monkeypatch.setattr(J, "SMALL", 12)
    monkeypatch.setattr(J, "BLOCK", 25)
    got = check(spark, rows)
    assert sum(n > 10 for _, _, n, _ in got) >= 80


def test_similarity_by_products_equals_pairs():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 9000, 6000).astype(np.uint64)) for _ in range(12)]
    pairs = np.array([(i, j) for i in range(12) for j in range(i + 1, 12)])
    want = [len(np.intersect1d(sets[i], sets[j])) / len(np.union1d(sets[i], sets[j])) >= 0.3 for i, j in pairs]
    assert J._similar(pairs, sets, 0.3).tolist() == want
    assert J._similar(pairs[:20], sets, 0.3).tolist() == want[:20]


def test_runs_reach_the_recall():
    assert 1 - (1 - J.meeting()) ** J.runs_for(0.9995) >= 0.9995


def test_components_of_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(200, 200), (301, 300)]
    got = {r.id: r.root for r in components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()}
    ids = {i for p in pairs if p[0] != p[1] for i in p}
    assert got == roots(ids, [p for p in pairs if p[0] != p[1]])
