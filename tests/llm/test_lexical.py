"""Ranked lexical search against brute force."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

from tests.llm.conftest import DOCUMENTS, odd_rows
from tripweave.llm import lexical as X

TERM = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda c: c.group().lower(), t) for t in TERM.findall(text or "")]


def brute(docs, items, k=20):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    n = sum(1 for _, b in bags if b)
    total = sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in set(items):
        query = terms(text)
        rated = []
        for i, b in bags:
            if i is None or not b:
                continue
            m = 75 + 25 * sum(b.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * b[t] // (1000 * b[t] + 12 * m)) for t in query if b[t])
            if s > 0:
                rated.append((-s, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(rated)[:k])]
    return sorted(out, key=repr)


def got(spark, docs, items, **kw):
    d = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs], DOCUMENTS).repartition(4)
    q = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, score int")
    return sorted((tuple(r) for r in X.search(d, q, **kw).collect()), key=repr)


def test_the_smaller_table(spark):
    sf = "/root/testdata/sf0.001"
    docs, items = ([tuple(r) for r in spark.read.parquet(f"{sf}/{t}.parquet").select(c, "text").collect()] for t, c in (("documents", "doc_id"), ("benchmark", "item_id")))
    want = brute(docs, items)
    assert sorted((tuple(r) for r in X.op13_lexical_search(spark, sf).collect()), key=repr) == want
    assert len(want) > 500


def test_copies_ties_blocks_and_odd_rows(spark, monkeypatch):
    rng = random.Random(2)
    word = lambda: rng.choice(["a", "B", "b", "É", "é", "x1", "zz", "der", "Der"])
    docs = [(i, " ".join(word() for _ in range(rng.randrange(1, 9)))) for i in range(200)]
    docs += [(300 + i, "hot Copy, of-all") for i in range(60)] + [(299 - i, "copy hot of all") for i in range(9)]
    docs += [(7, "hot copy"), (7, "hot copy"), (None, "hot copy x1"), (-5, "hot")] + odd_rows()
    items = [(1, "hot copy"), (2, "der É é b, b"), (3, None), (4, "  ... "), (5, "absent"), (6, "x1"), (6, "zz zz"), (6, "x1"), (None, "word end"), (8, "a b 𝒳")]
    want = brute(docs, items)
    assert got(spark, docs, items) == want
    monkeypatch.setattr(X, "ITEMS", 2)
    assert got(spark, docs, items) == want
    assert got(spark, docs, items, k=3) == brute(docs, items, 3)


def test_pieces_of_long_texts(spark, monkeypatch):
    text = "alpha Beta gamma-" * 50 + "x" * 200 + " end"
    for size in (1, 7, 100, 5000):
        parts = [p for some in X.pieces([b"", text.encode(), b"one"], size) for p in some]
        assert b"".join(p for i, p in parts if i == 1) == text.encode()
        found = [t.decode() for some in X.pieces([text.encode()], size) for t in X.terms(some)[1].to_pylist()]
        assert found == terms(text)


def test_large_products_stay_exact(spark):
    import numpy as np

    class Row:
        item_id, terms, counts = 1, [b"a", b"b"], [10**8, 3]

    block = X.Block([Row])
    got = X.scores(np.array([0, 0, 1]), np.array([0, 1, 1]), np.array([25_000_000_007, 5, 25_000_000_001]), 2, block)
    assert got.tolist() == [[10**8 * 25_000_000_007 + 15], [75_000_000_003]]


def test_empty_tables(spark):
    assert got(spark, [], [(1, "a")]) == [] and got(spark, [(1, "a")], []) == [] and got(spark, [(1, None)], [(1, "a")]) == []
