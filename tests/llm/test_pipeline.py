"""The pipeline's stages, one by one and together, against plain Python versions."""

from __future__ import annotations

import re
from collections import Counter

import corpus_pipeline as C
from pyspark.sql import functions as F

from tests.llm import test_jaccard, test_native, test_substrings
from tests.llm.conftest import DOCUMENTS, odd_rows
from tests.llm.test_tokens import check_packing
from tripweave.llm import packing
from tripweave.session import stored

SF = "/root/testdata/sf0.01"


def test_stages_on_the_smaller_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, was = docs.columns, docs
    seen = []
    for name, stage in C.STAGES[:-1]:
        was = stored(stage(spark, was, SF), "stage")
        assert was.columns == columns and dict(was.dtypes) == dict(docs.dtypes)
        seen.append({r.doc_id: r for r in was.collect()})
        assert len(seen[-1]) == was.count()
    one, two, three, four = seen
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(one) >= 0.999 * len(texts) and all(re.search(r"\w", t) for d, t in texts.items() if d in one)
    groups = test_jaccard.brute([(d, r.text) for d, r in one.items()])
    assert set(two) == {d for d, c, *_ in groups if d == c}
    cut = {d: (n, gone, h) for d, n, gone, h in test_substrings.brute([(d, r.text) for d, r in two.items()])}
    assert set(three) == {d for d, (n, gone, _) in cut.items() if not gone or gone < n}
    for d, r in three.items():
        assert r.n_chars == len(r.text)
        assert (r.text == two[d].text) == (cut[d][1] == 0)
    for d, r in four.items():
        spans = test_native.entropy_brute(three[d].text, test_native.base_brute(three[d].text))
        assert (r.text == three[d].text) == (not spans)
        assert not any(three[d].text[a:b] in r.text for a, _, b in spans)
    out = C.STAGES[-1][1](spark, was, SF).collect()
    assert {r.doc_id for r in out} == set(four)
    check_packing(out, packing.CAPACITY)


def test_odd_documents(spark):
    rows = [(d, t, "en", f"s{i % 2}", None) for i, (d, t) in enumerate(odd_rows())] + [(50, "some more words of plain english here", "en", None, 3)]
    docs = spark.createDataFrame(rows, DOCUMENTS).withColumn("extra", F.lit(1))
    was = docs
    for _, stage in C.STAGES[:-1]:
        was = stored(stage(spark, was, SF), "stage")
        assert was.columns == docs.columns
    got = Counter(r.doc_id for r in was.collect())
    assert got == Counter([4, 5, 6, 7, 50, None])
    empty = docs.limit(0)
    for _, stage in C.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_one_id_with_two_texts_loses_neither(spark):
    words = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen".split()
    a, b = " ".join(words), " ".join(words[::-1])
    rows = [(1, a, "en", "x", 1), (1, b, "en", "x", 1), (1, a, "en", "w", 1), (2, a, "en", "x", 1), (None, a, "en", "x", 1), (3, b + " more", "fr", "x", 1), (1, None, "en", "x", 1)]
    got = C.near_copies(spark, spark.createDataFrame(rows, DOCUMENTS).repartition(3), SF).collect()
    assert Counter((r.doc_id, r.text, r.source) for r in got if r.doc_id in (1, 2)) == Counter([(1, a, "w"), (1, b, "x"), (1, None, "x")])
    assert sum(r.doc_id is None for r in got) == 1
