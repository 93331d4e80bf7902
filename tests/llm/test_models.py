"""Language identification and toxicity: held-out accuracy, fixtures and odd rows."""

from __future__ import annotations

import math
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tests.llm.conftest import DOCUMENTS, odd_rows
from tripweave.llm import language as L
from tripweave.llm import toxicity as X

SF = "/root/testdata/sf0.1"


def test_trigrams_are_of_one_text_each():
    texts = ["abc déf".encode(), b"", b"12 34", b"x" * 50]
    bins, owner = L.trigrams(texts)
    for i, t in enumerate(texts):
        alone, _ = L.trigrams([t])
        assert bins[owner == i].tolist() == alone.tolist()
    assert not (owner == 1).any() and not (owner == 2).any()


def test_language_of_documents(spark):
    rows = L.op6_language_id(spark, SF).collect()
    assert len(rows) == 10_000 and len({r.doc_id for r in rows}) == 10_000
    assert sum(r.language == r.declared for r in rows) / len(rows) > 0.99
    assert sum(r.accepted for r in rows) / len(rows) > 0.999
    pages = L.language_id_pages(spark, SF).collect()
    assert sum(r.language == r.declared and r.accepted for r in pages) / len(pages) > 0.99


WORDS = {"aa": "olo mano velo tira", "bb": "sch krum zwek brod"}


def sample(n=120):
    rng = random.Random(3)
    rows = []
    for i in range(n):
        lang = "aa" if i % 3 else "bb"
        text = " ".join(rng.choice(WORDS[lang].split()) for _ in range(12))
        rows.append((i, text, "bb" if i == 4 else lang, f"h{i % 5}.{lang}", 0))
    return rows


def test_evidence_is_fused(spark):
    """Text beats a wrong declaration; declaration and host decide where the text has little to say."""
    rows = sample() + [(500, "12 34", "aa", "h1.aa", 0), (501, "q", None, "h0.bb", 0), (502, "q", None, "h0.aa", 0), (503, "olo mano", "zz", None, 0)]
    df = spark.createDataFrame(rows, DOCUMENTS).withColumn("suffix", F.substring_index("source", ".", -1))
    got = {r.doc_id: r.language for r in L.identify(df, L.fit(df, host="source", suffix="suffix"), host="source", suffix="suffix").collect()}
    assert all(got[i].language == ("aa" if i % 3 else "bb") and got[i].accepted for i in range(120))
    assert not got[500].accepted
    assert got[501].language == "bb" and got[502].language == "aa"
    assert got[503].language == "aa"


def test_posterior_equals_plain_arithmetic(spark):
    """Text likelihood, channel and priors by hand, without host evidence."""
    rows = sample(60)
    df = spark.createDataFrame(rows, DOCUMENTS)
    model = L.fit(df)
    got = {r.doc_id: r.language for r in L.identify(df, model).collect()}
    counts = {x: np.ones(L.BINS) for x in ("aa", "bb")}
    for _, t, lang, _, _ in rows:
        np.add.at(counts[lang], L.trigrams([t.encode()])[0], 1)
    logs = {x: np.log(c / c.sum()) for x, c in counts.items()}
    soft = {}
    for i, t, *_ in rows:
        b = L.trigrams([t.encode()])[0]
        e = np.array([logs[x][b].sum() * min(len(b), L.EVIDENCE) / len(b) for x in ("aa", "bb")])
        soft[i] = (e, np.exp(e - e.max()) / np.exp(e - e.max()).sum())
    channel = np.full((3, 2), 0.5)
    for i, _, lang, _, _ in rows:
        channel["aa bb".split().index(lang)] += soft[i][1]
    channel = np.log(channel / channel.sum(axis=0))
    prior = np.sum([s for _, s in soft.values()], axis=0) + 1
    for i, _, lang, _, _ in rows:
        z = soft[i][0] + channel["aa bb".split().index(lang)] + np.log(prior / prior.sum())
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert math.isclose(got[i].confidence, p.max(), rel_tol=1e-9)


def test_language_odd_rows(spark):
    rows = [(d, t, lang, s, 0) for (d, t), lang, s in zip(odd_rows(), [None, "aa", "", "aa", "aa", "bb", "aa", None, "aa"], ["h", None] * 5)]
    df = spark.createDataFrame(rows, DOCUMENTS)
    got = L.identify(df, L.fit(df, host="source"), host="source").collect()
    assert len(got) == len(rows)
    assert all(not r.language.accepted for r in got if not (r.text or "").strip())
    none = df.limit(0)
    assert L.identify(none, L.fit(none, host="source"), host="source").count() == 0
    undeclared = df.withColumn("lang", F.lit(None).cast("string"))
    assert all(not r.language.accepted for r in L.identify(undeclared, L.fit(undeclared)).collect())


def test_rare_codes_are_languages(spark):
    """A language code needs a number of trigrams, not a share of the rows; other values need the share."""
    rng = random.Random(5)
    say = lambda words, n: " ".join(rng.choice(words.split()) for _ in range(n))
    rows = [(i, say(WORDS["aa"], 8), "aa", "h", 0) for i in range(5000)]
    rare = "ddwy llyn gwyr fach"
    rows += [(6000 + i, say(rare, 120), "cy", "h", 0) for i in range(3)] + [(6010, say(rare, 30), None, "h", 0)]
    rows += [(6020, say("beag glas", 9), "gd", "h", 0), *((6030 + i, say("junk", 300), "n/a", "h", 0) for i in range(3))]
    df = spark.createDataFrame(rows, DOCUMENTS)
    model = L.fit(df, host="source")
    assert model.languages == ["aa", "cy"]
    got = {r.doc_id: r.language for r in L.identify(df, model, host="source").collect()}
    assert all(got[i].language == "cy" and got[i].accepted for i in (6000, 6001, 6002, 6010))
    assert all(got[i].language == "aa" for i in range(5000))


def test_region_tags_are_their_language(spark):
    rows = [(i, t, f"{lang}-{'us' if i % 2 else 'GB'}" if i % 3 else lang, s, n) for i, t, lang, s, n in sample(60)]
    df = spark.createDataFrame(rows, DOCUMENTS)
    model = L.fit(df)
    assert model.languages == ["aa", "bb"]
    plain = spark.createDataFrame([(i, t, lang[:2], s, n) for i, t, lang, s, n in rows], DOCUMENTS)
    want = {r.doc_id: r.language for r in L.identify(plain, L.fit(plain)).collect()}
    for r in L.identify(df, model).collect():
        assert r.language.language == want[r.doc_id].language and math.isclose(r.language.confidence, want[r.doc_id].confidence, rel_tol=1e-9)


def test_every_listed_language_at_once(spark):
    """All codes: time grows with the languages, and the driver gets a row for each."""
    import time

    codes = sorted(L.CODES)
    say = lambda i: " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}q{chr(97 + (i + j) % 26)}" for j in range(60))
    rows = [(10 * i + j, say(i) * 5, c, f"h{i % 9}", 0) for i, c in enumerate(codes) for j in range(2)]
    df = spark.createDataFrame(rows, DOCUMENTS).repartition(4)
    t = time.time()
    model = L.fit(df, host="source")
    got = L.identify(df, model, host="source").select("lang", "language").collect()
    assert time.time() - t < 60
    assert model.languages == codes and len(got) == len(rows)
    assert sum(r.lang == r.language.language for r in got) > 0.98 * len(got)


def test_toxicity_on_held_out_labels(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = X.op8_toxicity(spark, SF).join(labels, "doc_id").filter("toxic IS NOT NULL").collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}
    scores, marks = np.array([r.score for r in held]), np.array([r.toxic for r in held])
    ranks = scores.argsort(kind="stable").argsort(kind="stable")
    n = marks.sum()
    assert (ranks[marks == 1].sum() - n * (n - 1) / 2) / (n * (len(held) - n)) > 0.93
    caught = ((scores >= 0.5) & (marks == 1)).sum()
    assert caught / n > 0.85 and ((scores >= 0.5) & (marks == 0)).sum() / (marks == 0).sum() < 0.03


def test_training_lowers_the_risk_and_stays_non_negative():
    rng = np.random.default_rng(0)
    x = (rng.random((300, 6)) < 0.1)
    y = rng.random(300) < 0.3
    x[y, 0] = True
    sparse = lambda m: (*np.nonzero(m), len(m))
    w, b = X.train(sparse(x[y]), sparse(x), 6, 0.3)
    p = x @ w + b > 0
    assert w[0] == max(w) and (p == y).mean() > 0.9


def test_toxicity_odd_rows(spark):
    docs = spark.createDataFrame(odd_rows() + [(i, "nice word" if i % 5 else "vile scum word") for i in range(10, 260)], "doc_id long, text string").withColumn("f", F.lit("x"))
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(10, 260)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    w, b = X.fit(docs, labels)
    got = X.score(docs, w, b).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.f == "x" for r in got)
    assert all((r.score >= 0.5) == (r.doc_id % 5 == 0) for r in got if r.doc_id and r.doc_id >= 10)
    assert X.fit(docs, labels.filter("toxic = 0")) == ({}, -40.0)
    assert X.score(docs.limit(0), w, b).count() == 0
