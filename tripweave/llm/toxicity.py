"""Operator 8: toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic examples and unlabelled text are compared: a linear
classifier is trained in numpy on the risk

    prior * loss(positives, +) + max(0, loss(all, -) - prior * loss(positives, -))

with the logistic loss, where "all" is text from the whole population whatever
its labels, and ``prior`` is the share of toxic rows among the labelled ones.

A text's features are its distinct words and their beginnings of 4 to 7
characters, and for each beginning whether two or three distinct words or more
share it; a feature enters if enough confirmed toxic texts have it and their
rate is well above the unlabelled rate.  Weights are learnt on bounded samples
by hash of the id (``POSITIVES`` and ``UNLABELLED`` rows); every text is scored
as a whole.

Rules: rows whose crc32(id as text) mod 5 is 0 are held out: neither their
labels nor their texts are learnt from.  Null and empty texts get the bias
alone.  Without a confirmed toxic example all scores are 0.  Repeated rows are
scored alike; a null id is not held out and not learnt from.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tripweave.llm.common import SLICE_BYTES, slices, table
from tripweave.session import stored

#: Documented bounds of what the classifier is fitted on: rows, and features at most.
POSITIVES, UNLABELLED, FEATURES = 20_000, 40_000, 20_000
#: A feature needs so many positive texts (and that share of them); over the number that the unlabelled rate
#: lets expect, it needs that ratio and so many standard deviations more.
LEAST_TEXTS, LEAST_SHARE, LIFT, DEVIATIONS = 4, 0.004, 3.0, 4.0
STEPS, RATE, DECAY = 600, 0.05, 3e-5
#: Words of which a worker remembers whether they have a feature; beyond, it starts anew.
CACHE = 400_000

_EDGES = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»“”„’‘…–—¡¿"


def features(word: str) -> list[str]:
    bare = word.strip(_EDGES)
    return [bare, *(f"{bare[:n]}~" for n in (4, 5, 6, 7) if len(bare) >= n)] if bare else []


def raised(found: Counter) -> set[str]:
    """The features of a text whose distinct words have each feature so often."""
    return {g for f, n in found.items() for g in (f, f + "#2", f + "#3")[: min(n, 3)]}


def _words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct lower-case words of some texts, and the numbers of (text, word) for all words."""
    split = pc.ascii_split_whitespace(pc.utf8_lower(pc.fill_null(texts.cast(pa.string()), "")))
    coded = split.flatten().dictionary_encode()
    return coded.dictionary.to_pylist(), np.repeat(np.arange(len(split)), np.diff(split.offsets.to_numpy())), coded.indices.to_numpy()


def held_out(doc_id: str) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _feature_counts(df: DataFrame, only: frozenset | None = None) -> DataFrame:
    """(feature, n): texts that have it."""
    def run(batches):
        held: Counter = Counter()
        for batch in batches:
            for part in slices(batch, "text"):
                names, owner, code = _words(part.column("text"))
                kept = [[f for f in features(w) if only is None or f in only] for w in names]  # beginnings, not yet raised
                useful = np.array([bool(k) for k in kept], bool)
                pairs = np.unique(np.stack([owner, code])[:, useful[code]], axis=1) if len(code) else np.zeros((2, 0), int)
                for text in np.split(pairs[1], np.flatnonzero(np.diff(pairs[0])) + 1):
                    held.update(raised(Counter(f for c in text.tolist() for f in kept[c])))
            if len(held) > 1 << 20:
                yield _counted(held)
                held.clear()
        yield _counted(held)

    return df.select("text").mapInArrow(run, "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n"))


def _counted(held: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["feature", "n"])


def _found(names: list[str], owner: np.ndarray, code: np.ndarray, n: int, stems: set, known: dict | None = None) -> list[set]:
    """The features of each text that come from ``stems``; ``known`` remembers which words have any."""
    known = {} if known is None else known
    hits = np.zeros(len(names), bool)
    for i, w in enumerate(names):
        if (x := known.get(w)) is None:
            x = known[w] = not stems.isdisjoint(features(w))
        hits[i] = x
    pairs = set(zip(*(a[hits[code]].tolist() for a in (owner, code)))) if len(code) else ()
    counts: list = [None] * n
    for o, c in pairs:
        counts[o] = counts[o] or Counter()
        counts[o].update(f for f in features(names[c]) if f in stems)
    return [raised(c) if c else set() for c in counts]


def _stems(features_: dict) -> set[str]:
    return {f.split("#")[0] if f[-2:] in ("#2", "#3") else f for f in features_}


def _vectors(df: DataFrame, place: dict[str, int]) -> tuple[np.ndarray, np.ndarray, int]:
    """Sparse rows of a bounded sample: numbers of (row, feature), and how many rows there are."""
    stems = _stems(place)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                names, owner, code = _words(part.column("text"))
                rows = [sorted(place[f] for f in found if f in place) for found in _found(names, owner, code, part.num_rows, stems)]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int32()))], names=["f"])

    got = df.select("text").mapInArrow(run, "f array<int>").collect()
    sizes = [len(r.f) for r in got]
    return np.repeat(np.arange(len(got)), sizes), np.array([x for r in got for x in r.f], np.int64), len(got)


def train(positive, unlabelled, n_features: int, prior: float) -> tuple[np.ndarray, float]:
    """Weights and bias of the linear classifier by full-batch Adam on the non-negative risk."""
    (pr, pf, np_), (ur, uf, nu) = positive, unlabelled
    w, b = np.zeros(n_features), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(n_features + 1), np.zeros(n_features + 1)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    for step in range(1, STEPS + 1):
        zp = np.bincount(pr, w[pf], minlength=np_) + b
        zu = np.bincount(ur, w[uf], minlength=nu) + b
        sp, su = sigmoid(zp), sigmoid(zu)
        negative = -np.log1p(-np.minimum(su, 1 - 1e-12)).mean() + prior * np.log1p(-np.minimum(sp, 1 - 1e-12)).mean()
        gp = prior * (sp - 1) / np_          # positives as positives
        gn_u, gn_p = su / nu, -prior * sp / np_  # all as negatives, less the positives in it
        if negative < 0:                     # over-fitted: climb back on the negative part alone
            gp, gn_u, gn_p = np.zeros_like(gp), -gn_u, -gn_p
        both = gp + gn_p
        g = np.empty(n_features + 1)
        g[:-1] = np.bincount(pf, both[pr], minlength=n_features) + np.bincount(uf, gn_u[ur], minlength=n_features) + DECAY * w
        g[-1] = both.sum() + gn_u.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        change = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - change[:-1], b - change[-1]
    return w, float(b)


def _sample(df: DataFrame, n: int, doc_id: str) -> DataFrame:
    """About ``n`` rows at most, by hash of the id."""
    total = df.count()
    return df if total <= n else df.filter(F.pmod(F.xxhash64(doc_id, F.lit("sample")), F.lit(1 << 20)) < int(n / total * (1 << 20)))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic") -> tuple[dict[str, float], float]:
    """Weight by feature, and the bias."""
    learn = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).filter(F.col(doc_id).isNotNull() & ~held_out(doc_id))
    marks = labels.select(F.col(doc_id).alias("doc_id"), F.col(toxic).alias("toxic")).filter(F.col(doc_id).isNotNull() & ~held_out(doc_id) & F.col(toxic).isNotNull())
    row = marks.agg(F.count("*").alias("n"), F.sum((F.col("toxic") == 1).cast("int")).alias("t")).first()
    if not row.t:
        return {}, -40.0
    prior = min(max(row.t / row.n, 1e-3), 0.9)
    # the sampled ids are few: the join sends them to the texts, not the texts to them
    chosen = F.broadcast(_sample(marks.filter("toxic = 1").select("doc_id").distinct(), POSITIVES, "doc_id"))
    positive = stored(learn.join(chosen, "doc_id", "left_semi").select("text"), "positives")
    unlabelled = stored(_sample(learn, UNLABELLED, "doc_id").select("text"), "unlabelled")
    n_p, n_u = positive.count(), unlabelled.count()
    if not n_p:
        return {}, -40.0
    least = max(LEAST_TEXTS, LEAST_SHARE * n_p)
    common = _feature_counts(positive).filter(F.col("n") >= min(least, n_p)).orderBy(F.desc("n"), "feature").limit(FEATURES)
    seen = {r.feature: r.n for r in common.collect()}
    rates = {r.feature: r.n for r in _feature_counts(unlabelled, frozenset(_stems(seen))).collect()}
    lift = min(LIFT, 0.7 / prior)  # no ratio exceeds 1 / prior: the whole population holds the positives too
    place = {}
    for f, n in sorted(seen.items()):
        expected = n_p * (rates.get(f, 0) + 0.5) / (n_u + 1)
        if n >= lift * expected and n - expected >= DEVIATIONS * np.sqrt(expected + 1):
            place[f] = len(place)
    if not place:
        return {}, float(np.log(prior / (1 - prior)))
    w, b = train(_vectors(positive, place), _vectors(unlabelled, place), len(place), prior)
    return {f: float(w[i]) for f, i in place.items()}, b


def score(docs: DataFrame, weights: dict[str, float], bias: float, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the score (0 to 1) in place of the text."""
    rest = [c for c in docs.columns if c != text]

    stems = _stems(weights)

    def run(batches):
        known: dict[str, bool] = {}
        for batch in batches:
            for part in slices(batch, text, 4 * SLICE_BYTES):
                names, owner, code = _words(part.column(text))
                if len(known) + len(names) > CACHE:
                    known.clear()
                z = np.full(part.num_rows, bias)
                for o, found in enumerate(_found(names, owner, code, part.num_rows, stems, known)):
                    if found:
                        z[o] += sum(weights[f] for f in sorted(found) if f in weights)
                p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in rest), pa.array(p)], names=[*rest, out])

    schema = T.StructType([*(docs.schema[c] for c in rest), T.StructField(out, T.DoubleType())])
    return docs.select(*rest, text).mapInArrow(run, schema)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights, bias = fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    out = score(docs, weights, bias)
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
