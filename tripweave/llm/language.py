"""Operator 6: language identification by Bayesian evidence fusion.

Text likelihood: byte trigrams of the lower-cased text (anything but letters is
a blank), hashed to ``BINS`` bins, whose frequencies per declared language are
counted over the whole table.  Declared language (a markup attribute or a
column): P(declared | language) from the counts of declared against text-most-
likely language.  Address: a prior per host, smoothed towards its suffix's,
which is smoothed towards the whole table's; all three are sums of the texts'
own posteriors, by grouped aggregation.  The log evidences add up.

A text's likelihood counts as if it had at most ``EVIDENCE`` trigrams, since
neighbouring trigrams repeat each other's evidence.

Rules: a row without letters has no text evidence and is rejected, as is one
whose best language stays under ``LEAST``; a null declared value, host or
suffix adds nothing; a declared tag counts by its primary subtag (``pt-BR`` is ``pt``);
languages are the codes of ISO 639 (``CODES``) whose declared rows
hold ``TRIGRAMS`` trigrams, however small their share, and any other values that
``SHARE`` of the declared rows name (so there are at most as many as codes and
1 / SHARE); without any, all rows are rejected.
Ties go to the first language by name.  Rows are never grouped by host in one
place: hosts are summed with map-side partial sums, and their priors are stored
and joined back, a hot host's rows staying spread over the partitions.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tripweave.llm.common import free_name, groups, once, slices, table, texts_of, worker_memory
from tripweave.session import stored

BINS = 1 << 14
EVIDENCE = 100
LEAST = 0.5
#: Trigrams of declared rows that a language code needs, whatever the size of the table.
TRIGRAMS = 1000
#: Share of the declared rows that any other value needs; strengths of the smoothing towards the suffix and the whole.
SHARE, TO_SUFFIX, TO_ALL = 0.001, 20.0, 100.0

#: ISO 639-1, and those of ISO 639-2 without a code there (no collections of none, many or unknown languages).
CODES = frozenset("""
    aa ab ae af ak am an ar as av ay az ba be bg bh bi bm bn bo br bs ca ce ch co cr cs cu cv cy da de dv dz ee el en eo es et eu fa ff fi
    fj fo fr fy ga gd gl gn gu gv ha he hi ho hr ht hu hy hz ia id ie ig ii ik io is it iu ja jv ka kg ki kj kk kl km kn ko kr ks ku kv kw
    ky la lb lg li ln lo lt lu lv mg mh mi mk ml mn mr ms mt my na nb nd ne ng nl nn no nr nv ny oc oj om or os pa pi pl ps pt qu rm rn ro
    ru rw sa sc sd se sg si sk sl sm sn so sq sr ss st su sv sw ta te tg th ti tk tl tn to tr ts tt tw ty ug uk ur uz ve vi vo wa wo xh yi
    yo za zh zu ace ach ada ady afa afh ain akk ale alg alt ang anp apa arc arn arp art arw ast ath aus awa bad bai bal ban bas bat bej bem
    ber bho bik bin bla bnt bra btk bua bug byn cad cai car cau ceb cel chb chg chk chm chn cho chp chr chy cmc cnr cop cpe cpf cpp crh crp
    csb cus dak dar day del den dgr din doi dra dsb dua dum dyu efi egy eka elx enm ewo fan fat fil fiu fon frm fro frr frs fur gaa gay gba
    gem gez gil gmh goh gon gor got grb grc gsw gwi hai haw hil him hit hmn hsb hup iba ijo ilo inc ine inh ira iro jbo jpr jrb kaa kab kac
    kam kar kaw kbd kha khi kho kmb kok kos kpe krc krl kro kru kum kut lad lah lam lez lol loz lua lui lun luo lus mad mag mai mak man map
    mas mdf mdr men mga mic min mkh mnc mni mno moh mos mun mus mwl mwr myn myv nah nai nap nds new nia nic niu nog non nqo nso nub nwc nym
    nyn nyo nzi osa ota oto paa pag pal pam pap pau peo phi phn pon pra pro raj rap rar roa rom rup sad sah sai sal sam sas sat scn sco sel
    sem sga sgn shn sid sio sit sla sma smi smj smn sms snk sog son srn srr ssa suk sus sux syc syr tai tem ter tet tig tiv tkl tlh tli tmh
    tog tpi tsi tum tup tut tvl tyv udm uga umb vai vot wak wal war was wen xal yao yap ypk zap zbl zen zgh znd zun zza
""".split())

_LETTER = np.full(256, 0x20, np.uint8)
_LETTER[0x80:] = np.arange(0x80, 0x100)
for _a in (0x41, 0x61):
    _LETTER[_a : _a + 26] = np.arange(0x61, 0x7B)


def trigrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bins of all trigrams that hold a letter in their middle, and the number of each one's text."""
    sizes = np.array([len(t) + 4 for t in texts])
    data = _LETTER[np.frombuffer(b"".join(b"  " + t + b"  " for t in texts), np.uint8)]
    owner = np.repeat(np.arange(len(texts)), sizes)
    keep = np.flatnonzero(data[1:-1] != 0x20)
    x = data.astype(np.uint32)
    code = (x[:-2] << np.uint32(16) | x[1:-1] << np.uint32(8) | x[2:])[keep]
    return ((code * np.uint32(0x9E3779B1)) >> np.uint32(32 - 14)).astype(np.int64), owner[keep]


def _lower(batch, text):
    return pa.RecordBatch.from_arrays([pc.utf8_lower(batch.column(text).cast(pa.string()))], names=["t"])


def primary(declared) -> F.Column:
    """The primary subtag of a declared language, in lower case; any other value as it is."""
    return F.regexp_replace(F.lower(declared), r"^([a-z]{2,3})[-_].*$", "$1")


@dataclass
class Model:
    """Languages, log trigram frequencies, log P(declared | language) with a last row for other values, and the stored priors by host and by suffix."""

    languages: list[str]
    grams: np.ndarray
    channel: np.ndarray
    hosts: DataFrame
    suffixes: DataFrame
    overall: list[float]


def _evidence(df: DataFrame, text: str, model: Model, out: str, declared: str | None = None) -> DataFrame:
    """``df`` with (logs by language, letters): log likelihoods of the text, and of the declared value if one is named."""
    columns = df.columns
    grams, channel = model.grams, model.channel
    place = {x: i for i, x in enumerate(model.languages)}
    n, kind = len(place), T.StructType([T.StructField("logs", T.ArrayType(T.DoubleType())), T.StructField("letters", T.BooleanType())])

    def run(batches):
        worker_memory("language")
        for batch in batches:
            for part in slices(batch, text):
                bins, owner = trigrams(texts_of(_lower(part, text), "t"))
                found = np.bincount(owner, minlength=part.num_rows)
                sums = np.empty((part.num_rows, n))
                for i, g in enumerate(grams):
                    sums[:, i] = np.bincount(owner, g[bins], minlength=part.num_rows)
                sums *= (np.minimum(found, EVIDENCE) / np.maximum(found, 1))[:, None]
                if declared:
                    said = part.column(declared).to_pylist()
                    at = np.flatnonzero([bool(x) for x in said])
                    sums[at] += channel[[place.get(said[i], n) for i in at]]
                logs = pa.ListArray.from_arrays(np.arange(0, sums.size + 1, n, dtype=np.int32), pa.array(sums.ravel()))
                rows = pa.StructArray.from_arrays([logs, pa.array(found > 0)], names=["logs", "letters"])
                yield pa.RecordBatch.from_arrays([*part.columns, rows], names=[*columns, out])

    return df.mapInArrow(run, T.StructType([*df.schema, T.StructField(out, kind)]))


def _shares(logs: F.Column) -> F.Column:
    """Log weights to shares that add up to 1."""
    raised = once(logs, lambda x: once(F.array_max(x), lambda top: F.transform(x, lambda v: F.exp(v - top))))
    return once(raised, lambda r: once(F.aggregate(r, F.lit(0.0), lambda a, y: a + y), lambda total: F.transform(r, lambda v: v / total)))


def _counted(named: DataFrame, languages: list[str]) -> np.ndarray:
    """Occurrences of each trigram bin by declared language, languages by ``BINS``; the driver gets one row per language."""
    place = {x: i for i, x in enumerate(languages)}

    def count(batches):
        worker_memory("language")
        held = np.zeros((len(languages), BINS), np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                bins, owner = trigrams(texts_of(_lower(part, "text"), "t"))
                own = np.array([place.get(x, -1) for x in part.column("declared").to_pylist()])[owner]
                np.add.at(held, (own[own >= 0], bins[own >= 0]), 1)
        lang, b = np.nonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(lang.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(held[lang, b])], names=["lang", "bin", "n"])

    def gather(batches):
        for part in groups(batches, ["lang"]):
            row = np.zeros(BINS, np.int64)
            row[part.column("bin").to_numpy()] = part.column("n").to_numpy()
            yield pa.RecordBatch.from_arrays([part.column("lang")[:1], pa.array([row.astype("<i8").tobytes()], pa.binary())], names=["lang", "counts"])

    sums = named.select("text", "declared").mapInArrow(count, "lang int, bin int, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    out = np.zeros((len(languages), BINS))
    for r in sums.repartition("lang").sortWithinPartitions("lang").mapInArrow(gather, "lang int, counts binary").collect():
        out[r.lang] = np.frombuffer(r.counts, "<i8")
    return out


def fit(df: DataFrame, text: str = "text", declared: str = "lang", host: str | None = None, suffix: str | None = None) -> Model:
    named = df.select(F.col(text).alias("text"), primary(F.col(declared)).alias("declared"),
                      (F.col(host) if host else F.lit(None).cast("string")).alias("host"),
                      (F.col(suffix) if suffix else F.lit(None).cast("string")).alias("suffix"))
    counts = named.filter("declared IS NOT NULL AND declared <> ''").groupBy("declared").count()
    total = counts.agg(F.sum("count")).first()[0] or 0
    least = max(1, SHARE * total)
    named_by = {r.declared: r["count"] for r in counts.filter((F.col("count") >= least) | F.col("declared").isin(*CODES)).collect()}
    languages = [x for x, rows in named_by.items() if rows >= least]
    if rare := [x for x, rows in named_by.items() if rows < least]:
        # a trigram's middle is a byte of a letter
        letters = F.sum(F.octet_length(F.regexp_replace("text", r"[\x00-\x40\x5B-\x60\x7B-\x7F]+", "")))
        enough = named.filter(F.col("declared").isin(rare)).groupBy("declared").agg(letters.alias("n")).filter(F.col("n") >= TRIGRAMS)
        languages += [r.declared for r in enough.collect()]
    languages.sort()
    place = {x: i for i, x in enumerate(languages)}
    n = len(languages)
    if not n:
        return Model([], np.ones((0, BINS)), np.zeros((1, 0)), counts, counts, [])
    seen = _counted(named, languages) + 1
    model = Model(languages, np.log(seen / seen.sum(axis=1, keepdims=True)), np.zeros((n + 1, n)), counts, counts, [])
    # one scan for all sums: by declared value, by host and by suffix
    posterior = _evidence(named, "text", model, "e").filter("e.letters").withColumn("p", _shares(F.col("e.logs"))).select("declared", "host", "suffix", "p")
    sums = [F.sum(F.get("p", F.lit(i))).alias(f"s{i}") for i in range(n)]
    known = F.when(F.col("declared").isin(languages), F.col("declared"))
    summed = posterior.withColumn("declared", known).groupBy("declared", "host", "suffix").agg(*sums)
    cells = stored(summed.select("declared", "host", "suffix", F.array(*[f"s{i}" for i in range(n)]).alias("s")), "language_cells")
    again = F.array(*[F.sum(F.get("s", F.lit(i))) for i in range(n)]).alias("s")
    whole = np.array(cells.agg(again).first().s, float)
    whole = np.nan_to_num(whole) + 1
    overall = whole / whole.sum()
    channel = np.full((n + 1, n), 0.5)  # declared languages and any other value, by language
    for r in cells.filter("declared IS NOT NULL").groupBy("declared").agg(again).collect():
        channel[place[r.declared]] += r.s
    model.channel = np.log(channel / channel.sum(axis=0))

    def priors(key, parent, strength, name):
        """Smoothed shares by ``key``: (key, its log shares)."""
        own = cells.filter(F.col(key).isNotNull()).groupBy(key, *([] if parent is None else ["suffix"])).agg(again)
        base = F.array(*map(F.lit, overall.tolist()))
        if parent is not None:
            own = own.join(parent.withColumnRenamed("logs", "up"), "suffix", "left")
            base = F.coalesce(F.transform("up", F.exp), base)
        size = F.aggregate("s", F.lit(0.0), lambda a, x: a + x)
        logs = once(size, lambda total: F.zip_with("s", base, lambda x, up: F.log((x + strength * up) / (total + strength))))
        return stored(own.select(*([key] if parent is None else [key, "suffix"]), logs.alias("logs")), name)

    model.suffixes = priors("suffix", None, TO_ALL, "suffix_priors")
    model.hosts = priors("host", model.suffixes, TO_SUFFIX, "host_priors")
    model.overall = np.log(overall).tolist()
    return model


def identify(df: DataFrame, model: Model, text: str = "text", declared: str = "lang", host: str | None = None,
             suffix: str | None = None, verdict: str = "language") -> DataFrame:
    """``df`` with a struct ``verdict``: (language, confidence, accepted)."""
    if not model.languages:
        none = F.struct(F.lit(None).cast("string").alias("language"), F.lit(0.0).alias("confidence"), F.lit(False).alias("accepted"))
        return df.withColumn(verdict, none)
    e, say, up_host, up_suffix, key_h, key_s = (free_name(df, x) for x in ("_evidence", "_say", "_by_host", "_by_suffix", "_host", "_suffix"))
    out = _evidence(df.withColumn(say, primary(F.col(declared))), text, model, e, say).drop(say)
    prior = F.array(*map(F.lit, model.overall))
    if suffix:
        out = out.join(model.suffixes.select(F.col("suffix").alias(key_s), F.col("logs").alias(up_suffix)), F.col(suffix) == F.col(key_s), "left").drop(key_s)
        prior = F.coalesce(up_suffix, prior)
    if host:
        mine = model.hosts.select(F.col("host").alias(key_h), F.col("suffix").alias(key_s), F.col("logs").alias(up_host))
        same = F.lit(None).cast("string").eqNullSafe(F.col(key_s)) if not suffix else F.col(suffix).eqNullSafe(F.col(key_s))
        out = out.join(mine, (F.col(host) == F.col(key_h)) & same, "left").drop(key_h, key_s)
        prior = F.coalesce(up_host, prior)
    fused = _shares(F.zip_with(F.col(f"{e}.logs"), prior, lambda a, b: a + b))
    names = F.array(*map(F.lit, model.languages))

    def verdict_of(shares):
        return once(F.array_max(shares), lambda best: F.struct(
            F.get(names, (F.array_position(shares, best) - 1).cast("int")).alias("language"), best.alias("confidence"),
            (F.col(f"{e}.letters") & (best >= LEAST)).alias("accepted")))

    return out.withColumn(verdict, once(fused, verdict_of)).drop(e, up_host, up_suffix)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: its column lang is the declared language, its source the host."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    out = identify(docs, fit(docs, host="source"), host="source")
    return out.select("doc_id", F.col("lang").alias("declared"), "language.language", "language.confidence", "language.accepted")


def language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every web page: declared markup language, address suffix and host."""
    pages = table(spark, sf_dir, "pages").select(
        "page_id", F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1>", " "), r"(?s)<[^>]*>|&[a-z]+;", " ").alias("text"),
        F.nullif(F.lower(F.regexp_extract("html", r"(?is)<html[^>]*\blang=[\"']?([a-z]{2})", 1)), F.lit("")).alias("lang"),
        F.lower(F.regexp_extract("url", r"^[a-zA-Z]+://([^/:?#]+)", 1)).alias("host"))
    pages = pages.withColumn("suffix", F.substring_index("host", ".", -1))
    out = identify(pages, fit(pages, host="host", suffix="suffix"), host="host", suffix="suffix")
    return out.select("page_id", "host", F.col("lang").alias("declared"), "language.language", "language.confidence", "language.accepted")
