"""Operator 2: secret scan by patterns and sliding-window Shannon entropy, in native expressions only.

Base spans come from three fixed patterns (assignment, access key, long hex).
The entropy method adds spans: candidate strings (runs of 20 or more characters
of the base64 alphabet that hold a digit) are classed by the characters they
use, a window of ``WINDOW`` characters slides over each, and the window's
Shannon entropy follows from counts that are updated by the character that
enters and the one that leaves.  A candidate whose entropy reaches its class's
threshold adds the span from its first to its last such window, unless a base
span covers it.

The allow-list names strings within a candidate (example words, sequences, runs,
UUIDs): a window that touches one does not count, the others do, so an innocent
stretch never hides a key beside it.  Only candidates that are nothing but words
(``PATHS``) are left out whole.

Rules: null text is empty and has no spans; positions are code points, end
exclusive; spans sort by start, then kind as listed in ``KINDS``.  Each row is
worked on alone (nothing is shuffled), so repeated rows and hot sources need no
special care.  Work grows with the length of a text: a candidate is cut into
characters once, and matches are added up in chunks of ``CHUNK``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tripweave.llm.common import once, table

KINDS = ("assign", "access", "hex", "entropy")
#: The base patterns.  Runs with a least length equal the unbounded run with a length test.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"

WINDOW = 20
CANDIDATE = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{20,}+"
#: Per character class: pattern, alphabet (the place of a character is its count's index), bits a window needs.
CLASSES = (
    ("digits", "[0-9]+", "0123456789", 3.1),
    ("hex", "[0-9a-fA-F]+", "0123456789abcdefABCDEF", 3.2),
    ("base64", "[A-Za-z0-9+/_-]+", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-", 3.7),
)
#: Strings that are no secrets, each with its length: example words, sequences, runs of six, UUIDs.
ALLOWED = (
    *((f"(?i){word}", len(word)) for word in ("example", "sample", "dummy", "placeholder", "changeme", "redacted", "testkey",
                                              "abcdefgh", "01234567", "12345678")),
    (r"(.)\1{5}", 6),
    (r"(?i)(?<![0-9a-z])[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}(?![0-9a-z])", 36),
)
#: Candidates of words alone, with a short number at most.
PATHS = r"^[A-Za-z]*(?:[/_-][A-Za-z]+){3,}[/_-]?[0-9]{0,4}$"
#: What an allowed string is written over with: outside of every alphabet.
_FILLER = "."
#: Matches that are added up at one time.
CHUNK = 128


def matches(text: Column, pattern: str, group: int | None = None) -> Column:
    """Array of (start, end, text, part) of a pattern's leftmost non-overlapping matches; ``part`` is a group's text."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = found if group is None else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.transform(F.split(text, pattern, -1), F.char_length)
    rows = F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("gap"), found.alias("found"), part.alias("part"))
    none = F.array().cast("array<struct<start:int,end:int,text:string,part:string>>")
    start = F.struct(F.lit(0).alias("at"), none.alias("out"))

    def step(acc, x):
        a = acc["at"] + x["gap"]
        b = a + F.char_length(x["found"])
        one = F.struct(a.alias("start"), b.alias("end"), x["found"].alias("text"), x["part"].alias("part"))
        return F.struct(b.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    def chunks(xs):
        """Each chunk's matches as if it stood at 0, then moved to where the chunks before it end."""
        n = F.floor((F.size(xs) + (CHUNK - 1)) / CHUNK).cast("int")
        each = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.aggregate(F.slice(xs, i * CHUNK + 1, F.lit(CHUNK)), start, step))
        return once(each, lambda parts: once(ends(parts), lambda at: F.flatten(F.transform(parts, lambda p, i: F.transform(
            p["out"], lambda m: F.struct((m["start"] + F.get(at, i)).alias("start"), (m["end"] + F.get(at, i)).alias("end"),
                                         m["text"].alias("text"), m["part"].alias("part")))))))

    def ends(parts):
        """Where each chunk begins."""
        return F.aggregate(parts, F.array(F.lit(0)), lambda acc, p: F.concat(acc, F.array(F.element_at(acc, -1) + p["at"])))

    return once(rows, lambda xs: F.when(F.size(xs) > 0, chunks(xs)).otherwise(none))


_SPAN = "array<struct<start:int,kind:int,end:int>>"


def _spans(condition: Column, found: Column, kind: str, keep=None) -> Column:
    found = F.filter(found, keep) if keep else found
    k = F.lit(KINDS.index(kind))
    out = F.transform(found, lambda m: F.struct(m["start"].alias("start"), k.alias("kind"), m["end"].alias("end")))
    return F.when(condition, out.cast(_SPAN)).otherwise(F.array().cast(_SPAN))


def base_spans(text: Column) -> Column:
    """Array of (start, kind, end) of the three patterns; the conditions only spare texts that cannot match."""
    return F.concat(
        _spans(text.rlike("[:=]") & text.rlike(ASSIGN), matches(text, ASSIGN, 2), "assign",
               lambda m: F.char_length(m["part"]) >= 8),
        _spans(F.contains(text, F.lit("AKIA")), matches(text, ACCESS), "access"),
        _spans(text.rlike(HEX), matches(text, HEX), "hex"),
    )


def window_hits(value: Column, alphabet: str, least: float) -> Column:
    """(first, last): start of the first and end of the last window of ``value`` with ``least`` bits; null if none.

    The state is a count per character of the alphabet, the sum of c*log2(c)
    over the counts, and how many characters of the window are outside of the
    alphabet (a window with such a one does not count); a window's entropy is
    log2(WINDOW) - sum / WINDOW.
    """
    plogp = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(WINDOW + 2)])
    limit = WINDOW * (math.log2(WINDOW) - least) + 1e-9
    start = F.struct(F.array_repeat(F.lit(0), len(alphabet)).alias("n"), F.lit(0.0).alias("s"), F.lit(0).alias("outside"), F.lit(0).alias("end"),
                     F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last"))

    def step(acc, move):
        enters, leaves = move["enters"], move["leaves"]
        less = F.coalesce(F.get(acc["n"], leaves - 1), F.lit(0))
        s = F.when(leaves > 0, acc["s"] - F.get(plogp, less) + F.get(plogp, less - 1)).otherwise(acc["s"])
        more = F.coalesce(F.get(acc["n"], enters - 1), F.lit(0)) - F.when(enters == leaves, 1).otherwise(0)
        s = F.when(enters > 0, s + F.get(plogp, more + 1) - F.get(plogp, more)).otherwise(s)
        n = F.when(enters == leaves, acc["n"]).otherwise(F.transform(acc["n"], lambda x, j: F.when(j + 1 == enters, x + 1).when(j + 1 == leaves, x - 1).otherwise(x)))
        outside = acc["outside"] + F.when(enters == 0, 1).otherwise(0) - F.when(leaves == 0, 1).otherwise(0)
        return F.struct(n.alias("n"), s.alias("s"), outside.alias("outside"), (acc["end"] + 1).alias("end"), acc["first"].alias("first"), acc["last"].alias("last"))

    def mark(x):
        hit = (x["end"] >= WINDOW) & (x["outside"] == 0) & (x["s"] <= limit)
        return F.struct(x["n"].alias("n"), x["s"].alias("s"), x["outside"].alias("outside"), x["end"].alias("end"),
                        F.when(hit & x["first"].isNull(), x["end"] - WINDOW).otherwise(x["first"]).alias("first"),
                        F.when(hit, x["end"]).otherwise(x["last"]).alias("last"))

    # 0: outside of the alphabet; what leaves is what entered WINDOW moves before, nothing (null) at first
    codes = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(alphabet), c))
    moves = once(codes, lambda x: F.slice(F.arrays_zip(x.alias("enters"), F.concat(F.array_repeat(F.lit(None).cast("int"), WINDOW), x).alias("leaves")), 1, F.size(x)))
    done = F.aggregate(moves, start, lambda acc, m: once(step(acc, m), mark))
    return once(done, lambda x: F.struct(x["first"].alias("first"), x["last"].alias("last")))


def entropy_spans(text: Column, allowed: tuple[tuple[str, int], ...] = ALLOWED) -> Column:
    """Array of (start, kind, end) that the entropy method finds, before base spans are taken into account."""
    def hits(m):
        shown = m["text"]
        for pattern, length in allowed:
            shown = F.regexp_replace(shown, pattern, _FILLER * length)

        def rated(value):
            out = F.lit(None)
            for _, pattern, alphabet, least in reversed(CLASSES):
                out = F.when(m["text"].rlike(f"^{pattern}$"), window_hits(value, alphabet, least)).otherwise(out)
            return out

        return F.struct(m["start"].alias("at"), F.when(~m["text"].rlike(PATHS), once(shown, rated)).alias("hit"))

    rated = F.filter(F.transform(matches(text, CANDIDATE), hits), lambda x: x["hit"]["first"].isNotNull())
    out = F.transform(rated, lambda x: F.struct((x["at"] + x["hit"]["first"]).alias("start"), F.lit(KINDS.index("entropy")).alias("kind"),
                                                (x["at"] + x["hit"]["last"]).alias("end")))
    return F.when(text.rlike("[0-9]") & text.rlike(CANDIDATE), out.cast(_SPAN)).otherwise(F.array().cast(_SPAN))


def scan(df: DataFrame, text: str = "text", base: str = "base", spans: str = "spans") -> DataFrame:
    """``df`` with ``base`` and ``spans`` (base and added ones): sorted arrays of (start, kind, end)."""
    t = F.coalesce(F.col(text), F.lit(""))
    out = df.withColumn(base, F.array_sort(base_spans(t))).withColumn(spans, entropy_spans(t))
    covered = lambda s: F.exists(F.col(base), lambda b: (b["start"] <= s["start"]) & (b["end"] >= s["end"]))
    return out.withColumn(spans, F.array_sort(F.concat(F.col(base), F.filter(F.col(spans), lambda s: ~covered(s)))))


def joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each stretch of (sorted, maybe overlapping) spans replaced by ``mark``."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(s["start"] >= acc["at"], F.concat(acc["out"], gap, F.lit(mark))).otherwise(acc["out"]).alias("out"))

    done = F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "base", "spans")
    count = lambda i: F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long")
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"),
                        F.size(F.filter("spans", lambda s: s["kind"] == 3)).cast("long").alias("n_entropy"))
