"""Operator 9: duplicate passages by a compressed FM-index per shard.

A window is ``WINDOW`` consecutive words of a document.  A word is removed if a
window that covers it also starts in a document with a smaller id.

Windows go to shards by content: each chooses its smallest ``GRAM``-gram (by hash,
leftmost first), so equal windows choose equal grams, and neighbouring windows
mostly the same one.

1. Documents are stored in blocks of some MB.  Each block announces its chosen
   grams, once each, to the grams' shards; a shard tells each block which of
   them another document has as well.
2. For those only, a block sends the passages (the words of all neighbouring
   windows that chose one gram) to the gram's shard, equal ones once, with the
   smallest and greatest id that has them.  The shard builds an FM-index over
   its distinct passages, streams them through it by backward search over the
   wavelet matrix, and gets from each window's suffix range the smallest
   document that has it.  It reports the windows whose match reaches the
   threshold, and answers those blocks that have a greater document with them.
3. Blocks with their answers mark windows and cut the words.

A passage, however frequent, reaches a shard once a block, so hot passages are
summed up before the shuffle and no group is without bound.  Words travel as
32-bit parts of 64-bit hashes, 13 in a row, within a shard chosen by 64 bits.

Rules: null text has no words; a null id counts as greater than any other;
rows that repeat an id don't remove each other's words; windows are judged on
the input, not on what is left.
"""

from __future__ import annotations

from functools import reduce
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tripweave.llm.common import groups, mixed, powers, slices, span_hashes, table, texts_of, word_spans
from tripweave.session import stored

WINDOW, GRAM = 13, 4
#: Blocks (of ``SLICE_BYTES``) whose grams or passages make one shard; shards at least.
BLOCKS_A_SHARD, SHARDS = 12, 12
_LAST = np.iinfo(np.int64).max
_PLACE = np.uint64((1 << 30) - 1)


def _blocks(df: DataFrame, text: str) -> DataFrame:
    """(block, payload): the rows of ``df`` some MB at a time, as compressed Arrow streams."""
    def run(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, text):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_batch(part)
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["block", "payload"])
                number += 1

    return df.mapInArrow(run, "block long, payload binary")


def _opened(payload: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(payload).read_next_batch()


class Windows:
    """The windows of a block's documents and the gram that each one chose."""

    def __init__(self, rows: pa.RecordBatch, doc_id: str, text: str):
        self.texts = texts_of(rows, text)
        self.ids = rows.column(doc_id).cast(pa.int64()).fill_null(_LAST).to_numpy()
        data, starts, ends, self.owner = word_spans(self.texts)
        self.words = span_hashes(data, starts, ends)
        n = len(starts)
        self.starts = np.zeros(0, np.int64)  # first words of windows, and the place of the gram that each chose
        self.grams = np.zeros(0, np.uint64)
        if n < WINDOW:
            return
        w = self.words
        gram = w[: n - GRAM + 1]
        for i in range(1, GRAM):
            gram = mixed(gram * np.uint64(3) + w[i : n - GRAM + 1 + i])
        # smallest gram of WINDOW - GRAM + 1 in a row: 34 bits of hash, then place
        key = (gram & ~_PLACE) | np.arange(len(gram), dtype=np.uint64)
        span = WINDOW - GRAM + 1
        least, have = key, 1
        while have < span:
            more = min(have, span - have)
            least = np.minimum(least[: len(least) - more], least[more:])
            have += more
        inside = np.flatnonzero(self.owner[: n - WINDOW + 1] == self.owner[WINDOW - 1 :])
        self.starts = inside
        self.chosen = (least[inside] & _PLACE).astype(np.int64)
        self.grams = gram[self.chosen]
        total = np.zeros(n + 1, np.uint64)
        up, self.down = powers(n + 1)
        np.cumsum((w + np.uint64(1)) * up[:n], out=total[1:])
        self.total = total

    def documents(self) -> np.ndarray:
        return self.ids[self.owner[self.starts]]

    def passages(self, grams: np.ndarray):
        """Of windows that chose one of ``grams`` (sorted): first and last windows' places in ``starts`` by passage, and the passages' keys."""
        at = np.flatnonzero(np.isin(self.grams, grams, assume_unique=False)) if len(grams) else np.zeros(0, np.int64)
        if not len(at):
            return at, at, np.zeros(0, np.uint64)
        # windows of one passage follow each other, within a document, and chose the same place
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1] + 1) | (self.chosen[at[1:]] != self.chosen[at[:-1]]) | (self.starts[at[1:]] != self.starts[at[:-1]] + 1)
        a = at[new]
        b = at[np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)]
        lo, hi = self.starts[a], self.starts[b] + WINDOW
        return a, b, mixed(((self.total[hi] - self.total[lo]) * self.down[lo]) ^ (hi - lo).astype(np.uint64))


def _pack(*arrays: np.ndarray) -> bytes:
    return b"".join(len(a).to_bytes(8, "little") + a.tobytes() for a in arrays)


def _unpack(data: bytes, *kinds: str) -> list[np.ndarray]:
    out, at = [], 0
    for kind in kinds:
        n = int.from_bytes(data[at : at + 8], "little")
        a = np.frombuffer(data, kind, n, at + 8)
        out.append(a)
        at += 8 + a.nbytes
    return out


def _mail(shards, blocks, blobs) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(shards, pa.int32()), pa.array(blocks, pa.int64()), pa.array(blobs, pa.binary())], names=["shard", "block", "blob"])


_MAIL = "shard int, block long, blob binary"


def _by_shard(values: np.ndarray, shards: int):
    """(shard, places of its values) of 64-bit hashes."""
    shard = (values % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    cuts = np.searchsorted(shard[order], np.arange(shards + 1))
    for s in np.unique(shard).tolist():
        yield s, order[cuts[s] : cuts[s + 1]]


def _announced(blocks: DataFrame, shards: int, doc_id: str, text: str) -> DataFrame:
    def run(batches):
        for batch in batches:
            for block, payload in zip(*(batch.column(c).to_pylist() for c in ("block", "payload"))):
                w = Windows(_opened(payload), doc_id, text)
                order = np.lexsort((w.documents(), w.grams)) if len(w.starts) else w.starts
                g, d = w.grams[order], w.documents()[order] if len(order) else w.starts
                first = np.ones(len(g), bool)
                first[1:] = g[1:] != g[:-1]
                begin = np.flatnonzero(first)
                last = np.append(begin[1:] - 1, len(g) - 1)[: len(begin)]
                g, several = g[begin], d[begin] != d[last]
                for s, at in _by_shard(g, shards):
                    yield _mail([s], [block], [_pack(g[at][several[at]], g[at][~several[at]])])

    return blocks.mapInArrow(run, _MAIL)


def _shared(mail: DataFrame) -> DataFrame:
    """Per block the grams of its own that more than one document has."""
    def run(batches):
        for part in groups(batches, ["shard"]):
            blocks = part.column("block").to_pylist()
            sent = [_unpack(x, "<u8", "<u8") for x in part.column("blob").to_pylist()]
            grams = np.concatenate([np.concatenate(x) for x in sent])
            weight = np.concatenate([np.repeat([2, 1], [len(a), len(b)]) for a, b in sent])
            order = np.argsort(grams, kind="stable")
            g = grams[order]
            begin = np.flatnonzero(np.append(True, g[1:] != g[:-1])) if len(g) else np.zeros(0, np.int64)
            often = np.add.reduceat(weight[order], begin) > 1 if len(g) else np.zeros(0, bool)
            common = np.zeros(len(g), bool)
            common[order] = np.repeat(often, np.diff(np.append(begin, len(g))))
            cuts = np.cumsum([0, *(len(a) + len(b) for a, b in sent)])
            for block, a, b in zip(blocks, cuts, cuts[1:]):
                own = grams[a:b][common[a:b]]
                if len(own):
                    yield _mail([part.column("shard")[0].as_py()], [block], [_pack(np.sort(own))])

    return mail.repartition("shard").sortWithinPartitions("shard", "block").mapInArrow(run, _MAIL)


def _sent(blocks: DataFrame, shared: DataFrame, shards: int, doc_id: str, text: str) -> DataFrame:
    """Passages of shared grams, equal ones of a block once: keys, smallest and greatest document, lengths, words."""
    own = shared.groupBy("block").agg(F.collect_list("blob").alias("blobs"))

    def run(batches):
        for batch in batches:
            for block, payload, blobs in zip(*(batch.column(c).to_pylist() for c in ("block", "payload", "blobs"))):
                w = Windows(_opened(payload), doc_id, text)
                grams = np.sort(np.concatenate([_unpack(x, "<u8")[0] for x in blobs]))
                a, b, keys = w.passages(grams)
                if not len(a):
                    continue
                docs = w.documents()[a]
                order = np.lexsort((docs, keys))
                k = keys[order]
                begin = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
                last = np.append(begin[1:] - 1, len(k) - 1)
                pick = order[begin]
                low, high = docs[order[begin]], docs[order[last]]
                lo, size = w.starts[a[pick]], b[pick] - a[pick] + WINDOW
                words = (w.words >> np.uint64(32)).astype("<u4")
                for s, at in _by_shard(w.grams[a[pick]], shards):
                    n = size[at]
                    where = np.repeat(lo[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                    yield _mail([s], [block], [_pack(keys[pick[at]], low[at], high[at], n.astype("<u1"), words[where])])

    return blocks.join(own, "block").select("block", "payload", "blobs").mapInArrow(run, _MAIL)


def _judged(mail: DataFrame) -> DataFrame:
    """Per shard the FM-index and its answers: per block (keys, lengths in windows, smallest document by window)."""
    from tripweave.llm.fm_index import FMIndex

    def run(batches):
        pack = zstandard.ZstdCompressor(1).compress
        for part in groups(batches, ["shard"]):
            blocks = part.column("block").to_pylist()
            sent = [_unpack(x, "<u8", "<i8", "<i8", "<u1", "<u4") for x in part.column("blob").to_pylist()]
            keys, low, high, size = (np.concatenate([x[i] for x in sent]) for i in range(4))
            words, size = np.concatenate([x[4] for x in sent]), size.astype(np.int64)
            distinct, pick, code = np.unique(keys, return_index=True, return_inverse=True)
            least = np.full(len(distinct), _LAST)
            np.minimum.at(least, code, low)
            # the distinct passages, each followed by a separator
            n = size[pick]
            begin = (np.cumsum(size) - size)[pick]
            lay = np.cumsum(n + 1) - (n + 1)
            at = np.repeat(lay, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            names, symbol = np.unique(words[np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())], return_inverse=True)
            stream = np.zeros(int((n + 1).sum()), np.int64)
            stream[at] = symbol + 1
            index = FMIndex(stream, len(names) + 1)
            # every window of every passage, as a stream against the index
            count = n - WINDOW + 1
            owner = np.repeat(np.arange(len(n)), count)
            offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            length, lo, hi = index.statistics(stream, lay[owner] + offset + WINDOW, WINDOW, alone=True)
            passage = np.repeat(np.arange(len(n)), n + 1)[index.suffixes]  # of each suffix
            # a range of one suffix is the window itself; other ranges of equally long matches are equal or apart
            smallest = np.where(hi - lo == 1, least[owner], _LAST)
            full = np.flatnonzero((hi - lo > 1) & (length == WINDOW))  # at the threshold
            if len(full):
                ranges, at_, which = np.unique(lo[full], return_index=True, return_inverse=True)
                edges = np.stack([ranges, hi[full][at_]], axis=1).ravel()
                smallest[full] = np.minimum.reduceat(np.append(least[passage], _LAST), edges)[::2][which]
            first = np.cumsum(count) - count
            cuts = np.cumsum([0, *(len(x[0]) for x in sent)])
            for block, a, b in zip(blocks, cuts, cuts[1:]):
                c = code[a:b]
                useful = np.minimum.reduceat(smallest, first)[c] < high[a:b]
                c = c[useful]
                if len(c):
                    m = count[c]
                    where = np.repeat(first[c] - (np.cumsum(m) - m), m) + np.arange(m.sum())
                    yield _mail([part.column("shard")[0].as_py()], [block], [pack(_pack(distinct[c], m.astype("<u1"), smallest[where]))])

    return mail.repartition("shard").sortWithinPartitions("shard", "block").mapInArrow(run, _MAIL)


def _cut(blocks: DataFrame, answers: DataFrame, schema: T.StructType, doc_id: str, text: str) -> DataFrame:
    own = answers.groupBy("block").agg(F.collect_list("blob").alias("blobs"))

    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for payload, blobs in zip(*(batch.column(c).to_pylist() for c in ("payload", "blobs"))):
                rows = _opened(payload)
                gone, owner, texts = None, None, texts_of(rows, text)
                if blobs:
                    w = Windows(rows, doc_id, text)
                    got = [_unpack(unpack(x), "<u8", "<u1", "<i8") for x in blobs]
                    keys, size, least = (np.concatenate([x[i] for x in got]) for i in range(3))
                    gone, owner = _gone(w, keys, size.astype(np.int64), least), w.owner
                yield _result(rows, texts, gone, owner, schema)

    return blocks.join(own, "block", "left").select("payload", "blobs").mapInArrow(run, schema)


def _gone(w: Windows, keys: np.ndarray, size: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Which of a block's words are covered by a window that a smaller document has."""
    a, b, own = w.passages(np.unique(w.grams))
    order = np.argsort(keys)
    place = np.minimum(np.searchsorted(keys[order], own), len(keys) - 1)
    known = keys[order][place] == own
    a, b, which = a[known], b[known], order[place[known]]
    n = b - a + 1
    at = np.repeat(a - (np.cumsum(n) - n), n) + np.arange(n.sum())
    begin = (np.cumsum(size) - size)[which]
    smallest = least[np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())]
    hit = w.starts[at[smallest < w.documents()[at]]]
    change = np.zeros(len(w.words) + 1, np.int64)
    np.add.at(change, hit, 1)
    np.add.at(change, np.minimum(hit + WINDOW, len(w.words)), -1)
    return np.cumsum(change[:-1]) > 0


def _result(rows: pa.RecordBatch, texts: list[bytes], gone: np.ndarray | None, owner: np.ndarray | None, schema: T.StructType) -> pa.RecordBatch:
    n_words, n_gone, kept, spans = [], [], [], []
    cuts = None if gone is None else np.searchsorted(owner, np.arange(len(texts) + 1))
    for i, t in enumerate(texts):
        words = t.split()
        n_words.append(len(words))
        mine = None if gone is None else gone[cuts[i] : cuts[i + 1]]
        if mine is None or not mine.any():
            n_gone.append(0)
            kept.append(b" ".join(words))
            spans.append([])
            continue
        n_gone.append(int(mine.sum()))
        kept.append(b" ".join(compress(words, ~mine)))
        edge = np.flatnonzero(np.diff(mine.astype(np.int8), prepend=0, append=0))
        spans.append([{"first": int(a), "end": int(b)} for a, b in edge.reshape(-1, 2)])
    kind = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
    return pa.RecordBatch.from_arrays([*rows.columns, pa.array(n_words, pa.int64()), pa.array(n_gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(spans, kind)],
                                      names=schema.names)


def dedup(df: DataFrame, doc_id: str = "doc_id", text: str = "text", prefix: str = "") -> DataFrame:
    """``df`` with n_words, n_removed, kept (the words left, joined by a space) and removed (their spans, by word)."""
    added = [f"{prefix}{c}" for c in ("n_words", "n_removed", "kept", "removed")]
    if clash := {c.lower() for c in added} & {c.lower() for c in df.columns}:
        raise ValueError(f"columns exist already: {sorted(clash)}")
    span = T.ArrayType(T.StructType([T.StructField("first", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    kinds = (T.LongType(), T.LongType(), T.StringType(), span)
    schema = reduce(lambda s, x: s.add(*x), zip(added, kinds), T.StructType(list(df.schema.fields)))
    blocks = stored(_blocks(df, text), "blocks")
    shards = max(SHARDS, -(-blocks.count() // BLOCKS_A_SHARD))
    shared = stored(_shared(_announced(blocks, shards, doc_id, text)), "shared_grams")
    answers = stored(_judged(_sent(blocks, shared, shards, doc_id, text)), "answers")
    return _cut(blocks, answers, schema, doc_id, text)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
