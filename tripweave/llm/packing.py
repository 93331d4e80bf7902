"""Operator 10: best-fit packing of token pieces into sequences, by hierarchical residual packing.

Each document is its token ids and a closing id 0.  Only documents longer than
``capacity`` are cut, into pieces of ``capacity`` and a last, shorter one.

Round 0: every partition packs its own pieces best-fit decreasing and emits the
bins that are nearly full (at most ``slack`` places free).  The underfull bins
become items of the next round, where ``FAN_IN`` partitions' bins meet in one
and are packed again, and so on until one partition is left or a round no
longer saves a bin.  A task never gets more than ``ITEMS`` items: the number of
partitions of a round follows from the count of items, so where items cannot be
combined (all longer than half a sequence) the tree just stops early.

Rules: null text is empty (one piece: id 0); ties go by length, then document,
then piece; repeated rows are packed each on its own; a null doc_id is packed
like any other; an empty table gives no rows.  Every round is written to the
shared folder, so that a lost executor repeats only its part and every reader
sees one and the same packing.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tripweave.llm.byte_bpe import byte_map
from tripweave.llm.common import SLICE_BYTES, slices, table, worker_memory
from tripweave.session import stored

VOCABULARY = "word_bpe_49k.json"
CAPACITY = 2048
#: Free places up to which a bin counts as nearly full.
SLACK = 4
#: Partitions that meet in one partition of the next round, and items that a task packs at most.
FAN_IN, ITEMS = 16, 200_000
#: Words, and parts of words, that a worker remembers; beyond, it starts anew.
WORDS, PARTS = 500_000, 700_000

_PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class WordIds:
    """Token ids (little-endian unsigned 32-bit) of texts, word by word.

    The vocabulary's own splitting drops white space and never joins across it,
    so a text's ids are those of its words in order.  A word's trailing ASCII
    punctuation (no apostrophe) is likewise a split of its own if a letter or
    digit is before it; after any other character it belongs to that one's run.
    Only Latin letters and digits are asked for here, since others may end in a
    mark once normalised (so does U+0130).  What is left mostly is one run of
    Latin letters, which goes to the merge model at once.

    A text that spells a special token gets that token's id, as the library has
    it by default; with ``special_as_text`` it stays text.  A word that holds
    such a spelling goes to the tokenizer whole.
    """

    def __init__(self, path: str, special_as_text: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = () if special_as_text else tuple(t.content for t in added)
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _part_ids(self, part: str) -> bytes:
        low = part.lower()
        if low.isalpha() and max(low) < "\u0250":  # one lower-case run, composed already: no splitting, no normalising
            mapped = low.encode().decode("latin-1").translate(byte_map())
            ids = [t.id for t in self.tokenizer.model.tokenize(mapped)]
        else:
            ids = self.tokenizer.encode(part, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word_ids(self, word: str) -> bytes:
        if any(x in word for x in self.special):
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)
        stem = word.rstrip(_PUNCTUATION)
        apart = stem and stem[-1].isalnum() and stem[-1] < "\u0250" and stem[-1] != "\u0130"
        out = b""
        for part in (stem, word[len(stem):]) if apart else (word,):
            if part:
                key = part.lower() if part.isascii() else part
                if (ids := self.parts.get(key)) is None:
                    ids = self.parts[key] = self._part_ids(key)
                out += ids
        return out

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text; null is empty.  Words are numbered by Arrow, so each is looked up once a call."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.string()), ""))
        coded = split.flatten().dictionary_encode()
        for memory, most in ((self.words, WORDS), (self.parts, PARTS)):
            if len(memory) + len(coded.dictionary) > most:
                memory.clear()
        known, ids = self.words, []
        for w in coded.dictionary.to_pylist():
            if (x := known.get(w)) is None:
                x = known[w] = self._word_ids(w)
            ids.append(x)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), "<u4")
        words = coded.indices.to_numpy()
        each = sizes[words] if len(words) else np.zeros(0, np.int64)
        ends = np.concatenate([[0], np.cumsum(each)])
        first = (np.cumsum(sizes) - sizes)[words] if len(words) else each
        data = flat[np.repeat(first - ends[:-1], each) + np.arange(ends[-1])].tobytes()
        at = 4 * ends[split.offsets.to_numpy() - split.offsets[0].as_py()]
        return [data[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def _word_ids(path: str, special_as_text: bool) -> WordIds:
    return worker_memory((path, special_as_text), lambda: WordIds(path, special_as_text))


PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()),
    T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()),
])


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, special_as_text: bool = False) -> DataFrame:
    """(doc_id, text) to one row per piece: its place, length and the checksum of its ids."""
    path = path or public_tokenizers.path(VOCABULARY)
    wide = 4 * capacity

    def run(batches):
        coder = _word_ids(path, special_as_text)
        for batch in batches:
            for part in slices(batch, "text", 8 * SLICE_BYTES):
                ids = [x + b"\0\0\0\0" for x in coder.encode(part.column("text"))]
                rows = [(d, i, x[a : a + wide]) for d, x in zip(part.column("doc_id").to_pylist(), ids)
                        for i, a in enumerate(range(0, len(x), wide))]
                yield pa.RecordBatch.from_arrays([
                    pa.array([d for d, _, _ in rows], pa.int64()), pa.array([i for _, i, _ in rows], pa.int32()),
                    pa.array([i * capacity for _, i, _ in rows], pa.int64()),
                    pa.array([len(x) // 4 for _, _, x in rows], pa.int64()),
                    pa.array([zlib.crc32(x) for _, _, x in rows], pa.int64()),
                ], names=PIECES.names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins (lists of indices) of best-fit in the given order; a bin's free room never exceeds ``capacity``."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set if a bin has r places free
    for i, n in enumerate(lengths):
        fitting = rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[b].append(i)
        else:
            room, b = capacity, len(bins)
            bins.append([i])
        if left := room - n:
            by_room[left].append(b)
            rooms |= 1 << left
    return bins


#: A packed piece inside a bin, and a bin: its members travel as bytes of this layout.
_MEMBER = np.dtype([("doc_id", "<i8"), ("none", "<i8"), ("piece", "<i8"), ("start", "<i8"), ("length", "<i8"), ("crc", "<i8")])
_BINS = T.StructType([
    T.StructField("done", T.BooleanType()), T.StructField("used", T.LongType()),
    T.StructField("first", T.LongType()), T.StructField("members", T.BinaryType()),
])


def _emit(items: list[tuple[int, int, bytes]], capacity: int, slack: int) -> Iterator[pa.RecordBatch]:
    """Pack (used, first, members) items; bins of up to 1000 a batch."""
    items.sort(key=lambda x: (-x[0], x[1], x[2]))
    bins = best_fit([n for n, _, _ in items], capacity)
    for at in range(0, len(bins), 1000):
        rows = [[items[i] for i in b] for b in bins[at : at + 1000]]
        used = [sum(x[0] for x in b) for b in rows]
        yield pa.RecordBatch.from_arrays([
            pa.array([capacity - n <= slack for n in used]), pa.array(used, pa.int64()),
            pa.array([min(x[1] for x in b) for b in rows], pa.int64()),
            pa.array([b"".join(x[2] for x in b) for b in rows], pa.binary()),
        ], names=_BINS.names)


def pack(items: DataFrame, capacity: int = CAPACITY, slack: int = SLACK) -> DataFrame:
    """Pieces (columns of ``PIECES``) with the sequence_id and offset of their place."""

    def first_round(batches):
        held: list[tuple[int, int, bytes]] = []
        for batch in batches:
            rows = np.zeros(batch.num_rows, _MEMBER)
            doc = batch.column("doc_id")
            rows["doc_id"] = doc.fill_null(0).to_numpy()
            rows["none"] = doc.is_null().to_numpy(zero_copy_only=False)
            for name, column in (("piece", "piece"), ("start", "start"), ("length", "length"), ("crc", "ids_crc32")):
                rows[name] = batch.column(column).to_numpy()
            held += [(int(r["length"]), int(r["doc_id"]), r.tobytes()) for r in rows]
            if len(held) >= ITEMS:
                yield from _emit(held, capacity, slack)
                held = []
        yield from _emit(held, capacity, slack)

    def next_round(batches):
        held: list[tuple[int, int, bytes]] = []
        for batch in batches:
            held += zip(batch.column("used").to_pylist(), batch.column("first").to_pylist(),
                        batch.column("members").to_pylist())
            if len(held) >= ITEMS:
                yield from _emit(held, capacity, slack)
                held = []
        yield from _emit(held, capacity, slack)

    level = stored(items.select(*PIECES.names).mapInArrow(first_round, _BINS), "bins0")
    finished, left, before, n = [], level.filter("not done"), math.inf, 0
    parts = max(1, len(level.inputFiles()))
    while True:
        finished.append(level.filter("done"))
        count = left.count()
        if not count or count >= before or (n and parts == 1):
            finished.append(left)
            break
        before, n = count, n + 1
        parts = max(math.ceil(parts / FAN_IN), math.ceil(count / ITEMS))
        # dealt by length and first document: the same bins meet again if a task is repeated
        dealt = left.select("used", "first", "members").repartition(parts, F.xxhash64("used", "first", "members"))
        level = stored(dealt.mapInArrow(next_round, _BINS), f"bins{n}")
        left = level.filter("not done")
    bins = finished[0]
    for more in finished[1:]:
        bins = bins.unionByName(more)
    return _places(bins)


def _places(bins: DataFrame) -> DataFrame:
    schema = T.StructType([*PIECES.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(batches):
        for batch in batches:
            ids = batch.column("sequence_id").to_numpy()
            members = [np.frombuffer(m, _MEMBER) for m in batch.column("members").to_pylist()]
            if not members:
                continue
            rows = np.concatenate(members)
            offsets = np.concatenate([np.cumsum(m["length"]) - m["length"] for m in members])
            yield pa.RecordBatch.from_arrays([
                pa.array(rows["doc_id"], mask=rows["none"].astype(bool)), pa.array(rows["piece"].astype(np.int32)),
                pa.array(rows["start"]), pa.array(rows["length"]), pa.array(rows["crc"]),
                pa.array(np.repeat(ids, [len(m) for m in members])), pa.array(offsets),
            ], names=schema.names)

    return bins.select(F.monotonically_increasing_id().alias("sequence_id"), "members").mapInArrow(run, schema)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, special_as_text: bool = False) -> DataFrame:
    return pack(stored(pieces(docs, capacity, path, special_as_text), "pieces"), capacity)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
