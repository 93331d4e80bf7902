"""Operator 4: byte-level BPE encoding and decoding by a sentencepiece model.

A rank vocabulary (token bytes -> rank) is serialised straight into a
sentencepiece BPE model: every token becomes a piece of byte-mapped printable
characters with the score -rank, and the normaliser is the identity.  The
highest score is then the lowest rank, so sentencepiece merges in the order of
the ranks.  A text is cut into pre-tokens by the pattern, each pre-token is
encoded alone, and ids are decoded by the inverse of the byte map.

Rules: a null or empty text has no ids; a pre-token that is itself a token gets
that token (as rank encoders do before they merge); repeated rows are encoded
each on its own; extra columns pass through untouched.  Nothing is shuffled, so
a hot key or a long text costs its own bytes only; memory holds one slice of
``SLICE_BYTES`` (or one longer text) and a cache of ``CACHE`` pre-tokens.
"""

from __future__ import annotations

import base64
import struct
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tripweave.llm.common import slices, table, worker_memory

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Pre-tokens that a worker remembers; beyond, it starts anew.
CACHE = 400_000


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


@lru_cache(1)
def byte_map() -> dict[int, str]:
    """Byte -> printable character: visible Latin-1 stays, other bytes take the characters from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = sorted(set(range(256)) - set(visible))
    return {b: chr(b) for b in visible} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _bytes_field(number: int, value: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def _int_field(number: int, value: int) -> bytes:
    return _varint(number << 3) + _varint(value)


def serialise(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece model (protobuf) whose ids are the ranks; the unknown piece takes the id after the last."""
    if sorted(ranks.values()) != list(range(len(ranks))):
        raise ValueError("ranks must run from 0 without gaps")
    if missing := [b for b in range(256) if bytes([b]) not in ranks]:
        raise ValueError(f"bytes without a token: {missing[:5]}")
    letters = byte_map()
    pieces = []
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        text = "".join(map(letters.__getitem__, token)).encode()
        pieces.append(_bytes_field(1, _bytes_field(1, text) + _varint(2 << 3 | 5) + struct.pack("<f", -rank)))
    # fixed values: field numbers of ModelProto, SentencePiece, TrainerSpec and NormalizerSpec
    unknown = _bytes_field(1, "⁇".encode()) + _varint(2 << 3 | 5) + struct.pack("<f", 0.0) + _int_field(3, 2)
    pieces.append(_bytes_field(1, unknown))
    trainer = (_int_field(3, 2) + _int_field(4, len(ranks) + 1) + _int_field(40, len(ranks))
               + _int_field(41, -1) + _int_field(42, -1) + _int_field(43, -1)
               + _bytes_field(45, "⁇".encode()))
    normaliser = _bytes_field(1, b"identity") + _int_field(3, 0) + _int_field(4, 0) + _int_field(5, 0)
    return b"".join(pieces) + _bytes_field(2, trainer) + _bytes_field(3, normaliser)


class Codec:
    """Encoder and decoder over one serialised model; ids travel as little-endian unsigned 32-bit bytes."""

    def __init__(self, model: bytes, pattern: str):
        import sentencepiece

        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.to_letters = byte_map()
        back = {c: b for b, c in self.to_letters.items()}
        n = self.pieces.get_piece_size() - 1
        self.token_bytes = [bytes(map(back.__getitem__, self.pieces.id_to_piece(i))) for i in range(n)]
        self.whole = {t: i for i, t in enumerate(self.token_bytes)}
        self.find = regex.compile(pattern).findall
        self.cache: dict[str, bytes] = {}

    def _learn(self, tokens: list[str]) -> None:
        if len(self.cache) + len(tokens) > CACHE:
            self.cache.clear()
        rest, mapped = [], []
        for t in tokens:
            raw = t.encode()
            if (i := self.whole.get(raw)) is not None:
                self.cache[t] = struct.pack("<I", i)
            else:
                rest.append(t)
                mapped.append(raw.decode("latin-1").translate(self.to_letters))
        if rest:
            for t, ids in zip(rest, self.pieces.encode(mapped, out_type=int, num_threads=1)):
                self.cache[t] = struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        tokens = [self.find(t) if t else [] for t in texts]
        if new := {t for t in chain.from_iterable(tokens) if t not in self.cache}:
            if len(self.cache) + len(new) > CACHE:  # what is dropped must be learnt again
                new = set(chain.from_iterable(tokens))
            self._learn(list(new))
        ids = self.cache.__getitem__
        return [b"".join(map(ids, x)) for x in tokens]

    def decode(self, ids: list[bytes | None]) -> list[bytes]:
        piece = self.token_bytes.__getitem__
        return [b"".join(map(piece, np.frombuffer(x or b"", "<u4").tolist())) for x in ids]


def _codec(model: bytes, pattern: str) -> Codec:
    return worker_memory((model, pattern), lambda: Codec(model, pattern))


def _model(path: str | None) -> bytes:
    return serialise(load_ranks(path or public_tokenizers.path(VOCABULARY)))


def encode(df: DataFrame, text: str = "text", ids: str = "ids", decoded: str | None = None,
           path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``df`` with ``ids`` in place of ``text``: little-endian unsigned 32-bit token ids, as binary.

    ``decoded`` names a further binary column with the bytes that the ids decode to.
    """
    model = _model(path)
    rest = [c for c in df.columns if c != text]
    added = [ids, *([decoded] if decoded else [])]
    if clash := {c.lower() for c in added} & {c.lower() for c in rest}:
        raise ValueError(f"columns exist already: {sorted(clash)}")

    def run(batches):
        codec = _codec(model, pattern)
        for batch in batches:
            for part in slices(batch, text):
                got = codec.encode(part.column(text).to_pylist())
                out = [*(part.column(c) for c in rest), pa.array(got, pa.binary())]
                if decoded:
                    out.append(pa.array(codec.decode(got), pa.binary()))
                yield pa.RecordBatch.from_arrays(out, names=[*rest, *added])

    schema = T.StructType([*(df.schema[c] for c in rest), *(T.StructField(c, T.BinaryType()) for c in added)])
    return df.select(*rest, text).mapInArrow(run, schema)


def decode(df: DataFrame, ids: str = "ids", decoded: str = "decoded", path: str | None = None) -> DataFrame:
    """``df`` with ``decoded`` (the bytes) in place of ``ids``; null ids decode to nothing."""
    model = _model(path)
    rest = [c for c in df.columns if c != ids]

    def run(batches):
        codec = _codec(model, public_tokenizers.PATTERN)
        for batch in batches:
            for part in slices(batch, ids):
                out = pa.array(codec.decode(part.column(ids).to_pylist()), pa.binary())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in rest), out], names=[*rest, decoded])

    schema = T.StructType([*(df.schema[c] for c in rest), T.StructField(decoded, T.BinaryType())])
    return df.select(*rest, ids).mapInArrow(run, schema)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(docs, decoded="decoded").select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
