"""BPE round trips and packing against the tokenizer libraries and brute force."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from tests.llm.conftest import SF, odd_rows
from tripweave.llm import byte_bpe as B
from tripweave.llm import packing as K

STRANGE = [(200, "héllo  wörld's   x\n\n\t İSTANBUL ΟΔΟΣ é it's don't  1234567 a'sb ,.'re ''s"), (201, "\x1c\x00﻿ ab\x85cd <|endoftext|> <|startoftext|>"),
           (202, "한국어 テスト नमस्ते 👩‍👩‍👧‍👦 ﬁ"), (203, "x" * 5000 + " " * 300 + "9" * 400)]


@pytest.fixture(scope="module")
def rows(docs):
    return docs[:120] + odd_rows() + STRANGE


def test_bpe_ids_equal_the_rank_encoder(spark, rows):
    ranks = B.load_ranks(public_tokenizers.path(B.VOCABULARY))
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "n int, doc_id long, text string")
    out = B.encode(df, decoded="back").collect()
    assert len(out) == len(rows)
    for r in out:
        text = rows[r.n][1] or ""
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == own.encode_ordinary(text)
        assert bytes(r.back) == text.encode()


def test_decode_operator_and_clashes(spark):
    df = spark.createDataFrame([(1, "one two", "extra"), (2, None, None)], "doc_id long, text string, ids_old string")
    back = B.decode(B.encode(df)).collect()
    assert [(r.doc_id, bytes(r.decoded), r.ids_old) for r in back] == [(1, b"one two", "extra"), (2, b"", None)]
    with pytest.raises(ValueError):
        B.encode(df, ids="doc_id")
    assert B.encode(df.limit(0)).count() == 0


def test_bpe_query(spark, docs):
    from tripweave.llm.registry import queries

    got = {r.doc_id: r for r in queries()["op4_byte_bpe"](spark, SF).collect()}
    for d, t in docs:
        assert got[d].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_pieces_equal_the_tokenizer(spark, rows):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path(K.VOCABULARY))
    want = defaultdict(int)
    for d, t in rows:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for i, a in enumerate(range(0, len(ids), 2048)):
            want[d, i, a, len(ids[a : a + 2048]), zlib.crc32(ids[a : a + 2048].tobytes())] += 1
    got = defaultdict(int)
    for r in K.pieces(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got[tuple(r)] += 1
    assert got == want


def test_words_before_punctuation_equal_the_tokenizer():
    """Trailing punctuation is a split of its own only after a letter or digit."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path(K.VOCABULARY))
    stems = ["'hello'", "20€", "«oui»", "“yes”", "word’", "a…", "x", "7", "½", "é", "e\u0301", "İ", "Σ", "क़", "שׁ", "한", "१", "it's", "'s", "'", "—", "👩‍👩", "\u1fef", "\u037e", "a\u0338", "a\xa0", "<|endoftext|"]
    words = [s + p for s in stems for p in ("", ".", "!", ",", "),", ">", "'.", ".'", "=\u0338", "...", "?!")]
    words += [chr(c) + p for c in range(0x21, 0x3000) for p in (".", ")!")]
    got = K.WordIds(public_tokenizers.path(K.VOCABULARY)).encode(pa.array(words))
    for w, x in zip(words, got):
        assert np.frombuffer(x, "<u4").tolist() == tok.encode(w, add_special_tokens=False).ids, ascii(w)


SPECIAL = ["<|endoftext|>", "a<|endoftext|>b.", "It's<|startoftext|>!", "<|ENDOFTEXT|> x", "<|endoftext", "é<|endoftext|><|endoftext|>.", "x <|startoftext|>\ty"]


def test_special_tokens_as_the_library_has_them_or_as_text():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path(K.VOCABULARY))
    for as_text in (False, True):
        tok.encode_special_tokens = as_text
        got = K.WordIds(public_tokenizers.path(K.VOCABULARY), as_text).encode(pa.array(SPECIAL))
        for t, x in zip(SPECIAL, got):
            assert np.frombuffer(x, "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, t


def check_packing(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing_is_gapless_and_tight(spark):
    out = K.op10_best_fit_packing(spark, "/root/testdata/sf0.01").collect()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    want = {(r.doc_id, r.piece): tuple(r) for r in K.pieces(docs).collect()}
    assert {(r.doc_id, r.piece): tuple(r)[:5] for r in out} == want and len(out) == len(want)
    n = check_packing(out, 2048)
    total = sum(r.length for r in out)
    assert n <= -(-total // 2048) + 2


def test_packing_odd_rows_and_stubborn_items(spark):
    out = K.pack_documents(spark.createDataFrame(odd_rows(), "doc_id long, text string")).collect()
    assert sum(r.doc_id is None for r in out) == 1 and sum(r.doc_id == 4 for r in out) == 2
    check_packing(out, 2048)
    assert K.pack_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    long = spark.range(0, 400, 1, 8).selectExpr("id doc_id", "0 piece", "0L start", "1500L length", "0L ids_crc32")
    assert check_packing(K.pack(long).collect(), 2048) == 400
    mixed = spark.range(0, 2000, 1, 8).selectExpr("id doc_id", "0 piece", "0L start", "1L + id * 37 % 2048 length", "0L ids_crc32")
    rows = K.pack(mixed).collect()
    assert len(rows) == 2000 and check_packing(rows, 2048) <= -(-sum(r.length for r in rows) // 2048) * 1.03


def test_best_fit_takes_the_tightest_bin():
    assert K.best_fit([6, 7, 3, 4, 1], 10) == [[0, 3], [1, 2], [4]]
