"""Byte-level BPE by SQL against the tiktoken library, text by text."""

import base64
import hashlib
import random

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

import public_tokenizers
from clickloom.llm import byte_bpe, queries

SF = "/root/testdata/sf0.001"
PARAMS = byte_bpe.default_params()


@pytest.fixture(scope="module")
def content():
    return byte_bpe._vocabulary(PARAMS)


@pytest.fixture(scope="module")
def reference(content):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec(content):
    return byte_bpe.Codec(content, PARAMS)


def coded(codec, texts):
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(x.encode()) for x in texts])]).astype(np.int64)
    ids, counts = codec.encode(raw, offsets)
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])], codec.decode(ids, counts)


def assert_same(codec, reference, texts):
    ids, decoded = coded(codec, texts)
    assert ids == [reference.encode_ordinary(x) for x in texts]
    assert decoded == [x.encode() for x in texts]


def test_odd_texts(codec, reference):
    assert_same(
        codec,
        reference,
        ["", " ", "  x", "\n\n a", "don't I'LL we've 's 'sab ''s x's's", "a　 b  c", "a\x85 b\x1c\x1d c", "   x  \n", "  \t\n  "]
        + ["١٢ ४ ½", "é è mot", "<|endoftext|>", "\x00\x01", "\U0001f642‍" * 50, "࢏ \U0001e6c0 ⿠", "'", "x'", "'r", "re'"],
    )


def test_long_runs(codec, reference):
    texts = ["x" * 3000, "-" * 3001, "ab" * 2000, "aaab" * 999, "你好世界" * 500, "=-" * 1500, "abcabcd" * 300, "0" * 999]
    assert_same(codec, reference, texts)


def test_a_very_long_run_takes_few_queries(codec, reference):
    ids, decoded = coded(codec, ["-" * 200_000 + " end"])
    assert decoded[0] == b"-" * 200_000 + b" end" and len(ids[0]) == 12_501


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("abé \n'str1!好 　thion-=") | st.characters(codec="utf-8"), max_size=80), min_size=1, max_size=4))
def test_any_texts(codec, reference, texts):
    assert_same(codec, reference, texts)


def test_contracting_many_pairs_is_contracting_one_after_the_other(content, reference):
    random.seed(3)
    words = ["".join(random.choice("abcthion-=好") for _ in range(random.randint(1, 60))) for _ in range(400)]
    for long in (0, 10_000):
        codec = byte_bpe.Codec(content, byte_bpe.BpeParams(PARAMS.ranks, PARAMS.pattern, long=long))
        assert_same(codec, reference, words)


def test_other_patterns_and_forgetting(content):
    pattern = r"\w+|\W"
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}
    model = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    codec = byte_bpe.Codec(content, byte_bpe.BpeParams(PARAMS.ranks, pattern, known=3, part=2))
    for texts in (["one two", "three"], ["four, five", "one"], ["", "two three"]):
        assert_same(codec, model, texts)


def test_query(spark, reference):
    texts = {x.doc_id: x.text or "" for x in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    rows = queries.op11_byte_bpe(spark, SF).collect()
    assert len(rows) == len(texts)
    for x in rows:
        ids = np.array(reference.encode_ordinary(texts[x.doc_id]), "<u4")
        assert x.n_tokens == len(ids) and x.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert x.decoded_sha256 == hashlib.sha256(texts[x.doc_id].encode()).hexdigest()


def test_nulls_repeats_and_empty_tables(spark):
    schema = "doc_id long, text string, ids string, decoded string"
    frame = spark.createDataFrame([(1, None, "", ""), (1, "a b", "", ""), (1, "a b", "", ""), (None, "", "", "")], schema)
    rows = byte_bpe.digests(byte_bpe.round_trip(frame)).collect()
    assert sorted((x.doc_id or 0, x.n_tokens) for x in rows) == [(0, 0), (1, 0), (1, 2), (1, 2)]
    assert {x.ids_sha256 for x in rows if not x.n_tokens} == {hashlib.sha256(b"").hexdigest()}
    assert byte_bpe.round_trip(frame.limit(0)).count() == 0
