"""Token operators against the tokenizer libraries themselves."""

import base64
import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from obslayers.llm import byte_bpe, packing, token_counts

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXTS = [
    "",
    " ",
    "Don't we'll  go\n\n x<|endoftext|>y <|startoftext|>",
    "a" * 5000,
    "ab" * 700 + " " * 300,
    "漢字かな" * 400,
    "İstanbul ΣΑΣ naïve é \x1c\x85　½²Ⅷ ¡hola! × ÷ ¿qué?",
    "😀😀 🤷🏽‍♀️ ​﻿ end",
    "ab\r\n\tcd \x0b\x0c 12345 6'll're",
]
texts = st.lists(st.text(st.sampled_from("abzAÉß漢Σ 's!.\n\t　½1<|endoftext>́\x1f"), max_size=80), max_size=6)


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def rows(spark, extra=()):
    given_ = [(i, t, "x", 1) for i, t in enumerate([*TEXTS, *extra])] + [(None, "null id", "x", 1), (7, TEXTS[7], "x", 1), (99, None, "x", 1)]
    return spark.createDataFrame(given_, "doc_id bigint, text string, n_tokens string, piece int")


@given(texts)
@settings(max_examples=150, deadline=None)
def test_counts_equal_library(some):
    expected = [len(e.ids) for e in Tokenizer.from_file(WORDS).encode_batch(some, add_special_tokens=False)]
    assert list(token_counts.counter(WORDS).counts(some)) == expected


@given(texts)
@settings(max_examples=150, deadline=None)
def test_vocabulary_ids_equal_library(some):
    expected = [e.ids for e in Tokenizer.from_file(BYTES).encode_batch(some, add_special_tokens=False)]
    assert [packing.vocabulary_ids(BYTES).ids(text).tolist() for text in some] == expected


@given(texts)
@settings(max_examples=150, deadline=None)
def test_ids_equal_library(library, some):
    own = byte_bpe.encoder(RANKS, public_tokenizers.PATTERN)
    for text, ids in zip(some, own.encode(some)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
        assert own.decode(ids) == text.encode("utf-8")


def test_vocabulary_ids_equal_library_on_documents():
    texts_ = pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].to_pylist()
    expected = [e.ids for e in Tokenizer.from_file(BYTES).encode_batch(texts_, add_special_tokens=False)]
    assert [packing.vocabulary_ids(BYTES).ids(text).tolist() for text in texts_] == expected


def test_count_rows(spark):
    expected = Tokenizer.from_file(WORDS)
    for row in token_counts.count_tokens(rows(spark), WORDS, limit=100).collect():
        text = "null id" if row.doc_id is None else (TEXTS[row.doc_id] if row.doc_id < 50 else "")
        n = len(expected.encode(text, add_special_tokens=False).ids)
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(text.encode()), n, n > 100)
    assert token_counts.count_tokens(rows(spark), WORDS).count() == len(TEXTS) + 3
    assert token_counts.count_tokens(rows(spark).limit(0), WORDS).count() == 0


def test_encoding_rows(spark, library):
    got = byte_bpe.encoding_digests(rows(spark), RANKS, public_tokenizers.PATTERN).collect()
    assert len(got) == len(TEXTS) + 3
    for row in got:
        text = "null id" if row.doc_id is None else (TEXTS[row.doc_id] if row.doc_id < 50 else "")
        ids = np.array(library.encode_ordinary(text), "<u4").tobytes()
        assert row.n_tokens == len(ids) // 4
        assert row.ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    full = byte_bpe.encode_documents(rows(spark), RANKS, public_tokenizers.PATTERN)
    assert {r.doc_id: r.decoded for r in full.collect()}[6] == TEXTS[6]


@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=12))
@settings(max_examples=200, deadline=None)
def test_plan_uses_every_piece_once(counts):
    used, bins = defaultdict(int), 0
    for c in packing.plan(counts, 40):
        assert sum(length * n for length, n in c.uses) <= 40
        bins += c.bins
        for length, n in c.uses:
            used[length] += n * c.bins
    assert dict(used) == counts
    assert bins <= 2 * (sum(k * v for k, v in counts.items()) / 40) + 1


@given(st.integers(0, 60), st.lists(st.tuples(st.integers(1, 20), st.integers(1, 4)), max_size=6, unique_by=lambda x: x[0]))
@settings(max_examples=200, deadline=None)
def test_fullest_equals_brute_force(room, available):
    sums = {0}
    for length, count in available:
        sums = {s + k * length for s in sums for k in range(count + 1)}
    uses = packing.fullest(room, available)
    assert sum(k * n for k, n in uses.items()) == max(s for s in sums if s <= room)
    assert all(n <= dict(available)[k] for k, n in uses.items())


def test_packed_rows(spark):
    docs = rows(spark, ["word " * 3000, "x " * 1023, "y " * 1024])
    library = Tokenizer.from_file(BYTES)
    all_texts = [*TEXTS, "word " * 3000, "x " * 1023, "y " * 1024]
    packed = packing.pack_documents(docs, BYTES, with_ids=True)
    got = packed.collect()
    by_sequence, by_document = defaultdict(list), defaultdict(list)
    for r in got:
        by_sequence[r.sequence_id].append(r)
        by_document[r.doc_id].append(r)
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        assert r.length == len(r.ids)
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    for i, text in enumerate(all_texts):
        if i == 7:  # there twice
            continue
        ids = library.encode(text, add_special_tokens=False).ids + [2]
        parts = sorted(by_document[i], key=lambda r: r.piece)
        assert [x for r in parts for x in r.ids] == ids
        assert all(r.length == 1024 for r in parts[1:])
        assert [r.start for r in parts] == [sum(q.length for q in parts[:k]) for k in range(len(parts))]
    assert len(by_document[7]) == 2 and len(by_document[99]) == 1 and len(by_document[None]) == 1
    whole = packing.sequences(packed).select(F.sum(F.size("ids"))).first()[0]
    assert whole == sum(r.length for r in got)
    assert packing.pack_documents(docs.limit(0), BYTES).count() == 0
