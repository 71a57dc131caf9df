from __future__ import annotations

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from helpers import documents

from revlens.llm import byte_bpe as B
from revlens.llm import packing as P

PARTS = [" ", "  ", "\n", "\n\n", "\t", "\r\n", "a", "B", "é", "É", "é", "the", " the", "Enau.", "1", "23", "!", "'s", "'LL", "日本", " ", "　"]
PARTS += ["😀", "\x1c", "x" * 50, "́", "\x85", "Σ", "İ", "<|endoftext|>", "</w>", "ﬁ", "word,", "ªº"]
EDGES = [None, "", " ", "\n", "word", "x" * 30_000, "long text " * 30_000]


def fuzz(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choices(PARTS, k=rng.randrange(14))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path(B.VOCABULARY), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encoder_equals_the_library(library):
    bpe = B.load(public_tokenizers.path(B.VOCABULARY), public_tokenizers.PATTERN)
    for text in fuzz(1, 20_000):
        ids = bpe.encode(text)
        assert ids == library.encode_ordinary(text), repr(text)
        assert bpe.decode(ids) == text.encode()


def test_encoder_equals_merging_by_rank():
    bpe = B.load(public_tokenizers.path(B.VOCABULARY), public_tokenizers.PATTERN)
    rng = random.Random(2)
    for _ in range(2000):
        data = bytes(rng.choices(b"aeinorst \xc3\xa9\xff", k=rng.randrange(1, 25)))
        assert [bpe.tokens[i] for i in bpe.encode_bytes(data)] == bpe.merged(data)


def test_memo_generations(monkeypatch, library):
    monkeypatch.setattr(B, "CACHE_WORDS", 5)
    bpe = B.ByteBPE.load(public_tokenizers.path(B.VOCABULARY), public_tokenizers.PATTERN)
    for text in fuzz(3, 500):
        assert bpe.encode(text) == library.encode_ordinary(text)
    assert len(bpe.after_space) <= 6 and len(bpe.after_space.old) <= 6


def test_byte_bpe_rows(spark, library):
    texts = EDGES + fuzz(4, 100)
    got = {r.doc_id: r for r in B.byte_bpe(documents(spark, texts, extra=True)).collect()}
    for k, text in enumerate(texts, 1):
        ids = library.encode_ordinary(text or "")
        assert got[k].ids == ids and got[k].n_tokens == len(ids)
        assert got[k].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[k].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    repeated = spark.createDataFrame([(None, "a"), (1, "a"), (1, "a")], "doc_id bigint, text string")
    assert B.byte_bpe(repeated).count() == 3 and B.byte_bpe(repeated.limit(0)).count() == 0


def test_words_equal_the_tokenizer(monkeypatch):
    for limit in (P.CACHE_WORDS, 20):
        monkeypatch.setattr(P, "CACHE_WORDS", limit)
        tokenizer = P.WordTokenizer(public_tokenizers.path(P.VOCABULARY))
        texts = fuzz(5, 6000)
        for k in range(0, len(texts), 50):
            for text, ids in zip(texts[k : k + 50], tokenizer.encode(texts[k : k + 50]), strict=True):
                assert np.frombuffer(ids, "<u4").tolist() == tokenizer.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("pool", [1 << 20, 3000])
def test_packing(spark, monkeypatch, pool):
    monkeypatch.setattr(P, "POOL_TOKENS", pool)
    rng = random.Random(6)
    texts = EDGES + [" ".join(rng.choices(["the", "of", "Word.", "é"], k=rng.choice([1, 9, 200, 700, 3000]))) for _ in range(120)]
    df = documents(spark, texts, extra=True).repartition(2)
    rows = P.pack_documents(df, with_ids=True).collect()
    tokenizer = P.WordTokenizer(public_tokenizers.path(P.VOCABULARY)).tokenizer
    pieces, windows = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        windows.setdefault(r.sequence_id, []).append(r)
    for k, text in enumerate(texts, 1):
        own = sorted(pieces[k], key=lambda r: r.start)
        want = [*tokenizer.encode(text or "", add_special_tokens=False).ids, P.END_ID]
        assert [i for r in own for i in r.ids] == want and {r.doc_tokens for r in own} == {len(want)}
        for r in own:
            assert r.ids == want[r.start : r.start + r.length]
            assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    for own in windows.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == [sum(x.length for x in own[:k]) for k in range(len(own))]
        size = sum(r.length for r in own)
        assert size == own[0].window <= 2048 and size & (size - 1) == 0  # no padding at all
    steps = {}
    for own in windows.values():
        steps.setdefault(own[0].step_id, []).append(own[0].window)
    assert all(len(set(s)) == 1 and sum(s) <= P.STEP_TOKENS for s in steps.values())


def test_packing_null_ids_repeats_and_empty(spark):
    df = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b")], "doc_id bigint, text string")
    assert sum(r.length for r in P.pack_documents(df).collect()) == 9
    assert P.pack_documents(df.limit(0)).count() == 0
