"""Byte-level BPE against the library."""

import base64
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from test_packing import random_texts

from scorecraft.llm import byte_bpe as B

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
FILE = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(FILE, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def ranks():
    with open(FILE, "rb") as f:
        return f.read()


def test_pair_table():
    rnd = np.random.default_rng(1)
    pairs = np.unique(rnd.integers(0, 300, (5000, 2)), axis=0)
    t = B.PairTable(pairs[:, 0], pairs[:, 1], np.arange(len(pairs)))
    assert (t.get(pairs[:, 0], pairs[:, 1]) == np.arange(len(pairs))).all()
    assert (t.get(pairs[:, 0] + 300, pairs[:, 1]) == -1).all()


@pytest.mark.parametrize("long", [512, 4, 10000])
def test_words_equal_library(library, ranks, monkeypatch, long):
    monkeypatch.setattr(B, "LONG", long)
    bpe = B.ByteBPE(ranks)
    rnd = random.Random(4)
    words = [bytes(rnd.choice(b"abetionrsh \xc3\xa9\xff\n") for _ in range(rnd.randint(1, 40))) for _ in range(800)]
    words += [b"a" * 1500, b"ab" * 700, b"aab" * 400, "é".encode() * 300, b"x"]
    for w, ids in zip(words, bpe.encode_words(words), strict=True):
        assert ids.tolist() == library._core_bpe.encode_single_piece(w), w
        assert bpe.decode(ids) == w


def test_texts_equal_library(library, ranks):
    bpe, memory = B.coder(ranks, P.PATTERN)
    texts = random_texts(2000, 6)
    ids, ends = memory.encode(texts)
    for t, got in zip(texts, np.split(ids, ends[:-1]), strict=True):
        assert got.tolist() == library.encode_ordinary(t), repr(t)
        assert bpe.decode(got) == t.encode()


def test_frame(spark, library):
    rows = list(enumerate(random_texts(100, 8))) + [(None, None), (2**60 + 1, "big id"), (5, "twice"), (5, "twice")]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA).selectExpr(
        "*", "1 AS id", "2 AS ids", "3 AS n_tokens")
    got = sorted(((r.doc_id, r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in B.encode_decode(
        df, FILE, P.PATTERN).collect()), key=str)
    want = []
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), np.array(ids, "<u4").tobytes(), (t or "").encode()))
    assert got == sorted(want, key=str)
    assert B.encode_decode(df.limit(0), FILE, P.PATTERN).collect() == []
