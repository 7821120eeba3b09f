"""Token files: exact round trips."""

import random

import numpy as np
import public_tokenizers as P
import pytest
from test_packing import random_texts
from tokenizers import Tokenizer

from scorecraft.llm import token_store as S

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
FILE = P.path("byte_bpe_50k.json")


@pytest.mark.parametrize("values", [[], [0], [7], [0, 0, 0], [1, 2, 3], [10**12] * 70,
                                    sorted(random.Random(1).choices(range(10**6), k=1000)),
                                    list(range(1000)), [5] * 64 + [10**9] * 65])
def test_elias_fano(values):
    ef = S.EliasFano.build(np.array(values, np.int64))
    assert ef.all().tolist() == values
    assert [ef.select(i) for i in range(len(values))] == values
    for i in (-1, len(values)):
        with pytest.raises(IndexError):
            ef.select(i)
    if len(values) == 1000:  # near 2 + log2(range / n) bits each
        bits = 8 * (ef.low.nbytes + ef.high.nbytes + ef.samples.nbytes)
        assert bits < 1000 * (4 + np.log2(max(values) / 1000 + 1)) + 64


def test_file_round_trip():
    rnd = np.random.default_rng(2)
    sizes = rnd.integers(1, 50, 300)
    ids = rnd.integers(0, 50257, sizes.sum())
    content = S.to_bytes(np.arange(300) - 5, ids, np.cumsum(sizes), 2, 3, 99)
    f = S.TokenFile(content)
    assert f.doc_ids.tolist() == list(range(-5, 295)) and (f.part, f.before) == (3, 99)
    at = 0
    for i, n in enumerate(sizes):
        assert f.document(i).tolist() == ids[at:at + n].tolist()
        at += n
    with pytest.raises(ValueError):
        S.TokenFile(content[:-2] + b"xx")


@pytest.mark.parametrize("file_ids", [500, 1 << 22])
def test_write_and_read(spark, file_ids):
    rows = list(zip(random.Random(5).sample(range(-1000, 1000), 120), random_texts(109, 9)))
    rows += [(None, "no id"), (2**62, None), (5000, "twice"), (5000, "twice"), (6000, "word " * 3000)]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA).selectExpr(
        "*", "1 AS id", "2 AS start", "3 AS tie")
    folder, files = S.write_tokens(df, FILE, 0, file_ids=file_ids)
    got = sorted(S.read_tokens(files, folder).collect(), key=lambda r: r.start)
    tokenizer = Tokenizer.from_file(FILE)
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i))
    texts, at = dict(rows), 0
    for r in got:
        want = tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [0]
        assert np.frombuffer(r.ids, "<u4").tolist() == want
        assert (r.start, r.n_tokens) == (at, len(want))
        at += len(want)
    assert files.agg({"ids": "sum"}).first()[0] == at
    if file_ids == 500:
        assert files.count() > 8


def test_empty_table(spark):
    folder, files = S.write_tokens(spark.createDataFrame([], SCHEMA), FILE, 0)
    assert S.read_tokens(files, folder).collect() == []
