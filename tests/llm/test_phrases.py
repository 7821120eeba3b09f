"""Phrase fingerprints against a scalar parse, and the edited-text query."""

import hashlib
import random

import numpy as np
import pytest

from scorecraft.llm import phrases as P
from scorecraft.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
M = 2**64 - 1


def mix(x):
    x = (x ^ x >> 31) * 0x7FB5D329728EA185 & M
    x = (x ^ x >> 27) * 0x81DADEF4BC2DD44D & M
    return x ^ x >> 33


def parse(x):
    """One level of one text, symbol by symbol."""
    runs = []
    for s in x:
        if runs and runs[-1][0] == s:
            runs[-1][1] += 1
        else:
            runs.append([s, 1])
    x = label = [s if n == 1 else mix(s ^ mix(n)) for s, n in runs]
    for width in (64, 8, 8):
        before = [~label[0] & (1 << width) - 1, *label[:-1]]
        bits = [next(k for k in range(width) if (a ^ b) >> k & 1) for a, b in zip(label, before)]
        label = [2 * k + (a >> k & 1) for k, a in zip(bits, label)]
    out = []
    for i, s in enumerate(x):
        if i == 0 or i < len(x) - 1 and label[i - 1] < label[i] > label[i + 1]:
            out.append([])
        out[-1].append(s)
    factors = [mix(k * 0x9E3779B97F4A7C15 & M) | 1 for k in range(1, 33)]
    assert max(map(len, out)) < 17
    return [mix(sum(a * f for a, f in zip(ph, factors)) & M) for ph in out]


def brute(text):
    out, x, level = [P.NONE] * 64, [ord(c) for c in text], 0
    while x:
        x, level = parse(x), level + 1
        if level >= P.LEVEL or len(x) == 1:
            for n in x:
                out[n >> 58] = min(out[n >> 58], n >> 42 & 0xFFFF, 0xFFFE)
        if len(x) == 1:
            break
    return out


def some_texts(n, seed=1):
    rnd = random.Random(seed)
    words = ["the", "nation", "é", "aaaa", "b" * 30, "\U0001f600", "zu", "\n", "x1"]
    return ["", "a", "aa", "ab", "aba", " " * 50, "ab" * 200] + [
        " ".join(rnd.choice(words) + str(rnd.randrange(50)) for _ in range(rnd.randint(1, 80))) for _ in range(n)]


def test_equals_scalar_parse():
    texts = some_texts(60)
    got = P.fingerprints(texts)
    for t, row in zip(texts, got):
        assert row.tolist() == brute(t), repr(t)
    # The same, whatever else is worked on with it.
    assert (P.fingerprints(texts[20:23]) == got[20:23]).all()


def test_shared_substrings_share_names():
    rnd = random.Random(3)

    def noise(n):
        return "".join(rnd.choice("abcdefghijklmnop ") for _ in range(n))

    common = noise(4000)
    near = [P.likeness(*P.fingerprints([noise(k) + common, common + noise(3 * k)])[:, None])[0]
            for k in (1, 7, 50, 333)]
    assert min(near) > 0.7
    far = P.likeness(*P.fingerprints([noise(4000), noise(4000)])[:, None])[0]
    assert far < 0.1
    half = P.likeness(*P.fingerprints([common + noise(4000), noise(4000) + common])[:, None])[0]
    assert 0.3 < half < 0.7


@pytest.mark.parametrize("parts", [8, 1])
def test_edited_query(spark, tmp_path, parts):
    texts = some_texts(90, 5)
    ids = random.Random(6).sample(range(-500, 500), len(texts))
    rows = list(zip(ids, texts)) + [(None, "null id " * 9), (2**60 + 1, None), (600, "twice " * 20), (600, "twice " * 20)]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA).selectExpr(
        "*", "1 AS id", "2 AS key", "3 AS part", "4 AS tie")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = QUERIES["op10_fingerprints"](spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    order = [(i, t or "") for i, t in order]
    want = []
    for (i, t), (_, after) in zip(order, order[1:] + order[:1]):
        edited = t[:len(t) - len(t) // 2] + after[:len(t) // 2]
        a, b, c = (np.array([brute(x)], np.uint16) for x in (t, edited, after))
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), a.astype(">u2").tobytes().hex(),
                     b.astype(">u2").tobytes().hex(), P.likeness(a, b)[0], P.likeness(a, c)[0]))
    key = lambda r: (r[0] is not None, r[0] or 0, r[2])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_empty_and_single(spark):
    assert P.edited_likeness(spark.createDataFrame([], SCHEMA)).collect() == []
    one = P.edited_likeness(spark.createDataFrame([(1, "one text only", "en", "s", 1)], SCHEMA)).collect()
    assert [(r.n_chars, r.near_next) for r in one] == [(13, 1.0)]
    assert P.fingerprint_texts(spark.createDataFrame([(1, None, "en", "s", 1)], SCHEMA)).first().n_chars == 0
