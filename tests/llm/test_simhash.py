"""SimHash groups against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from scorecraft.llm import simhash as S

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute_fingerprint(text, k=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, cur = [], ""
    for c in low + " ":
        if c in " \t\n\x0b\x0c\r":
            if cur:
                words.append(cur)
            cur = ""
        else:
            cur += c
    if not words:
        return 0
    sh = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(fps, bits):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(fps))]


def test_fingerprint_equals_brute_force():
    for t in ["", None, " \n", "One", "one TWO", "a b c d\te\x0bf  ÀÉ g", "x " * 50, "\x1c a\x85b c d"]:
        assert S.fingerprint(t) == brute_fingerprint(t)


@pytest.mark.parametrize("block", [2048, 20])
def test_links_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(S, "BLOCK", block)
    rnd = random.Random(7)
    fps = [rnd.getrandbits(64) for _ in range(120)]
    for base in list(fps[:60]) + [0]:
        for _ in range(rnd.randint(1, 4)):
            x = base
            for b in rnd.sample(range(64), rnd.randint(1, 5)):
                x ^= 1 << b
            fps.append(x)
    for _ in range(150):  # one large group of near copies
        fps.append(fps[0] ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)))
    fps = sorted(set(fps))
    for bits in (3, 1):
        df = spark.createDataFrame([(int(np.uint64(x).view(np.int64)),) for x in fps], "fp long")
        links = S.fingerprint_links(df, bits).collect()
        place = {int(np.uint64(x).view(np.int64)): i for i, x in enumerate(fps)}
        root = list(range(len(fps)))

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in links:
            assert (fps[place[a]] ^ fps[place[b]]).bit_count() <= bits
            i, j = find(place[a]), find(place[b])
            root[max(i, j)] = min(i, j)
        assert [find(i) for i in range(len(fps))] == brute_groups(fps, bits)


def test_groups_and_kept_rows(spark):
    rnd = random.Random(3)
    vocab = [f"w{i}" for i in range(300)]
    long = [" ".join(rnd.choice(vocab) for _ in range(400)) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(long)]
    rows += [(100 + i, long[i % 4].replace("w7 ", "w8 ")) for i in range(8)]
    rows += [(200 + i, long[5]) for i in range(30)] + [(300, ""), (301, None), (302, " "), (302, " ")]
    rows += [(None, long[6]), (None, "only one such"), (400, "two words")]
    df = spark.createDataFrame([(a, b, "en", "s", None) for a, b in rows], SCHEMA)
    df = df.withColumn("fp", F.lit(1)).withColumn("rid", F.lit("x"))
    got = S.simhash_groups(df).collect()
    assert len(got) == len(rows)
    fps = [brute_fingerprint(t) for _, t in rows]
    groups = brute_groups(fps, 3)
    least = {}
    for (i, _), g in zip(rows, groups):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    want = sorted(((i, f"{f:016x}", least.get(g)) for (i, _), f, g in zip(rows, fps, groups)), key=str)
    assert sorted(map(tuple, got), key=str) == want
    kept = S.keep_one_per_group(df)
    assert kept.columns == df.columns
    assert len(kept.collect()) == len(set(groups))


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert S.simhash_groups(df).collect() == []
    assert S.keep_one_per_group(df).collect() == []


def test_the_copy_of_whole_texts_is_packed(spark):
    df = spark.createDataFrame([(i, f"some words of document {i} " * 20, "en", "s", 1) for i in range(30)], SCHEMA)
    kept = S.keep_one_per_group(df)
    files = [f for f in kept.inputFiles() if "simhash-docs" in f]
    assert files and all(f.endswith(".zstd.parquet") for f in files)
    assert {r.text for r in kept.collect()} <= {r.text for r in df.collect()}
