"""Language model against its definition, languages apart."""

import math
import random
from collections import Counter

import pytest

from scorecraft.llm import language_model as L
from scorecraft.llm import quality as Q

SCHEMA = "doc_id long, text string, lang string"
N = L.ORDER


def discounts(counts):
    """Discounts of counts 0 to 3 and more, from the counts of counts."""
    n = [sum(c == k for c in counts) for k in range(5)]
    if not n[1] or not n[2]:
        return [0, .5, .5, .5]
    y = n[1] / (n[1] + 2 * n[2])
    d = [k - (k + 1) * y * n[k + 1] / n[k] if n[k] else .5 for k in (1, 2, 3)]
    return [0, *(min(max(x, .05), k - .05) for k, x in enumerate(d, 1))]


def brute(texts):
    levels = {N: Counter()}
    for t in texts:
        s = [L.PAD] * (N - 1) + [ord(c) for c in t]
        levels[N].update(tuple(s[i:i + N]) for i in range(len(t)))
    for k in range(N - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
    d = {k: discounts(levels[k].values()) for k in levels}

    def p(g):
        k = len(g)
        if not k:
            return 1 / (len(levels[1]) + 1)
        same = {x: n for x, n in levels[k].items() if x[:-1] == g[:-1]}
        if not same:
            return p(g[1:])
        n, total = same.get(g, 0), sum(same.values())
        return (n - d[k][min(n, 3)]) / total + sum(d[k][min(m, 3)] for m in same.values()) / total * p(g[1:])

    return p


def test_model_equals_definition(spark, monkeypatch):
    rnd = random.Random(3)
    words = {"de": ["und", "die", "ö"], None: ["мир", "да", "\U0001f600"], "pl": ["się", "jest"], "": ["x"]}
    rows = [(i, " ".join(rnd.choice(w) for _ in range(60)), l) for i, (l, w) in enumerate(
        [*words.items()] * 3)] + [(90, None, "de"), (91, "", None)]
    monkeypatch.setattr(L, "BUCKET", 40)
    df = spark.createDataFrame(rows, SCHEMA)
    folder = L.fit_model(df)
    reader = L.Reader(folder)
    # each language has buckets of its own size
    assert reader.buckets("=de") > reader.buckets("=") == 1 and reader.buckets("==") == 0
    assert math.isnan(reader.totals(["=fr"], ["text"])[0])
    for lang in words:
        p = brute([t for _, t, l in rows if l == lang and t])
        for text in ("und die мир", "x\U0001f600ö się", rows[1][1][:40]):
            s = [L.PAD] * (N - 1) + [ord(c) for c in text]
            want = sum(math.log(p(tuple(s[i:i + N]))) for i in range(len(text)))
            got = reader.totals(["null" if lang is None else "=" + lang], [text])[0]
            assert got == pytest.approx(want, abs=1e-3)


def test_reader_reads_only_what_does_not_fit(spark, monkeypatch):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice("abcdefgh ") for _ in range(400)) for _ in range(12)]
    monkeypatch.setattr(L, "BUCKET", 60)
    reader = L.Reader(L.fit_model(spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], SCHEMA)))
    whole = reader.totals(["=x"] * 12, texts)
    model = reader.bytes_read  # with room for all, each bucket is read once
    assert reader.totals(["=x"] * 12, texts) == whole and reader.bytes_read == model
    for share in (0.0, 0.1, 0.5, 0.9, 1.0):
        monkeypatch.setattr(L, "CACHE", int(model * share))
        small = L.Reader(reader.folder)
        assert small.totals(["=x"] * 12, texts) == whole
        assert small.size <= model * share
        first = small.bytes_read
        small.totals(["=x"] * 12, texts)
        again = small.bytes_read - first
        # what is kept is not read again: each pass over the model reads the rest of it
        passes = 2 * L.ORDER + 1
        assert again <= passes * (1 - share + 0.1) * model
        assert first <= again + model


def test_model_grows_and_languages_keep_their_bands(spark):
    rnd = random.Random(6)

    def texts(syllables, n):
        vocab = ["".join(rnd.choice(syllables) for _ in range(3)) for _ in range(60)]
        return [" ".join(rnd.choice(vocab) for _ in range(120)) for _ in range(n)]

    de, null = texts(["sch", "er", "ung", "ei"], 30), texts(["при", "вет", "мир", "но", "ка"], 6)
    noise = "".join(rnd.choice("приветмнокаый ") for _ in range(900))
    rows = [(i, t, "de") for i, t in enumerate(de)] + [(100 + i, t, None) for i, t in enumerate(null)]
    df = spark.createDataFrame([*rows, (900, noise, None)], SCHEMA)
    got = {r.doc.doc_id: r for r in Q.judged(df).collect()}
    assert all(got[i].kept for i in range(100, 106))
    assert got[900].log_perplexity > 1.5 * max(got[i].log_perplexity for i in range(100, 106))
    assert len({(r.low / r.log_perplexity > 0, got[i].doc.lang) for i, r in got.items()}) == 2
    small = L.count_grams(df.limit(1), "text", "lang").count()
    assert L.count_grams(df, "text", "lang").count() > 2 * small


def test_null_language_beside_german(spark):
    rnd = random.Random(7)

    def texts(syllables, n):
        return [" ".join("".join(rnd.choice(syllables) for _ in range(3)) for _ in range(150)) for _ in range(n)]

    # Null, "", "de" and "pl" shared a hash slot.
    rows = [(i, t, "de") for i, t in enumerate(texts(["sch", "er", "ung", "ei"], 20))]
    others = [(None, ["ka", "lo", "mi"]), ("", ["zu", "fy"]), ("pl", ["cz", "ow", "ie"])]
    for k, (lang, syllables) in enumerate(others, 1):
        rows += [(100 * k + i, t, lang) for i, t in enumerate(texts(syllables, 6))]
    got = Q.judged(spark.createDataFrame(rows, SCHEMA)).collect()
    alone = [x for k in (None, "", "pl", "de") for x in Q.judged(spark.createDataFrame(
        [r for r in rows if r[2] == k], SCHEMA)).collect()]
    want = {r.doc.doc_id: (r.log_perplexity, r.low, r.high) for r in alone}
    assert {r.doc.doc_id for r in got} == set(want)
    for r in got:
        assert (r.log_perplexity, r.low, r.high) == pytest.approx(want[r.doc.doc_id], abs=1e-6)
