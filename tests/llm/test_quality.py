"""Quality rules against brute force."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from scorecraft.llm import quality as Q

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute_counts(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            dup += line in seen
            seen.add(line)
    wins = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    n = Counter(wins)
    cover = {j for i, w in enumerate(wins) if n[w] > 1 for j in range(i, i + 5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(cover))


TEXTS = ["", None, " \n\t", "one", "a b c d e f g", "a b c d e a b c d e", "x " * 40,
         "l1\nl2\nl1\n \n \nl1", "## é$ \x1c \x85 \xa0 ü|<>\x0b\x0c", "a b c d e f\n" * 7 + "g h",
         "\U0001f600 b c d e \U0001f600 b c d e q"]


def test_counts_equal_brute_force(monkeypatch):
    rnd = random.Random(1)
    texts = TEXTS + [" ".join(rnd.choice("abc") for _ in range(rnd.randint(1, 60))) for _ in range(60)]
    for size in (1 << 20, 7):
        monkeypatch.setattr(Q, "SLICE", size)
        for t in texts:
            assert Q.rule_counts(t) == brute_counts(t), t


def test_judged_rows(spark):
    rnd = random.Random(4)
    vocab = {l: ["".join(rnd.choice(s) for _ in range(3)) for _ in range(200)] for l, s in (
        ("en", ["th", "e", "ing", "on", "at"]), ("de", ["sch", "ön", "er", "ung", "ei"]))}
    rows = [(i, " ".join(rnd.choice(vocab[l]) for _ in range(200)), l)
            for i in range(40) for l in vocab]
    junk = "".join(chr(rnd.randint(33, 47)) + (" " if i % 7 == 0 else "") for i in range(3000))
    rows += [(900, junk, "en"), (901, None, "en"), (902, "", None), (903, "short text", None),
             (904, "same words again and " * 30, "de"), (None, rows[0][1], "en"), (0, rows[0][1], "en")]
    df = spark.createDataFrame([(a, t, l, "s", None) for a, t, l in rows], SCHEMA)
    df = df.selectExpr("*", "1 AS slot", "'x' AS kept", "2 AS p")
    got = Q.judged(df).collect()
    assert len(got) == len(rows)
    for r in got:
        n = brute_counts(r.doc.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n
        assert r.base_failed == (n[0] < 10 or 100 * n[4] > 20 * n[0])
        assert not (r.base_failed and r.kept)
    kept = Q.keep_good(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert not {900, 901, 902, 903, 904} & set(ids)
    assert sum(i is None or i < 40 for i in ids) >= 75


def test_empty_table(spark):
    assert Q.judged(spark.createDataFrame([], SCHEMA)).collect() == []


def test_band_rejects_labelled_junk(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang")
    got = Q.judged(docs, keep=["doc_id"]).filter("not base_failed").select("doc.doc_id", "kept").join(labels, "doc_id")
    share = {r.quality: r.share for r in got.groupBy("quality").agg(
        F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert share[1] > 0.97 and share[0] < 0.8
