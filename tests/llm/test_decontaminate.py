"""Benchmark passages in documents against plain Python."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from scorecraft.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, item_id long, segment int, term string"


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=10, within=20):
    """(n_words, n_hit, exact, near) of each text."""
    items = sorted({("" if i is None else str(i), tuple(words(t))) for i, t in items if words(t)})
    tf = Counter(w for _, t in docs for w in words(t))
    out = []
    for _, text in docs:
        w = words(text)
        hit, exact, near = set(), [], []
        for name, item in items:
            n = min(window, len(item))
            found = close = False
            for s in range(len(item) - n + 1):
                part = item[s:s + n]
                for i in range(len(w) - n + 1):
                    if tuple(w[i:i + n]) == part:
                        hit |= set(range(i, i + n))
                        found = True
                rare = sorted(set(part), key=lambda x: (tf[x], x.encode()))[:3]
                if all(tf[x] for x in part):
                    for i, x in enumerate(w):
                        close = close or x in rare and set(rare) <= set(w[i:i + within])
            exact += [name] * found
            near += [name] * close
        out.append((len(w), len(hit), sorted(exact), sorted(near)))
    return out


def corpus(seed=3):
    rnd = random.Random(seed)
    vocabulary = ["the", "of", "Ünder", "x1", "naïve", "日本"] * 4 + [f"w{i}" for i in range(60)]

    def text(n):
        return rnd.choice([" ", ", ", "-", "\n"]).join(rnd.choice(vocabulary) for _ in range(n))

    items = [(i, text(rnd.choice([1, 3, 9, 10, 11, 25, 40]))) for i in range(25)]
    items += [items[5], (5, "of of of of of of of of of of of of"), (None, "the naïve"), (77, ""), (78, None), (79, "missing word")]
    docs = [(i, text(rnd.choice([0, 1, 5, 30, 200]))) for i in range(50)]
    for i in range(40):
        own = items[rnd.randrange(25)][1]
        cut = rnd.randrange(max(1, len(own) // 3))
        docs.append((100 + i, text(rnd.randrange(30)) + " " + own[cut:].upper() + " " + text(rnd.randrange(30))))
    docs += [(None, None), (None, None), (7, ""), (8, "of " * 300), (9, items[4][1] * 3), docs[60], docs[60], (None, docs[61][1])]
    return docs, items


@pytest.mark.parametrize("segment", [1, 500, D.SEGMENT])
def test_equals_brute_force(spark, segment):
    docs, items = corpus()
    frame = spark.createDataFrame([(i, t, 4, 5, "x") for i, t in docs], SCHEMA).repartition(3)
    tests = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, j int").repartition(2)
    got = D.find_contamination(frame, tests, keep=["doc_id", "term"], segment=segment)
    rows = [(r.doc.doc_id, r.doc.term, r.n_words, r.n_hit, tuple(r.exact), tuple(r.near)) for r in got.collect()]
    want = [(i, "x", n, h, tuple(e), tuple(c)) for (i, _), (n, h, e, c) in zip(docs, brute(docs, items), strict=True)]
    assert Counter(rows) == Counter(want)
    assert any(r[4] for r in rows) and any(set(r[5]) - set(r[4]) for r in rows)


def test_other_windows(spark):
    docs, items = corpus(8)
    got = D.find_contamination(spark.createDataFrame([(i, t, 4, 5, "x") for i, t in docs], SCHEMA), spark.createDataFrame(
        items, "item_id long, text string"), keep=["doc_id"], window=4, within=6)
    want = [(i, n, h, tuple(e), tuple(c)) for (i, _), (n, h, e, c) in zip(docs, brute(docs, items, 4, 6), strict=True)]
    assert Counter((r.doc.doc_id, r.n_words, r.n_hit, tuple(r.exact), tuple(r.near)) for r in got.collect()) == Counter(want)
    with pytest.raises(ValueError):
        D.find_contamination(spark.createDataFrame([], SCHEMA), spark.createDataFrame(items, "item_id long, text string"),
                             keep=["doc_id"], within=D.GAP + 1)


def test_empty_tables(spark):
    none, items = spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert D.find_contamination(none, items, keep=["doc_id"]).collect() == []
    docs = spark.createDataFrame([(1, "a b", 1, 1, "")], SCHEMA)
    row = D.find_contamination(docs, items.filter("false"), keep=["doc_id"]).first()
    assert (row.n_words, row.n_hit, row.exact, row.near) == (2, 0, [], [])


def test_hot_word_and_long_text(spark):
    """A word that makes up nearly everything, over several segments, and one long text."""
    hot = [(i, "the " * 50) for i in range(300)] + [(999, "the " * 40_000 + "rare the rare")]
    docs = spark.createDataFrame(hot, "doc_id long, text string")
    items = spark.createDataFrame([(1, "the the"), (2, "the rare the rare")], "item_id long, text string")
    got = {r.doc.doc_id: r for r in D.find_contamination(docs, items, keep=["doc_id"], segment=3000).collect()}
    assert got[0].n_hit == 50 and got[0].exact == ["1"]
    assert got[999].n_hit == 40_003 and got[999].exact == ["1", "2"]


def test_index_holds_every_word(spark):
    docs, _ = corpus()
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    index = D.build_index(frame, ["doc_id"], segment=500)
    counts = {r.term: r.n for r in index.filter("term IS NOT NULL").groupBy("term").agg(F.sum(F.size("places")).alias("n")).collect()}
    assert counts == Counter(w for _, t in docs for w in words(t))
    assert index.filter("term IS NULL").count() == len(docs)
