"""Line dedup against brute force."""

import random
import re
from collections import defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from scorecraft.llm import line_dedup
from scorecraft.llm.line_dedup import PASSAGE, dedup_lines

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
M = 2**64 - 1


def brute_chunks(text, spacing=4, long=50):
    lines = text.split("\n")
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in lines]
    big = [len(x.split(" ")) >= long for x in lines]
    out, cur = [], []
    for i, line in enumerate(lines):
        cur.append(line)
        before = h[i - 1] if i else 0
        r = h[i] ^ ((before << 1 | before >> 63) & M)
        if i == len(lines) - 1 or r % spacing == 0 or big[i] or big[i + 1]:
            out.append("\n".join(cur))
            cur = []
    return out


def brute(rows):
    """rows: (id, text), ids distinct and not null."""
    where = defaultdict(list)
    cut = {i: brute_chunks(t) for i, t in rows if t is not None}
    for i in sorted(cut):
        for k, c in enumerate(cut[i]):
            full = [x for x in c.split("\n") if re.search(r"\S", x)]
            if len(full) > 1 or len(c.split(" ")) >= 50:
                where[c].append((i, k))
    gone = {p for places in where.values() for p in places[1:]}
    return {i: (None if t is None else "\n".join(c for k, c in enumerate(cut[i]) if (i, k) not in gone))
            for i, t in rows}


def corpus(rnd):
    def line(n):
        return " ".join(rnd.choice("abcdefghijkl") for _ in range(n))

    passage = [line(9) for _ in range(30)]
    long = line(60)
    rows = []
    for i in range(60):
        t = [line(rnd.randint(0, 8)) for _ in range(rnd.randint(1, 25))]
        if i % 2:
            at = rnd.randint(0, len(t))
            t[at:at] = passage[: rnd.randint(8, 30)]
        if i % 3 == 0:
            t.insert(rnd.randint(0, len(t)), long)
        rows.append((i, "\n".join(t)))
    rows += [(100, None), (101, ""), (102, "\n\n\n"), (103, "BC\nCB\n$1\nB\n\\n"), (104, long + "\n" + long),
             (105, "\r\n\x85 x\n B\n" * 3), (106, "\n".join(passage)), (107, "\n".join(passage))]
    return rows


def test_equals_brute_force(spark):
    rows = corpus(random.Random(5))
    df = spark.createDataFrame([(i, t, "en", "s", -1) for i, t in rows], SCHEMA)
    df = df.selectExpr("*", "1 AS key", "'x' AS at", "2 AS h1", "3 AS gone", "4 AS doc")
    out = dedup_lines(df)
    got = {r.doc.doc_id: r for r in out.collect()}
    want = brute(rows)
    assert out.select("doc.*").columns == df.columns
    assert {i: r.doc.text for i, r in got.items()} == want
    for i, t in rows:
        r = got[i]
        assert r.doc.n_chars == (-1 if t is None else len(want[i]))
    assert got[107].n_removed > 1 and len(got[107].doc.text) < 60
    assert sum(r.n_removed for r in got.values()) > 40


def test_null_and_repeated_ids(spark):
    t = "one two\nthree four\nfive six\nseven eight\nnine ten\neleven twelve"
    df = spark.createDataFrame([(None, t, "en", "s", 1), (5, t, "en", "s", 1), (5, t, "en", "s", 1),
                                (5, t + "\nq r\nu v", None, None, None)], SCHEMA)
    got = [r.doc for r in dedup_lines(df).collect()]
    assert len(got) == 4
    texts = sorted(r.text for r in got if r.doc_id == 5)
    assert texts.count(t) in (1, 2) and len([r for r in got if r.doc_id is None][0].text) < len(t)


def test_empty_table(spark):
    assert dedup_lines(spark.createDataFrame([], SCHEMA)).collect() == []


def brute_passages(rows, m=50):
    """Every run of lines with m words that occurs at an earlier place."""
    lines = {i: t.split("\n") for i, t in rows}
    seen, gone = set(), set()
    for i in sorted(lines):
        n = len(lines[i])
        for a in range(n):
            for b in range(a + 1, n + 1):
                if sum(len(x.split()) for x in lines[i][a:b]) >= m:
                    run = tuple(lines[i][a:b])
                    gone |= {(i, k) for k in range(a, b)} if run in seen else set()
                    seen.add(run)
    return gone


def test_short_passages_go_whole(spark):
    rnd = random.Random(8)

    def line(n):
        return " ".join("".join(rnd.choice("abcdefghijkl") for _ in range(4)) for _ in range(n))

    passages = [[line(rnd.choice([0, 3, 12, 24, 40])) for _ in range(rnd.randint(3, 6))] for _ in range(8)]
    rows = []
    for i in range(40):
        t = [line(rnd.randint(0, 20)) for _ in range(rnd.randint(1, 6))]
        at = rnd.randint(0, len(t))
        t[at:at] = passages[i % 8]
        rows.append((i, "\n".join(t)))
    rows.append((50, "\n".join(passages[0] + ["new"] + passages[0])))
    df = spark.createDataFrame([(i, t, "en", "s", -1) for i, t in rows], SCHEMA)
    got = {r.doc.doc_id: r.doc.text for r in dedup_lines(df, min_words=50).collect()}
    gone = brute_passages(rows)
    assert len({i for i, _ in gone}) > 25
    for i, t in rows:
        want = "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone)
        # Chunks may take more (never less), and what goes stands in an earlier place.
        left = iter(want.split("\n"))
        assert all(x in left for x in got[i].split("\n")) or got[i] == ""
    kept = {x for t in got.values() for x in t.split("\n")}
    assert {x for _, t in rows for x in t.split("\n") if x} <= kept
    assert got[50] == "new"


def test_equal_ids_and_half_hashes(spark):
    shared, own = "\n".join(["a b " * 30] * 2), "\n".join(["c d " * 30, "e f " * 30])

    def low(t):
        return xxhash.xxh64_intdigest(t.encode(), 42) % 2**32

    n = 300_000
    by_low = {low(f"{shared}\n{k}"): k for k in range(n)}
    pair = next((by_low[h], k) for k in range(n) if (h := low(f"{own}\n{k}")) in by_low)
    texts = [f"{shared}\n{pair[0]}", f"{own}\n{pair[1]}"]
    df = spark.createDataFrame([(1, shared, "en", "s", 1)] + [(None, t, "en", "s", 1) for t in texts], SCHEMA)
    got = [r.doc.text for r in dedup_lines(df).collect() if r.doc.doc_id is None]
    assert sorted(got) == sorted([str(pair[0]), texts[1]])


def test_widest_ids(spark):
    t = "\n".join(["a b " * 30, "c d " * 30])
    ids = [2**63 - 1, None, -2**63]
    df = spark.createDataFrame([(i, t + f"\n{i}", "en", "s", 1) for i in ids], SCHEMA)
    got = {r.doc.doc_id: r.doc.text for r in dedup_lines(df).collect()}
    assert got == {-2**63: t + f"\n{-2**63}", 2**63 - 1: str(2**63 - 1), None: "None"}


def brute_registered(rows, m=PASSAGE):
    """Repeated chunks and repeated runs of lines with m words, as the query has them.
    rows: (id, text), ids distinct and not null."""
    texts = [(i, t) for i, t in rows if t is not None]
    gone = brute_passages(texts, m)
    where = defaultdict(list)
    for i, t in sorted(texts):
        at = 0
        for c in brute_chunks(t):
            n = c.count("\n") + 1
            if sum(bool(re.search(r"\S", x)) for x in c.split("\n")) > 1 or len(c.split(" ")) >= 50:
                where[c].append([(i, k) for k in range(at, at + n)])
            at += n
    gone |= {line for places in where.values() for lines in places[1:] for line in lines}
    return {i: None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone)
            for i, t in rows}


@pytest.mark.parametrize("seed", [5, 6])
def test_registered_form_equals_brute_force(spark, seed):
    rnd = random.Random(seed)
    rows = corpus(rnd)
    rows += [(200 + i, "\n".join(rnd.sample(rows[1][1].split("\n") + rows[3][1].split("\n"), 9))) for i in range(10)]
    df = spark.createDataFrame([(i, t, "en", "s", -1) for i, t in rows], SCHEMA).repartition(4)
    df = df.selectExpr("*", "1 AS key", "'x' AS piece", "2 AS h1", "3 AS gone", "4 AS doc", "5 AS f", "6 AS wrong", "7 AS t")
    out = dedup_lines(df, min_words=PASSAGE)
    want = brute_registered(rows)
    assert out.select("doc.*").columns == df.columns
    got = {r.doc.doc_id: r for r in out.collect()}
    assert {i: r.doc.text for i, r in got.items()} == want
    assert all(got[i].doc.n_chars == (-1 if t is None else len(want[i])) for i, t in rows)
    assert all((got[i].n_removed > 0) == (t is not None and want[i] != t) for i, t in rows)


def test_registered_form_null_and_repeated_ids(spark):
    t = "\n".join(" ".join(f"{a}{i}" for i in range(20)) for a in "abcd")
    other = t + "\nq r\nu v"
    df = spark.createDataFrame([(None, t, "en", "s", 1), (None, t, "en", "s", 1), (5, t, "en", "s", 1), (5, t, "en", "s", 1),
                                (5, other, None, None, None), (None, None, None, None, None)], SCHEMA).repartition(3)
    got = [r.doc for r in dedup_lines(df, min_words=PASSAGE).collect()]
    # Rows equal in id and text count as one; of different texts one keeps what they share.
    mine = sorted(r.text for r in got if r.doc_id == 5)
    assert mine in ([t, t, "q r\nu v"], ["", "", other])
    assert sorted((r.text for r in got if r.doc_id is None), key=str) == ["", "", None]


def test_registered_form_empty_table(spark):
    out = dedup_lines(spark.createDataFrame([], SCHEMA), min_words=PASSAGE)
    assert out.columns == ["doc", "n_removed"] and out.collect() == []


def test_same_hashes_different_bytes(spark, monkeypatch):
    """Where the hashes don't tell pieces apart, their bytes do: nothing is removed."""
    plain = line_dedup._pieces
    monkeypatch.setattr(line_dedup, "_pieces", lambda *a: F.transform(plain(*a), lambda x: F.struct(
        x["first"].alias("first"), x["last"].alias("last"), F.lit(1).cast("long").alias("h1"), F.lit(2).alias("h2"))))
    rows = corpus(random.Random(5))
    df = spark.createDataFrame([(i, t, "en", "s", -1) for i, t in rows], SCHEMA)
    got = {r.doc.doc_id: (r.doc.text, r.n_removed) for r in dedup_lines(df, min_words=PASSAGE).collect()}
    assert got == {i: (t, 0) for i, t in rows}
