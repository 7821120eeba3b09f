"""Word-by-word encoding against the library, packing against its rules."""

import random
from collections import defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from scorecraft.llm import encoding as E
from scorecraft.llm.packing import ROW, pack, pack_lengths

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = ["the", "Nation's", "don't", "ÉTÉ", "Σας", "x1 ", "12345", "#$%", "é", " ", "  ", "\n", "\t", "\r\n",
         "\x85", "\xa0", "\x1c", "\x1f", " ", "<|endoftext|>", "'", "'s", "日本語", "\U0001f600", "a_b", "-", ".", "",
         "Foo.", "foo.", "FOO!?", "été,", "Ünd:", "don't.", "..", "a.b", "ÿ;", "×.", "\u0130.", "\u03a3.", "1."]


def random_texts(n, seed=1):
    rnd = random.Random(seed)
    out = ["", " ", "a", "a b", " a\nb ", "a  b", "\n\n a", "a \n b", "foo\n", "\nfoo", "x" * 3000]
    for _ in range(n):
        joint = rnd.choice(["", " ", " ", "\n"])
        out.append(joint.join(rnd.choice(WORDS) for _ in range(rnd.randint(1, 30))))
    return out


@pytest.mark.parametrize("file,cut", [("byte_bpe_50k.json", E.spaced_pieces),
                                      ("word_bpe_49k.json", E.dropped_space_pieces)])
def test_pieces_encode_as_whole_texts(file, cut, monkeypatch):
    path = public_tokenizers.path(file)
    tokenizer = Tokenizer.from_file(path)
    memory = E.memory_of(Path(path).read_text(encoding="utf-8"), cut)
    texts = random_texts(1500)
    monkeypatch.setattr(E, "BUDGET", 20000)
    for at in range(0, len(texts), 100):
        ids, ends = memory.encode(texts[at:at + 100])
        for t, got in zip(texts[at:at + 100], np.split(ids, ends[:-1]), strict=True):
            assert got.tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_new_words_are_rewritten_in_one_go_and_few_at_a_time():
    words = ["word", " word", " été", "ÿ", " Ünd"]
    assert E.byte_words(words) == [w.encode().decode("latin-1").translate(E.BYTE_CHARS) for w in words]
    assert E.byte_words([]) == []
    calls = []

    def encode_new(pieces):
        calls.append(len(pieces))
        return [[len(p)] for p in pieces]

    memory = E.PieceMemory(E.dropped_space_pieces, encode_new, E.ended_word, at_once=3)
    text = "a bb, cc cc dd. bb ee ff. ggg"
    ids, ends = memory.encode([text, text])
    assert max(calls) <= 6 and len(calls) > 1  # a word and its marks are two pieces
    want = [len(x) for p in text.split(" ") for x in E.ended_word(p)]
    assert ids.tolist() == 2 * want and ends.tolist() == [len(want), 2 * len(want)]


def check_pieces(lengths, pieces, capacity):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for doc, start, n, seq, offset in pieces:
        assert n > 0
        by_doc[doc].append((start, n))
        by_seq[seq].append((offset, n))
    for parts, totals in ((by_doc, dict(enumerate(lengths))), (by_seq, None)):
        for k, spans in parts.items():
            at = 0
            for a, n in sorted(spans):
                assert a == at
                at += n
            assert at == totals[k] if totals else at <= capacity
    assert set(by_doc) == {i for i, n in enumerate(lengths) if n}
    assert len(by_seq) == -(-sum(n % capacity for n in lengths) // capacity) + sum(n // capacity for n in lengths)


def test_pack_lengths():
    rnd = random.Random(2)
    for capacity in (1, 7, 64):
        for _ in range(40):
            lengths = [rnd.choice([1, 1, rnd.randint(0, 3 * capacity)]) for _ in range(rnd.randint(0, 60))]
            check_pieces(lengths, pack_lengths(np.array(lengths, np.int64), capacity), capacity)


def test_costs_are_balanced():
    lengths = np.array([300] * 8 + [50] * 48)
    pieces = pack_lengths(lengths, 600)
    cost = defaultdict(float)
    for _, _, n, s, _ in pieces:
        cost[s] += n + n * n / 8192
    assert max(cost.values()) < 1.02 * min(cost.values())


def test_pack(spark):
    texts = random_texts(300, 3) + [None, "word " * 9000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "null id"), (2**60 + 1, "big"), (7777, "a"), (7777, "a")]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA).selectExpr(
        "*", "1 AS id", "2 AS `group`", "3 AS start", "4 AS ids")
    path = public_tokenizers.path("word_bpe_49k.json")
    got = pack(df, path, group_bytes=20000).collect()
    tokenizer = Tokenizer.from_file(path)
    want = defaultdict(list)
    for i, t in rows:
        want[i].append(tokenizer.encode(t or "", add_special_tokens=False).ids + [2])
    docs, seqs = defaultdict(dict), defaultdict(list)
    for r in got:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length <= 4096
        docs[r.doc_id].setdefault(r.start, []).append((ids.tolist(), r.doc_tokens))
        seqs[r.sequence_id].append((r.offset, r.length))
    for i, lists in want.items():
        joined = [x for start in sorted(docs[i]) for x, _ in docs[i][start]]
        assert sum(joined, []) == sum(lists, [])
        assert all(n == len(lists[0]) for v in docs[i].values() for _, n in v)
    for spans in seqs.values():
        at = 0
        for a, n in sorted(spans):
            assert a == at
            at += n
        assert at <= 4096
    assert pack(df.limit(0), path).collect() == []


def test_equal_rows_are_spread_over_groups(spark):
    """A third of all rows and more equal in id and text: no group holds them all."""
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = spark.range(100_000).selectExpr("CAST(NULL AS LONG) AS doc_id", "CAST(NULL AS STRING) AS text").unionByName(
        spark.range(3000).selectExpr("7L AS doc_id", "repeat('word ', 100) AS text")).unionByName(
        spark.range(500).selectExpr("id + 1000 AS doc_id", "concat('text ', id) AS text"))
    packed = pack(rows, path, group_bytes=200_000)
    pieces = packed.select("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", F.crc32("ids").alias("crc"))
    got = pieces.toPandas()
    group = got.sequence_id // (1 << 32)
    # a row counts its text's bytes and ROW: a group holds two blocks and some single rows
    assert len(got[got.doc_id.isna()]) == 100_000 and (got[got.doc_id.isna()].doc_tokens == 1).all()
    assert got[got.doc_id.isna()].groupby(group).size().max() <= 8 * (200_000 // ROW)
    assert got[got.doc_id.isna()].groupby(group).size().size > 15
    whole = got[got.doc_id == 7]
    assert whole.length.sum() == 3000 * 101 and (whole.doc_tokens == 101).all()
    assert got[got.doc_id >= 1000].doc_id.nunique() == 500
    spans = got.sort_values(["sequence_id", "offset"]).groupby("sequence_id")
    assert (spans.offset.first() == 0).all() and (spans.length.sum() <= 4096).all()
    assert (spans.length.sum() == spans.offset.last() + spans.length.last()).all()
