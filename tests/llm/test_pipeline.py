"""The pipeline's stages, each held against brute force on its own input."""

import random
from collections import defaultdict

import numpy as np
import public_tokenizers
from test_line_dedup import brute_registered as brute_lines
from test_pii import brute as brute_spans
from test_quality import brute_counts
from test_simhash import brute_fingerprint, brute_groups
from tokenizers import Tokenizer

import corpus_pipeline
from scorecraft.llm.common import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def documents():
    rnd = random.Random(11)
    syllables = {"en": ["th", "e", "ing", "on", "at", "er"], "de": ["sch", "ön", "er", "ung", "ei", "ch"]}
    vocab = {k: ["".join(rnd.choice(v) for _ in range(rnd.randint(1, 3))) for _ in range(400)]
             for k, v in syllables.items()}

    def sentence(lang):
        return " ".join(rnd.choice(vocab[lang]) for _ in range(rnd.randint(6, 14))) + "."

    passage = {k: [sentence(k) for _ in range(14)] for k in vocab}
    rows = []
    for i in range(120):
        lang = rnd.choice(list(vocab))
        lines = [sentence(lang) for _ in range(rnd.randint(4, 20))]
        if i % 5 == 0:
            lines[2:2] = passage[lang]
        if i % 7 == 0:
            lines.insert(1, f"write to me{i}@mail.example.com or +1 (017) 555-77{i % 90 + 10} now")
        rows.append((i, "\n".join(lines), lang))
    rows += [(200 + i, rows[i % 3 + 21][1], rows[i % 3 + 21][2]) for i in range(40)]  # copies
    rows += [(300 + i, rows[30][1] + f" one{i}", rows[30][2]) for i in range(6)]
    rows += [(400, None, "en"), (401, "", None), (402, "too short", "en"), (403, "again and again " * 40, "en"), (None, rows[40][1], "de")]
    return [(i, t, lang, "s", None if t is None else len(t)) for i, t, lang in rows]


def test_stages_on_their_own_input(spark):
    docs = spark.createDataFrame(documents(), "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.repartition(5)
    before = {None: None}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, ""), f"test-{name}")
        assert docs.columns == COLUMNS and [f.dataType.simpleString() for f in docs.schema] == [
            "bigint", "string", "string", "string", "bigint"]
        after = docs.collect()
        if name == "quality_rules":
            ok = [r for r in documents() if r[1] and brute_counts(r[1])[0] >= 10
                  and 100 * brute_counts(r[1])[4] <= 20 * brute_counts(r[1])[0]]
            assert {(r.doc_id, r.text) for r in after} <= {(r[0], r[1]) for r in ok}
            assert len(after) >= 0.97 * len(ok)
        elif name == "line_dedup":
            known = [(r.doc_id, r.text) for r in before if r.doc_id is not None]
            want = brute_lines(known + [(10**6, r.text) for r in before if r.doc_id is None])  # null: last
            assert {10**6 if r.doc_id is None else r.doc_id: r.text for r in after} == want
            assert all(r.n_chars == len(r.text) for r in after)
            assert sum(len(r.text) for r in after) < sum(len(r.text) for r in before)
        elif name == "simhash_near_dedup":
            fps = [brute_fingerprint(r.text) for r in before]
            groups, least = brute_groups(fps, 3), {}
            for r, g in zip(before, groups):
                least[g] = min(least.get(g, (2**62, r)), (2**62 if r.doc_id is None else r.doc_id, r))
            assert sorted(after, key=str) == sorted((r for _, r in least.values()), key=str)
            assert len(after) < len(before)
        elif name == "pii":
            texts = {r.doc_id: r.text for r in before}
            assert set(texts) == {r.doc_id for r in after}
            for r in after:
                spans = brute_spans(texts[r.doc_id])
                assert not brute_spans(r.text) and r.text.count("[EMAIL]") == sum(k == "email" for k, _, _ in spans)
            assert any("[PHONE]" in r.text for r in after)
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = defaultdict(dict)
    for r in packed:
        pieces[r.doc_id][r.start] = np.frombuffer(r.ids, "<u4").tolist()
    for r in before:
        want = tokenizer.encode(r.text, add_special_tokens=False).ids + [2]
        assert sum((pieces[r.doc_id][s] for s in sorted(pieces[r.doc_id])), []) == want
    assert set(pieces) == {r.doc_id for r in before}


def test_run(spark, tmp_path):
    spark.createDataFrame(documents(), "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    assert 0 < out.select("doc_id").distinct().count() <= len(documents())
