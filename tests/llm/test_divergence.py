"""Divergence of sources against plain Python."""

import random
import re
from collections import Counter, defaultdict

import pytest

from scorecraft.llm import divergence as D

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, g long, digest long"


def brute(docs, min_docs=3, top=200):
    count, df, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in docs:
        lang, source = lang or "", source or ""
        terms = TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        count[lang, source].update(terms)
        df[lang].update(set(terms))
        groups.add((lang, source))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in df[lang].items() if n >= min_docs]
        sources = [s for x, s in groups if x == lang]
        total = {s: sum(count[lang, s][t] for t in kept) for s in sources}

        def p(n, of, v=len(kept)):
            return 1 + D.SCALE * (n + 1) // (of + v)

        for s in sources:
            mine = {t: p(count[lang, s][t], total[s]) for t in kept}
            pairs = [(-sum((mine[t] - q) ** 2 // q for t in kept for q in [p(count[lang, o][t], total[o])]), o.encode(), o)
                     for o in sources if o != s]
            whole = {t: p(sum(count[lang, o][t] for o in sources), sum(total.values())) for t in kept}
            terms = [(-((mine[t] - whole[t]) ** 2 // whole[t]), t.encode(), t)
                     for t in kept if count[lang, s][t] and mine[t] > whole[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item, -v, r) for r, (v, _, item) in enumerate(found, 1)]
    return Counter(out)


def corpus():
    rnd = random.Random(5)
    words = ["The", "of", "Ünd", "naïve", "日本", "é", "Z"] * 5 + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    docs = []
    for _ in range(250):
        lang = rnd.choice(["en", "en", "en", "de", None, ""])
        source = rnd.choice(["big"] * 4 + ["a", "b", "ü", None, ""])
        docs.append((rnd.choice([" ", "1", "_", "\n"]).join(rnd.choice(words) for _ in range(rnd.choice([0, 1, 20, 80]))), lang, source))
    docs += [("", "en", "empty"), (None, "en", "null"), ("one two", "fr", "x"), ("one", "fr", "y"), (None, "it", None),
             ("w" * 5000, "en", "big")] + [docs[0]] * 4
    return docs


def run(spark, docs, **how):
    frame = spark.createDataFrame([(1, t, lang, s, 1, 2) for t, lang, s in docs], SCHEMA).repartition(4)
    return Counter((r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in D.source_divergence(frame, **how).collect())


# Ten bits: every digest is shared by some terms; small limits: many parts and blocks.
@pytest.mark.parametrize("how", [{}, {"bits": 4, "flush": 500}, {"flush": 300, "pairs": 7}, {"top": 3, "bits": 10}])
def test_equals_brute_force(spark, how):
    docs = corpus()
    assert run(spark, docs, **how) == brute(docs, top=how.get("top", 200))


def test_ties_at_the_last_rank(spark):
    docs = [(f"{a} same", "en", "x") for a in ("d", "b", "a", "c") for _ in range(3)] + [("same " * 30, "en", "y")]
    assert run(spark, docs, top=2) == brute(docs, top=2)


def test_empty_table(spark):
    assert run(spark, []) == Counter()


def test_shuffles_no_strings(spark):
    """What is counted by group crosses the network as numbers only."""
    docs = spark.createDataFrame([(1, "a b", "en", "s", 1, 2)], SCHEMA)
    counts = D.term_counts(docs)
    assert dict(counts.dtypes)["digest"] == "array<bigint>"
    got = counts.filter(f"kind = {D.GROUP}").first()
    assert len(got.digest) == 2 and got.terms == [] and list(got.twin) == [0, 0]
