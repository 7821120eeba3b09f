"""Personal data against plain regular expressions."""

import hashlib
import random
import re

from scorecraft.llm.pii import find_pii, mask_pii, span_list

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def luhn(d):
    return sum(int(c) if i % 2 == 0 else (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(c)]
               for i, c in enumerate(reversed(d))) % 10 == 0


def digits(m):
    return re.sub("[^0-9]", "", m)


BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15)]


def brute(text):
    return [(k, m.start(), m.end()) for k, p, ok in BASE for m in re.finditer(p, text or "") if ok(m[0])]


FIXED = [
    "", None, "no data", "a@b.c_d@e.f x..@y.z @q a@b a@b.c@d.e", "1.2.3.4.5.6.7.8 0255.1.1.1 256.1.1.1 00.0.0.0",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 4111  1111", "+1 (017) 555-7713 +1 2 +12345678901234567 ++49-30-1234567)",
    "é\U0001f600 mail ü me@x.org\n+49 30 12345678", "card 10.0.0.1 4111111111111111 x1.2.3.4.",
    "+4111111111111111 a@1.2.3.4 " * 40, "9" * 5000, "a" * 20000 + " %@%.x", "1." * 3000, "a.b-" * 3000 + "@x.y",
    "iban DE89 3704 0044 0532 0130 00, GB82WEST12345698765432 DE88370400440532013000",
    "SSN: 123-45-6789 and later 123-45-6780 but 000-12-3456", "no word here 123-45-6789"]


def texts():
    rnd = random.Random(9)
    alphabet = ["a", "B9", "@", ".", "-", "+", "1", "22", "255", " ", "(", ")", "\n", "_", "4111111111111111", "é", "%"]
    return FIXED + ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 120))) for _ in range(400)]


def frame(spark):
    df = spark.createDataFrame([(i, t, "en", "s", -1) for i, t in enumerate(texts())], SCHEMA)
    return df.selectExpr("*", "1 AS t", "2 AS base", "'x' AS doc", "3 AS f_email")


def test_base_spans_equal_brute_force(spark):
    got = {r[0]: r for r in find_pii(frame(spark)).select(
        "doc.doc_id", "base", "added", span_list("base").alias("s")).collect()}
    for i, t in enumerate(texts()):
        want = brute(t)
        assert [(s.kind, s.start, s.end) for s in got[i].base] == want, t
        assert got[i].s == ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert all(0 < s.score <= 1 for s in got[i].base)


def test_added_spans(spark):
    rows = {r[0]: [(s.kind, texts()[r[0]][s.start:s.end]) for s in r[1]] for r in find_pii(
        frame(spark)).select("doc.doc_id", "added").collect()}
    at = {t: i for i, t in enumerate(FIXED)}
    assert rows[at[FIXED[14]]] == [("iban", "DE89 3704 0044 0532 0130 00"), ("iban", "GB82WEST12345698765432")]
    assert rows[at[FIXED[15]]] == [("ssn", "123-45-6789")]
    assert rows[at[FIXED[16]]] == []


def test_masking(spark):
    df = frame(spark)
    out = mask_pii(df)
    assert out.columns == df.columns
    added = {r[0]: [(s.kind, s.start, s.end) for s in r[1]] for r in find_pii(df).select(
        "doc.doc_id", "added").collect()}
    for r in out.collect():
        t = texts()[r.doc_id]
        if t is None:
            assert r.text is None and r.n_chars == -1
            continue
        parts, at = [], 0
        for a, b, k in sorted((a, b, k) for k, a, b in brute(t) + added[r.doc_id]):
            if a >= at:
                parts += [t[at:a], f"[{k.upper()}]"]
            at = max(at, b)
        want = "".join(parts) + t[at:]
        assert r.text == want and r.n_chars == len(want)


def test_query_digest(spark, tmp_path):
    from scorecraft.llm.queries import QUERIES

    frame(spark).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    for r in QUERIES["op2_pii"](spark, str(tmp_path)).collect():
        want = brute(texts()[r.doc_id])
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest() and r.spans.startswith(text)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [
            sum(k == x for k, _, _ in want) for x in ("email", "ip", "card", "phone")]


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert find_pii(df).collect() == [] and mask_pii(df).collect() == []


def test_context_beyond_a_match_and_after_it(spark):
    texts = ["SSN: 123-45-6789, 234-56-7890", "123-45-6789 (social security number)",
             "ssn" + " " * 41 + "123-45-6789", "123-45-6789" + " " * 41 + "ssn"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc.doc_id: [(s.start, s.end) for s in r.added] for r in find_pii(df, beyond=True).collect()}
    assert got == {0: [(5, 16), (18, 29)], 1: [(0, 11)], 2: [], 3: []}
