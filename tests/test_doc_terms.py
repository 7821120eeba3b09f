"""Terms counted inside the rows: brute force, repeated ids, no shuffle."""

from collections import Counter

from scorecraft.operators import text as tx

ROWS = [(1, ["b", "a", "b", "c", "b"]), (2, ["a"]), (2, ["a", "a"]), (3, []), (4, None), (None, ["c", "é", "c"])]


def test_equals_brute_force(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, tokens array<string>").repartition(3)
    want = sorted((d or 0, t, n) for d, ts in ROWS for t, n in Counter(ts or []).items())
    assert sorted((r.doc_id or 0, r.term, r.n) for r in tx.doc_terms(df).collect()) == want
    got = {r.term: (r.df, r.tf) for r in tx.term_stats(df).collect()}
    assert got == {t: (sum(x == t for _, x, _ in want), sum(n for _, x, n in want if x == t)) for _, t, _ in want}
    assert tx.doc_terms(df.filter("false")).count() == 0


def test_no_shuffle_by_document(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, tokens array<string>")
    plan = tx.term_stats(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in tx.doc_terms(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(term") == 1 and plan.count("Exchange") == 1
