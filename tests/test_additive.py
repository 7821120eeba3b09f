"""Results from sums that add up, against NumPy, MLlib and single-node sorting."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorecraft.operators import features as fe
from scorecraft.operators import models as md
from scorecraft.operators import moments, sampling
from scorecraft.operators.bayes import NaiveBayesTables
from scorecraft.session import scratch_path
from scorecraft.sources import io


def frame_of(spark, x, parts=7):
    names = [f"f{i}" for i in range(x.shape[1])]
    return spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(
        f"{n} double" for n in names)).repartition(parts), names


# ---------------------------------------------------------------- tall-skinny QR
def test_svd_keeps_the_digits_that_squares_lose(spark):
    rng = np.random.default_rng(3)
    u, _ = np.linalg.qr(rng.normal(size=(900, 6)))
    v, _ = np.linalg.qr(rng.normal(size=(6, 6)))
    true = np.array([1e3, 1.0, 1e-1, 1e-2, 1e-3, 3e-4])
    x = u * true @ v.T
    df, names = frame_of(spark, x)
    values, vecs = fe.svd(df, names, 6)
    reference = np.linalg.svd(x, compute_uv=False)
    assert np.abs(values - reference).max() <= 1e-10  # X^T X would be off by 1e-7
    assert np.allclose(np.abs(np.sum(vecs * v, axis=0)), 1, atol=1e-7)


def test_svd_of_many_features_and_of_few_rows(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(500, 120))
    df, names = frame_of(spark, x, 40)
    assert np.allclose(fe.svd(df, names, 5)[0], np.linalg.svd(x, compute_uv=False)[:5], rtol=1e-10)
    few, names = frame_of(spark, x[:2, :4], 5)
    assert np.allclose(fe.svd(few, names, 4)[0], [*np.linalg.svd(x[:2, :4], compute_uv=False), 0, 0])
    assert fe.svd(few.limit(0), names, 3)[0].tolist() == [0, 0, 0]


@pytest.mark.parametrize("bad", [None, float("nan")])
def test_svd_missing_value_raises(spark, bad):
    df = spark.createDataFrame([(1.0, 2.0), (bad, 1.0)], "f0 double, f1 double")
    with pytest.raises(ValueError, match="1 rows have a missing feature"):
        fe.svd(df, ["f0", "f1"], 1)


# ------------------------------------------------------------------ exact sample
def brute_sample(rows, wanted):
    out, seen = [], {}
    for s, u, k in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        seen[s] = seen.get(s, 0) + 1
        if seen[s] <= wanted(s, sum(r[0] == s for r in rows)):
            out.append((s, k))
    return sorted(out, key=str)


def sample_rows(n=400):
    # a third of the rows share one draw, and NULL is a stratum
    return [("ab"[i % 2] if i % 5 else None, 77 if i % 3 == 0 else i * 7919 % 1009, i) for i in range(n)]


@pytest.mark.parametrize("size", [0, 1, 37, 10_000, 0.25, 1.0, {"a": 5, None: 0.5}])
def test_exact_sample_equals_sorting_for_any_layout(spark, size):
    rows = sample_rows()
    df = spark.createDataFrame(rows, "s string, u long, k long")

    def wanted(s, n):
        x = size.get(s, 0) if isinstance(size, dict) else size
        return x if isinstance(x, int) else int(n * x + 0.5)

    expected = brute_sample(rows, wanted)
    for parts in (1, 9):
        got = sampling.exact_sample(df.repartition(parts), size, ["k"], "s", draw=F.col("u"), draws=1009)
        assert got.columns == ["s", "u", "k"]
        assert sorted(((r.s, r.k) for r in got.collect()), key=str) == expected


def test_exact_sample_by_hash(spark):
    df = spark.range(5000).withColumn("same", F.lit(1))
    first = {r.id for r in sampling.exact_sample(df.repartition(3), 0.3, ["id"]).collect()}
    again = {r.id for r in sampling.exact_sample(df.repartition(11), 0.3, ["id"]).collect()}
    other = {r.id for r in sampling.exact_sample(df, 0.3, ["id"], seed=1).collect()}
    assert first == again and len(first) == 1500 and len(first & other) < 700
    assert sampling.exact_sample(df, 70, ["same"]).count() == 70  # all rows tie
    assert sampling.exact_sample(df.limit(0), 0.5, ["id"]).count() == 0


# ----------------------------------------------------------- fits by subtraction
def test_leave_one_group_out_equals_refits(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(700, 3)) * [1, 50, 1000] + [5, 0, 300]
    y = x @ [2.0, -0.1, 0.003] + 4 + rng.normal(size=700)
    g = np.where(np.arange(700) % 2, "hot", np.array([f"g{i % 90}" for i in range(700)]))
    rows = [(None if k == "g4" else str(k), *map(float, r), 1.0, float(t)) for k, r, t in zip(g, x, y)]
    df = spark.createDataFrame(rows, "g string, a double, b double, c double, same double, y double").repartition(6)
    got = {r["group"]: r for r in moments.leave_one_group_out_linear(df, "g", ["a", "b", "c", "same"], "y").collect()}
    keys = [r[0] for r in rows]
    assert set(got) == set(keys)
    for k in set(keys):
        out = np.array([x_ == k for x_ in keys])
        design = np.c_[np.ones(700), x]
        beta = np.linalg.lstsq(design[~out], y[~out], rcond=None)[0]
        r = got[k]
        assert (r.n_train, r.n_test) == (int((~out).sum()), int(out.sum()))
        assert np.allclose([r.intercept, *r.coefficients], [*beta, 0], rtol=1e-6, atol=1e-9)
        for side, r2 in ((~out, r.train_r2), (out, r.test_r2)):
            e, t = y[side] - design[side] @ beta, y[side] - y[side].mean()
            assert r2 == pytest.approx(1 - (e @ e) / (t @ t), abs=1e-7) if side.sum() > 1 else r2 is None


def test_leave_one_group_out_edges(spark):
    schema = "g long, x double, y double"
    one = moments.leave_one_group_out_linear(spark.createDataFrame([(1, 2.0, 3.0), (1, 3.0, 5.0)], schema), "g", ["x"], "y")
    assert [tuple(r) for r in one.collect()] == [(1, 0, 2, None, None, None, None)]
    assert moments.leave_one_group_out_linear(spark.createDataFrame([], schema), "g", ["x"], "y").count() == 0
    with pytest.raises(Exception, match="missing feature"):
        moments.leave_one_group_out_linear(spark.createDataFrame([(1, None, 3.0)], schema), "g", ["x"], "y")


def test_leave_one_group_out_reads_the_rows_once(spark):
    path = scratch_path(spark, "rows")
    spark.range(100).selectExpr("id % 7 AS g", "CAST(id AS DOUBLE) AS x", "2D * id AS y").write.parquet(path)
    plan = moments.group_moments(spark.read.parquet(path), "g", ["x"], "y")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


# ------------------------------------------------------------------- naive Bayes
def test_bayes_on_numbers_equals_mllib(spark):
    rng = np.random.default_rng(6)
    rows = [(i, *map(float, rng.integers(0, 9, 3)), float(rng.integers(0, 3))) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, label double")
    model = NaiveBayesTables(df, "label", ["a", "b", "c"])
    fitted = md.naive_bayes(md.assembled(df, ["a", "b", "c"], keep=["id"]))
    logs = {r["column"]: r["logs"] for r in model.terms.collect()}
    assert np.allclose(np.array([logs[c] for c in "abc"]).T, fitted.theta.toArray())
    assert np.allclose(model.priors, fitted.pi.toArray())
    ours = {r.id: r.prediction for r in model.transform(df).collect()}
    theirs = {r.id: r.prediction for r in fitted.transform(md.assembled(df, ["a", "b", "c"], keep=["id"])).collect()}
    assert ours == theirs


def test_bayes_of_a_wide_column_nulls_and_unseen(spark):
    # a value per row but for a hot one and NULL
    rows = [(i, None if i % 7 == 0 else "hot" if i % 3 == 0 else f"v{i}", None if i % 50 == 49 else "xy"[i % 3 == 0])
            for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, c string, label string")
    model = NaiveBayesTables(df, "label", categorical=["c"])
    fit = [r for r in rows if r[2] is not None]
    vocabulary = {r[1] for r in fit}
    n = {k: sum(r[2] == k for r in fit) for k in "xy"}
    prior = {k: np.log((n[k] + 1) / (len(fit) + 2)) for k in "xy"}

    def score(k, v):
        seen = sum(r[2] == k and r[1] == v for r in fit)
        return prior[k] + np.log((seen + 1) / (n[k] + len(vocabulary)))

    asked = spark.createDataFrame([("hot",), (None,), ("v1",), ("never",)], "c string")
    for r in model.transform(asked).collect():
        best = max("xy", key=lambda k: score(k, r.c))
        assert r.prediction == best and r.prediction_score == pytest.approx(score(best, r.c))
    assert model.frequency_table().count() == 2 * len(vocabulary)


def test_bayes_scores_rows_of_one_key_together(spark):
    rows = [(1, 2.0, "u", 0), (1, 1.0, "v", 1), (2, 4.0, "u", 1), (None, 3.0, "v", 0), (None, 1.0, "u", 0)]
    df = spark.createDataFrame(rows, "id long, a double, c string, label int")
    model = NaiveBayesTables(df, "label", ["a"], ["c"])
    got = {r.id: r for r in model.transform(df, by=["id"]).collect()}
    assert model.transform(df).count() == 5 and set(got) == {1, 2, None}
    logs = {(r["column"], r["value"]): r["logs"] for r in model.terms.collect()}
    for key, r in got.items():
        scores = [model.priors[k] + sum(a * logs["a", None][k] + logs["c", c][k] for i, a, c, _ in rows if i == key)
                  for k in range(2)]
        assert r.prediction == int(np.argmax(scores)) and r.prediction_score == pytest.approx(max(scores))


def test_bayes_refuses_and_survives(spark):
    schema = "a double, label int"
    for bad in (-1.0, None, float("nan")):
        with pytest.raises(ValueError, match="negative or missing"):
            NaiveBayesTables(spark.createDataFrame([(bad, 1), (2.0, 0)], schema), "label", ["a"])
    empty = NaiveBayesTables(spark.createDataFrame([], schema), "label", ["a"])
    assert empty.classes == [] and empty.terms.count() == 0


# ------------------------------------------------------------------------ buckets
def test_bucketed_join_has_no_shuffle(spark):
    rows = spark.range(1000).selectExpr("id % 300 AS k", "id AS v")
    keys = spark.range(300).selectExpr("id AS j", "id * 2 AS w")
    names = [io.save_bucketed(df, scratch_path(spark, "bucketed"), [key], 4) for df, key in ((rows, "k"), (keys, "j"))]
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = spark.table(names[0]).join(spark.table(names[1]), F.col("k") == F.col("j"))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.agg(F.sum("w")).first()[0] == sum(2 * (i % 300) for i in range(1000))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        for n in names:
            spark.sql(f"DROP TABLE {n}")
