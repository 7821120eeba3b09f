"""Packed blocks: lossless, and the fits over them against MLlib's."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from scorecraft.operators import blocks as bl
from scorecraft.operators import models as md


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(900, 3)) * [1, 30, 0.1] + [0, 500, 0]
    x[:, 1] = np.round(x[:, 1], 2)
    y = (x[:, 0] + 0.02 * x[:, 1] + rng.normal(size=900) * 0.5 > 10).astype(float)
    df = spark.createDataFrame([(i, *map(float, r), float(t), f"g{i % 3}") for i, (r, t) in enumerate(zip(x, y))],
                               "id long, a double, b double, c double, label double, g string")
    return md.stable(md.assembled(df, ["a", "b", "c"], keep=["id", "g"]), ["id"], 4).cache()


def test_blocks_give_their_values_back():
    pack, unpack = bl._coder()
    rng = np.random.default_rng(1)
    x = np.column_stack([rng.integers(0, 256, 99), rng.integers(-300, 300, 99), np.rint(rng.random(99) * 1e7) / 100, rng.normal(size=99),
                         rng.integers(0, 2 ** 40, 99), np.where(rng.random(99) < 0.5, -0.0, 1.0), np.full(99, np.inf), np.full(99, 0.07)])
    blob = pack(x)
    assert np.array_equal(unpack(blob), x) and np.array_equal(np.signbit(unpack(blob)), np.signbit(x))
    assert len(blob) < 99 * (1 + 2 + 4 + 8 * 4 + 1) + 50


@pytest.mark.parametrize("block", [1 << 15, 512])
def test_fits_in_step_are_those_of_single_fits(spark, frame, monkeypatch, block):
    monkeypatch.setattr(bl, "_BLOCK", block)
    grid = [(0.0, 0.0), (0.1, 0.0), (0.1, 0.5), (0.01, 1.0)]
    with bl.packed(frame, [F.col("id") % 3]) as rows:
        got = bl.logistic_fits(rows, 2, [lambda b: b[:, 1] != 1, lambda b: b[:, 1] < 9], grid, 10)
    for side, part in enumerate((frame.filter("id % 3 != 1"), frame)):
        for k, (strength, mix) in enumerate(grid):
            m = LogisticRegression(maxIter=10, regParam=strength, elasticNetParam=mix).fit(part)
            assert np.allclose(got[side, k], [*m.coefficients, m.intercept], rtol=1e-7, atol=1e-9)


def test_search_gives_the_metrics_of_pyspark(spark, frame):
    lr, grid = md._logistic_grid()
    want = CrossValidator(estimator=lr, estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(), numFolds=3,
                          seed=12345).fit(frame)
    got = md.cross_validate(frame, folds=3)
    assert np.allclose(got.avgMetrics, want.avgMetrics, atol=1e-9) and np.allclose(got.stdMetrics, want.stdMetrics, atol=1e-9)
    assert np.allclose(got.bestModel.coefficients, want.bestModel.coefficients)


def test_searches_and_groups_read_the_rows_together(spark, frame, monkeypatch):
    fits = []
    fit = LogisticRegression._fit
    monkeypatch.setattr(LogisticRegression, "_fit", lambda self, d: fits.append(1) or fit(self, d))
    md.cross_validate(frame, folds=3), md.train_valid_search(frame)
    assert len(fits) == 2  # the best points' refits
    one = md.leave_one_group_out(frame, "g", md.logistic_estimator("binomial", 10)).collect()
    assert len(fits) == 2
    each = md.leave_one_group_out(frame, "g", lambda t: md.logistic(t, "binomial", 10)).collect()
    assert one == each and len(fits) == 5


def test_areas_are_exact_with_ties_over_many_ranges(spark, frame, monkeypatch):
    for name, value in (("_SORTED", 50), ("_PART", 200), ("_BLOCK", 128)):
        monkeypatch.setattr(bl, name, value)
    models = np.array([[1.0, 0, 0, 0], [0, 0.05, 0, -1], [0, 0, 0, 3.0]])
    use = lambda b: np.stack([np.full(len(b), 0), np.full(len(b), 1), np.full(len(b), 2), np.where(b[:, 1] == 9, 0, -1)], axis=1)
    df = frame.withColumn("k", F.col("id") % 7)
    with bl.packed(df, [F.col("k")]) as rows:
        got = bl.areas_under_roc(rows, 2, models, 4, use)
    x = np.array([[*r.features, r.label] for r in frame.select("features", "label").collect()])
    for a in range(3):
        s = x[:, :3] @ models[a, :3]
        p, n = s[x[:, 3] == 1], s[x[:, 3] == 0]
        assert got[a] == pytest.approx(((p[:, None] > n) + 0.5 * (p[:, None] == n)).mean(), abs=1e-12)
    assert got[2] == 0.5 and np.isnan(got[3])


def test_null_label_and_one_class(spark):
    df = md.assembled(spark.range(40).selectExpr("double(id) a", "if(id = 3, null, double(id % 2)) label"), ["a"])
    with pytest.raises(Exception, match="Labels MUST NOT be Null"):
        md.cross_validate(df, folds=2)
    df = md.assembled(spark.range(40).selectExpr("double(id) a", "1.0 label"), ["a"])
    with bl.packed(df) as rows:
        assert bl.logistic_fits(rows, 1, [lambda b: b[:, 0] >= 0], [(0.0, 0.0)], 5).tolist() == [[[0.0, np.inf]]]


@pytest.mark.parametrize("rows, at_once", [(10_000, 4), (2000, 2), (5, 1)])
def test_fewer_fits_at_once_for_more_rows(spark, frame, monkeypatch, rows, at_once):
    seen = []
    monkeypatch.setattr(md, "_ROWS_AT_ONCE", rows)
    monkeypatch.setattr(md, "OneVsRest", lambda classifier, parallelism: seen.append(parallelism) or type("Fit", (), {"fit": lambda s, d: d.count()})())
    assert md.one_vs_rest(frame) == 900 and seen == [at_once]
