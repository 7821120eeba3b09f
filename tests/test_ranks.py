"""Rank correlation against numpy, with every kind of column and small bounds."""

import numpy as np
import pytest

from scorecraft.operators import ranks
from scorecraft.operators import selection as sel


def _mid_ranks(x):
    _, at, n = np.unique(x, return_inverse=True, return_counts=True)
    return (np.cumsum(n) - (n - 1) / 2)[at]


@pytest.mark.parametrize("chunk, cuts, group", [(7, 5, 20), (64, 40, 100), (1 << 18, 1024, 1 << 20)])
def test_ranks_are_exact_whatever_the_bounds(spark, monkeypatch, chunk, cuts, group):
    for name, value in (("_CHUNK", chunk), ("_CUTS", cuts), ("_GROUP", group), ("_TASK", 100)):
        monkeypatch.setattr(ranks, name, value)
    rng = np.random.default_rng(3)
    a = rng.normal(size=700)
    x = np.stack([a, np.round(a + rng.normal(size=700), 1), rng.integers(0, 3, 700), np.where(rng.random(700) < 0.4, 0.0, a ** 3),
                  np.full(700, 2.0), np.where(a > 1, np.inf, -a)], axis=1)
    cols = list("abcdef")
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"{c} double" for c in cols)).repartition(3)
    got = {(r.var1, r.var2): r["corr"] for r in sel.correlation_matrix(df, cols, "spearman").collect()}
    r = np.stack([_mid_ranks(c) for c in x.T])
    for i, p in enumerate(cols):
        for j, q in enumerate(cols):
            if p == q or "e" in (p, q):
                assert got[p, q] == (1.0 if p == q else None)
            else:
                assert got[p, q] == pytest.approx(np.corrcoef(r[i], r[j])[0, 1], abs=1.1e-6)


def test_values_travel_as_arrays_not_one_by_one(spark, monkeypatch):
    monkeypatch.setattr(sel.Correlation, "corr", lambda *a: pytest.fail("a shuffle of every value by itself"))
    df = spark.range(50).selectExpr("double(id) a", "double(id * id) b", "double(-id) c")
    got = {(r.var1, r.var2): r["corr"] for r in sel.correlation_matrix(df, ["a", "b", "c"], "spearman").collect()}
    assert got["a", "b"] == 1.0 and got["a", "c"] == -1.0


def test_null_and_nan_raise(spark):
    for bad in ("null", "double('NaN')"):
        df = spark.range(9).selectExpr("double(id) a", f"if(id = 4, {bad}, double(id)) b")
        with pytest.raises(Exception, match="impute it first"):
            sel.correlation_matrix(df, ["a", "b"], "spearman")
