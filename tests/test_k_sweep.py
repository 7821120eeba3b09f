"""All k of a sweep in one scan: equal to separate fits, MLlib's silhouette, few scans."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from scorecraft.operators import clustering as cl


def points(spark, n=600):
    draw = np.random.default_rng(5)
    x = draw.normal(size=(n, 3)) + 6 * draw.integers(0, 4, size=(n, 1))
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    rows += [(n + i, rows[0][1]) for i in range(50)]  # repeated rows
    return spark.createDataFrame(rows, "id long, v array<double>").repartition(5)


def lloyd(x, c, max_iter=20, tol=1e-4):
    for _ in range(max_iter):
        near = ((x[:, None] - c) ** 2).sum(2).argmin(1)
        new = np.array([x[near == i].mean(0) if (near == i).any() else c[i] for i in range(len(c))])
        done = (((new - c) ** 2).sum(1) <= tol * tol).all()
        c = new
        if done:
            break
    return c


def test_equals_separate_fits(spark):
    df = points(spark)
    rows = df.select("v")
    x = np.array([r.v for r in rows.collect()])
    start = cl.start_centers(rows, 6, 3)
    assert (start == cl.start_centers(rows.repartition(2), 6, 3)).all() and len(start) == 6
    assert (start[:4] == cl.start_centers(rows, 4, 3)).all()
    together = cl.kmeans_all(rows, {k: start[:k] for k in (2, 4, 6)})
    for k, c in together.items():
        assert np.allclose(c, lloyd(x, start[:k]), atol=1e-8)
        assert np.allclose(c, cl.kmeans_all(rows, {k: start[:k]})[k], atol=1e-8)
    found = cl.silhouettes_all(rows, together)
    for k, c in together.items():
        near = F.udf(lambda v, c=c: int(((np.array(v) - c) ** 2).sum(1).argmin()), "int")
        pred = rows.select(array_to_vector("v").alias("features"), near("v").alias("prediction"))
        assert abs(found[k] - cl.silhouette(pred)) < 1e-9


def test_scans_do_not_grow_with_ks(spark, monkeypatch):
    rows, scans = points(spark, 200).select("v"), []
    plain = cl._scan
    monkeypatch.setattr(cl, "_scan", lambda *a: scans.append(len(a[1])) or plain(*a))
    start = cl.start_centers(rows, 7, 3)
    cl.kmeans_all(rows, {k: start[:k] for k in range(2, 8)}, max_iter=3, tol=0.0)
    assert len(scans) <= 3 and scans[0] == 6


def test_edges(spark):
    def frame(vectors, parts=3):
        rows = spark.createDataFrame([(v,) for v in vectors], "v array<double>").repartition(parts)
        return rows.select(array_to_vector("v").alias("features"))

    def sweep(df, ks):
        return {r.k: r.silhouette for r in cl.k_sweep(df, ks).collect()}

    assert sweep(frame([[1.0, 2.0]] * 20), [2, 3]) == {2: None, 3: None}  # one distinct vector
    assert sweep(frame([[1.0], [2.0]] * 9), [2, 5]) == {2: 1.0, 5: 1.0}  # fewer than k
    assert sweep(frame([]), [2]) == {2: None}
    with pytest.raises(Exception, match="missing or infinite"):
        sweep(frame([[1.0], [float("nan")], [2.0]]), [2])
    holes = spark.createDataFrame([([1.0],), (None,), ([2.0],)], "v array<double>")
    with pytest.raises(Exception, match="missing or infinite"):
        cl.kmeans_all(holes, {2: np.array([[1.0], [2.0]])})
