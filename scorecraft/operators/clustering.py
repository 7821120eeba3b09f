"""Clustering: k-means, bisecting k-means and silhouette sweeps.

Single fits are MLlib's. The sweep over several k moves the centres of every k in
the same scan of the rows, and takes all silhouettes in two more scans.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def kmeans(df: DataFrame, k: int = 2, seed: int = 1003, features: str = "features"):
    return KMeans(k=k, seed=seed, featuresCol=features).fit(df)


def bisecting_kmeans(df: DataFrame, k: int = 2, seed: int = 1, features: str = "features"):
    return BisectingKMeans(k=k, seed=seed, featuresCol=features).fit(df)


def centers_table(model, names: Sequence[str], spark) -> DataFrame:
    rows = [(i, n, float(c[j])) for i, c in enumerate(model.clusterCenters())
            for j, n in enumerate(names)]
    return spark.createDataFrame(rows, "cluster int, feature string, center double")


def silhouette(pred: DataFrame, features: str = "features") -> float:
    return ClusteringEvaluator(featuresCol=features, predictionCol="prediction",
                               metricName="silhouette",
                               distanceMeasure="squaredEuclidean").evaluate(pred)


# ------------------------------------------------------- all k in one scan
Centers = dict[int, np.ndarray]


def _scan(rows: DataFrame, centers: Centers, each: Callable[[np.ndarray, int, np.ndarray], np.ndarray]
          ) -> dict[int, np.ndarray]:
    """One scan of the vectors ``v``: per k the sum over all batches of
    ``each(vectors, k, nearest centre)``, an array of fixed shape. Batches are summed
    inside the task, tasks by Spark; the driver gets one array per k."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            column = batch.column(0)
            x = column.flatten().to_numpy(zero_copy_only=False)
            if column.null_count or not np.isfinite(x).all():
                raise ValueError("vectors have missing or infinite values")
            x = x.reshape(len(column), -1)
            for k, c in centers.items():
                near, best = np.zeros(len(x), np.int64), np.full(len(x), np.inf)
                for i in range(len(c)):  # ties: the smaller number
                    d = ((x - c[i]) ** 2).sum(axis=1)
                    closer = d < best
                    near[closer], best[closer] = i, d[closer]
                part = each(x, k, near)
                total[k] = total[k] + part if k in total else part
        for k, part in total.items():
            yield pa.RecordBatch.from_pydict({
                "k": pa.array(np.full(part.size, k, np.int64)), "at": pa.array(np.arange(part.size)),
                "value": pa.array(part.ravel())}, pa.schema([("k", pa.int64()), ("at", pa.int64()), ("value", pa.float64())]))

    out: dict[int, list] = {}
    for r in rows.mapInArrow(sums, "k long, at long, value double").groupBy("k", "at").agg(
            F.sum("value").alias("value")).orderBy("k", "at").collect():
        out.setdefault(r["k"], []).append(r["value"])
    return {k: np.array(v) for k, v in out.items()}


def _cluster_sums(rows: DataFrame, centers: Centers) -> dict[int, np.ndarray]:
    """Per k and cluster: rows, sum of the squared norms, sum of the vectors."""
    def each(x: np.ndarray, k: int, near: np.ndarray) -> np.ndarray:
        member = (near[:, None] == np.arange(len(centers[k]))).astype(float)
        return member.T @ np.column_stack([np.ones(len(x)), (x * x).sum(axis=1), x])

    return {k: v.reshape(len(centers[k]), -1) for k, v in _scan(rows, centers, each).items()}


def start_centers(rows: DataFrame, k: int, seed: int, sample: int = 10_000) -> np.ndarray:
    """Up to ``k`` start centres by k-means++ over the ``sample`` vectors of smallest
    seeded hash (a bound on what the driver holds; the same for any partitioning). The
    first ones are also the start of every smaller k. Fewer distinct vectors, fewer centres."""
    some = [r["v"] for r in rows.orderBy(F.xxhash64(F.lit(seed), "v"), "v").limit(sample).collect()]
    if any(v is None for v in some) or not all(np.isfinite(v).all() for v in some):
        raise ValueError("vectors have missing or infinite values")
    x = np.array(some, float)
    if not len(x):
        return x
    draw = np.random.default_rng(seed)
    at = [int(draw.integers(len(x)))]
    far = ((x - x[at[0]]) ** 2).sum(axis=1)
    while len(at) < k and far.any():
        at.append(int(draw.choice(len(x), p=far / far.sum())))
        far = np.minimum(far, ((x - x[at[-1]]) ** 2).sum(axis=1))
    return x[at]


def kmeans_all(rows: DataFrame, centers: Centers, max_iter: int = 20, tol: float = 1e-4) -> Centers:
    """Lloyd's iterations of several k at once over the arrays ``v``: one scan an
    iteration, whatever the number of k. A k whose centres move by at most ``tol`` is
    done; a centre without rows stays. NULL, NaN and infinite values raise."""
    centers = {k: c.copy() for k, c in centers.items()}
    moving = [k for k, c in centers.items() if len(c)]
    for _ in range(max_iter):
        if not moving:
            break
        sums = _cluster_sums(rows, {k: centers[k] for k in moving})
        for k in [*moving]:
            n, total = sums[k][:, :1], sums[k][:, 2:]
            new = np.where(n > 0, total / np.maximum(n, 1), centers[k])
            if (((new - centers[k]) ** 2).sum(axis=1) <= tol * tol).all():
                moving.remove(k)
            centers[k] = new
    return centers


def silhouettes_all(rows: DataFrame, centers: Centers) -> dict[int, float | None]:
    """Mean silhouette (squared Euclidean distance, a lone row counts 0) of several k in
    two scans: mean distances to a cluster follow from its sums. None below two clusters."""
    sums = _cluster_sums(rows, {k: c for k, c in centers.items() if len(c)})
    filled = {k: centers[k] for k, s in sums.items() if (s[:, 0] > 0).sum() > 1}
    if not filled:
        return dict.fromkeys(centers)

    def each(x: np.ndarray, k: int, near: np.ndarray) -> np.ndarray:
        n, square, total = sums[k][:, 0], sums[k][:, 1], sums[k][:, 2:]
        size = np.maximum(n, 1)
        apart = (x * x).sum(axis=1)[:, None] - 2 * x @ (total / size[:, None]).T + square / size
        apart[:, n == 0] = np.inf
        row = np.arange(len(x))
        own = apart[row, near] * n[near] / np.maximum(n[near] - 1, 1)
        apart[row, near] = np.inf
        other = apart.min(axis=1)
        most = np.maximum(own, other)
        s = np.where((n[near] > 1) & (most > 0), (other - own) / np.where(most > 0, most, 1), 0.0)
        return np.array([s.sum(), len(x)])

    got = _scan(rows, filled, each)
    return {k: float(got[k][0] / got[k][1]) if k in got else None for k in centers}


_TASK_ROWS = 200_000


def in_few_tasks(cached: DataFrame) -> DataFrame:
    """Persisted rows in tasks of ``_TASK_ROWS``, at least 8: a fit of hundreds of short
    jobs sends the driver a result for every task (and a size for every pair of tasks
    of a shuffle), so the tasks follow the rows and not the shuffle partitions."""
    return cached.coalesce(max(8, -(-cached.count() // _TASK_ROWS)))


def k_sweep(df: DataFrame, ks: Sequence[int], algo: str = "kmeans", seed: int = 1003,
            features: str = "features") -> DataFrame:
    """Silhouette for each k: ``k, silhouette`` (NULL below two clusters). The input is
    persisted for the repeated scans and released afterwards. ``kmeans`` starts every k
    from the same centres (``start_centers``) and fits all k together; ``bisecting`` is
    one MLlib fit per k, over tasks of bounded number."""
    spark = df.sparkSession
    if algo == "kmeans":
        rows = df.select(vector_to_array(features).alias("v")).persist()
        try:
            start = start_centers(rows, max(ks), seed)
            centers = kmeans_all(rows, {int(k): start[:k] for k in ks if len(start)})
            found = silhouettes_all(rows, centers)
        finally:
            rows.unpersist()
        return spark.createDataFrame([(int(k), found.get(int(k))) for k in ks], "k int, silhouette double")
    cached = df.persist()
    try:
        rows = in_few_tasks(cached)
        out = [(int(k), float(silhouette(bisecting_kmeans(rows, k, seed, features).transform(rows), features)))
               for k in ks]
    finally:
        cached.unpersist()
    return spark.createDataFrame(out, "k int, silhouette double")
