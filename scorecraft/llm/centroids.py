"""Lloyd's clustering in exact integers, with n-simplex bounds as a filter.

Method: a few vectors serve as pivots. They span a simplex; from its squared
distances to them a vector gets the coordinates of an apex over that simplex: its
foot inside the span of the pivots, and its height over it. The apexes are worked out
once and kept beside the vectors. Between two apexes, the distance with both heights
on the same side is a lower bound of the true distance, and that with the heights on
opposite sides an upper bound. A centroid whose lower bound is above the smallest
upper bound cannot be nearest; the others are compared in whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare, written

PIVOTS = 16
#: Share of the largest squared distance that rounding of the bounds may reach.
SLACK = 1e-6
#: Whole components beyond this have squared distances that no long holds.
LARGEST = 180_000_000


class Simplex:
    """Base simplex of the pivots (rows), those left out that lie in the span of the
    ones before, up to rounding."""

    def __init__(self, pivots: np.ndarray) -> None:
        self.pivots = np.zeros((0, pivots.shape[1] if pivots.ndim == 2 else 0))
        self.base = np.zeros((0, 0))
        for p in np.asarray(pivots, np.float64):
            if not len(self.pivots):
                self.pivots, self.base = p[None], np.zeros((1, 0))
                continue
            apex = self.apexes(p[None])[0]
            if apex[-1] > 1e-3 * max(np.abs(apex).max(), 1.0):
                self.base = np.vstack([np.hstack([self.base, np.zeros((len(self.base), 1))]), apex])
                self.pivots = np.vstack([self.pivots, p])

    def apexes(self, vectors: np.ndarray) -> np.ndarray:
        """Apex of each row: its foot's coordinates, then its height."""
        v = np.asarray(vectors, np.float64)
        squared = np.stack([((v - p) ** 2).sum(1) for p in self.pivots], 1)
        foot = np.zeros((len(v), len(self.pivots) - 1))
        for k in range(1, len(self.pivots)):
            b = self.base[k]
            half = (squared[:, 0] - squared[:, k] + (b ** 2).sum()) / 2
            foot[:, k - 1] = (half - foot[:, :k - 1] @ b[:k - 1]) / b[k - 1]
        height = np.sqrt(np.maximum(squared[:, 0] - (foot ** 2).sum(1), 0))
        return np.hstack([foot, height[:, None]])


def _candidates(apex: np.ndarray, of_centroids: np.ndarray) -> np.ndarray:
    """Which centroids (columns) may be nearest to which vectors (rows)."""
    a, c = apex[:, :-1], of_centroids[:, :-1]
    foot = (a ** 2).sum(1)[:, None] + (c ** 2).sum(1) - 2 * (a @ c.T)
    h, g = apex[:, -1:], of_centroids[:, -1]
    lower, upper = foot + (h - g) ** 2, foot + (h + g) ** 2
    slack = SLACK * (1 + (apex ** 2).sum(1)[:, None] + (of_centroids ** 2).sum(1).max(initial=0))
    return lower <= upper.min(1, keepdims=True) + slack


def _nearest(v: np.ndarray, apex: np.ndarray, centroids: np.ndarray,
             of_centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (ties: the smaller) and its squared distance."""
    may = _candidates(apex, of_centroids)
    best = np.full(len(v), np.iinfo(np.int64).max)
    cluster = np.full(len(v), -1, np.int32)
    for k, c in enumerate(centroids):
        rows = np.flatnonzero(may[:, k])
        d = v[rows] - c
        d = np.einsum("ij,ij->i", d, d)
        less = d < best[rows]
        best[rows[less]], cluster[rows[less]] = d[less], k
    return cluster, best


def _matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, width)


def whole_vectors(df: DataFrame, col: str, dims: int) -> DataFrame:
    """``df`` with ``v``: floor(256 x) of each component, for the rows whose vector
    has ``dims`` components, none null or not finite."""
    x = F.col(f"`{col}`").cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))

    def whole(c: Column) -> Column:
        big = F.floor(c * 256)
        return F.when(F.abs(c) * 256 < LARGEST, big).otherwise(F.raise_error(
            F.lit(f"a component beyond {LARGEST} / 256 has no distance in 64 bits")).cast("long")).cast("int")

    return df.filter(x.isNotNull() & (F.size(x) == dims) & ~F.coalesce(bad, F.lit(False))).select(
        "*", F.transform(x, whole).alias("v"))


def cluster_vectors(df: DataFrame, id_col: str = "vec_id", col: str = "embedding", dims: int = 64,
                    k: int = 40, rounds: int = 5, pivots: int = PIVOTS, salt: str = "2:") -> DataFrame:
    """``id_col``, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia``
    and ``centroid`` (whole components) of every usable vector (see
    ``whole_vectors``; the others have no row).

    The ``k`` usable vectors whose salted id has the smallest SHA-256 start as
    centroids (ties: by components; a null id counts as an empty one). After each of
    ``rounds`` assignments a centroid becomes the floor of its vectors' mean, one
    without vectors stays. Fewer vectors than ``k`` give fewer centroids, none give
    no rows. Rows equal in id are vectors of their own. Driver and tasks hold ``k``
    centroids and ``pivots`` pivots, never more."""
    spark = df.sparkSession
    prepare(spark)
    usable = whole_vectors(df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{col}`").alias("x")), "x", dims)
    name = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = usable.select(name.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    centroids = np.array([r.v for r in first], np.int64).reshape(-1, dims)
    simplex = Simplex(centroids[:pivots])
    width = max(len(simplex.pivots), 1)

    def with_apexes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                apex = simplex.apexes(_matrix(batch.column("v"), dims, np.float64))
                ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * width)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(
                    ends, pa.array(apex.ravel()))], ["id", "v", "apex"])

    kind = usable.schema["id"].dataType.simpleString()
    cached = written(usable.select("id", "v").mapInArrow(
        with_apexes, f"id {kind}, v array<int>, apex array<double>"), "apexes")

    def assigned(batch: pa.RecordBatch, now: np.ndarray, of_now: np.ndarray):
        v = _matrix(batch.column("v"), dims, np.int64)
        return v, *_nearest(v, _matrix(batch.column("apex"), width, np.float64), now, of_now)

    for _ in range(rounds if len(centroids) else 0):
        now, of_now = centroids, simplex.apexes(centroids)

        def sums(batches: Iterator[pa.RecordBatch], now=now, of_now=of_now) -> Iterator[pa.RecordBatch]:
            total, n = np.zeros((len(now), dims + 1), np.int64), 0
            for batch in batches:
                if batch.num_rows:
                    v, cluster, _ = assigned(batch, now, of_now)
                    order = np.argsort(cluster, kind="stable")
                    ks, at = np.unique(cluster[order], return_index=True)
                    total[ks, :dims] += np.add.reduceat(v[order], at, axis=0)
                    total[:, dims] += np.bincount(cluster, minlength=len(now))
                    n += batch.num_rows
            if n:
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(np.arange(len(now), dtype=np.int32), dims + 1)),
                    pa.array(np.tile(np.arange(dims + 1, dtype=np.int32), len(now))),
                    pa.array(total.ravel())], ["cluster", "place", "total"])

        found = (cached.select("v", "apex").mapInArrow(sums, "cluster int, place int, total long")
                 .groupBy("cluster", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect())
        table = {(r.cluster, r.place): int(r.total) for r in found}
        centroids = np.array([
            [table[c, j] // table[c, dims] for j in range(dims)] if table.get((c, dims)) else list(old)
            for c, old in enumerate(now)], np.int64).reshape(-1, dims)

    last, of_last = centroids, simplex.apexes(centroids) if len(centroids) else centroids

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                _, cluster, distance = assigned(batch, last, of_last)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(cluster), pa.array(distance)], ["id", "cluster", "distance"])

    done = written(cached.mapInArrow(judged, f"id {kind}, cluster int, distance long"), "assigned")
    per = done.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"))
    whole = per.agg(F.sum("s").cast("long").alias("inertia"))
    shapes = spark.createDataFrame([(c, [int(x) for x in row]) for c, row in enumerate(last)],
                                   "cluster int, centroid array<long>")
    # One row per centroid.
    totals = per.join(shapes, "cluster").crossJoin(whole).select(
        "cluster", F.col("s").cast("long").alias("cluster_inertia"), "inertia", "centroid")
    return done.join(F.broadcast(totals), "cluster").select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def digest(centroid: str) -> Column:
    """SHA-256 of the components as decimal integers joined by commas."""
    return F.sha2(F.array_join(F.transform(centroid, lambda x: x.cast("string")), ","), 256)
