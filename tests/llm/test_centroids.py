"""Clustering in whole numbers against plain Python, and the bounds that filter."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from scorecraft.llm import centroids as C
from scorecraft.llm.queries import digest

SCHEMA = "vec_id long, embedding array<float>, v int, cluster int"


def brute(rows, dims, k=40, rounds=5):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in e]) for i, e in rows
            if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e)]
    if not kept:
        return Counter()
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    now = [list(v) for _, v in first[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), i) for i, c in enumerate(now))

    for _ in range(rounds):
        where = [nearest(v)[1] for _, v in kept]
        new = []
        for i, c in enumerate(now):
            own = [v for (_, v), w in zip(kept, where, strict=True) if w == i]
            new.append([sum(x) // len(own) for x in zip(*own, strict=True)] if own else c)
        now = new
    done = [nearest(v) for _, v in kept]
    per = Counter()
    for d, i in done:
        per[i] += d
    return Counter((i, c, d, per[c], sum(per.values()), hashlib.sha256(",".join(map(str, now[c])).encode()).hexdigest())
                   for (i, _), (d, c) in zip(kept, done, strict=True))


def vectors(dims, seed=2):
    rnd = random.Random(seed)
    middles = [[rnd.gauss(0, 1) for _ in range(dims)] for _ in range(5)]
    rows = [(i, [m + rnd.gauss(0, 0.3) for m in rnd.choice(middles)]) for i in range(150)]
    rows += [(i, rows[3][1]) for i in (200, 201, 202)] + [(3, rows[3][1]), (None, rows[5][1]), (None, [0.0] * dims)]
    rows += [(300, None), (301, []), (302, [1.0] * (dims - 1)), (303, [None] + [1.0] * (dims - 1)),
             (304, [math.nan] * dims), (305, [math.inf] + [0.0] * (dims - 1)), (306, [1000.0] * dims), (307, [-1e-9] * dims)]
    return rows


def run(spark, rows, dims, **how):
    frame = spark.createDataFrame([(i, e, 1, 2) for i, e in rows], SCHEMA).repartition(3)
    got = C.cluster_vectors(frame, dims=dims, **how)
    return Counter(tuple(r) for r in got.withColumn("centroid", digest("centroid")).collect())


@pytest.mark.parametrize("dims,k,pivots", [(8, 12, 16), (8, 40, 3), (3, 5, 16), (64, 40, 16), (4, 6, 1)])
def test_equals_brute_force(spark, dims, k, pivots):
    rows = vectors(dims)
    assert run(spark, rows, dims, k=k, pivots=pivots) == brute(rows, dims, k)


def test_ties_repeats_and_few_vectors(spark):
    rows = [(i, [float(i % 3), 0.0]) for i in range(30)]
    assert run(spark, rows, 2, k=40) == brute(rows, 2, 40)
    assert run(spark, rows[:1], 2, k=4) == brute(rows[:1], 2, 4)
    assert run(spark, [(1, None), (2, [1.0])], 2) == Counter()
    assert run(spark, [], 2) == Counter()


def test_component_too_large(spark):
    with pytest.raises(Exception, match="64 bits"):
        run(spark, [(1, [1e30, 0.0])], 2)


def test_bounds_enclose_the_distance_and_filter():
    rng = np.random.default_rng(4)
    middles = rng.normal(0, 40, (30, 64))
    v = np.floor(middles[rng.integers(0, 30, 500)] + rng.normal(0, 8, (500, 64)))
    c = np.floor(middles)
    simplex = C.Simplex(c[:16])
    a, b = simplex.apexes(v), simplex.apexes(c)
    true = ((v[:, None] - c) ** 2).sum(2)
    foot = ((a[:, None, :-1] - b[:, :-1]) ** 2).sum(2)
    assert (foot + (a[:, -1:] - b[:, -1]) ** 2 <= true + 1e-3).all()
    assert (foot + (a[:, -1:] + b[:, -1]) ** 2 >= true - 1e-3).all()
    may = C._candidates(a, b)
    assert may[np.arange(500), true.argmin(1)].all() and may.mean() < 0.3
