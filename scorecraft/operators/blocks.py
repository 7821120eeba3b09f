"""Rows of a fit as packed blocks, and what is summed over them in one scan.

A block holds some ten thousand rows, each column in the smallest number type that gives
its values back exactly (whole numbers, or hundredths of them), so all scans of a fit read
a few bytes per value. Sums per task reach the driver; rows never do.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shuffle_partitions
from .minimizers import minimize

#: Rows of a block, scores sorted together, rows of a part.
_BLOCK, _SORTED, _PART = 1 << 15, 1 << 20, 400_000


def _coder() -> tuple[Callable, Callable]:
    """``pack(matrix) -> bytes`` and ``unpack(bytes) -> matrix`` (rows x columns), lossless."""
    kinds, scales = ("u1", "i2", "i4", "f8"), (1, 100)

    def pack(x):
        import struct

        import numpy as np

        head, body = [], []
        for c in x.T:
            found = 3, 1, c
            if np.all(np.abs(c) < 2e7):
                for s in scales:
                    k = np.rint(c * s)
                    if np.array_equal(k / s, c) and not np.signbit(c[c == 0]).any():
                        found = 0 if 0 <= k.min() and k.max() < 256 else 1 if abs(k).max() < 32768 else 2, s, k
                        break
            head.append(struct.pack("BB", found[0], found[1]))
            body.append(found[2].astype(kinds[found[0]]).tobytes())
        return struct.pack("<qq", *x.shape) + b"".join(head) + b"".join(body)

    def unpack(blob):
        import struct

        import numpy as np

        n, d = struct.unpack_from("<qq", blob)
        at, x = 16 + 2 * d, np.empty((d, n))
        for j in range(d):
            kind, scale = struct.unpack_from("BB", blob, 16 + 2 * j)
            c = np.frombuffer(blob, kinds[kind], n, at)
            at += c.nbytes
            if scale == 1:
                x[j] = c
            else:
                np.divide(c, scale, out=x[j])
        return x.T

    return pack, unpack


@contextmanager
def packed(df: DataFrame, extra: Sequence[Column] = ()) -> Iterator[DataFrame]:
    """``part, b``: the rows of ``df`` (``label``, vector ``features``) with ``extra`` numbers,
    kept until the block ends. Columns of a block: label, extra, features. A NULL or NaN
    label or extra raises, as a NULL feature does. The order of rows within a part stays."""
    pack, _ = _coder()
    most = _BLOCK

    def blocks(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        part, kept, rows = TaskContext.get().partitionId(), [], 0

        def block(x):
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "b": pa.array([pack(x)], pa.binary())})

        for batch in batches:
            *plain, features = batch.columns
            if not batch.num_rows:
                continue
            y = np.stack([c.to_numpy(zero_copy_only=False).astype("f8") for c in plain])
            if np.isnan(y).any():
                raise ValueError("Labels MUST NOT be Null or NaN")
            x = features.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            kept.append(np.concatenate([y.T, x], axis=1))
            rows += len(x)
            while rows >= most:
                all_ = np.concatenate(kept)
                yield block(all_[:most])
                kept, rows = [all_[most:]], rows - most
        if rows:
            yield block(np.concatenate(kept))

    plain = [F.col("label").cast("double"), *[c.cast("double") for c in extra]]
    kept = df.select(*[c.alias(f"_{i}") for i, c in enumerate(plain)], vector_to_array("features").alias("_x")
                     ).mapInArrow(blocks, "part int, b binary").persist()
    try:
        yield kept
    finally:
        kept.unpersist()


def summed(blocks: DataFrame, of: Callable) -> np.ndarray:
    """Sum over all blocks of ``of(matrix)``, an array of fixed shape: added up block by block
    in the tasks, then in the order of the parts, so that it comes out the same each time."""
    _, unpack = _coder()

    def run(batches):
        import numpy as np
        import pyarrow as pa

        part, total = None, 0.0
        for batch in batches:
            for p, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                got = of(unpack(blob.as_buffer()))
                part, total = p if part is None else part, total + got
        if part is not None:
            total = np.asarray(total)
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "s": pa.array([total.astype("f8").tobytes()], pa.binary()),
                "shape": pa.array([list(total.shape)], pa.list_(pa.int32()))})

    rows = sorted(blocks.mapInArrow(run, "part int, s binary, shape array<int>").collect())
    return sum((np.frombuffer(r["s"]).reshape(r["shape"]) for r in rows), 0.0)


# ------------------------------------------------------- many logistic fits at once
def logistic_fits(blocks: DataFrame, first: int, uses: Sequence[Callable], grid: Sequence[tuple[float, float]],
                  max_iter: int, tol: float = 1e-6) -> np.ndarray:
    """Coefficients and intercept of binomial fits, ``len(uses) x len(grid)`` of them, in
    one scan per step of the slowest. Features begin at column ``first``. ``uses``: the rows
    that fits train on, as a mask of a block. ``grid``: strength and share of the L1 penalty. They are fitted as MLlib's
    ``LogisticRegression`` does: features scaled by their deviation (and centred for the
    fit), penalties on scaled coefficients, intercept free."""
    def moments(b):
        import numpy as np

        y, x = b[:, 0], b[:, first:]
        if not np.isin(y, (0.0, 1.0)).all():
            raise ValueError("labels of a binomial fit are 0 and 1")
        return np.stack([u(b) for u in uses]).astype("f8") @ np.column_stack([np.ones(len(x)), y, x])

    got = summed(blocks, moments)
    if np.ndim(got) == 0:
        raise ValueError("no rows to fit")
    n, ones, total = got[:, :1], got[:, 1], got[:, 2:]
    if not (n > 0).all():
        raise ValueError("a fit has no rows")
    mean = total / n

    def spread(b):  # about the mean: squares of large values would lose the small differences
        import numpy as np

        x = b[:, first:]
        return np.stack([use(b).astype("f8") @ (x - m) ** 2 for use, m in zip(uses, mean)])

    sd = np.sqrt(summed(blocks, spread) / np.maximum(n - 1, 1))
    per = np.divide(1.0, sd, out=np.zeros_like(sd), where=sd > 0)
    centre = mean * per
    share = ones / n[:, 0]
    d = mean.shape[1]
    fits, asked, done = {}, {}, np.zeros((len(uses), len(grid), d + 1))
    for s in range(len(uses)):
        for g, (strength, mix) in enumerate(grid):
            if share[s] in (0.0, 1.0):  # one class only: the intercept says it all
                done[s, g, d] = np.inf if share[s] else -np.inf
                continue
            x0 = np.zeros(d + 1)
            x0[d] = np.log(share[s] / (1 - share[s]))
            l1 = np.append(np.full(d, strength * mix), 0.0) if strength and mix else None
            fits[s, g] = minimize(x0, max_iter, tol, l1=l1)
            asked[s, g] = next(fits[s, g])
    while asked:
        keys = sorted(asked)
        side = [s for s, _ in keys]
        # in terms of the plain features: margin = x . w + c
        w = np.stack([asked[k][:d] * per[k[0]] for k in keys], axis=1)
        c = np.array([asked[k][d] - asked[k][:d] @ centre[k[0]] for k in keys])

        w = np.ascontiguousarray(w.T)

        def step(b):  # a thousand rows at a time, which the processor's cache holds
            import numpy as np

            total = np.zeros((len(w), w.shape[1] + 2))
            masks = np.stack([u(b) for u in uses]).astype("f8")[side]
            for at in range(0, len(b), 1024):
                x, y, use = b[at:at + 1024, first:].T, b[at:at + 1024, 0], masks[:, at:at + 1024]
                margin = w @ x + c[:, None]
                total[:, 0] += np.einsum("ij,ij->i", np.maximum(margin, 0), use) - np.einsum("ij,ij,j->i", margin, use, y)
                off = np.exp(-np.abs(margin))
                one = off + 1.0
                np.copyto(off, 1.0, where=margin >= 0)
                off /= one
                off -= y
                off *= use
                one = (one - 1.0) * use + 1.0
                for z in range(0, one.shape[1], 256):  # logs of products, at most 2^256
                    total[:, 0] += np.log(np.multiply.reduce(one[:, z:z + 256], axis=1))
                total[:, 1] += off.sum(1)
                total[:, 2:] += off @ x.T
            return total.T

        out = summed(blocks, step)
        for i, key in enumerate(keys):
            s, (strength, mix) = key[0], grid[key[1]]
            l2, x = strength * (1 - mix), asked[key]
            loss = out[0, i] / n[s, 0] + 0.5 * l2 * (x[:d] @ x[:d])
            grad = (out[2:, i] * per[s] - centre[s] * out[1, i]) / n[s, 0] + l2 * x[:d]
            try:
                asked[key] = fits[key].send((loss, np.append(grad, out[1, i] / n[s, 0])))
            except StopIteration as end:
                x = end.value
                done[key][:d] = x[:d] * per[s]
                done[key][d] = x[d] - x[:d] @ centre[s]
                del asked[key], fits[key]
    return done


# ------------------------------------------------------------------- exact areas
def areas_under_roc(blocks: DataFrame, first: int, models: np.ndarray, n_areas: int, use: Callable,
                    chance: bool = False) -> np.ndarray:
    """Area under the ROC curve of each of the ``n_areas`` columns of ``use(block)`` (rows x
    columns: which model scores the row for that area, or -1), over all distinct scores; NaN
    with one class only. Features begin at column ``first``. ``models``: rows of coefficients and intercept; ``chance``: scores are probabilities.
    Scores are sorted inside ranges of an area's scores, each cut in one task."""
    _, unpack = _coder()
    d = models.shape[1] - 1

    def scores(b):
        import numpy as np

        y, x = b[:, 0], b[:, first:]
        m = np.zeros((len(models), len(x)))
        for j in range(d):  # term by term, so that equal rows score the same wherever they stand
            m += models[:, j, None] * x[:, j]
        m += models[:, d, None]
        if chance:
            with np.errstate(over="ignore"):
                m = 1 / (1 + np.exp(-m))
        which = use(b)
        for a in range(which.shape[1]):
            sure = which[:, a] >= 0
            yield a, m[which[sure, a], np.flatnonzero(sure)], y[sure] > 0

    def some(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for blob in batch.column(1)[:1]:
                for a, s, _ in scores(unpack(blob.as_buffer())):
                    yield pa.RecordBatch.from_pydict({"a": pa.array([a], pa.int32()),
                                                      "s": pa.array([np.sort(s)[::max(1, len(s) // 64)].tobytes()], pa.binary())})
            return  # where the ranges end is of no consequence, so a few blocks will do

    spark = blocks.sparkSession
    parts = blocks.rdd.getNumPartitions()
    drawn: dict[int, list] = {}
    for r in blocks.mapInArrow(some, "a int, s binary").collect():
        drawn.setdefault(r["a"], []).append(np.frombuffer(r["s"]))
    ends_at = np.linspace(0, 1, max(1, -(-parts * _PART // _SORTED)) + 1)[1:-1]
    cuts = {a: np.unique(np.quantile(np.concatenate(s), ends_at, method="lower"))
            for a, s in drawn.items() if sum(map(len, s))}

    def runs(s, pos, neg):  # one entry per distinct score
        import numpy as np

        order = np.argsort(s, kind="stable")
        s, pos, neg = s[order], pos[order], neg[order]
        at = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
        return s[at], np.add.reduceat(pos, at), np.add.reduceat(neg, at)

    def send(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for blob in batch.column(1):
                out = {"a": [], "range": [], "s": [], "pos": [], "neg": []}
                for a, s, y in scores(unpack(blob.as_buffer())):
                    if not len(s):
                        continue
                    s, pos, neg = runs(s, y.astype("i8"), (~y).astype("i8"))
                    small = "u1" if max(pos.max(), neg.max()) < 256 else "i8"
                    ends = np.searchsorted(s, cuts.get(a, []), side="right")
                    for t, v in enumerate(zip(*(np.split(z, ends) for z in (s, pos.astype(small), neg.astype(small))))):
                        if len(v[0]):
                            out["a"].append(a), out["range"].append(t)
                            for name, z in zip(("s", "pos", "neg"), v):
                                out[name].append(z.tobytes())
                yield pa.RecordBatch.from_pydict({
                    "a": pa.array(out["a"], pa.int32()), "range": pa.array(out["range"], pa.int32()),
                    **{c: pa.array(out[c], pa.binary()) for c in ("s", "pos", "neg")}})

    def area(table):
        import numpy as np
        import pyarrow as pa

        s = [np.frombuffer(v.as_buffer()) for v in table.column("s")]
        pos, neg = ([np.frombuffer(v.as_buffer(), "u1" if len(v.as_buffer()) == len(z) else "i8").astype("i8")
                     for v, z in zip(table.column(c), s)] for c in ("pos", "neg"))
        _, pos, neg = runs(np.concatenate(s), np.concatenate(pos), np.concatenate(neg))
        over = np.cumsum(pos[::-1])[::-1] - pos / 2.0  # positives above, ties half
        return pa.table({"a": table.column("a").slice(0, 1), "range": table.column("range").slice(0, 1),
                         "area": pa.array([float(neg @ over)]), "p": pa.array([int(pos.sum())], pa.int64()),
                         "n": pa.array([int(neg.sum())], pa.int64())})

    n = max(shuffle_partitions(spark), parts)
    rows = (blocks.mapInArrow(send, "a int, range int, s binary, pos binary, neg binary")
            .repartition(n, "a", "range").groupBy("a", "range")
            .applyInArrow(area, "a int, range int, area double, p long, n long").collect())
    found: dict[int, list] = {}
    for r in sorted(rows, reverse=True):
        found.setdefault(r["a"], []).append(r)
    out = np.full(n_areas, np.nan)
    for a, parts_ in found.items():
        p, n, sum_ = 0, 0, 0.0
        for r in parts_:
            sum_, p, n = sum_ + r["area"] + r["n"] * float(p), p + r["p"], n + r["n"]
        if p and n:
            out[a] = sum_ / (float(p) * float(n))
    return out
