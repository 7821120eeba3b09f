"""Correlation of ranks (Spearman) without moving every value by itself.

The rows are written once in chunks, columns packed as arrays. Cut values, taken at
quantiles of a sample, only divide the work: every row is counted against them, so the
rank of a value that equals a cut (all values of a column with few, and any common one)
follows from the counts alone. The values between two cuts are sent there as arrays,
ranked exactly, and their ranks sent back to the chunk. The products are summed in the
chunks; the driver gets counts per cut and d x d sums.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path, shuffle_partitions

#: Rows of a chunk, cut values of a column, rows ranked together and rows of a task.
_CHUNK, _CUTS, _GROUP, _TASK = 1 << 18, 1024, 1 << 20, 400_000


def _chunks(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``id, n, x``: up to ``_CHUNK`` rows, ``x`` their values column by column. A value
    that is NULL or NaN raises, so that no row is left out unsaid."""
    most, names = _CHUNK, list(cols)

    def pack(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        made = TaskContext.get().partitionId() << 32
        kept, rows = [], 0

        def chunk(x):
            return pa.RecordBatch.from_pydict({"id": pa.array([made], pa.int64()), "n": pa.array([x.shape[1]], pa.int64()),
                                               "x": pa.array([x.tobytes()], pa.binary())})

        for batch in batches:
            for at in range(0, batch.num_rows, most):
                piece = batch.slice(at, most)
                x = np.stack([c.to_numpy(zero_copy_only=False) for c in piece.columns]).astype("f8")
                if np.isnan(x).any():
                    raise ValueError(f"NULL or NaN in {', '.join(names)}: impute it first")
                if rows + x.shape[1] > most:
                    yield chunk(np.concatenate(kept, axis=1))
                    made, kept, rows = made + 1, [], 0
                kept.append(x)
                rows += x.shape[1]
        if rows:
            yield chunk(np.concatenate(kept, axis=1))

    path = scratch_path(df.sparkSession, "rank-chunks")
    df.select(*[F.col(c).cast("double") for c in names]).mapInArrow(pack, "id long, n long, x binary").write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _counts(chunks: DataFrame, cuts: list[np.ndarray]) -> list[np.ndarray]:
    """Rows of each column below, at and between its cuts: 2 k + 1 numbers for k cuts."""
    d = len(cuts)

    def count(batches):
        import numpy as np
        import pyarrow as pa

        total = [np.zeros(2 * len(c) + 1, "i8") for c in cuts]
        for batch in batches:
            for blob in batch.column(0):
                for j, x in enumerate(np.frombuffer(blob.as_buffer(), "f8").reshape(d, -1)):
                    at = np.searchsorted(cuts[j], x)
                    cell = 2 * at + (cuts[j][np.minimum(at, len(cuts[j]) - 1)] == x)
                    total[j] += np.bincount(cell, minlength=len(total[j]))
        yield pa.RecordBatch.from_pydict({"c": pa.array([np.concatenate(total).tobytes()], pa.binary())})

    def add(batches):
        import numpy as np
        import pyarrow as pa

        total = 0
        for batch in batches:
            for blob in batch.column(0):
                total = total + np.frombuffer(blob.as_buffer(), "i8")
        if not np.isscalar(total):
            yield pa.RecordBatch.from_pydict({"c": pa.array([total.tobytes()], pa.binary())})

    per_task = chunks.select("x").mapInArrow(count, "c binary")
    few = per_task.repartition(8).mapInArrow(add, "c binary").collect()
    total = sum(np.frombuffer(r["c"], "i8") for r in few)
    return np.split(total, np.cumsum([2 * len(c) + 1 for c in cuts])[:-1])


def spearman_matrix(df: DataFrame, cols: Sequence[str]) -> np.ndarray | None:
    """Correlation of the mid-ranks of ``cols``, NaN where a column has one value only;
    None for fewer than two rows."""
    d, spark = len(cols), df.sparkSession
    chunks = _chunks(df, cols)
    n, packs = chunks.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("n")).first()
    if n < 2:
        return None
    parts = max(shuffle_partitions(spark), -(-n // _TASK))
    step = max(1, n // (200 * _CUTS))

    def some(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            x = [np.frombuffer(b.as_buffer(), "f8").reshape(d, -1)[:, ::step].tobytes() for b in batch.column(0)]
            yield pa.RecordBatch.from_pydict({"s": pa.array(x, pa.binary())})

    sample = np.concatenate([np.frombuffer(r["s"], "f8").reshape(d, -1) for r in
                             chunks.select("x").mapInArrow(some, "s binary").collect()], axis=1)
    places = np.unique(np.linspace(0, sample.shape[1] - 1, _CUTS).astype(int))
    cuts = [np.unique(np.sort(s)[places]) for s in sample]
    cuts = [np.unique(s) if len(np.unique(s)) <= _CUTS else c for s, c in zip(sample, cuts)]
    counts = _counts(chunks, cuts)
    before = [np.concatenate([[0], np.cumsum(c)[:-1]]) for c in counts]
    # rank of a value equal to a cut; rows below each interval; the group that ranks it
    at_cut = [b[1::2] + (c[1::2] + 1) / 2 for b, c in zip(before, counts)]
    below = [b[::2] for b in before]
    group = [np.cumsum(c[::2]) // _GROUP for c in counts]

    def inside(x, j):  # interval of each value and whether it is a cut
        import numpy as np

        at = np.searchsorted(cuts[j], x)
        return at, cuts[j][np.minimum(at, len(cuts[j]) - 1)] == x

    def send(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for i, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                out = {"col": [], "part": [], "id": [], "v": []}
                for j, x in enumerate(np.frombuffer(blob.as_buffer(), "f8").reshape(d, -1)):
                    at, known = inside(x, j)
                    x, to = x[~known], group[j][at[~known]]
                    x = x[np.argsort(to, kind="stable")]
                    which, ends = np.unique(to, return_counts=True)
                    for t, v in zip(which, np.split(x, np.cumsum(ends)[:-1])):
                        out["col"].append(j), out["part"].append(int(t)), out["id"].append(i), out["v"].append(v.tobytes())
                yield pa.RecordBatch.from_pydict({
                    "col": pa.array(out["col"], pa.int32()), "part": pa.array(out["part"], pa.int64()),
                    "id": pa.array(out["id"], pa.int64()), "v": pa.array(out["v"], pa.binary())})

    def rank(table):
        import numpy as np
        import pyarrow as pa

        j = table.column("col")[0].as_py()
        pieces = [np.frombuffer(v.as_buffer(), "f8") for v in table.column("v")]
        x = np.concatenate(pieces)
        order = np.argsort(x)
        s = x[order]
        new = np.concatenate([[True], s[1:] != s[:-1]])
        first = np.flatnonzero(new)
        run = np.cumsum(new) - 1
        at = np.searchsorted(cuts[j], s)
        begins = np.searchsorted(at, at)  # where its interval begins among these values
        ranks = np.empty(len(x))
        ranks[order] = below[j][at] + (first[run] - begins) + (np.diff(np.append(first, len(s)))[run] + 1) / 2
        out = [r.tobytes() for r in np.split(ranks, np.cumsum([len(p) for p in pieces])[:-1])]
        return pa.table({"id": table.column("id"), "col": table.column("col"), "part": table.column("part"),
                         "r": pa.array(out, pa.binary())})

    def products(left, right):
        import numpy as np
        import pyarrow as pa

        back = {}
        for j, _, i in sorted((j, t, i) for i, (j, t) in enumerate(
                zip(right.column("col").to_pylist(), right.column("part").to_pylist()))):
            back.setdefault(j, []).append(np.frombuffer(right.column("r")[i].as_buffer(), "f8"))
        z = np.frombuffer(left.column("x")[0].as_buffer(), "f8").reshape(d, -1).copy()
        for j, x in enumerate(z):
            at, known = inside(x, j)
            x[known] = at_cut[j][at[known]]
            rest = np.flatnonzero(~known)
            if len(rest):
                x[rest[np.argsort(group[j][at[rest]], kind="stable")]] = np.concatenate(back[j])
        z = (2 * z - (n + 1)) / n
        return pa.table({"id": left.column("id"), "g": pa.array([(z @ z.T).tobytes()], pa.binary())})

    ranked = (chunks.select("id", "x").mapInArrow(send, "col int, part long, id long, v binary")
              .repartition(parts, "col", "part").groupBy("col", "part")
              .applyInArrow(rank, "id long, col int, part long, r binary"))
    sums = (chunks.select("id", "x").repartition(parts, "id").groupBy("id")
            .cogroup(ranked.repartition(parts, "id").groupBy("id"))
            .applyInArrow(products, "id long, g binary").collect())
    if len(sums) != packs:
        raise RuntimeError("a chunk of rows was lost")
    cov = sum(np.frombuffer(r["g"], "f8").reshape(d, d) for r in sorted(sums))
    sd = np.sqrt(np.diag(cov))
    with np.errstate(invalid="ignore", divide="ignore"):
        corr = np.where(np.outer(sd, sd) > 0, cov / np.outer(sd, sd), np.nan)
    np.fill_diagonal(corr, 1.0)
    return corr
