"""Sampling and splits.

``sample``/``sampleBy`` are Spark's seeded draws and depend on the layout of the
input; ``exact_sample`` gives the same rows for every layout and sizes that are
exact. The splits draw from a hash of the row's own values, so the same rows get
the same part however they are partitioned, in one pass without a shuffle; only
``stratified_split``, which is exact per stratum, orders the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path


def sample_fraction(df: DataFrame, fraction: float, seed: int = 2023) -> DataFrame:
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def sample_by_stratum(df: DataFrame, col: str, fractions: Mapping, seed: int = 2023) -> DataFrame:
    """Per-stratum Bernoulli fractions; strata not listed get 0."""
    return df.sampleBy(col, fractions=dict(fractions), seed=seed)


#: Values of the draw, and cells of equal width that its counts are kept in.
DRAWS, CELLS = 1 << 32, 1 << 16


def exact_sample(df: DataFrame, size: float | Mapping, key: Sequence[str], stratum: str | None = None,
                 seed: int = 2023, draw: Column | None = None, draws: int = DRAWS) -> DataFrame:
    """The rows of each stratum (of the table without one) with the smallest draws.

    ``size`` is a number of rows (int) or a share of the stratum's rows (float,
    rounded), or a mapping from stratum to either; strata not listed get no rows. The
    draw is a seeded hash of the ``key`` columns, or a long column ``draw`` from 0 to
    ``draws`` - 1; equal draws go by the key, so any partitioning of the input gives
    the same rows. Rows equal in all key columns are told apart by nothing: how many of
    them are taken is exact, which is not. A NULL stratum is a stratum; a NULL draw is 0.

    State that merges over parts of the input: rows per stratum and cell of the draw
    (``CELLS`` at most for each stratum). It names the cell in which the last row lies;
    rows of earlier cells are taken as they stand, and only that cell's rows, one in
    ``CELLS``, are ordered.
    """
    from .ordering import grouped_row_number

    spark = df.sparkSession
    u = draw if draw is not None else F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(draws))
    marked = df.select("*", (F.col(stratum) if stratum else F.lit(0)).alias("_stratum"),
                       F.coalesce(u.cast("long"), F.lit(0)).alias("_draw")).withColumn(
        "_cell", F.expr(f"_draw * {CELLS} div {int(draws)}"))
    w = Window.partitionBy("_stratum")
    cells = marked.groupBy("_stratum", "_cell").agg(F.count("*").alias("n")).select(
        "*", F.sum("n").over(w.orderBy("_cell")).alias("upto"), F.sum("n").over(w).alias("rows"))

    def rows_for(x: float) -> Column:
        return F.lit(x) if isinstance(x, int) else F.round(F.col("rows") * F.lit(float(x))).cast("long")

    if isinstance(size, Mapping):
        wanted = F.lit(0)
        for value, x in size.items():
            wanted = F.when(F.col("_stratum").eqNullSafe(F.lit(value)), rows_for(x)).otherwise(wanted)
    else:
        wanted = rows_for(size)
    last = cells.withColumn("wanted", F.least(wanted, F.col("rows"))).filter(
        "wanted > 0 AND upto >= wanted AND upto - n < wanted").select(
        F.col("_stratum").alias("_of"), F.col("_cell").alias("_last"),
        (F.col("wanted") - F.col("upto") + F.col("n")).alias("_left"))
    path = scratch_path(spark, "sample-cells")  # a row per stratum: joined by its true size
    last.write.parquet(path)
    found = marked.join(spark.read.parquet(path), F.col("_stratum").eqNullSafe(F.col("_of")))
    edge = grouped_row_number(found.filter("_cell = _last"), ["_stratum"], ["_draw", *key], out="_pos")
    return found.filter("_cell < _last").select(*df.columns).unionByName(
        edge.filter("_pos <= _left").select(*df.columns))


def labelled_split(df: DataFrame, weights: Sequence[float], names: Sequence[str],
                   seed: int = 12345, out: str = "split",
                   key: Sequence[str] | None = None) -> DataFrame:
    """Random split with each row tagged by its part, in one pass. The draw is a
    seeded hash of the row (or of its ``key`` columns), so every row is in
    exactly one part and repeated runs agree."""
    cols = [F.col(f"`{c}`") for c in key or df.columns]
    u = F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(1_000_000)) / F.lit(1_000_000.0)
    total, acc, edges = float(sum(weights)), 0.0, []
    for w in weights[:-1]:
        acc += w / total
        edges.append(acc)
    return df.withColumn(out, _interval(u, edges, names))


def stratified_split(df: DataFrame, strata: str, weights: Sequence[float], names: Sequence[str],
                     seed: int = 12345, out: str = "split",
                     keep: Sequence[str] | None = None) -> DataFrame:
    """Exact stratified split for any number of strata: inside each stratum the
    rows are put in a seeded random order and cut at round(cumulative weight x
    stratum size), so every stratum keeps the weights. The order is one global
    range-partitioned numbering on (stratum, draw), so a stratum holding most
    rows is spread over many tasks; positions and stratum sizes come from the
    (partition, stratum) offsets table. A NULL stratum is a stratum. ``keep``
    names the columns needed afterwards (all by default); only they and the
    stratum are materialised."""
    from .ordering import grouped_row_number

    total = float(sum(weights))
    cum, acc = [], 0.0
    for w in weights[:-1]:
        acc += w / total
        cum.append(acc)
    drawn = df.withColumn("_u", F.rand(seed))
    j = grouped_row_number(drawn, [strata], [F.col("_u")], out="_pos", size="_size", keep=keep)
    pos = F.col("_pos")
    expr = None
    for edge, name in zip(cum, names):
        cond = pos <= F.round(F.col("_size") * F.lit(edge))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    label = expr.otherwise(F.lit(names[-1])) if expr is not None else F.lit(names[-1])
    return j.withColumn(out, label).drop("_u", "_pos", "_size")


def _interval(u: Column, edges: Sequence[float], names: Sequence[str]) -> Column:
    expr = None
    for edge, name in zip(edges, names):
        expr = F.when(u < edge, F.lit(name)) if expr is None else expr.when(u < edge, F.lit(name))
    return expr.otherwise(F.lit(names[-1])) if expr is not None else F.lit(names[-1])


def hash_split(key: Column, percents: Sequence[int], names: Sequence[str],
               multiplier: int | None = None) -> Column:
    """Reproducible split label of a key against cumulative integer percentages
    (e.g. [70, 30]): by a hash of the key, or with ``multiplier`` by the plain
    arithmetic ``((key % 100) * multiplier) % 100``, which any SQL engine can
    repeat. A NULL key has no part (NULL)."""
    bucket = (F.pmod(F.xxhash64(key), F.lit(100)) if multiplier is None
              else F.pmod(key.cast("long") % 100 * F.lit(multiplier), F.lit(100)))
    edges = [sum(percents[:i + 1]) for i in range(len(percents) - 1)]
    return F.when(key.isNotNull(), _interval(bucket, edges, names))
