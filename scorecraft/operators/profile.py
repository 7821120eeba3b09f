"""Table profiling: describe, variance, quantiles, cardinality, missing values,
equal-width histograms. Each profile is ONE aggregation over the table (all
columns at once) reshaped to a long ``(column, …)`` table, instead of one job
per column.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import is_missing
from ..session import scratch_path


def _long(wide: DataFrame, cols: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Reshape a one-row ``<field>__<column>`` aggregate into rows per column."""
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), *[F.col(f"{f}__{c}").alias(f) for f in fields])
        for c in cols]))
    return wide.select(rows.alias("r")).select("r.*")


def describe_long(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    """count, mean, stddev (sample), min, max of each numeric column."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"count__{c}"), F.avg(x).alias(f"mean__{c}"),
                 F.stddev_samp(x).alias(f"stddev__{c}"), F.min(x).alias(f"min__{c}"),
                 F.max(x).alias(f"max__{c}")]
    out = _long(df.agg(*aggs), cols, ["count", "mean", "stddev", "min", "max"])
    return out.select("column", "count", *[F.round(f, digits).alias(f)
                                           for f in ("mean", "stddev", "min", "max")])


def sample_variance(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    """Sample variance (n-1) of each column over non-null values, one pass."""
    wide = df.agg(*[F.var_samp(F.col(c).cast("double")).alias(f"variance__{c}") for c in cols])
    return _long(wide, cols, ["variance"]).select(
        "column", F.round("variance", digits).alias("variance"))


def approx_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                     relative_error: float = 0.001) -> DataFrame:
    """Approximate quantiles of each column (Greenwald–Khanna sketch, partial
    aggregation): ``(column, prob, value)``. The error must be positive; exact
    quantiles are ``selection.exact_quantiles``."""
    if relative_error <= 0:
        raise ValueError("approx_quantiles needs a positive relative_error")
    acc = max(1, int(round(1.0 / relative_error)))
    wide = df.agg(*[F.percentile_approx(F.col(c).cast("double"), list(probs), acc)
                    .alias(f"q__{c}") for c in cols])
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(float(p)).alias("prob"),
                 F.col(f"q__{c}")[i].alias("value"))
        for c in cols for i, p in enumerate(probs)]))
    return wide.select(rows.alias("r")).select("r.*")


def quantile_state(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), k: int = 2000) -> DataFrame:
    """KLL sketches of each column as binary columns ``kll__<column>``, per ``by``.

    A sketch has a bounded size whatever the rows behind it (larger ``k``, smaller
    error: ``kll_rank_error``), merges with others (``merge_quantiles``) and answers
    any probability later (``quantiles_from``). NULL and NaN have no rank."""
    values = [F.col(c).cast("double") for c in cols]
    return df.groupBy(*by).agg(*[F.kll_sketch_agg_double(F.when(~F.isnan(x), x), F.lit(k)).alias(f"kll__{c}")
                                 for c, x in zip(cols, values)])


def merge_quantiles(state: DataFrame, cols: Sequence[str], by: Sequence[str] = (), k: int = 2000) -> DataFrame:
    """One sketch per column and ``by`` from several."""
    return state.groupBy(*by).agg(*[F.kll_merge_agg_double(f"kll__{c}", F.lit(k)).alias(f"kll__{c}") for c in cols])


def quantiles_from(state: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """``by``, ``column``, ``prob``, ``value`` from sketches; NULL without values."""
    rows = [F.struct(F.lit(c).alias("column"), F.lit(float(p)).alias("prob"), F.when(
        F.kll_sketch_get_n_double(f"kll__{c}") > 0,
        F.kll_sketch_get_quantile_double(f"kll__{c}", F.lit(float(p)))).alias("value")) for c in cols for p in probs]
    return state.select(*by, F.explode(F.array(*rows)).alias("r")).select(*by, "r.*")


def kll_rank_error(k: int) -> float:
    """Share of the rows by which an answer's rank may be off (99 % of all answers),
    as the sketch's authors give it."""
    return 2.296 / k ** 0.9021


def rank_checked(df: DataFrame, answers: DataFrame, error: float) -> DataFrame:
    """``column, prob, n, within``: whether each answer's true rank lies within
    ``error`` (a share of the column's rows) of its probability. One scan; the answers
    (a row per column and probability) come to the driver."""
    asked = answers.collect()
    cols = sorted({r["column"] for r in asked})
    counted = df.agg(*[F.count(c).alias(f"n_{c}") for c in cols], *[e for i, r in enumerate(asked) for e in (
        F.count_if(F.col(r["column"]) < r["value"]).alias(f"under_{i}"),
        F.count_if(F.col(r["column"]) <= r["value"]).alias(f"upto_{i}"))]).first()
    rows = []
    for i, r in enumerate(asked):
        n = counted[f"n_{r['column']}"]
        low, high = (r["prob"] - error) * n, (r["prob"] + error) * n
        rows.append((r["column"], r["prob"], n, bool(
            n and counted[f"under_{i}"] <= high + 1 and counted[f"upto_{i}"] >= low - 1)))
    return df.sparkSession.createDataFrame(rows, "column string, prob double, n long, within boolean")


#: A column's bitmaps take a bit per whole number of its range; they are used up to
#: so many bits per row, beyond which the values themselves are smaller.
BITS_PER_ROW = 64
_WHOLE = ("tinyint", "smallint", "int", "bigint")


def distinct_state(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """Which whole numbers occur in ``col``, as bitmaps: ``by``, ``bucket``, ``bits``.

    Each row is 4 kB for 32,768 numbers, whatever the rows behind it; states of
    different days or partitions merge (``merge_distinct``) without the rows."""
    return (df.filter(F.col(col).isNotNull())
            .select(*by, F.bitmap_bucket_number(F.col(col).cast("long")).alias("bucket"),
                    F.bitmap_bit_position(F.col(col).cast("long")).alias("bit"))
            .groupBy(*by, "bucket").agg(F.bitmap_construct_agg("bit").alias("bits")))


def merge_distinct(state: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One bitmap per bucket and ``by`` from several."""
    return state.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def count_distinct_state(state: DataFrame, by: Sequence[str] = (), out: str = "n_distinct") -> DataFrame:
    """Distinct count per ``by`` of a merged state."""
    return state.groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias(out))


def _distinct_count(df: DataFrame, col: str, bitmaps: bool) -> DataFrame:
    if bitmaps:
        counted = count_distinct_state(distinct_state(df, col))
    else:
        counted = df.groupBy(col).agg(F.lit(1).alias("_one")).agg(F.count(col).alias("n_distinct"))
    return counted.select(F.lit(col).alias("column"), "n_distinct")


def cardinality_profile(df: DataFrame, cols: Sequence[str] | None = None, cut_off: int = 1,
                        exact: bool = False) -> DataFrame:
    """Distinct count of every column; ``flag`` = 1 when it is <= cut_off
    (constant columns to drop). Approximate (HyperLogLog++) by default.

    The exact form writes the columns once and counts each from its own part of the
    columnar file, so no row is copied per column: whole numbers of a dense range as
    bitmaps, others by value."""
    cols = list(cols or df.columns)
    if not exact:
        wide = df.agg(*[F.approx_count_distinct(F.col(c)).alias(f"n_distinct__{c}") for c in cols])
        out = _long(wide, cols, ["n_distinct"])
        return out.withColumn("flag", (F.col("n_distinct") <= cut_off).cast("int"))
    spark = df.sparkSession
    path = scratch_path(spark, "profiled")
    narrow = df.select(*cols)
    narrow.write.parquet(path)
    rows = spark.read.schema(narrow.schema).parquet(path)
    whole = [c for c, kind in rows.dtypes if kind in _WHOLE]
    ends = rows.agg(F.count(F.lit(1)).alias("n"), *[f(c).cast("decimal(20,0)").alias(f"{name}_{c}") for c in whole
                                                   for name, f in (("lo", F.min), ("hi", F.max))]).first()
    dense = {c for c in whole if ends[f"lo_{c}"] is not None
             and ends[f"hi_{c}"] - ends[f"lo_{c}"] <= BITS_PER_ROW * ends["n"]}
    out = reduce(DataFrame.unionByName, [_distinct_count(rows, c, c in dense) for c in cols])
    return out.withColumn("flag", (F.col("n_distinct") <= cut_off).cast("int"))


def missing_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Missing (NULL / NaN / '') count of every column."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count(F.when(is_missing(df, c), 1)).alias(f"n_missing__{c}")
                    for c in cols])
    return _long(wide, cols, ["n_missing"])


def missing_profile(df: DataFrame, cols: Sequence[str] | None = None, drop_at: float = 0.80,
                    keep_at: float = 0.75, digits: int = 6) -> DataFrame:
    """Missing share per column with ``drop`` (share >= drop_at) and ``keep``
    (share <= keep_at) flags."""
    cols = list(cols or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("_n"),
                  *[F.count(F.when(is_missing(df, c), 1)).alias(f"n_missing__{c}") for c in cols])
    out = _long(wide.withColumns({f"n__{c}": F.col("_n") for c in cols}), cols,
                ["n_missing", "n"])
    share = F.try_divide(F.col("n_missing").cast("double"), F.col("n"))
    return out.select("column", "n_missing", F.round(share, digits).alias("missing_share"),
                      (share >= drop_at).cast("int").alias("drop"),
                      (share <= keep_at).cast("int").alias("keep"))


def histogram_equal_width(df: DataFrame, col: str, bins: int = 25,
                          digits: int = 6) -> DataFrame:
    """Equal-width histogram over [min, max]: ``bin, lo, hi, count`` for every
    bin (empty ones included); NULL, NaN and infinite values have no bin and are
    left out; the last bin is closed."""
    x = F.col(col).cast("double")
    clean = df.select(x.alias("x")).filter(F.col("x").between(
        -sys.float_info.max, sys.float_info.max))
    stats = clean.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    lo, hi = stats.select("lo").scalar(), stats.select("hi").scalar()
    width = (hi - lo) / F.lit(float(bins))
    raw_bin = F.floor(F.try_divide(F.col("x") - lo, width))
    b = F.least(F.coalesce(raw_bin, F.lit(0)), F.lit(bins - 1)).cast("int")
    counts = clean.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    spark = df.sparkSession
    all_bins = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (all_bins.join(F.broadcast(counts), "bin", "left")
            .select("bin",
                    F.round(lo + F.col("bin") * width, digits).alias("lo"),
                    F.round(lo + (F.col("bin") + 1) * width, digits).alias("hi"),
                    F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count")))
