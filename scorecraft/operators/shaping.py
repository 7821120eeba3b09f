"""Grouped shaping that stays skew-safe.

Per-group results that a window would compute by pulling a whole group into
one task (partition maximum, share of group total, one row per key) are written
as map-side-combined aggregations joined back on the group key. The joined side
has one row per group; Spark's adaptive execution measures it at run time and
broadcasts it when it is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``
(a checked size), and otherwise keeps a shuffle join with skew splitting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_group_aggregate(df: DataFrame, group: Sequence[str], agg: Column, name: str) -> DataFrame:
    """Attach one per-group aggregate (e.g. max, sum) to every row. A NULL group
    is a group, as in a window."""
    per_group = df.groupBy(*[F.col(g).alias(f"_g_{g}") for g in group]).agg(agg.alias(name))
    match = [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in group]
    return df.join(per_group, match).drop(*[f"_g_{g}" for g in group])


def gap_to_group_max(df: DataFrame, group: Sequence[str], value: str,
                     out: str = "gap_to_max") -> DataFrame:
    """value's distance below the maximum of its group (max - value)."""
    res = with_group_aggregate(df, group, F.max(value), "_gmax")
    return res.withColumn(out, F.col("_gmax") - F.col(value)).drop("_gmax")


def share_of_group(df: DataFrame, group: Sequence[str], value: str, out: str = "share") -> DataFrame:
    """value / sum(value) within its group (NULL when the group sums to 0)."""
    if group:
        res = with_group_aggregate(df, group, F.sum(value), "_gsum")
        total = F.col("_gsum")
    else:
        res = df
        total = df.agg(F.sum(value)).scalar()
    res = res.withColumn(out, F.try_divide(F.col(value).cast("double"), total))
    return res.drop("_gsum") if group else res


def first_by_order(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Deterministic ``dropDuplicates(keys)``: per key, the row that sorts first
    on ``order`` (then on all remaining columns). Written as ``min(struct)``,
    a partial aggregate, so a hot key is combined map-side before the shuffle."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.min(F.struct(*[F.col(c) for c in list(order) + rest])).alias("_first")
    agg = df.groupBy(*keys).agg(packed)
    return agg.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in list(order) + rest])


def nth_largest_rows(df: DataFrame, group: Sequence[str], value: str, rank: int = 2,
                     rank_col: str = "rank") -> DataFrame:
    """Rows whose ``rank()`` within the group (value descending) equals ``rank``.

    Uses the rank-filter form Spark rewrites with a partial group limit before
    the shuffle (at most ``rank`` rows per group and map partition travel), so a
    large group never reaches one task whole.
    """
    from pyspark.sql import Window

    w = Window.partitionBy(*group).orderBy(F.col(value).desc())
    return df.withColumn(rank_col, F.rank().over(w)).filter(F.col(rank_col) == rank)
