"""Global ordering without a single-partition window.

``Window.orderBy(...)`` with no partition spec moves every row into one task.
Instead we range-partition on the full sort key (score plus unique tie keys, so
a hot score value is split across partitions like any other key range), sort
within partitions, and number rows from the monotonic id's partition/position
bits. Per-partition counts (one row per partition) are prefix-summed on a tiny
table and broadcast back; their size is the partition count, which we choose.

The range bounds are sampled each time an exchange is planned, so the numbered
partitions are checkpointed (reliable checkpoint in the shared folder named by
``spark.checkpoint.dir``) before counting: counts and rows then come from the
same partitions, and a lost executor cannot change them. Callers pass only the
columns they need, which keeps the checkpoint narrow.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, shuffle_partitions

_PID_SHIFT = 33  # monotonically_increasing_id = partition_index << 33 | position


def _sort_cols(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def _numbered(df: DataFrame, order: Sequence[Column | str], num_partitions: int | None,
              keep: Sequence[str] | None = None):
    """Range-partition and sort on ``order``, tag partition id and position,
    and checkpoint. ``keep`` (column names) narrows what is checkpointed: the
    sort keys are usually not needed once positions are assigned."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or shuffle_partitions(spark)
    cols = _sort_cols(order)
    tagged = (
        df.repartitionByRange(n, *cols)
        .sortWithinPartitions(*cols)
        .withColumn("_sc_mid", F.monotonically_increasing_id())
        .withColumn("_sc_pid", F.shiftright(F.col("_sc_mid"), _PID_SHIFT))
        .withColumn("_sc_pos", F.col("_sc_mid") - F.shiftleft(F.col("_sc_pid"), _PID_SHIFT))
        .drop("_sc_mid")
    )
    if keep is not None:
        tagged = tagged.select(*dict.fromkeys(list(keep)), "_sc_pid", "_sc_pos")
    return tagged.checkpoint(eager=True), n


def _partition_offsets(tagged: DataFrame, sums: Sequence[str] = ()) -> DataFrame:
    """One row per partition: rows (and value sums) in all earlier partitions."""
    aggs = [F.count(F.lit(1)).alias("_sc_cnt")] + [F.sum(c).alias(f"_sc_tot_{c}") for c in sums]
    per_part = tagged.groupBy("_sc_pid").agg(*aggs)
    before = Window.orderBy("_sc_pid").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    cols = [
        F.col("_sc_pid"),
        F.coalesce(F.sum("_sc_cnt").over(before), F.lit(0)).alias("_sc_off"),
        F.sum("_sc_cnt").over(everything).alias("_sc_n"),
    ]
    for c in sums:
        cols.append(F.coalesce(F.sum(f"_sc_tot_{c}").over(before), F.lit(0)).alias(f"_sc_off_{c}"))
        cols.append(F.sum(f"_sc_tot_{c}").over(everything).alias(f"_sc_all_{c}"))
    return per_part.select(*cols)


def global_row_number(df: DataFrame, order: Sequence[Column | str], out: str = "row_number",
                      total: str | None = None, num_partitions: int | None = None) -> DataFrame:
    """1-based row number over a total order; ``total`` optionally names N.

    ``order`` must be a total order (append unique tie keys) for reproducible
    results, exactly as with ``row_number().over(Window.orderBy(...))``.
    """
    tagged, _ = _numbered(df, order, num_partitions)
    offsets = _partition_offsets(tagged)
    res = tagged.join(F.broadcast(offsets), "_sc_pid").withColumn(
        out, (F.col("_sc_off") + F.col("_sc_pos") + 1).cast("long"))
    if total:
        res = res.withColumn(total, F.col("_sc_n").cast("long"))
    return res.drop("_sc_pid", "_sc_pos", "_sc_off", "_sc_n")


def ntile_from_rank(rn: Column, n_rows: Column, k: int) -> Column:
    """``ntile(k)`` of 1-based row ``rn`` among ``n_rows``: the first N mod k
    tiles hold one extra row, exactly as SQL ``ntile``."""
    q = F.floor(n_rows / F.lit(k)).cast("long")
    m = (n_rows - q * F.lit(k)).cast("long")
    big = m * (q + 1)
    first = F.floor((rn - 1) / (q + 1)) + 1
    rest = m + F.floor((rn - big - 1) / F.greatest(q, F.lit(1))) + 1
    return F.when(rn <= big, first).otherwise(rest).cast("int")


def global_ntile(df: DataFrame, order: Sequence[Column | str], k: int, out: str = "ntile",
                 row_number: str | None = None, num_partitions: int | None = None) -> DataFrame:
    """Scalable ``ntile(k).over(Window.orderBy(order))``."""
    rn_col = row_number or "_rn"
    res = global_row_number(df, order, out=rn_col, total="_rows_total", num_partitions=num_partitions)
    res = res.withColumn(out, ntile_from_rank(F.col(rn_col), F.col("_rows_total"), k)).drop("_rows_total")
    if row_number is None:
        res = res.drop("_rn")
    return res


def _sums_in_partition(tagged: DataFrame, values: Sequence[str],
                       group: Sequence[str] = ()) -> DataFrame:
    """Append to a numbered table, whose groups are contiguous in a partition:
    ``_sc_in_<v>``, running sums of ``values`` along ``_sc_pos`` that restart at
    each group, ``_sc_at``, the row's place in its group there (from 1), and
    ``_sc_run0``, whether its group is the partition's first.

    Sums are taken where the partition already is (Arrow batches, numpy, with a
    carry between batches), so there is no shuffle; other columns pass through
    untouched. Sums are long for integers, else double; NULL counts as 0."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    from pyspark.sql import types as T

    fields = list(tagged.schema.fields)
    kinds = {}
    for v in values:
        integral = isinstance(tagged.schema[v].dataType,
                              (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
        kinds[v] = pa.int64() if integral else pa.float64()
        fields.append(T.StructField(f"_sc_in_{v}", T.LongType() if integral else T.DoubleType()))
    fields += [T.StructField("_sc_at", T.LongType()), T.StructField("_sc_run0", T.BooleanType())]
    gcols = list(group)

    def differs(a, b):
        out = pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.xor(pc.is_null(a), pc.is_null(b)))
        if pa.types.is_floating(a.type):
            both = pc.and_(pc.fill_null(pc.is_nan(a), False), pc.fill_null(pc.is_nan(b), False))
            out = pc.and_not(out, both)
        return out.to_numpy(zero_copy_only=False)

    def run(batches):
        last, carry, rows, run0 = None, dict.fromkeys(values, 0), 0, True
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            cols = {c: batch.column(batch.schema.get_field_index(c)) for c in [*gcols, *values]}
            change = np.zeros(n, bool)
            for c in gcols:
                change[1:] |= differs(cols[c].slice(1), cols[c].slice(0, n - 1))
                if last is not None:
                    change[0] |= differs(cols[c].slice(0, 1), last[c])[0]
            last = {c: cols[c].slice(n - 1) for c in gcols}
            seg, starts = np.cumsum(change), np.flatnonzero(change)
            out = []
            for v in values:
                x = pc.fill_null(pc.cast(cols[v], kinds[v]), 0).to_numpy(zero_copy_only=False)
                cum = np.cumsum(x)
                inside = cum - np.concatenate([[-carry[v]], (cum - x)[starts]]).astype(cum.dtype)[seg]
                carry[v] = inside[-1]
                out.append(pa.array(inside, kinds[v]))
            at = np.arange(1, n + 1) - np.concatenate([[-rows], starts])[seg]
            rows = int(at[-1])
            first = (seg == 0) & run0
            run0 = bool(first[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *out, pa.array(at, pa.int64()), pa.array(first)],
                names=[f.name for f in fields])

    return tagged.sortWithinPartitions("_sc_pos").mapInArrow(run, T.StructType(fields))


def global_running_sum(df: DataFrame, order: Sequence[Column | str], values: Sequence[str],
                       prefix: str = "cum_", totals: bool = False,
                       num_partitions: int | None = None) -> DataFrame:
    """Running sums of ``values`` over a total order, rows up to and including
    the current one, plus optional grand totals (``total_<v>``).

    Inside a range partition the running sum is taken in place (see
    ``_sums_in_partition``); earlier partitions contribute an offset
    from the one-row-per-partition table, broadcast back.
    """
    tagged, _ = _numbered(df, order, num_partitions)
    offsets = _partition_offsets(tagged, values)
    res = _sums_in_partition(tagged, values).drop("_sc_at", "_sc_run0")
    res = res.join(F.broadcast(offsets), "_sc_pid")
    for v in values:
        res = res.withColumn(f"{prefix}{v}", F.col(f"_sc_off_{v}") + F.col(f"_sc_in_{v}"))
        if totals:
            res = res.withColumn(f"total_{v}", F.col(f"_sc_all_{v}"))
    drop = (["_sc_pid", "_sc_pos", "_sc_off", "_sc_n"]
            + [f"_sc_{p}_{v}" for v in values for p in ("in", "off", "all")])
    return res.drop(*drop)


def top_n_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column | str],
                    n: int, rank_col: str = "rank") -> DataFrame:
    """Rows ranked 1..n inside each group (``row_number``; ties broken by order)."""
    w = Window.partitionBy(*group).orderBy(*_sort_cols(order))
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def flag_max(df: DataFrame, value: str, group: Sequence[str] = (), out: str = "is_max") -> DataFrame:
    """1 on rows holding the maximum of ``value`` (within ``group``), else 0.

    With no group the maximum is a scalar subquery (one value, computed once),
    so no row-level window collapses the data into one task.
    """
    if group:
        # maxima joined back (NULL groups match): a window would put a whole group in one task
        top = df.groupBy(*[F.col(c).alias(f"_m_{c}") for c in group]).agg(F.max(value).alias("_max"))
        res = df.join(top, [F.col(c).eqNullSafe(F.col(f"_m_{c}")) for c in group])
        return res.withColumn(out, F.coalesce((F.col(value) == F.col("_max")).cast("int"), F.lit(0))
                              ).drop("_max", *[f"_m_{c}" for c in group])
    mx = df.agg(F.max(value)).scalar()
    return df.withColumn(out, F.coalesce((F.col(value) == mx).cast("int"), F.lit(0)))


def _carries(tagged: DataFrame, group: Sequence[str], sums: Sequence[str] = ()) -> DataFrame:
    """One row per partition of a numbered table sorted on (group, order): rows
    (``_sc_off``) and value sums (``_sc_off_<v>``) that the partition's first
    group has in earlier partitions. Only that group can come from there, so the
    table has as many rows as partitions and may be broadcast. A group spans a
    contiguous run of partitions: the window below sees at most one row per
    partition for any group, however large the group is."""
    aggs = [F.count(F.lit(1)).alias("_sc_cnt"), F.min("_sc_pos").alias("_sc_first")]
    aggs += [F.sum(c).alias(f"_sc_tot_{c}") for c in sums]
    per = tagged.groupBy("_sc_pid", *group).agg(*aggs)
    before = Window.partitionBy(*group).orderBy("_sc_pid").rowsBetween(
        Window.unboundedPreceding, -1)
    cols = ["_sc_pid", "_sc_first",
            F.coalesce(F.sum("_sc_cnt").over(before), F.lit(0)).alias("_sc_off")]
    cols += [F.coalesce(F.sum(f"_sc_tot_{c}").over(before), F.lit(0)).alias(f"_sc_off_{c}")
             for c in sums]
    return per.select(*cols).filter(F.col("_sc_first") == 0).drop("_sc_first")


def _with_group_totals(rows: DataFrame, tagged: DataFrame, group: Sequence[str],
                       aggs: Sequence[Column]) -> DataFrame:
    """Join whole-group aggregates back (NULL groups match). One row per group:
    adaptive execution broadcasts it where its measured size allows and splits
    skewed groups otherwise."""
    if not group:
        return rows.join(F.broadcast(tagged.agg(*aggs)))
    per = tagged.groupBy(*[F.col(g).alias(f"_sc_t_{g}") for g in group]).agg(*aggs)
    match = [F.col(g).eqNullSafe(F.col(f"_sc_t_{g}")) for g in group]
    return rows.join(per, match).drop(*[f"_sc_t_{g}" for g in group])


def grouped_row_number(df: DataFrame, group: Sequence[str], order: Sequence[Column | str],
                       out: str = "row_number", size: str | None = None,
                       num_partitions: int | None = None,
                       keep: Sequence[str] | None = None) -> DataFrame:
    """``row_number().over(partitionBy(group).orderBy(order))`` without putting
    a group into one task: one range partitioning on (group, order); the
    number is the row's place in its group in this partition, plus, for the
    partition's first group, the group's rows in earlier partitions (a broadcast
    table of one row per partition). No rows are shuffled after the range
    partitioning. ``keep`` narrows the output (and the checkpoint) to those
    columns plus ``group``."""
    g = [F.col(c) for c in group]
    keep_cols = None if keep is None else list(group) + [c for c in keep if c not in group]
    tagged, _ = _numbered(df, g + _sort_cols(order), num_partitions, keep=keep_cols)
    res = _sums_in_partition(tagged, [], group).join(F.broadcast(_carries(tagged, group)), "_sc_pid")
    res = res.withColumn(out, F.col("_sc_at") + F.when(F.col("_sc_run0"), F.col("_sc_off")).otherwise(0))
    if size:
        res = _with_group_totals(res, tagged, group, [F.count(F.lit(1)).alias(size)])
    return res.drop("_sc_pid", "_sc_pos", "_sc_at", "_sc_run0", "_sc_off")


def grouped_ntile(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], k: int,
                  out: str = "ntile", num_partitions: int | None = None,
                  keep: Sequence[str] | None = None) -> DataFrame:
    """``ntile(k)`` within each group, skew-safe (see ``grouped_row_number``)."""
    res = grouped_row_number(df, group, order, out="_rn_g", size="_n_g",
                             num_partitions=num_partitions, keep=keep)
    return res.withColumn(out, ntile_from_rank(F.col("_rn_g"), F.col("_n_g"), k)).drop(
        "_rn_g", "_n_g")


def grouped_running_sum(df: DataFrame, group: Sequence[str], order: Sequence[Column | str],
                        values: Sequence[str], prefix: str = "cum_",
                        totals: bool = False) -> DataFrame:
    """Running sums of ``values`` within each group along ``order`` (rows up to
    and including the current one), skew-safe: one range partitioning on
    (group, order), in-partition sums restarting at group starts, plus, for a
    partition's first group, its sums in earlier partitions (a broadcast table
    of one row per partition).
    ``totals`` adds the group's sums as ``total_<v>``."""
    g = [F.col(c) for c in group]
    tagged, _ = _numbered(df, g + _sort_cols(order), None)
    res = _sums_in_partition(tagged, values, group).join(
        F.broadcast(_carries(tagged, group, values)), "_sc_pid")
    for v in values:
        res = res.withColumn(f"{prefix}{v}", F.col(f"_sc_in_{v}") + F.when(
            F.col("_sc_run0"), F.col(f"_sc_off_{v}")).otherwise(0))
    if totals:
        res = _with_group_totals(res, tagged, group, [F.sum(v).alias(f"total_{v}") for v in values])
    return res.drop("_sc_pid", "_sc_pos", "_sc_at", "_sc_run0", "_sc_off",
                    *[f"_sc_{p}_{v}" for v in values for p in ("in", "off")])
