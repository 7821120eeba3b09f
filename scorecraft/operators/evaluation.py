"""Scorecard evaluation: deciles/KS, gains and lift, ROC/PR/AUC, confusion
matrix, accuracy, metric tables and champion/challenger selection.

Row-level work is one range shuffle (global ordering) or one keyed
aggregation; everything after that runs on tables with one row per decile,
per distinct score or per model, never on all rows in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .ordering import _sort_cols, global_running_sum


def _pct(num: Column, den: Column) -> Column:
    return F.try_divide(num * F.lit(100.0), den.cast("double"))


def order_columns(order: Sequence[Column | str], available: Sequence[str]) -> list[str] | None:
    """Names of the plain columns a sort spec refers to, or None when an entry
    is an expression (then nothing is narrowed). Used to shuffle and
    checkpoint only those columns before a global ordering."""
    names: list[str] = []
    for o in order:
        text = o if isinstance(o, str) else str(o)
        if not isinstance(o, str):
            text = text.removeprefix("Column<'").removesuffix("'>").split(" ")[0].strip("`")
        if text not in available:
            return None
        if text not in names:
            names.append(text)
    return names


def decile_table(df: DataFrame, label: str, order: Sequence[Column | str], k: int = 10,
                 absolute_spread: bool = True, decile_col: str = "deciles") -> DataFrame:
    """Decile table: ``deciles, total, <label>, non_target, target_%, cum_target,
    cum_non_target, target_dist, non_target_dist, spread`` (2 dp).

    ``order`` is the score, best first, then the tie keys. Rows without a label
    have no part in the table. ``spread`` is |target_dist - non_target_dist| by
    default, signed on request. A table that already has the deciles in
    ``decile_col`` is summed as it is.

    Rows are first reduced to distinct scores; only scores on the edge of two
    deciles (at most k - 1) are numbered row by row.
    """
    df = df.filter(F.col(label).isNotNull())
    if decile_col in df.columns:
        g = df.groupBy(decile_col).agg(
            F.count(F.lit(1)).alias("total"),
            F.sum(F.col(label)).cast("long").alias(label),
            F.sum(1 - F.col(label)).cast("long").alias("non_target"))
    else:
        tiles = _tiles_by_score(df, label, order, k)
        g = tiles.select(F.col("_tile").alias(decile_col), F.col("_rows").alias("total"),
                         F.col("_t").alias(label), F.col("_nt").alias("non_target"))
    return decile_summary(g, label, decile_col, absolute_spread)


def _tiles_by_score(df: DataFrame, label: str, order: Sequence[Column | str], k: int) -> DataFrame:
    """``_tile, _rows, _t, _nt, _score_sum`` over (score desc, ties): the score is
    the first entry of ``order``, taken in the direction given there."""
    first = _sort_cols(order[:1])[0]
    name = order_columns(order[:1], df.columns)
    if name is None or "DESC" not in str(first).upper():
        raise ValueError("order starts with the score column, descending")
    score = name[0]
    runs = score_runs_by_group(df, [], score, label)
    return tile_counts_by_group(df, runs, [], score, list(order[1:]), label, k)


def decile_summary(g: DataFrame, label: str, decile_col: str = "deciles",
                   absolute_spread: bool = True) -> DataFrame:
    """Cumulative columns over an already aggregated table of k rows."""
    run = Window.orderBy(decile_col).rowsBetween(Window.unboundedPreceding, 0)
    allw = Window.partitionBy(F.lit(1))
    t = g.select(
        "*",
        F.sum(label).over(run).alias("cum_target"),
        F.sum("non_target").over(run).alias("cum_non_target"),
        F.sum(label).over(allw).alias("_tt"),
        F.sum("non_target").over(allw).alias("_tn"),
    )
    td = _pct(F.col("cum_target"), F.col("_tt"))
    nd = _pct(F.col("cum_non_target"), F.col("_tn"))
    spread = F.abs(td - nd) if absolute_spread else td - nd
    return t.select(
        F.col(decile_col).cast("int").alias(decile_col),
        F.col("total").cast("long").alias("total"),
        F.col(label).cast("long").alias(label),
        F.col("non_target").cast("long").alias("non_target"),
        F.round(_pct(F.col(label), F.col("total")), 2).alias("target_%"),
        F.col("cum_target").cast("long").alias("cum_target"),
        F.col("cum_non_target").cast("long").alias("cum_non_target"),
        F.round(td, 2).alias("target_dist"),
        F.round(nd, 2).alias("non_target_dist"),
        F.round(spread, 2).alias("spread"),
    )


def ks_statistic(decile_tbl: DataFrame) -> DataFrame:
    """KS = maximum spread of the decile table (one row ``ks``)."""
    return decile_tbl.agg(F.round(F.max("spread"), 2).alias("ks"))


def gains_lift_table(df: DataFrame, label: str, score: str, order: Sequence[Column | str],
                     k: int = 10) -> DataFrame:
    """Per decile: average actual and predicted, cumulative target share and
    lift = share / population %. Upper-case names as in the reference.
    ``order`` starts with ``score``; rows without a label have no part."""
    tiles = _tiles_by_score(df.filter(F.col(label).isNotNull()), label, order, k)
    g = tiles.select(
        F.col("_tile").alias("deciles"), F.col("_rows").alias("total"), F.col("_t").alias(label),
        F.try_divide(F.col("_t").cast("double"), F.col("_rows")).alias("_actual"),
        F.try_divide(F.col("_score_sum"), F.col("_rows")).alias("_pred"))
    run = Window.orderBy("deciles").rowsBetween(Window.unboundedPreceding, 0)
    allw = Window.partitionBy(F.lit(1))
    dist = _pct(F.sum(label).over(run), F.sum(label).over(allw))
    pop = F.col("deciles") * F.lit(100.0 / k)
    return g.select(
        (F.col("deciles") * F.lit(100 // k)).cast("int").alias("DECILE"),
        F.round(F.col("_actual"), 6).alias("ACTUAL"),
        F.round(F.col("_pred"), 6).alias("PRED"),
        F.round(dist, 4).alias("DIST_TAR"),
        F.round(F.try_divide(dist, pop), 6).alias("LIFT"),
    )


# ------------------------------------------------------------ ROC / PR / AUC
def score_counts(df: DataFrame, score: str, label: str) -> DataFrame:
    """Distinct scores with positive and negative counts (map-side combined)."""
    return df.groupBy(F.col(score).alias("score")).agg(
        F.sum(F.col(label)).cast("long").alias("pos"),
        F.sum(1 - F.col(label)).cast("long").alias("neg"))


def _cumulative_by_threshold(df: DataFrame, score: str, label: str) -> DataFrame:
    """Per distinct score s (descending): tp/fp = positives/negatives with
    score >= s, plus totals P and N."""
    sc = score_counts(df, score, label)
    return global_running_sum(sc, [F.col("score").desc()], ["pos", "neg"], prefix="cum_",
                              totals=True).select(
        "score", "pos", "neg",
        F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"),
        F.col("total_pos").alias("P"), F.col("total_neg").alias("N"))


def roc_points(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """One ROC point per distinct score threshold: ``threshold, fpr, tpr``."""
    c = _cumulative_by_threshold(df, score, label)
    return c.select(F.col("score").alias("threshold"),
                    F.round(F.try_divide(F.col("fp").cast("double"), F.col("N")), 6).alias("fpr"),
                    F.round(F.try_divide(F.col("tp").cast("double"), F.col("P")), 6).alias("tpr"))


def pr_points(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """One precision/recall point per distinct score threshold."""
    c = _cumulative_by_threshold(df, score, label)
    return c.select(F.col("score").alias("threshold"),
                    F.round(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp")),
                            6).alias("precision"),
                    F.round(F.try_divide(F.col("tp").cast("double"), F.col("P")), 6).alias("recall"))


def average_precision(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """AP = sum over thresholds of (recall step) * precision at the threshold."""
    c = _cumulative_by_threshold(df, score, label)
    return c.agg(F.round(F.try_divide(
        F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp"))),
        F.max("P").cast("double")), 6).alias("average_precision"))


def auc_roc(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Area under ROC by trapezoids over distinct thresholds (ties -> half
    credit), equal to the rank-sum statistic with mid-ranks."""
    c = _cumulative_by_threshold(df, score, label)
    # area of the trapezoid added at this threshold: neg * (tp_prev + tp) / 2
    area = F.col("neg") * ((F.col("tp") - F.col("pos")) + F.col("tp")) / 2.0
    return c.agg(F.round(F.try_divide(F.sum(area), F.max("P") * F.max("N") * 1.0), 6)
                 .alias("auc"))


# ------------------------------------------------------ classification tables
def confusion_matrix(df: DataFrame, label: str = "label",
                     prediction: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("count"))


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """accuracy and test error = 1 - accuracy."""
    hit = F.when(F.col(prediction).cast("double") == F.col(label).cast("double"), 1).otherwise(0)
    return df.agg(F.avg(hit).alias("_a")).select(
        F.round("_a", 6).alias("accuracy"), F.round(1 - F.col("_a"), 6).alias("test_error"))


def precision_recall_f1(df: DataFrame, label: str = "label",
                        prediction: str = "prediction") -> DataFrame:
    y = F.col(label).cast("double")
    p = F.col(prediction).cast("double")
    agg = df.agg(F.sum(F.when((y == 1) & (p == 1), 1).otherwise(0)).alias("tp"),
                 F.sum(F.when((y == 0) & (p == 1), 1).otherwise(0)).alias("fp"),
                 F.sum(F.when((y == 1) & (p == 0), 1).otherwise(0)).alias("fn"))
    prec = F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp"))
    rec = F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fn"))
    return agg.select(F.round(prec, 6).alias("precision"), F.round(rec, 6).alias("recall"),
                      F.round(F.try_divide(2 * prec * rec, prec + rec), 6).alias("f1"))


# ------------------------------------------------- metrics per (model, dataset)
def auc_by_group(df: DataFrame, group: Sequence[str], score: str = "score",
                 label: str = "label", digits: int = 6) -> DataFrame:
    """AUC per group by the rank-sum statistic with mid-ranks for ties, from
    the distinct-score runs (see ``score_runs_by_group``)."""
    return auc_accuracy_from_runs(score_runs_by_group(df, group, score, label), group, digits)


def score_runs_by_group(df: DataFrame, group: Sequence[str], score: str = "score",
                        label: str = "label", prediction: str | None = None) -> DataFrame:
    """Distinct (group, score) runs, best score first: ``_s, _cnt, _pos`` (rows,
    positives), ``_hit`` (rows with prediction == label, when given),
    ``_before`` (rows of the group with a better score) and ``_n`` (group rows).

    Rows are reduced by a map-side combined aggregation first; the running
    count is a skew-safe grouped running sum on that (usually far smaller)
    table, so one hot group or one hot score never lands in one task."""
    from .ordering import grouped_running_sum

    aggs = [F.count(F.lit(1)).alias("_cnt"), F.sum(F.col(label)).cast("long").alias("_pos"),
            F.sum(1 - F.col(label)).cast("long").alias("_neg")]
    if prediction:
        hit = F.when(F.col(prediction).cast("double") == F.col(label).cast("double"), 1)
        aggs.append(F.sum(hit.otherwise(0)).cast("long").alias("_hit"))
    runs = df.groupBy(*group, F.col(score).alias("_s")).agg(*aggs)
    cum = grouped_running_sum(runs, group, [F.col("_s").desc()], ["_cnt"], prefix="_cum",
                              totals=True)
    # checkpointed: AUC, accuracy and the KS tiles all read this table
    ensure_checkpoint_dir(df.sparkSession)
    return cum.withColumn("_before", F.col("_cum_cnt") - F.col("_cnt")).withColumnRenamed(
        "total__cnt", "_n").drop("_cum_cnt").checkpoint(eager=True)


def auc_accuracy_from_runs(runs: DataFrame, group: Sequence[str], digits: int = 6) -> DataFrame:
    """AUC by the rank-sum statistic with mid-ranks for ties, and accuracy when
    the runs carry ``_hit``: (sum of positive mid-ranks - P(P+1)/2) / (P * N)."""
    below = F.col("_n") - F.col("_before") - F.col("_cnt")
    midrank = below + (F.col("_cnt") + 1) / 2.0
    aggs = [F.sum(F.col("_pos") * midrank).alias("_rsum"), F.sum("_pos").alias("_P"),
            F.max("_n").alias("_N")]
    has_hit = "_hit" in runs.columns
    if has_hit:
        aggs.append(F.sum("_hit").alias("_H"))
    agg = runs.groupBy(*group).agg(*aggs)
    p, n = F.col("_P").cast("double"), (F.col("_N") - F.col("_P")).cast("double")
    out = [*group, F.round(F.try_divide(F.col("_rsum") - p * (p + 1) / 2.0, p * n),
                           digits).alias("auc")]
    if has_hit:
        out.append(F.round(F.try_divide(F.col("_H").cast("double"), F.col("_N")),
                           digits).alias("accuracy"))
    return agg.select(*out)


def tile_counts_by_group(df: DataFrame, runs: DataFrame, group: Sequence[str], score: str,
                         ties: Sequence[Column | str], label: str, k: int = 10) -> DataFrame:
    """Rows, positives and negatives per (group, tile) for ``ntile(k)`` over
    (score desc, ties) within each group: ``group…, _tile, _rows, _t, _nt,
    _score_sum`` (the sum of the rows' scores). No group columns: one group.

    A score run lying inside one tile adds its counts to that tile directly.
    Only runs straddling a tile boundary (at most k-1 per group) are resolved
    row by row: their rows are joined back (the straddling table is small and
    broadcast by AQE when its measured size allows) and numbered inside the run
    by the tie keys with the skew-safe grouped row number. Where these runs hold
    many rows, only those near a boundary are numbered (``_tiles_by_brackets``)."""
    from .ordering import grouped_row_number, ntile_from_rank

    first = ntile_from_rank(F.col("_before") + 1, F.col("_n"), k)
    last = ntile_from_rank(F.col("_before") + F.col("_cnt"), F.col("_n"), k)
    r = runs.select(*group, "_s", "_cnt", "_pos", "_neg", "_before", "_n",
                    first.alias("_t1"), last.alias("_t2"))
    whole = r.filter(F.col("_t1") == F.col("_t2")).select(
        *group, F.col("_t1").alias("_tile"), F.col("_cnt").alias("_rows"),
        F.col("_pos").alias("_t"), F.col("_neg").alias("_nt"),
        (F.col("_s").cast("double") * F.col("_cnt")).alias("_score_sum"))
    keys = list(group) + ["_s"]
    strad = r.filter(F.col("_t1") != F.col("_t2")).select(
        *[F.col(c).alias(f"_k{c}") for c in keys], "_before", "_n")
    rows = df.withColumn("_s", F.col(score))
    cond = [F.col(c).eqNullSafe(F.col(f"_k{c}")) for c in keys]
    tie_cols = order_columns(ties, df.columns)
    if tie_cols is not None:
        rows = rows.select(*dict.fromkeys(list(group) + ["_s"] + tie_cols + [label]))
    # checkpointed once, so the range sampling and the shuffle of the numbering
    # read these rows instead of scanning and joining the input twice
    wide = r.filter(F.col("_t1") != F.col("_t2"))
    n_runs, n_rows = wide.agg(F.count(F.lit(1)), F.coalesce(F.sum("_cnt"), F.lit(0))).first()
    ascending = tie_cols and all("DESC" not in str(c).upper() for c in _sort_cols(ties))
    if n_rows > _NUMBER_AT_MOST and n_runs <= _FEW_RUNS and ascending:
        part = _tiles_by_brackets(rows, wide, keys, tie_cols, label, k)
        return _tile_sums(whole.unionByName(part.select(whole.columns)), group)
    j = rows.join(strad, cond).drop(*[f"_k{c}" for c in keys]).checkpoint(eager=True)
    numbered = grouped_row_number(j, keys, ties, out="_rn", keep=[label, "_before", "_n"])
    part = numbered.select(*group, ntile_from_rank(F.col("_before") + F.col("_rn"), F.col("_n"),
                                                   k).alias("_tile"),
                           F.lit(1).cast("long").alias("_rows"),
                           F.col(label).cast("long").alias("_t"),
                           (1 - F.col(label)).cast("long").alias("_nt"),
                           F.col("_s").cast("double").alias("_score_sum"))
    return _tile_sums(whole.unionByName(part), group)


def _tile_sums(parts: DataFrame, group: Sequence[str]) -> DataFrame:
    return parts.groupBy(*group, "_tile").agg(
        F.sum("_rows").alias("_rows"), F.sum("_t").alias("_t"), F.sum("_nt").alias("_nt"),
        F.sum("_score_sum").alias("_score_sum"))


#: Rows numbered one by one without looking for brackets, runs that are broadcast, and
#: rows of a run that its brackets are taken from.
_NUMBER_AT_MOST, _FEW_RUNS, _BRACKET_ROWS = 2_000_000, 10_000, 20_000


def _tiles_by_brackets(rows: DataFrame, wide: DataFrame, keys: Sequence[str], ties: Sequence[str],
                       label: str, k: int) -> DataFrame:
    """Tile counts of straddling runs (``keys``; few, in ``wide``) without moving all their
    rows. Some rows of a run, drawn by a hash, bracket the row on each tile boundary; one
    scan counts the rows below the bracket, and only those inside it are numbered. A bracket
    that its counts show to miss the boundary gives way to the whole run, so the counts are
    exact."""
    from .ordering import grouped_row_number

    at = F.struct(*ties)
    named = [F.col(c).alias(f"_k{c}") for c in keys]
    same = [F.col(c).eqNullSafe(F.col(f"_k{c}")) for c in keys]
    pos, neg = F.col(label).cast("long"), (1 - F.col(label)).cast("long")

    def rows_of(runs):
        return rows.join(F.broadcast(runs), same).drop(*[f"_k{c}" for c in keys])

    # rows of the run before the end of each tile that ends inside it
    tiles, width = F.sequence("_t1", F.col("_t2") - 1), F.floor(F.col("_n") / F.lit(k)).cast("long")
    ends = wide.select(*keys, "_before", "_cnt", "_n", F.explode(tiles).alias("_tile")).select(
        *keys, "_cnt", "_tile", (F.col("_tile") * width + F.least("_tile", F.col("_n") - width * k)
                                 - F.col("_before")).alias("_p"))
    every = F.greatest(F.lit(1), F.floor(F.col("_cnt") / _BRACKET_ROWS))
    drawn = (rows_of(wide.select(*named, "_cnt")).filter(F.pmod(F.xxhash64(*ties), every) == 0)
             .groupBy(*named).agg(F.sort_array(F.collect_list(at)).alias("_some")))
    place, near = F.col("_p") / F.col("_cnt") * F.size("_some"), 4 * F.sqrt(F.size("_some") / 4) + 2
    low, high = F.floor(place - near).cast("int"), F.ceil(place + near).cast("int")
    brackets = ends.join(F.broadcast(drawn), same, "left").select(
        *keys, "_tile", "_p",
        F.when(low >= 1, F.get("_some", low - 1)).alias("_low"),
        F.when(high <= F.size("_some"), F.get("_some", high - 1)).alias("_high")).checkpoint(eager=True)
    below = F.coalesce(at < F.col("_low"), F.lit(False))
    inside = ~below & F.coalesce(at <= F.col("_high"), F.lit(True))
    counted = rows_of(brackets.select(*named, "_tile", "_low", "_high")).filter(below | inside).groupBy(*keys, "_tile").agg(
        F.count_if(below).alias("_r"), F.sum(F.when(below, pos)).alias("_bp"), F.sum(F.when(below, neg)).alias("_bn"),
        F.count_if(inside).alias("_in"))
    tell = [F.col(c).eqNullSafe(F.col(f"_k{c}")) for c in [*keys, "_tile"]]
    counted = counted.select(*named, F.col("_tile").alias("_k_tile"), "_r", "_bp", "_bn", "_in")
    found = brackets.join(F.broadcast(counted), tell, "left").withColumn(
        "_ok", F.coalesce((F.col("_p") >= F.col("_r")) & (F.col("_p") <= F.col("_r") + F.col("_in")), F.lit(False))).select(
        *keys, "_tile", "_p", "_low", "_high", "_ok", *[F.when(F.col("_ok"), F.coalesce(c, F.lit(0))).otherwise(0).alias(c)
                                                      for c in ("_r", "_bp", "_bn")]).checkpoint(eager=True)
    close = rows_of(found.select(*named, "_tile", "_p", "_r", "_low", "_high", "_ok")).filter(~F.col("_ok") | inside).select(
        *keys, *[c for c in ties if c not in keys], label, "_tile", (F.col("_p") - F.col("_r")).alias("_first")).checkpoint(eager=True)
    numbered = grouped_row_number(close, [*keys, "_tile"], list(ties), out="_rn", keep=[label, "_first"])
    head = numbered.filter(F.col("_rn") <= F.col("_first")).groupBy(*keys, "_tile").agg(
        F.sum(pos).alias("_hp"), F.sum(neg).alias("_hn")).select(
        *named, F.col("_tile").alias("_k_tile"), "_hp", "_hn")
    upto = found.join(F.broadcast(head), tell, "left").select(
        *keys, "_tile", "_p", (F.col("_bp") + F.coalesce("_hp", F.lit(0))).alias("_pos"),
        (F.col("_bn") + F.coalesce("_hn", F.lit(0))).alias("_neg"))
    last = wide.select(*keys, F.col("_t2").alias("_tile"), F.col("_cnt").alias("_p"), "_pos", "_neg")
    w = Window.partitionBy(*keys).orderBy("_tile")  # a row per tile of a run
    gain = lambda c: F.col(c) - F.lag(c, 1, 0).over(w)
    return upto.unionByName(last).select(*keys, "_tile", gain("_p").alias("_rows"), gain("_pos").alias("_t"),
                                         gain("_neg").alias("_nt")).withColumn(
        "_score_sum", F.col("_s").cast("double") * F.col("_rows"))


def ks_from_tiles(tiles: DataFrame, group: Sequence[str]) -> DataFrame:
    """KS (max |cumulative target % - cumulative non-target %| over tiles) per
    group, 2 dp, from a table of k rows per group."""
    run = Window.partitionBy(*group).orderBy("_tile").rowsBetween(Window.unboundedPreceding, 0)
    tot = Window.partitionBy(*group)
    nt = F.col("_nt")
    spread = F.abs(_pct(F.sum("_t").over(run), F.sum("_t").over(tot))
                   - _pct(F.sum(nt).over(run), F.sum(nt).over(tot)))
    return tiles.select(*group, spread.alias("_spread")).groupBy(*group).agg(
        F.round(F.max("_spread"), 2).alias("ks"))


def metrics_long(df: DataFrame, group: Sequence[str], ties: Sequence[Column | str],
                 score: str = "score", label: str = "label",
                 prediction: str = "prediction", k: int = 10) -> DataFrame:
    """``group…, metric, value`` with metric in {roc, accuracy, ks}; KS tiles
    follow (score desc, ties). One aggregation to score runs feeds all three."""
    runs = score_runs_by_group(df, group, score, label, prediction)
    aa = auc_accuracy_from_runs(runs, group)
    ks = ks_from_tiles(tile_counts_by_group(df, runs, group, score, ties, label, k), group)
    other = ks.select(*[F.col(c).alias(f"_k_{c}") for c in group], "ks")
    wide = aa.join(other, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in group])
    rows = F.explode(F.array(
        F.struct(F.lit("roc").alias("metric"), F.col("auc").alias("value")),
        F.struct(F.lit("accuracy").alias("metric"), F.col("accuracy").alias("value")),
        F.struct(F.lit("ks").alias("metric"), F.col("ks").cast("double").alias("value"))))
    return wide.select(*group, rows.alias("r")).select(*group, "r.metric", "r.value")


DATASETS = ["train", "valid", "test", "oot1", "oot2"]
METRICS = ["roc", "accuracy", "ks"]


def metrics_pivot(long: DataFrame, model: str = "model", dataset: str = "dataset") -> DataFrame:
    """One row per model, columns ``<metric>_<dataset>`` (15 for the reference's
    3 metrics x 5 datasets). Pivot values are listed, so no distinct pass."""
    names = [f"{m}_{d}" for d in DATASETS for m in METRICS]
    key = F.concat_ws("_", F.col("metric"), F.col(dataset))
    return long.withColumn("_key", key).groupBy(model).pivot("_key", names).agg(
        F.first("value"))


def select_champion(metrics: DataFrame, criterion: str = "roc", dataset: str = "test",
                    model: str = "model", checker: float = 0.03) -> DataFrame:
    """Champion/challenger: ``counter`` = number of the five datasets whose
    ``criterion`` differs from the chosen dataset's by more than ``checker``
    (x100 for KS); order by counter asc, chosen metric desc; label the first two.
    A missing value counts 0 (NaN comparisons are false in the reference)."""
    crit = criterion.lower()
    chk = checker * 100 if crit == "ks" else checker
    chosen = F.col(f"{crit}_{dataset.lower()}")
    counter = None
    for ds in DATASETS:
        term = F.coalesce((F.abs(chosen - F.col(f"{crit}_{ds}")) > chk).cast("int"), F.lit(0))
        counter = term if counter is None else counter + term
    t = metrics.withColumn("counter", counter)
    # one row per model: a bounded table, so an unpartitioned window is fine
    w = Window.orderBy(F.col("counter").asc(), chosen.desc_nulls_last(), F.col(model).asc())
    rn = F.row_number().over(w)
    return t.withColumn("selected_model", F.when(rn == 1, "Champion").when(rn == 2, "Challenger")
                        .otherwise(""))
