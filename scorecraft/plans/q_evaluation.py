"""Evaluation keys on the fixed-score view."""

from __future__ import annotations

from ..operators import evaluation as ev
from ..operators import score_state as ss
from ..session import scratch_path
from .registry import register
from .views import SCORE_ORDER_SQL, SCORE_VIEW_SQL, score_order, score_view, with_views

DECILES_SQL = f"""
d AS (SELECT label, score, prediction,
             ntile(10) OVER (ORDER BY {SCORE_ORDER_SQL}) AS deciles FROM score_view),
g AS (SELECT deciles, count(*) AS total, CAST(sum(label) AS BIGINT) AS label,
             CAST(sum(1 - label) AS BIGINT) AS non_target
      FROM d GROUP BY deciles),
c AS (SELECT *, sum(label) OVER (ORDER BY deciles) AS cum_target,
             sum(non_target) OVER (ORDER BY deciles) AS cum_non_target,
             sum(label) OVER () AS tt, sum(non_target) OVER () AS tn FROM g),
t AS (SELECT CAST(deciles AS INTEGER) AS deciles, CAST(total AS BIGINT) AS total, label,
             non_target, round(label * 100.0 / total, 2) AS "target_%",
             CAST(cum_target AS BIGINT) AS cum_target,
             CAST(cum_non_target AS BIGINT) AS cum_non_target,
             round(cum_target * 100.0 / tt, 2) AS target_dist,
             round(cum_non_target * 100.0 / tn, 2) AS non_target_dist,
             round(abs(cum_target * 100.0 / tt - cum_non_target * 100.0 / tn), 2) AS spread
      FROM c)
"""


def _decile_table(spark, sf_dir):
    return ev.decile_table(score_view(spark, sf_dir), "label", score_order())


register("decile_table", with_views(DECILES_SQL + "SELECT * FROM t",
                                    score_view=SCORE_VIEW_SQL))(_decile_table)


@register("ks_statistic", with_views(DECILES_SQL +
                                     "SELECT round(max(spread), 2) AS ks FROM t",
                                     score_view=SCORE_VIEW_SQL))
def _ks(spark, sf_dir):
    return ev.ks_statistic(_decile_table(spark, sf_dir))


# ------------------------------------------------------------ more evaluation
from pyspark.sql import functions as F  # noqa: E402

from .views import MODEL_SCORES_SQL, SCORE_TIE_KEYS, model_scores  # noqa: E402

_THRESH_SQL = """
c AS (SELECT score, CAST(sum(label) AS BIGINT) AS pos, CAST(sum(1 - label) AS BIGINT) AS neg
      FROM score_view GROUP BY score),
r AS (SELECT score, pos, neg,
             sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
             sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp,
             sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM c)
"""


@register("auc_roc", with_views(_THRESH_SQL + """
SELECT round(sum(neg * ((tp - pos) + tp) / 2.0) / (max(P) * max(N)), 6) AS auc FROM r""",
                                score_view=SCORE_VIEW_SQL))
def auc_roc(spark, d):
    return ev.auc_roc(score_view(spark, d), "score", "label")


@register("roc_points", with_views(_THRESH_SQL + """
SELECT round(score, 9) AS threshold, round(fp * 1.0 / N, 6) AS fpr, round(tp * 1.0 / P, 6) AS tpr
FROM r""", score_view=SCORE_VIEW_SQL))
def roc_points(spark, d):
    return ev.roc_points(score_view(spark, d)).withColumn("threshold", F.round("threshold", 9))


@register("pr_points", with_views(_THRESH_SQL + """
SELECT round(score, 9) AS threshold, round(tp * 1.0 / (tp + fp), 6) AS precision,
       round(tp * 1.0 / P, 6) AS recall FROM r""", score_view=SCORE_VIEW_SQL))
def pr_points(spark, d):
    return ev.pr_points(score_view(spark, d)).withColumn("threshold", F.round("threshold", 9))


@register("average_precision", with_views(_THRESH_SQL + """
SELECT round(sum(pos * tp * 1.0 / (tp + fp)) / max(P), 6) AS average_precision FROM r""",
                                          score_view=SCORE_VIEW_SQL))
def average_precision(spark, d):
    return ev.average_precision(score_view(spark, d))


@register("accuracy", with_views("""
SELECT round(avg(CASE WHEN prediction = label THEN 1 ELSE 0 END), 6) AS accuracy,
       round(1 - avg(CASE WHEN prediction = label THEN 1 ELSE 0 END), 6) AS test_error
FROM score_view""", score_view=SCORE_VIEW_SQL))
def accuracy(spark, d):
    return ev.accuracy(score_view(spark, d))


@register("confusion_matrix", with_views("""
SELECT label, prediction, count(*) AS count FROM score_view GROUP BY label, prediction""",
                                         score_view=SCORE_VIEW_SQL))
def confusion_matrix(spark, d):
    return ev.confusion_matrix(score_view(spark, d))


@register("precision_recall_f1", with_views("""
c AS (SELECT sum(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS tp,
             sum(CASE WHEN label = 0 AND prediction = 1 THEN 1 ELSE 0 END) AS fp,
             sum(CASE WHEN label = 1 AND prediction = 0 THEN 1 ELSE 0 END) AS fn FROM score_view),
p AS (SELECT tp * 1.0 / (tp + fp) AS pr, tp * 1.0 / (tp + fn) AS rc FROM c)
SELECT round(pr, 6) AS precision, round(rc, 6) AS recall, round(2 * pr * rc / (pr + rc), 6) AS f1
FROM p""", score_view=SCORE_VIEW_SQL))
def precision_recall_f1(spark, d):
    return ev.precision_recall_f1(score_view(spark, d))


@register("gains_lift_table", with_views(f"""
d AS (SELECT label, score, ntile(10) OVER (ORDER BY {SCORE_ORDER_SQL}) AS deciles
      FROM score_view),
g AS (SELECT deciles, avg(label) AS actual, avg(score) AS pred, sum(label) AS t FROM d
      GROUP BY deciles),
c AS (SELECT *, sum(t) OVER (ORDER BY deciles) * 100.0 / sum(t) OVER () AS dist FROM g)
SELECT CAST(deciles * 10 AS INTEGER) AS "DECILE", round(actual, 6) AS "ACTUAL",
       round(pred, 6) AS "PRED", round(dist, 4) AS "DIST_TAR",
       round(dist / (deciles * 10.0), 6) AS "LIFT"
FROM c""", score_view=SCORE_VIEW_SQL))
def gains_lift_table(spark, d):
    return ev.gains_lift_table(score_view(spark, d), "label", "score", score_order())


_TIES_SQL = ", ".join(SCORE_TIE_KEYS)
_METRICS_LONG_SQL = f"""
sc AS (SELECT model, dataset, score, sum(label) AS pos, count(*) AS cnt FROM ms
       GROUP BY model, dataset, score),
rk AS (SELECT *, sum(cnt) OVER (PARTITION BY model, dataset ORDER BY score
                                ROWS UNBOUNDED PRECEDING) - cnt + (cnt + 1) / 2.0 AS midrank
       FROM sc),
auc AS (SELECT model, dataset,
               round((sum(pos * midrank) - sum(pos) * (sum(pos) + 1) / 2.0)
                     / (sum(pos) * (sum(cnt) - sum(pos))), 6) AS v
        FROM rk GROUP BY model, dataset),
acc AS (SELECT model, dataset, round(avg(CASE WHEN prediction = label THEN 1 ELSE 0 END), 6) AS v
        FROM ms GROUP BY model, dataset),
tl AS (SELECT model, dataset, label,
              ntile(10) OVER (PARTITION BY model, dataset ORDER BY score DESC, {_TIES_SQL}) AS tile
       FROM ms),
tg AS (SELECT model, dataset, tile, sum(label) AS t, sum(1 - label) AS nt FROM tl
       GROUP BY model, dataset, tile),
tc AS (SELECT model, dataset,
              abs(sum(t) OVER (PARTITION BY model, dataset ORDER BY tile) * 100.0
                    / sum(t) OVER (PARTITION BY model, dataset)
                  - sum(nt) OVER (PARTITION BY model, dataset ORDER BY tile) * 100.0
                    / sum(nt) OVER (PARTITION BY model, dataset)) AS spread FROM tg),
ks AS (SELECT model, dataset, round(max(spread), 2) AS v FROM tc GROUP BY model, dataset),
ml AS (SELECT model, dataset, 'roc' AS metric, v AS value FROM auc
       UNION ALL SELECT model, dataset, 'accuracy', v FROM acc
       UNION ALL SELECT model, dataset, 'ks', v FROM ks)
"""


def _metrics_long(spark, d):
    ms = model_scores(spark, d)
    return ev.metrics_long(ms, ["model", "dataset"], [F.col(c).asc() for c in SCORE_TIE_KEYS])


_PIVOT_COLS = ", ".join(
    f"max(value) FILTER (WHERE metric = '{m}' AND dataset = '{ds}') AS {m}_{ds}"
    for ds in ev.DATASETS for m in ev.METRICS)
_PIVOT_SQL = _METRICS_LONG_SQL + f", pv AS (SELECT model, {_PIVOT_COLS} FROM ml GROUP BY model)\n"


@register("metrics_pivot", with_views(_PIVOT_SQL + "SELECT * FROM pv", ms=MODEL_SCORES_SQL))
def metrics_pivot(spark, d):
    return ev.metrics_pivot(_metrics_long(spark, d))


def _champion_sql(crit: str, ds: str, chk: float) -> str:
    terms = " + ".join(f"coalesce(CAST(abs({crit}_{ds} - {crit}_{o}) > {chk} AS INTEGER), 0)"
                       for o in ev.DATASETS)
    return (_PIVOT_SQL + f", ct AS (SELECT *, {terms} AS counter FROM pv)\n"
            "SELECT *, CASE row_number() OVER (ORDER BY counter ASC, "
            f"{crit}_{ds} DESC NULLS LAST, model ASC) WHEN 1 THEN 'Champion' "
            "WHEN 2 THEN 'Challenger' ELSE '' END AS selected_model FROM ct")


@register("select_champion", with_views(_champion_sql("ks", "test", 3.0), ms=MODEL_SCORES_SQL))
def select_champion(spark, d):
    return ev.select_champion(metrics_pivot(spark, d), criterion="ks", dataset="test")


# --------------------------------------------------- metrics over batches
@register("metrics_incremental", with_views("""
sc AS (SELECT model, score, sum(label) AS pos, sum(1 - label) AS neg,
              sum(CASE WHEN prediction = label THEN 1 ELSE 0 END) AS hits
       FROM ms GROUP BY model, score),
r AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER g AS p, sum(neg) OVER g AS n
      FROM sc WINDOW w AS (PARTITION BY model ORDER BY score DESC ROWS UNBOUNDED PRECEDING),
                     g AS (PARTITION BY model))
SELECT model, CAST(sum(pos + neg) AS BIGINT) AS n_rows, CAST(max(p) AS BIGINT) AS n_positive,
       round(sum(neg * (tp - pos / 2.0)) / (max(p) * max(n)), 6) AS auc,
       round(max(abs(tp * 1.0 / p - fp * 1.0 / n)) * 100, 4) AS ks,
       round(sum(pos * tp * 1.0 / (tp + fp)) / max(p), 6) AS average_precision,
       round(sum(hits) * 1.0 / sum(pos + neg), 6) AS accuracy
FROM r GROUP BY model""", ms=MODEL_SCORES_SQL))
def metrics_incremental(spark, d):
    # three batches arrive one after the other; the metrics are read from their states
    path = scratch_path(spark, "score-states")
    ms = model_scores(spark, d)
    for i in range(3):
        batch = ms.filter(F.col("l_orderkey") % 3 == i)
        ss.store_batch(ss.score_state(batch, by=["model"], prediction="prediction"), path, f"{i}")
    return ss.metrics_from_state(ss.merge_states(ss.read_states(spark, path), ["model"]), ["model"])
