"""Feature, model, clustering, text, run-log and UDF keys (SURVEY §2.12,
§2.14–2.18). Keys whose result comes from an iterative or random fit have no
oracle (rows-only check); the rest carry DuckDB SQL."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import clustering as cl
from ..operators import evaluation as ev
from ..operators import features as fe
from ..operators import models as md
from ..operators import runlog, sampling
from ..operators import text as tx
from ..session import ensure_checkpoint_dir, scratch_path, shuffle_partitions
from ..sources import io
from .registry import register
from .views import (BANK_CATEGORICAL, BANK_KEYS, BANK_NUMERIC, BANK_VIEW_SQL, MISSING_VIEW_SQL,
                    MOVIE_VIEW_SQL, SCORE_VIEW_SQL, bank_view, customer_features,
                    missing_view, movie_view, score_order, score_view, table, with_views)
from .q_evaluation import DECILES_SQL

INDEXED = [f"{c}_index" for c in BANK_CATEGORICAL]
MODEL_FEATURES = BANK_NUMERIC + INDEXED


# ------------------------------------------------------------------ features
def _index_sql() -> str:
    ctes = []
    joins = []
    cols = []
    for i, c in enumerate(BANK_CATEGORICAL):
        ctes.append(f"""i{i} AS (SELECT {c} AS v, CAST(row_number() OVER (ORDER BY cnt DESC, {c})
                                 - 1 AS DOUBLE) AS ix
             FROM (SELECT {c}, count(*) AS cnt FROM bank_view GROUP BY {c}))""")
        joins.append(f"JOIN i{i} ON b.{c} = i{i}.v")
        cols.append(f"i{i}.ix AS {c}_index")
    keys = ", ".join(f"b.{k}" for k in BANK_KEYS)
    return with_views(",\n".join(ctes) + f"\nSELECT {keys}, {', '.join(cols)} FROM bank_view b "
                      + " ".join(joins), bank_view=BANK_VIEW_SQL)


def _indexed(spark, d, partitions=None):
    return fe.category_index(bank_view(spark, d, partitions), BANK_CATEGORICAL)


@register("category_index", _index_sql())
def category_index(spark, d):
    df, _ = _indexed(spark, d)
    return df.select(*BANK_KEYS, *INDEXED)


@register("index_to_category", with_views(
    "SELECT " + ", ".join(BANK_KEYS) + ", "
    + ", ".join(f"{c} AS {c}_label" for c in BANK_CATEGORICAL) + " FROM bank_view",
    bank_view=BANK_VIEW_SQL))
def index_to_category(spark, d):
    df, model = _indexed(spark, d)
    back = fe.index_to_category(df, model, BANK_CATEGORICAL)
    return back.select(*BANK_KEYS, *[f"{c}_label" for c in BANK_CATEGORICAL])


_PART_ROWS = 400_000


def _layout(spark, d) -> tuple[int, int | None]:
    """Parts of a model's rows, and of the join behind them (None: Spark's choice). The
    session's shuffle partitions until these would hold more than ``_PART_ROWS`` rows
    each, so that no task reads more as the tables grow."""
    usual = shuffle_partitions(spark)
    n = -(-table(spark, d, "lineitem").count() // _PART_ROWS)  # from the file's footers
    return max(usual, n), n if n > usual else None


@contextmanager
def _wide_shuffles(spark, d) -> Iterator:
    """Shuffles inside the block have the parts of ``_layout``: where scores hardly repeat,
    a grouping or sort by score holds as many rows as the table. The session's setting comes
    back after the block, so the work must be done in it (checkpointed or ``_stored``)."""
    usual, (n, _) = shuffle_partitions(spark), _layout(spark, d)
    spark.conf.set("spark.sql.shuffle.partitions", n)
    try:
        yield n
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)


@contextmanager
def _kept_rows(rows, n) -> Iterator:
    """``rows`` in a fixed layout, worked out once and kept for all scans of the fits
    inside the block. What is read after the block must be stored (``_stored``)."""
    kept = md.stable(rows, BANK_KEYS, n).persist()
    try:
        yield kept
    finally:
        kept.unpersist()


@contextmanager
def _model_frame(spark, d, label="label", features=MODEL_FEATURES, keep=BANK_KEYS) -> Iterator:
    """Keys, label and feature vector. Kept are the plain columns, indices as whole
    numbers (they take few bytes); each scan puts its vectors together."""
    n, joined = _layout(spark, d)
    with _wide_shuffles(spark, d):  # also the join of orders and customers
        df, _ = _indexed(spark, d, joined)
        cols = dict.fromkeys([*keep, label, *features])
        whole = [c for c in cols if c in INDEXED]
        with _kept_rows(df.select(*cols).withColumns({c: F.col(c).cast("int") for c in whole}), n) as rows:
            yield md.assembled(rows.withColumns({c: F.col(c).cast("double") for c in whole}),
                               features, label, keep=keep)


def _stored(df, name):
    """``df`` written to the shared folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _assemble_sql() -> str:
    head, tail = _index_sql().rsplit("SELECT", 1)
    raw = ", ".join(f"CAST(b.{c} AS DOUBLE) AS {c}" for c in BANK_NUMERIC)
    return f"{head}SELECT CAST(b.label AS DOUBLE) AS label, {raw},{tail}"


@register("assemble_features", _assemble_sql())
def assemble_features(spark, d):
    df, _ = _indexed(spark, d)
    vec = fe.assemble_vectors(df, MODEL_FEATURES, "label", keep=BANK_KEYS)
    return fe.vector_columns(vec, "features", MODEL_FEATURES, keep=BANK_KEYS + ["label"])


@register("standard_scale", with_views(
    "SELECT " + ", ".join(BANK_KEYS) + ", "
    + ", ".join(f"round({c} / stddev_samp({c}) OVER (), 6) AS {c}" for c in BANK_NUMERIC)
    + " FROM bank_view", bank_view=BANK_VIEW_SQL))
def standard_scale(spark, d):
    b = bank_view(spark, d)
    model = fe.scale_pipeline(BANK_NUMERIC).fit(b)
    return fe.vector_columns(model.transform(b), "scaled", BANK_NUMERIC, keep=BANK_KEYS)


_L1 = ["l_quantity", "l_discount", "l_tax"]


@register("l1_normalize", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       round(l_quantity / (abs(l_quantity) + abs(l_discount) + abs(l_tax)), 6) AS l_quantity,
       round(l_discount / (abs(l_quantity) + abs(l_discount) + abs(l_tax)), 6) AS l_discount,
       round(l_tax / (abs(l_quantity) + abs(l_discount) + abs(l_tax)), 6) AS l_tax
FROM lineitem""")
def l1_normalize(spark, d):
    li = table(spark, d, "lineitem")
    out = fe.l1_normalize(li, _L1)
    return fe.vector_columns(out, "normalized", _L1, keep=BANK_KEYS)


_IMPUTE = ["l_tax", "l_discount", "l_extendedprice"]


@register("mean_impute", with_views(
    "SELECT l_orderkey, l_linenumber, " + ", ".join(
        f"round(coalesce(CASE WHEN isnan({c}) THEN NULL ELSE {c} END, "
        f"(SELECT avg({c}) FROM m WHERE NOT isnan({c}))), 6) AS {c}" for c in _IMPUTE)
    + " FROM m", m=MISSING_VIEW_SQL))
def mean_impute(spark, d):
    m = missing_view(spark, d).select("l_orderkey", "l_linenumber", *_IMPUTE)
    out = fe.mean_impute(m, _IMPUTE)
    return out.select("l_orderkey", "l_linenumber", *[F.round(c, 6).alias(c) for c in _IMPUTE])


@register("feature_names")
def feature_names(spark, d):
    df, _ = _indexed(spark, d)
    return fe.feature_names(fe.assemble_vectors(df, MODEL_FEATURES, "label"))


@register("pca_project")
def pca_project(spark, d):
    b = bank_view(spark, d)
    model = fe.pca_fit(b, BANK_NUMERIC, k=3, scaled=True)
    return fe.vector_columns(model.transform(b), "pca", ["pc1", "pc2", "pc3"], keep=BANK_KEYS)


@register("pca_project_raw")
def pca_project_raw(spark, d):
    b = bank_view(spark, d)
    model = fe.pca_fit(b, BANK_NUMERIC, k=3, scaled=False)
    return fe.vector_columns(model.transform(b), "pca", ["pc1", "pc2", "pc3"], keep=BANK_KEYS)


@register("pca_loadings")
def pca_loadings(spark, d):
    """Loadings of the raw and the scaled fit."""
    b, parts = bank_view(spark, d), []
    for name, scaled in (("raw", False), ("scaled", True)):
        model = fe.pca_fit(b, BANK_NUMERIC, k=3, scaled=scaled)
        parts.append(fe.pca_loadings(model, BANK_NUMERIC, spark).withColumn("fit", F.lit(name)))
    return parts[0].unionByName(parts[1])


@register("pca_explained_pair", with_views("""
m AS (SELECT var_samp(l_quantity) AS a, var_samp(l_discount) AS c,
             covar_samp(l_quantity, l_discount) AS b FROM bank_view),
e AS (SELECT (a + c) / 2 AS mid, sqrt((a - c) * (a - c) / 4 + b * b) AS half FROM m),
v AS (SELECT 1 AS component, (mid + half) / (2 * mid) AS explained FROM e
      UNION ALL SELECT 2, (mid - half) / (2 * mid) FROM e)
SELECT CAST(component AS INTEGER) AS component, round(explained, 6) AS explained,
       round(sum(explained) OVER (ORDER BY component), 6) AS cumulative FROM v""",
                                            bank_view=BANK_VIEW_SQL))
def pca_explained_pair(spark, d):
    # two features have a closed form that SQL can state
    pair = ["l_quantity", "l_discount"]
    model = fe.pca_fit(bank_view(spark, d), pair, k=2, scaled=False)
    return fe.pca_explained(model, pair, spark).select(
        "component", F.round("explained", 6).alias("explained"),
        F.round("cumulative", 6).alias("cumulative"))


@register("pca_explained")
def pca_explained(spark, d):
    model = fe.pca_fit(bank_view(spark, d), BANK_NUMERIC, k=3, scaled=True)
    return fe.pca_explained(model, BANK_NUMERIC, spark)


@register("svd_values")
def svd_values(spark, d):
    return fe.svd_values(bank_view(spark, d), BANK_NUMERIC, k=5)


@register("svd_values_pair", with_views("""
m AS (SELECT sum(l_quantity * l_quantity) AS a, sum(l_discount * l_discount) AS c,
             sum(l_quantity * l_discount) AS b FROM bank_view),
e AS (SELECT (a + c) / 2 AS mid, sqrt((a - c) * (a - c) / 4 + b * b) AS half FROM m)
SELECT CAST(1 AS INTEGER) AS component, round(sqrt(mid + half), 4) AS singular_value FROM e
UNION ALL SELECT 2, round(sqrt(mid - half), 4) FROM e""", bank_view=BANK_VIEW_SQL))
def svd_values_pair(spark, d):
    out = fe.svd_values(bank_view(spark, d), ["l_quantity", "l_discount"], k=2)
    return out.withColumn("singular_value", F.round("singular_value", 4))


@register("svd_vectors")
def svd_vectors(spark, d):
    return fe.svd_vectors(bank_view(spark, d), BANK_NUMERIC, k=5)


@register("svd_project")
def svd_project(spark, d):
    return fe.svd_project(bank_view(spark, d), BANK_NUMERIC, k=5, keep=BANK_KEYS)


@register("prepare_dataset")
def prepare_dataset(spark, d):
    li = table(spark, d, "lineitem")
    x = li.select("l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                  "l_returnflag", "l_linestatus")
    y = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.when(F.col("o_orderstatus") == "F", 0).otherwise(1).alias("label"))
    prepared, feats = fe.prepare_dataset(x, y, "l_orderkey", "label")
    return fe.vector_columns(prepared, "scaled", feats, keep=["split", "label"])


# ------------------------------------------------------------------- models
@register("linear_regression", with_views("""
cv AS (SELECT l_extendedprice, l_extendedprice * (1 - l_discount) AS y FROM bank_view)
SELECT 'l_extendedprice' AS feature, round(regr_slope(y, l_extendedprice), 6) AS coefficient
FROM cv
UNION ALL SELECT '(intercept)' AS feature, round(regr_intercept(y, l_extendedprice), 4)
FROM cv""", bank_view=BANK_VIEW_SQL))
def linear_regression(spark, d):
    b = bank_view(spark, d).withColumn("y", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    model = md.linear_regression(md.assembled(b, ["l_extendedprice"], "y"))
    tbl = md.coefficients_table(model, ["l_extendedprice"], spark)
    return tbl.select("feature", F.when(F.col("feature") == "(intercept)",
                                        F.round("coefficient", 4))
                      .otherwise(F.round("coefficient", 6)).alias("coefficient"))


@register("logistic_binomial")
def logistic_binomial(spark, d):
    with _model_frame(spark, d) as frame:
        model = md.logistic(frame, "binomial", max_iter=10)
    return md.coefficients_table(model, MODEL_FEATURES, spark)


_PRIORITY = "o_orderpriority_index"
_PRIORITY_FEATURES = BANK_NUMERIC + [c for c in INDEXED if c != _PRIORITY]


@register("logistic_multinomial")
def logistic_multinomial(spark, d):
    with _model_frame(spark, d, _PRIORITY, _PRIORITY_FEATURES) as frame:
        model = md.logistic(frame, "multinomial", max_iter=10)
    return md.coefficient_matrix_table(model, _PRIORITY_FEATURES, spark)


def _fit_summary(spark, name, model, test, metric):
    return spark.createDataFrame([(name, float(metric(model.transform(test))))],
                                 "model string, metric double")


@register("tree_classifier")
def tree_classifier(spark, d):
    rows = []
    with _model_frame(spark, d) as frame:
        train, test = frame.randomSplit([0.7, 0.3], 2023)
        for imp in ("gini", "entropy"):
            m = md.decision_tree(train, imp, 5)
            auc = float(md.binary_auc(m.transform(test)))
            rows += [(imp, m.depth, m.numNodes, auc, i, line) for i, line in md.tree_lines(m)]
    return spark.createDataFrame(rows, "impurity string, depth int, nodes int, test_auc double, "
                                       "line int, tree string")


@register("tree_regressor")
def tree_regressor(spark, d):
    with _model_frame(spark, d, "l_extendedprice") as frame:
        train, test = frame.randomSplit([0.7, 0.3], 2023)
        return _fit_summary(spark, "tree_regressor", md.tree_regressor(train), test,
                            md.regression_metric)


@register("tree_regressor_lines")
def tree_regressor_lines(spark, d):
    """The fitted regression tree, whole: one row per line of its description."""
    with _model_frame(spark, d, "l_extendedprice") as frame:
        model = md.tree_regressor(frame)
    return spark.createDataFrame(md.tree_lines(model), "line int, tree string")


@register("forest_classifier")
def forest_classifier(spark, d):
    with _model_frame(spark, d) as frame:
        train, test = frame.randomSplit([0.7, 0.3], 2023)
        model = md.random_forest(train)
        pred = md.probability_of_one(model.transform(test))
        return _stored(pred.select(*BANK_KEYS, "label", F.round("p1", 6).alias("p1"), "prediction"),
                       "forest-scores")


@register("forest_regressor")
def forest_regressor(spark, d):
    with _model_frame(spark, d, "l_extendedprice") as frame:
        train, test = frame.randomSplit([0.7, 0.3], 2023)
        return _fit_summary(spark, "forest_regressor", md.forest_regressor(train), test,
                            md.regression_metric)


@register("gbt_classifier")
def gbt_classifier(spark, d):
    with _model_frame(spark, d) as frame:
        train, test = frame.randomSplit([0.7, 0.3], 2023)
        return _fit_summary(spark, "gbt_classifier", md.gbt(train), test, md.binary_auc)


@register("gbt_regressor")
def gbt_regressor(spark, d):
    with _model_frame(spark, d, "l_extendedprice") as frame:
        train, test = frame.randomSplit([0.7, 0.3], 2023)
        return _fit_summary(spark, "gbt_regressor", md.gbt_regressor(train), test,
                            md.regression_metric)


@register("linear_svc")
def linear_svc(spark, d):
    with _model_frame(spark, d) as frame:
        train, test = frame.randomSplit([0.7, 0.3], 2023)
        return _fit_summary(spark, "linear_svc", md.linear_svc(train), test, md.binary_auc)


@register("mlp_classifier")
def mlp_classifier(spark, d):
    with _model_frame(spark, d) as frame:
        train, test = frame.randomSplit([0.7, 0.3], 2023)
        model = md.mlp(train, len(MODEL_FEATURES), 2, max_iter=100)
        return _fit_summary(spark, "mlp_classifier", model, test, md.multiclass_metric)


@register("one_vs_rest")
def one_vs_rest(spark, d):
    with _model_frame(spark, d, _PRIORITY, _PRIORITY_FEATURES) as frame:
        train, test = frame.randomSplit([0.7, 0.3], 2023)
        model = md.one_vs_rest(train)
        acc = md.multiclass_metric(model.transform(test))
    return spark.createDataFrame([("one_vs_rest", acc, 1 - acc)],
                                 "model string, accuracy double, test_error double")


@register("naive_bayes")
def naive_bayes(spark, d):
    feats = ["l_quantity", "l_discount", "l_tax"] + INDEXED  # non-negative features
    with _model_frame(spark, d, features=feats) as frame:
        train, test = frame.randomSplit([0.7, 0.3], 2023)
        return _fit_summary(spark, "naive_bayes", md.naive_bayes(train), test, md.multiclass_metric)


@register("train_valid_search")
def train_valid_search(spark, d):
    with _model_frame(spark, d) as frame:
        return md.search_table(md.train_valid_search(frame), spark)


@register("cross_validate")
def cross_validate(spark, d):
    with _model_frame(spark, d) as frame:
        return md.search_table(md.cross_validate(frame, folds=3), spark)


@register("leave_one_group_out")
def leave_one_group_out(spark, d):
    with (_model_frame(spark, d, keep=BANK_KEYS + ["c_mktsegment"]) as frame,
          _wide_shuffles(spark, d)):
        return md.leave_one_group_out(
            frame, "c_mktsegment", md.logistic_estimator("binomial", max_iter=10))


@register("chi_square_select")
def chi_square_select(spark, d):
    df, _ = _indexed(spark, d)
    frame = md.assembled(df, INDEXED, "label")
    return md.chi_square_select(frame, INDEXED, top=3)


def _rf_importance(spark, frame):
    return md.importances_table(md.random_forest(frame), MODEL_FEATURES, spark, "random_forest")


@register("rf_importance")
def rf_importance(spark, d):
    with _model_frame(spark, d) as frame:
        return _rf_importance(spark, frame)


def _importance_long(spark, d):
    with _model_frame(spark, d) as frame:
        parts = [md.importances_table(md.decision_tree(frame), MODEL_FEATURES, spark,
                                      "decision_tree"),
                 md.importances_table(md.gbt(frame), MODEL_FEATURES, spark, "gradient_boosting"),
                 _rf_importance(spark, frame)]
        lr = md.logistic(frame, "binomial", max_iter=10)
    coef = [(("logistic"), f, abs(float(c))) for f, c in zip(MODEL_FEATURES,
                                                            lr.coefficients.toArray())]
    parts.append(spark.createDataFrame(coef, "method string, feature string, score double"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("importance_by_method")
def importance_by_method(spark, d):
    return _importance_long(spark, d)


@register("voting_by_importance")
def voting_by_importance(spark, d):
    from ..operators.selection import voting
    return voting(_importance_long(spark, d), top_n=7)


@register("probability_of_one")
def probability_of_one(spark, d):
    with _model_frame(spark, d) as frame:
        model = md.logistic(frame, "binomial", max_iter=10)
        pred = md.probability_of_one(model.transform(frame))
        return _stored(pred.select(*BANK_KEYS, "label", F.round("p1", 6).alias("p1")), "chances")


def _validation_scores(frame):
    """One model fitted on ``train`` and scored on all five datasets (split by
    key arithmetic as the metric views are)."""
    frame = frame.withColumn("dataset", sampling.hash_split(
        F.col("l_orderkey"), [40, 20, 20, 10, 10], ev.DATASETS, multiplier=7919))
    model = md.logistic(frame.filter(F.col("dataset") == "train"), "binomial", max_iter=10)
    pred = md.probability_of_one(model.transform(frame))
    return _stored(pred.select(*BANK_KEYS, "dataset", F.col("label").cast("int").alias("label"),
                               F.col("p1").alias("score"), "prediction"), "validation-scores")


def _validation(scores):
    long = ev.metrics_long(scores, ["dataset"], [F.col(k).asc() for k in BANK_KEYS])
    return long.groupBy("dataset").pivot("metric", ev.METRICS).agg(F.first("value"))


@register("model_validation")
def model_validation(spark, d):
    """ROC, accuracy and KS of one fitted model on each of the five datasets."""
    with _model_frame(spark, d) as frame:
        scores = _validation_scores(frame)
    with _wide_shuffles(spark, d):
        return _validation(scores)


@register("model_validation_tables")
def model_validation_tables(spark, d):
    """The tables behind it: each dataset's decile table with its confusion counts."""
    with _model_frame(spark, d) as frame:
        scores = _validation_scores(frame)
    order = [F.col("score").desc()] + [F.col(k).asc() for k in BANK_KEYS]
    out = None
    for name in ev.DATASETS:
        part = scores.filter(F.col("dataset") == name)
        hits = ev.confusion_matrix(part).groupBy().agg(*[
            F.coalesce(F.sum(F.when((F.col("label") == y) & (F.col("prediction") == p), F.col("count"))),
                       F.lit(0)).alias(n)
            for n, y, p in (("tp", 1, 1), ("fp", 0, 1), ("fn", 1, 0), ("tn", 0, 0))])
        with _wide_shuffles(spark, d):
            tbl = ev.decile_table(part, "label", order).withColumn("dataset", F.lit(name))
        tbl = tbl.join(F.broadcast(hits))  # one row
        out = tbl if out is None else out.unionByName(tbl)
    return out


@register("metrics_export")
def metrics_export(spark, d):
    """Metric and importance reports written and read back."""
    with _model_frame(spark, d) as frame:  # both models read the same rows
        scores, importance = _validation_scores(frame), _rf_importance(spark, frame)
    with _wide_shuffles(spark, d):
        metrics = _validation(scores)
    metrics = metrics.select(
        F.lit("metrics").alias("report"), F.col("dataset").alias("name"), F.col("ks").alias("value"))
    top = importance.orderBy(F.desc("score"), "feature").limit(30)  # a top-30 report
    both = metrics.unionByName(top.select(
        F.lit("importance").alias("report"), F.col("feature").alias("name"),
        F.col("score").alias("value")))
    return spark.read.parquet(io.export_report(both, io.fresh_path(spark, "reports")))


# ------------------------------------------------------------ run log / store
_RUN_SQL = with_views(DECILES_SQL + """,
sc AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM score_view GROUP BY score),
rr AS (SELECT *, sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
              sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM sc),
m AS (SELECT round(sum(neg * ((tp - pos) + tp) / 2.0) / (max(P) * max(N)), 6) AS auc FROM rr)
SELECT 'param' AS kind, 'n_bins' AS name, 10.0 AS value
UNION ALL SELECT 'param', 'seed', 12345.0
UNION ALL SELECT 'metric', 'auc', auc FROM m
UNION ALL SELECT 'metric', 'ks', (SELECT round(max(spread), 2) FROM t)
UNION ALL SELECT 'metric', 'accuracy',
  (SELECT round(avg(CASE WHEN prediction = label THEN 1 ELSE 0 END), 6) FROM score_view)""",
                      score_view=SCORE_VIEW_SQL)


@register("run_log", _RUN_SQL)
def run_log(spark, d):
    s = score_view(spark, d)
    auc = ev.auc_roc(s)
    ks = ev.ks_statistic(ev.decile_table(s, "label", score_order()))
    acc = ev.accuracy(s).select("accuracy")
    metrics = auc.select("auc", ks.scalar().alias("ks"), acc.scalar().alias("accuracy"))
    path = scratch_path(spark, "run_log")
    rid = runlog.log_run(spark, path, {"n_bins": 10, "seed": 12345}, metrics)
    return runlog.read_runs(spark, path, rid).select("kind", "name", "value")


@contextmanager
def _stored_pipeline(spark, d) -> Iterator:
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import StringIndexer, VectorAssembler

    n, joined = _layout(spark, d)
    pipe = Pipeline(stages=[
        StringIndexer(inputCols=BANK_CATEGORICAL, outputCols=INDEXED, handleInvalid="keep"),
        VectorAssembler(inputCols=MODEL_FEATURES, outputCol="features"),
        LogisticRegression(featuresCol="features", labelCol="label", maxIter=10)])
    with _wide_shuffles(spark, d), _kept_rows(bank_view(spark, d, joined), n) as b:
        yield b, runlog.save_model(pipe.fit(b), scratch_path(spark, "pipeline_model"))


@register("model_roundtrip_scores")
def model_roundtrip_scores(spark, d):
    with _stored_pipeline(spark, d) as (b, path):
        pred = md.probability_of_one(runlog.load_model(path).transform(b))
        with _wide_shuffles(spark, d):
            return _stored(ev.auc_roc(pred, "p1", "label"), "auc")


@register("batch_score")
def batch_score(spark, d):
    with _stored_pipeline(spark, d) as (b, path):
        scored = runlog.batch_score(runlog.load_model(path), b, keep=BANK_KEYS)
        return _stored(scored.select(*BANK_KEYS, F.round("p1", 6).alias("p1"), "prediction", "label"),
                       "batch-scores")


# ---------------------------------------------------------------- UDF parity
_CATS = T.StructType([T.StructField("budget_cat", T.StringType()),
                      T.StructField("popularity_cat", T.StringType())])


@F.pandas_udf(_CATS)
def _categories(budget: pd.Series, popularity: pd.Series) -> pd.DataFrame:
    """Arrow-batched twin of the native ``case_bucket`` struct; NULL -> last
    branch, as the native CASE does."""
    b = pd.Series("Big", index=budget.index)
    b[budget < 300000] = "Medium"
    b[budget < 100000] = "Small"
    p = pd.Series("High", index=popularity.index)
    p[popularity < 35] = "Mid"
    p[popularity < 15] = "Low"
    return pd.DataFrame({"budget_cat": b, "popularity_cat": p})


@register("struct_udf", with_views("""
SELECT id, line,
       CASE WHEN budget < 100000 THEN 'Small' WHEN budget < 300000 THEN 'Medium'
            ELSE 'Big' END AS budget_cat,
       CASE WHEN popularity < 15 THEN 'Low' WHEN popularity < 35 THEN 'Mid'
            ELSE 'High' END AS popularity_cat
FROM movie_view""", movie_view=MOVIE_VIEW_SQL))
def struct_udf(spark, d):
    m = movie_view(spark, d)
    cats = _categories(F.col("budget"), F.col("popularity"))
    return m.select("id", "line", cats.alias("c")).select("id", "line", "c.budget_cat",
                                                           "c.popularity_cat")


# ---------------------------------------------------------------- clustering
def _cluster_frame(spark, d):
    cf = customer_features(spark, d)
    feats = ["n_orders", "sum_price", "avg_price", "c_acctbal", "n_months"]
    imputed = fe.mean_impute(cf, feats)
    return fe.assemble_vectors(imputed, feats, keep=["c_custkey"]), feats


@register("kmeans_assign")
def kmeans_assign(spark, d):
    df, _ = _cluster_frame(spark, d)
    return cl.kmeans(df, 2, 1003).transform(df).select("c_custkey", "prediction")


@register("kmeans_centers")
def kmeans_centers(spark, d):
    df, feats = _cluster_frame(spark, d)
    return cl.centers_table(cl.kmeans(df, 2, 1003), feats, spark)


@register("bisecting_kmeans_assign")
def bisecting_kmeans_assign(spark, d):
    df, _ = _cluster_frame(spark, d)
    return cl.bisecting_kmeans(df, 2, 1).transform(df).select("c_custkey", "prediction")


@register("kmeans_k_sweep")
def kmeans_k_sweep(spark, d):
    df, _ = _cluster_frame(spark, d)
    return cl.k_sweep(df, range(2, 8), "kmeans", 1003)


@register("bisecting_k_sweep")
def bisecting_k_sweep(spark, d):
    df, _ = _cluster_frame(spark, d)
    return cl.k_sweep(df, range(2, 8), "bisecting", 1)


@register("l1_normalized_kmeans")
def l1_normalized_kmeans(spark, d):
    """Embeddings, L1-normalised, clustered (k=2) — vector input path."""
    from pyspark.ml.functions import array_to_vector

    e = table(spark, d, "embeddings").select("vec_id", array_to_vector("embedding").alias("v"))
    from pyspark.ml.feature import Normalizer
    normed = Normalizer(inputCol="v", outputCol="features", p=1.0).transform(e)
    return cl.kmeans(normed, 2, 1003).transform(normed).select("vec_id", "prediction")


# ---------------------------------------------------------------------- text
_STOP_SQL = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in tx.STOP_WORDS) + "]"
_TOKENS_SQL = f"""
tk AS (SELECT doc_id, list_filter(string_split(lower(trim(text)), ' '),
                  lambda t: regexp_full_match(t, '\\p{{L}}+') AND length(t) >= 4
                            AND NOT list_contains({_STOP_SQL}, t)) AS toks
       FROM documents WHERE text IS NOT NULL)"""


def _docs(spark, d):
    return table(spark, d, "documents").select("doc_id", "text")


@register("tokenize_documents", f"""WITH {_TOKENS_SQL}
SELECT doc_id, array_to_string(toks, ' ') AS tokens, CAST(len(toks) AS INTEGER) AS n_tokens
FROM tk""")
def tokenize_documents(spark, d):
    t = tx.tokenize(_docs(spark, d))
    return t.select("doc_id", F.array_join("tokens", " ").alias("tokens"),
                    F.size("tokens").alias("n_tokens"))


_TERMS_SQL = _TOKENS_SQL + """,
ex AS (SELECT doc_id, unnest(toks) AS term FROM tk),
pd AS (SELECT doc_id, term, count(*) AS n FROM ex GROUP BY ALL),
ts AS (SELECT term, count(*) AS df, sum(n) AS tf FROM pd GROUP BY term),
vocab AS (SELECT * FROM ts WHERE df >= 10),
m AS (SELECT count(*) AS m FROM tk)"""


@register("vocabulary_table", f"""WITH {_TERMS_SQL}
SELECT term, df, CAST(tf AS BIGINT) AS tf FROM vocab""")
def vocabulary_table(spark, d):
    return tx.vocabulary_table(tx.tokenize(_docs(spark, d)))


@register("idf_table", f"""WITH {_TERMS_SQL}
SELECT term, round(ln((m + 1.0) / (df + 1.0)), 6) AS idf FROM vocab, m""")
def idf_table(spark, d):
    return tx.idf_table(tx.tokenize(_docs(spark, d)))


@register("tfidf_terms", f"""WITH {_TERMS_SQL}
SELECT pd.doc_id, pd.term, round(pd.n * ln((m + 1.0) / (vocab.df + 1.0)), 6) AS tfidf
FROM pd JOIN vocab ON pd.term = vocab.term, m""")
def tfidf_terms(spark, d):
    return tx.tfidf_terms(tx.tokenize(_docs(spark, d)))


def _lda(spark, d):
    # 5000 terms is the size of the topic model's vectors, an argument of the fit
    w, cv, _ = tx.tfidf(tx.tokenize(_docs(spark, d)), vocab_size=5000)
    # iterations re-read the input: materialise it once (reliable checkpoint)
    ensure_checkpoint_dir(spark)
    w = md.stable(w, ["doc_id"]).checkpoint()
    return w, cv, tx.lda_fit(w, k=10, max_iter=100)


@register("lda_topic_mix")
def lda_topic_mix(spark, d):
    w, _, model = _lda(spark, d)
    from pyspark.ml.functions import vector_to_array
    return model.transform(w).select("doc_id", vector_to_array("topicDistribution")
                                     .alias("topic_mix"))


@register("lda_topic_terms")
def lda_topic_terms(spark, d):
    _, cv, model = _lda(spark, d)
    return tx.lda_topic_terms(model, cv, spark, 5)
