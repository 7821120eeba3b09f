"""Supervised models, searches and validation on MLlib estimators.

Every fit is a distributed MLlib job; what comes back to the driver is the
fitted model (coefficients, trees), which is bounded by the feature count and
model size, never by the rows. Results are returned as DataFrames.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC,
                                       LogisticRegression, MultilayerPerceptronClassifier,
                                       NaiveBayes, OneVsRest, RandomForestClassifier)
from pyspark.ml.evaluation import (BinaryClassificationEvaluator,
                                   MulticlassClassificationEvaluator, RegressionEvaluator)
from pyspark.ml.feature import UnivariateFeatureSelector, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, LinearRegression,
                                   RandomForestRegressor)
from pyspark.ml.stat import ChiSquareTest
from pyspark.ml.tuning import (CrossValidator, CrossValidatorModel, ParamGridBuilder,
                               TrainValidationSplit, TrainValidationSplitModel)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import areas_under_roc, logistic_fits, packed
from .evaluation import auc_roc


def assembled(df: DataFrame, features: Sequence[str], label: str = "label",
              keep: Sequence[str] = ()) -> DataFrame:
    """Feature vector and label. A NULL feature raises: impute first, so that
    no row is lost between the table and its scores."""
    vec = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")
    return vec.transform(df).select(*keep, F.col(label).cast("double").alias("label"),
                                    "features")


def stable(df: DataFrame, key: Sequence[str], n: int | None = None) -> DataFrame:
    """Fix the row layout before a seeded fit so repeated runs agree."""
    n = n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8"))
    return df.repartition(n, *key).sortWithinPartitions(*key)


def probability_of_one(pred: DataFrame, col: str = "probability", out: str = "p1") -> DataFrame:
    """Class-1 probability pulled out of the probability vector (no UDF)."""
    return pred.withColumn(out, vector_to_array(F.col(col))[1])


def coefficients_table(model, features: Sequence[str], spark) -> DataFrame:
    rows = [(f, float(c)) for f, c in zip(features, model.coefficients.toArray())]
    rows.append(("(intercept)", float(model.intercept)))
    return spark.createDataFrame(rows, "feature string, coefficient double")


def coefficient_matrix_table(model, features: Sequence[str], spark) -> DataFrame:
    m = model.coefficientMatrix.toArray()
    rows = [(int(k), f, float(m[k, j])) for k in range(m.shape[0])
            for j, f in enumerate(features)]
    rows += [(int(k), "(intercept)", float(v))
             for k, v in enumerate(model.interceptVector.toArray())]
    return spark.createDataFrame(rows, "class int, feature string, coefficient double")


def importances_table(model, features: Sequence[str], spark, method: str = "") -> DataFrame:
    imp = model.featureImportances.toArray()
    rows = [(method, f, float(v)) for f, v in zip(features, imp)]
    return spark.createDataFrame(rows, "method string, feature string, score double").orderBy(
        F.desc("score"))


def tree_lines(model) -> list[tuple[int, str]]:
    """A fitted tree's whole description, numbered line by line (its size is the
    model's, at most 2^(depth+1) nodes)."""
    return list(enumerate(model.toDebugString.rstrip().split("\n")))


# ------------------------------------------------------------------- fitters
def linear_regression(train: DataFrame):
    return LinearRegression(featuresCol="features", labelCol="label", solver="normal").fit(train)


def logistic_estimator(family: str = "binomial", max_iter: int = 100) -> LogisticRegression:
    return LogisticRegression(featuresCol="features", labelCol="label", family=family,
                              maxIter=max_iter)


def logistic(train: DataFrame, family: str = "binomial", max_iter: int = 100):
    return logistic_estimator(family, max_iter).fit(train)


def decision_tree(train: DataFrame, impurity: str = "gini", max_depth: int = 5):
    return DecisionTreeClassifier(featuresCol="features", labelCol="label", impurity=impurity,
                                  maxDepth=max_depth, seed=12345).fit(train)


def tree_regressor(train: DataFrame, max_depth: int = 5):
    return DecisionTreeRegressor(featuresCol="features", labelCol="label", maxDepth=max_depth,
                                 seed=12345).fit(train)


def random_forest(train: DataFrame, num_trees: int = 10, max_depth: int = 3, max_bins: int = 20):
    return RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=num_trees,
                                  maxDepth=max_depth, maxBins=max_bins, seed=12345).fit(train)


def forest_regressor(train: DataFrame, num_trees: int = 10):
    return RandomForestRegressor(featuresCol="features", labelCol="label", numTrees=num_trees,
                                 seed=12345).fit(train)


def gbt(train: DataFrame, max_iter: int = 10):
    return GBTClassifier(featuresCol="features", labelCol="label", maxIter=max_iter,
                         seed=12345).fit(train)


def gbt_regressor(train: DataFrame, max_iter: int = 10):
    return GBTRegressor(featuresCol="features", labelCol="label", maxIter=max_iter,
                        seed=12345).fit(train)


def linear_svc(train: DataFrame, max_iter: int = 10):
    return LinearSVC(featuresCol="features", labelCol="label", maxIter=max_iter).fit(train)


def mlp(train: DataFrame, n_features: int, n_classes: int = 2, max_iter: int = 100):
    layers = [n_features, n_features * 3, n_features * 2, n_classes]
    return MultilayerPerceptronClassifier(featuresCol="features", labelCol="label", layers=layers,
                                          maxIter=max_iter, blockSize=512, seed=12345).fit(train)


#: Rows that the fits of one-vs-rest running at once may hold copies of.
_ROWS_AT_ONCE = 10_000_000


def one_vs_rest(train: DataFrame, parallelism: int = 4):
    """One forest per class. Each fit keeps its own binned copy of all rows, so the more
    rows, the fewer fits run at once, at most ``parallelism``: the copies would else fill the
    disks. Each fit uses all cores, and the models do not depend on it."""
    if parallelism > 1:
        parallelism = max(1, min(parallelism, _ROWS_AT_ONCE // max(1, train.count())))
    base = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=10,
                                  seed=12345)
    return OneVsRest(classifier=base, parallelism=parallelism).fit(train)


def naive_bayes(train: DataFrame):
    return NaiveBayes(featuresCol="features", labelCol="label", smoothing=1.0).fit(train)


# -------------------------------------------------------------- evaluation
def binary_auc(pred: DataFrame) -> float:
    return BinaryClassificationEvaluator(rawPredictionCol="rawPrediction", labelCol="label",
                                         metricName="areaUnderROC").evaluate(pred)


def multiclass_metric(pred: DataFrame, metric: str = "accuracy") -> float:
    return MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction",
                                             metricName=metric).evaluate(pred)


def regression_metric(pred: DataFrame, metric: str = "rmse") -> float:
    return RegressionEvaluator(labelCol="label", predictionCol="prediction",
                               metricName=metric).evaluate(pred)


# --------------------------------------------------------------- searches
def _logistic_grid():
    """Logistic regression and the six points both searches try."""
    lr = LogisticRegression(featuresCol="features", labelCol="label", maxIter=10)
    return lr, (ParamGridBuilder().addGrid(lr.regParam, [0.1, 0.01])
                .addGrid(lr.elasticNetParam, [0.0, 0.5, 1.0]).build())


def _search_scores(est: LogisticRegression, grid, data: DataFrame, seed: int, tests) -> np.ndarray:
    """Area under ROC of each grid point (columns) on each test side (rows), fitted on the
    rest. ``tests``: bounds of the row's random number, as pyspark's searches draw it. All
    fits of all sides share their scans, and one more scan scores them; areas are over all
    distinct scores (MLlib's evaluator merges them to about 1,000)."""
    points = [tuple({p.name: v for p, v in m.items()}[k] for k in ("regParam", "elasticNetParam")) for m in grid]

    def inside(low, high):
        return lambda b: (b[:, 1] >= low) & (b[:, 1] < high)

    sides = [inside(*t) for t in tests]
    others = [(lambda b, f=f: ~f(b)) for f in sides]

    def use(b):
        which = np.full((len(b), len(sides) * len(points)), -1)
        for i, f in enumerate(sides):
            for j in range(len(points)):
                which[f(b), i * len(points) + j] = i * len(points) + j
        return which

    with packed(data, [F.rand(seed)]) as rows:
        fits = logistic_fits(rows, 2, others, points, est.getMaxIter(), est.getTol())
        areas = areas_under_roc(rows, 2, fits.reshape(-1, fits.shape[-1]), len(sides) * len(points), use)
    return areas.reshape(len(sides), len(points))


class _TrainValidation(TrainValidationSplit):
    """pyspark's search with its points fitted and scored together."""

    def _fit(self, dataset):
        est, grid = self.getEstimator(), self.getEstimatorParamMaps()
        metrics = _search_scores(est, grid, dataset, self.getSeed(), [(self.getTrainRatio(), np.inf)])[0]
        best = est.fit(dataset, grid[int(np.argmax(metrics))])
        return self._copyValues(TrainValidationSplitModel(best, [float(m) for m in metrics]))


class _CrossValidation(CrossValidator):
    """pyspark's search with the points of all folds fitted and scored together."""

    def _fit(self, dataset):
        est, grid, h = self.getEstimator(), self.getEstimatorParamMaps(), 1.0 / self.getNumFolds()
        metrics = _search_scores(est, grid, dataset, self.getSeed(),
                                 [(i * h, (i + 1) * h) for i in range(self.getNumFolds())])
        mean = np.mean(metrics, axis=0)
        best = est.fit(dataset, grid[int(np.argmax(mean))])
        return self._copyValues(CrossValidatorModel(best, [float(m) for m in mean], None,
                                                    [float(m) for m in np.std(metrics, axis=0)]))


def train_valid_search(train: DataFrame, parallelism: int = 4, seed: int = 12345):
    lr, grid = _logistic_grid()
    tvs = _TrainValidation(estimator=lr, estimatorParamMaps=grid,
                           evaluator=BinaryClassificationEvaluator(),
                           trainRatio=0.7, parallelism=parallelism, seed=seed)
    return tvs.fit(train)


def cross_validate(train: DataFrame, folds: int = 3, parallelism: int = 4, seed: int = 12345):
    lr, grid = _logistic_grid()
    cv = _CrossValidation(estimator=lr, estimatorParamMaps=grid,
                          evaluator=BinaryClassificationEvaluator(), numFolds=folds,
                          parallelism=parallelism, seed=seed)
    return cv.fit(train)


def search_table(model, spark) -> DataFrame:
    """Grid point -> validation metric for a TrainValidationSplit/CrossValidator."""
    metrics = getattr(model, "validationMetrics", None) or model.avgMetrics
    rows = []
    for params, m in zip(model.getEstimatorParamMaps(), metrics):
        desc = ", ".join(f"{p.name}={v}" for p, v in sorted(params.items(), key=lambda t: t[0].name))
        rows.append((desc, float(m)))
    return spark.createDataFrame(rows, "params string, metric double")


def leave_one_group_out(df: DataFrame, group: str, estimator_fn, max_groups: int = 100):
    """For each group: fit on the other groups, score both sides; returns
    ``group, train_auc, test_auc``. There is one fit per group, so more than
    ``max_groups`` groups raise. A NULL group is a group. The input should be
    persisted by the caller. AUC uses the distributed rank-sum (``auc_roc``),
    not a driver-side metric. ``estimator_fn`` fits a table; given as a plain binomial
    ``LogisticRegression``, the fits of all groups share their scans and so do the areas."""
    spark = df.sparkSession
    groups = [r[0] for r in df.select(group).distinct().orderBy(group).limit(max_groups + 1).collect()]
    if len(groups) > max_groups:
        raise ValueError(f"{group} has more than {max_groups} groups: one fit for each is too many")
    if isinstance(estimator_fn, LogisticRegression):
        return spark.createDataFrame(_logistic_by_group(df, group, groups, estimator_fn),
                                     "group string, train_auc double, test_auc double")
    rows = []
    for g in groups:
        inside = F.col(group).eqNullSafe(F.lit(g))
        train, test = df.filter(~inside), df.filter(inside)
        model = estimator_fn(train)
        aucs = []
        for part in (train, test):
            pred = probability_of_one(model.transform(part))
            aucs.append(auc_roc(pred, "p1", "label").first()["auc"])
        rows.append((None if g is None else str(g), aucs[0], aucs[1]))
    return spark.createDataFrame(rows, "group string, train_auc double, test_auc double")


def _logistic_by_group(df: DataFrame, group: str, groups: list, est: LogisticRegression) -> list[tuple]:
    number = F.coalesce(*[F.when(F.col(group).eqNullSafe(F.lit(g)), F.lit(i)) for i, g in enumerate(groups)])
    others = [(lambda b, i=i: b[:, 1] != i) for i in range(len(groups))]

    def use(b):  # each model's area on the other groups, then on its own
        k, own = np.arange(len(others)), b[:, 1, None].astype(int)
        return np.concatenate([np.where(own != k, k, -1), np.where(own == k, k, -1)], axis=1)

    with packed(df, [number]) as rows:
        fits = logistic_fits(rows, 2, others, [(est.getRegParam(), est.getElasticNetParam())], est.getMaxIter(), est.getTol())
        areas = areas_under_roc(rows, 2, fits[:, 0], 2 * len(groups), use, chance=True)
    areas = [None if np.isnan(a) else round(float(a), 6) for a in areas]
    return [(None if g is None else str(g), *ab) for g, *ab in zip(groups, areas, areas[len(groups):])]


# ---------------------------------------------------------- chi-square select
def chi_square_select(df: DataFrame, features: Sequence[str], top: int = 6):
    """Top categorical features by chi-square (UnivariateFeatureSelector,
    categorical/categorical); returns ``feature, statistic, p_value, selected``."""
    sel = UnivariateFeatureSelector(featuresCol="features", labelCol="label",
                                    outputCol="selected", selectionMode="numTopFeatures")
    sel.setFeatureType("categorical").setLabelType("categorical").setSelectionThreshold(top)
    model = sel.fit(df)
    chosen = set(model.selectedFeatures)
    test = ChiSquareTest.test(df, "features", "label").head()
    stats = test.statistics.toArray()
    pvals = test.pValues.toArray()
    rows = [(f, float(stats[i]), float(pvals[i]), int(i in chosen))
            for i, f in enumerate(features)]
    return df.sparkSession.createDataFrame(
        rows, "feature string, statistic double, p_value double, selected int")

