"""Fits: seeded repeats, floors on quality, and identities of their results."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF_SMALL
from scorecraft.operators import clustering as cl
from scorecraft.operators import features as fe
from scorecraft.operators import models as md
from scorecraft.operators import runlog
from scorecraft.operators import sampling
from scorecraft.operators import text as tx
from scorecraft.session import scratch_path


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 3))
    y = (x[:, 0] + 0.5 * x[:, 1] + rng.normal(size=600) * 0.5 > 0).astype(float)
    df = spark.createDataFrame([(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))],
                               "id long, a double, b double, c double, label double")
    return md.stable(md.assembled(df, ["a", "b", "c"], keep=["id"]), ["id"], 4).cache()


@pytest.mark.parametrize("fit", [
    lambda f: md.logistic(f, "binomial", max_iter=10), md.decision_tree, md.random_forest, md.gbt,
    md.linear_svc, lambda f: md.mlp(f, 3, 2, max_iter=30)])
def test_classifiers_beat_the_floor_and_repeat(frame, fit):
    first, again = (fit(frame).transform(frame) for _ in range(2))
    assert md.binary_auc(first) > 0.75 if "rawPrediction" in first.columns else True
    assert first.select("id", "prediction").exceptAll(again.select("id", "prediction")).count() == 0
    assert first.count() == 600


@pytest.mark.parametrize("fit", [md.tree_regressor, md.forest_regressor, md.gbt_regressor])
def test_regressors_beat_the_mean(frame, fit):
    y = frame.select("id", (vector_to_array("features")[0] * 3).alias("label"), "features")
    assert md.regression_metric(fit(y).transform(y)) < 0.5 * y.agg(F.stddev("label")).first()[0]


def test_naive_bayes_equals_closed_form(spark):
    rng = np.random.default_rng(6)
    x, y = rng.integers(0, 5, (300, 3)).astype(float), rng.integers(0, 2, 300).astype(float)
    df = md.assembled(spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)],
                                            "a double, b double, c double, label double"), ["a", "b", "c"])
    model = md.naive_bayes(df)
    theta = model.theta.toArray()
    for k in (0, 1):
        s = x[y == k].sum(axis=0)
        assert np.allclose(theta[k], np.log((s + 1) / (s.sum() + 3)))
        assert np.isclose(model.pi.toArray()[k], np.log(((y == k).sum() + 1) / (300 + 2)))


def test_one_vs_rest_and_multinomial(spark):
    rows = [(float(i % 3 == 0), float(i % 3 == 1), float(i % 3)) for i in range(150)]
    df = md.assembled(spark.createDataFrame(rows, "a double, b double, label double"), ["a", "b"])
    assert md.multiclass_metric(md.one_vs_rest(df).transform(df)) > 0.95
    assert md.multiclass_metric(md.logistic(df, "multinomial", max_iter=20).transform(df)) > 0.95


def test_searches_try_all_six_points(spark, frame):
    for search in (md.train_valid_search, lambda f: md.cross_validate(f, folds=3)):
        rows = md.search_table(search(frame), spark).collect()
        assert len({r.params for r in rows}) == 6 and max(r.metric for r in rows) > 0.75


def test_importances_sum_to_one(spark, frame):
    rows = md.importances_table(md.random_forest(frame), ["a", "b", "c"], spark, "rf").collect()
    assert np.isclose(sum(r.score for r in rows), 1) and rows[0].feature == "a"


def test_tree_lines_are_whole(frame):
    model = md.decision_tree(frame)
    lines = [t for _, t in md.tree_lines(model)]
    assert "\n".join(lines) == model.toDebugString.rstrip()
    assert sum("Predict" in t for t in lines) == (model.numNodes + 1) // 2


def test_pca_and_svd_match_numpy(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(200, 3)) @ np.array([[3, 1, 0], [0, 1, 0.3], [0, 0, 0.2]])
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, a double, b double, c double")
    model = fe.pca_fit(df, ["a", "b", "c"], 3)
    want = np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1]
    got = [r.explained for r in fe.pca_explained(model, ["a", "b", "c"], spark).orderBy("component").collect()]
    assert np.allclose(got, want / want.sum())
    load = {(r.feature, r.component): r.loading for r in fe.pca_loadings(model, ["a", "b", "c"], spark).collect()}
    assert np.isclose(sum(load[f, 1] ** 2 for f in "abc"), 1)
    values, v = fe.svd(df, ["a", "b", "c"], 3)
    u = np.array([r[1:] for r in sorted(fe.svd_project(df, ["a", "b", "c"], 3, keep=["id"]).collect())])
    assert np.allclose(u * values @ v.T, x) and np.allclose(u.T @ u, np.eye(3), atol=1e-8)


def test_kmeans_centres_are_means_of_members(spark):
    rows = [(i, float(i % 2 * 10 + i % 5), float(i % 3)) for i in range(120)]
    df = fe.assemble_vectors(spark.createDataFrame(rows, "id long, a double, b double"), ["a", "b"], keep=["id"])
    for fit in (lambda: cl.kmeans(df, 2, 1003), lambda: cl.bisecting_kmeans(df, 2, 1)):
        model = fit()
        out = model.transform(df).select("prediction", vector_to_array("features").alias("x")).collect()
        for k, centre in enumerate(model.clusterCenters()):
            assert np.allclose(centre, np.mean([r.x for r in out if r.prediction == k], axis=0))
    sweep = cl.k_sweep(df, range(2, 5), "kmeans", 1003).collect()
    assert len(sweep) == 3


def test_topic_mixes_sum_to_one(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    w, cv, _ = tx.tfidf(tx.tokenize(docs), vocab_size=500, min_df=3)
    model = tx.lda_fit(md.stable(w, ["doc_id"], 2), k=3, max_iter=3)
    mix = model.transform(w).select(vector_to_array("topicDistribution").alias("m"), "tfidf").collect()
    assert all(np.isclose(sum(r.m), 1) or not r.tfidf.numNonzeros() for r in mix)
    terms = tx.lda_topic_terms(model, cv, spark, 5).collect()
    assert len(terms) == 15 and {r.term for r in terms} <= set(cv.vocabulary)


def test_samples(spark):
    df = spark.range(4000).withColumn("k", F.col("id") % 4)
    a, b = (sampling.sample_fraction(df, 0.4, seed=7) for _ in range(2))
    assert a.exceptAll(b).count() == 0 and abs(a.count() - 1600) < 200
    n = {r.k: r["count"] for r in sampling.sample_by_stratum(df, "k", {0: 0.5, 1: 1.0}).groupBy("k").count().collect()}
    assert set(n) == {0, 1} and n[1] == 1000 and abs(n[0] - 500) < 100


def test_scores_survive_the_model_store(spark, frame):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression

    model = Pipeline(stages=[LogisticRegression(maxIter=5)]).fit(frame)
    loaded = runlog.load_model(runlog.save_model(model, scratch_path(spark, "test-model")))
    one, two = (runlog.batch_score(m, frame, keep=["id"]).select("id", "p1") for m in (model, loaded))
    assert one.exceptAll(two).count() == 0 and two.count() == 600


def test_validation_covers_the_five_datasets(spark):
    out = entry.queries()["model_validation"](spark, SF_SMALL).collect()
    assert {r.dataset for r in out} == {"train", "valid", "test", "oot1", "oot2"}
    assert all(r.roc > 0.75 and 0 <= r.ks <= 100 for r in out)
