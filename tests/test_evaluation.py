"""Evaluation operators: AUC equivalence, KS range, guarded one-class cases."""

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from scorecraft.operators import evaluation as ev
from scorecraft.operators import ordering
from scorecraft.plans.views import score_order, score_view
from conftest import SF_SMALL


def _ties(spark):
    rows = [(i, float(i % 4) / 4, int(i % 3 == 0 or i % 4 == 3)) for i in range(40)]
    return spark.createDataFrame(rows, "id int, score double, label int")


def test_auc_equals_evaluator_with_ties(spark):
    df = _ties(spark)
    ours = ev.auc_roc(df).first()["auc"]
    vec = df.withColumn("raw", array_to_vector(F.array(1 - F.col("score"), F.col("score"))))
    ref = BinaryClassificationEvaluator(rawPredictionCol="raw", labelCol="label",
                                        numBins=0).evaluate(vec.withColumn(
                                            "label", F.col("label").cast("double")))
    assert abs(ours - ref) < 1e-6


def test_auc_by_group_matches_single(spark):
    df = _ties(spark).withColumn("g", F.lit("a"))
    a = ev.auc_by_group(df, ["g"]).first()["auc"]
    b = ev.auc_roc(df).first()["auc"]
    assert abs(a - b) < 1e-9


def test_decile_table_properties(spark):
    tbl = ev.decile_table(score_view(spark, SF_SMALL), "label", score_order()).collect()
    assert sum(r.total for r in tbl) == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    assert all(0 <= r.spread <= 100 for r in tbl)
    assert max(r.target_dist for r in tbl) == 100.0


def test_one_class_is_guarded(spark):
    df = spark.createDataFrame([(float(i), 1) for i in range(12)], "score double, label int")
    tbl = ev.decile_table(df, "label", [F.col("score").desc()]).collect()
    assert all(r.non_target_dist is None for r in tbl)
    assert ev.auc_roc(df).first()["auc"] is None


def test_champion_counts_unstable_datasets(spark):
    cols = [f"{m}_{d}" for d in ev.DATASETS for m in ev.METRICS]
    stable = [0.8] * len(cols)
    shaky = [0.95 if c == "roc_train" else 0.85 for c in cols]
    df = spark.createDataFrame([("a",) + tuple(stable), ("b",) + tuple(shaky)],
                               ["model"] + cols)
    out = {r.model: (r.counter, r.selected_model)
           for r in ev.select_champion(df, "roc", "test").collect()}
    assert out["a"] == (0, "Champion")
    assert out["b"] == (1, "Challenger")


def test_metrics_long_matches_row_level_windows(spark):
    """Run-based KS/AUC/accuracy equal row-level windows over each group,
    including score runs that straddle tile boundaries (few distinct scores)."""
    from pyspark.sql import Window
    from scorecraft.plans.views import SCORE_TIE_KEYS

    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    df = li.select(*SCORE_TIE_KEYS, F.col("l_returnflag").alias("g"),
                   (F.col("l_quantity") > 25).cast("int").alias("label"),
                   F.round(F.col("l_discount") * 10 + F.col("l_tax"), 1).alias("score"),
                   (F.col("l_tax") > 0.04).cast("int").alias("prediction"))
    ties = [F.col(c) for c in SCORE_TIE_KEYS]
    got = {(r.g, r.metric): r.value for r in ev.metrics_long(df, ["g"], ties).collect()}
    w = Window.partitionBy("g").orderBy(F.col("score").desc(), *ties)
    t = df.withColumn("tile", F.ntile(10).over(w)).groupBy("g", "tile").agg(
        F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("nt"))
    run = Window.partitionBy("g").orderBy("tile").rowsBetween(Window.unboundedPreceding, 0)
    tot = Window.partitionBy("g")
    spread = F.abs(F.sum("t").over(run) * 100.0 / F.sum("t").over(tot)
                   - F.sum("nt").over(run) * 100.0 / F.sum("nt").over(tot))
    ks = {r.g: r.ks for r in t.select("g", spread.alias("s")).groupBy("g").agg(
        F.round(F.max("s"), 2).alias("ks")).collect()}
    for g, v in ks.items():
        assert got[(g, "ks")] == v
        sub = df.filter(F.col("g") == g)
        assert abs(got[(g, "roc")] - ev.auc_roc(sub).first()["auc"]) < 1e-6
        acc = sub.agg(F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()[0]
        assert abs(got[(g, "accuracy")] - round(acc, 6)) < 1e-9


@pytest.mark.parametrize("some", [20_000, 30, 1])
def test_tiles_by_brackets_are_those_of_numbered_rows(spark, monkeypatch, some):
    df = spark.range(3000).select(
        "id", F.pmod(F.xxhash64("id"), F.lit(900)).alias("tie"),
        F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id") % 3).alias("g"), (F.col("id") % 7 / 10).alias("score"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(3)) == 0).cast("int").alias("label"))
    df = df.withColumn("label", F.when(F.col("id") % 41 != 0, F.col("label")))
    for group in ([], ["g"]):
        runs = ev.score_runs_by_group(df, group)
        want = ev.tile_counts_by_group(df, runs, group, "score", ["tie", "id"], "label", 10)
        monkeypatch.setattr(ev, "_NUMBER_AT_MOST", 10)
        monkeypatch.setattr(ev, "_BRACKET_ROWS", some)
        seen = []
        monkeypatch.setattr(ordering, "_numbered", lambda d, *a, f=ordering._numbered, **kw: seen.append(d.count()) or f(d, *a, **kw))
        got = ev.tile_counts_by_group(df, runs, group, "score", ["tie", "id"], "label", 10)
        rows = lambda t: sorted([tuple(round(x, 9) if isinstance(x, float) else x if x is not None else -1 for x in r) for r in t.select(want.columns).collect()])
        assert rows(got) == rows(want)
        if some == 20_000:
            assert 0 < sum(seen) < 3000 * 9
        monkeypatch.undo()
