"""NULL groups, labels and keys; infinities; refusals instead of silent loss."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from scorecraft.operators import evaluation as ev
from scorecraft.operators import features as fe
from scorecraft.operators import models as md
from scorecraft.operators import ordering, profile, sampling, shaping


@pytest.fixture(scope="module")
def grouped(spark):
    rows = [(i, None if i % 5 == 0 else "hot" if i % 5 < 4 else f"g{i % 7}", float(i % 13)) for i in range(400)]
    return spark.createDataFrame(rows, "id long, g string, v double").repartition(6)


def test_group_aggregates_keep_null_groups(grouped):
    w = Window.partitionBy("g")
    want = grouped.withColumn("gap", F.max("v").over(w) - F.col("v")).withColumn(
        "share", F.col("v") / F.sum("v").over(w))
    got = shaping.share_of_group(shaping.gap_to_group_max(grouped, ["g"], "v", "gap"), ["g"], "v")
    assert got.count() == 400
    assert got.select("id", "gap", F.round("share", 9)).exceptAll(
        want.select("id", "gap", F.round("share", 9))).count() == 0


def test_flag_max_in_groups(grouped):
    want = grouped.withColumn("m", (F.col("v") == F.max("v").over(Window.partitionBy("g"))).cast("int"))
    got = ordering.flag_max(grouped, "v", ["g"], out="m")
    assert got.select("id", "m").exceptAll(want.select("id", "m")).count() == 0 and got.count() == 400


def test_metrics_keep_null_groups(spark):
    df = spark.createDataFrame([(i, None if i % 2 else "a", float(i % 9), int(i % 9 > 3 or i % 4 == 0))
                                for i in range(200)], "id long, g string, score double, label int")
    df = df.withColumn("prediction", (F.col("score") > 4).cast("int"))
    out = ev.metrics_long(df, ["g"], [F.col("id")]).collect()
    assert {(r.g, r.metric) for r in out} == {(g, m) for g in (None, "a") for m in ("roc", "accuracy", "ks")}
    assert all(r.value is not None for r in out)


def test_null_labels_have_no_part_in_the_decile_table(spark):
    rows = [(i, float(i % 17), None if i % 6 == 0 else int(i % 17 > 8)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, score double, label int")
    tbl = ev.decile_table(df, "label", [F.col("score").desc(), F.col("id")]).collect()
    assert sum(r.total for r in tbl) == 250
    assert all(r.total == r.label + r.non_target for r in tbl)
    assert max(r.total for r in tbl) - min(r.total for r in tbl) <= 1


def test_decile_table_equals_row_level_tiles(spark):
    rows = [(i, float(i * 7 % 23), int(i * 7 % 23 > 9 or i % 5 == 0)) for i in range(503)]
    df = spark.createDataFrame(rows, "id long, score double, label int")
    order = [F.col("score").desc(), F.col("id").asc()]
    want = df.withColumn("d", F.ntile(10).over(Window.orderBy(*order))).groupBy("d").agg(
        F.count("*").alias("n"), F.sum("label").alias("t"), F.avg("score").alias("s")).orderBy("d").collect()
    got = sorted(ev.decile_table(df, "label", order).collect())
    assert [(r.deciles, r.total, r.label) for r in got] == [(r.d, r.n, r.t) for r in want]
    lift = sorted(ev.gains_lift_table(df, "label", "score", order).collect())
    assert [r.PRED for r in lift] == [round(r.s, 6) for r in want]
    with pytest.raises(ValueError):
        ev.decile_table(df, "label", [F.col("score").asc()])


def test_decile_family_shuffles_no_rows_after_ordering(spark):
    """Rows are reduced to scores before any range partitioning."""
    rows = [(i, float(i % 5), i % 2) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, score double, label int")
    runs = ev.score_runs_by_group(df, [], "score", "label")
    assert runs.count() == 5


def test_grouped_numbering_has_no_shuffle_after_the_range_partitioning(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), "id")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = ordering.grouped_row_number(df, ["g"], ["id"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    above = plan[:plan.index("BroadcastExchange")]
    assert "BroadcastHashJoin" in above and "Exchange hashpartitioning" not in above
    assert "SortMergeJoin" not in plan


def test_histogram_leaves_infinities_out(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)] + [
        (float("inf"),), (float("-inf"),), (float("nan"),), (None,)], "x double")
    out = profile.histogram_equal_width(df, "x", 5).orderBy("bin").collect()
    assert [r["count"] for r in out] == [2, 2, 2, 2, 3] and (out[0].lo, out[-1].hi) == (0.0, 10.0)


def test_approximate_quantiles_refuse_error_zero(spark):
    with pytest.raises(ValueError):
        profile.approx_quantiles(spark.range(5).select(F.col("id").alias("x")), ["x"], [0.5], 0)


def test_hash_split_of_large_negative_and_null_keys(spark):
    keys = [2**62 + i for i in range(500)] + [-(2**62) - i for i in range(500)] + [None, None]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for multiplier in (None, 7919):
        out = df.withColumn("s", sampling.hash_split(F.col("k"), [70, 30], ["a", "b"], multiplier)).groupBy(
            "s").count().collect()
        n = {r.s: r["count"] for r in out}
        assert n[None] == 2 and n["a"] + n["b"] == 1000 and 600 < n["a"] < 800


def test_labelled_split_is_one_scan_and_does_not_depend_on_the_layout(spark):
    df = spark.range(5000).withColumn("x", F.col("id") * 2)
    a = sampling.labelled_split(df.repartition(3), [0.7, 0.2, 0.1], ["train", "valid", "test"], seed=1)
    b = sampling.labelled_split(df.repartition(11, "x"), [0.7, 0.2, 0.1], ["train", "valid", "test"], seed=1)
    assert a.exceptAll(b).count() == 0 and a.count() == 5000
    n = {r.split: r["count"] for r in a.groupBy("split").count().collect()}
    assert abs(n["train"] - 3500) < 150 and abs(n["test"] - 500) < 90
    plan = sampling.labelled_split(df, [0.5, 0.5], ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1 and "Union" not in plan and "Exchange" not in plan


def test_missing_features_raise_and_scoring_keeps_every_row(spark):
    rows = [(i, float(i % 7), None if i == 3 else float(i % 5), float(i % 2)) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, a double, b double, label double")
    for bad in (lambda: md.assembled(df, ["a", "b"]).collect(),
                lambda: fe.pca_fit(df, ["a", "b"], 2).transform(df).collect(),
                lambda: fe.svd_values(df, ["a", "b"], 2)):
        with pytest.raises(Exception):
            bad()
    full = fe.mean_impute(df, ["a", "b"])
    frame = md.assembled(full, ["a", "b"], keep=["id"])
    scored = md.probability_of_one(md.logistic(frame, "binomial", max_iter=5).transform(frame))
    assert scored.count() == 60
    assert scored.filter(~F.col("p1").between(0, 1)).count() == 0


def test_leave_one_group_out_takes_null_groups_and_refuses_too_many(spark):
    rows = [(float(i % 9), float(i % 9 > 4 or i % 11 == 0), None if i % 3 == 0 else f"s{i % 3}") for i in range(300)]
    df = md.assembled(spark.createDataFrame(rows, "x double, label double, seg string"), ["x"], keep=["seg"])
    fit = lambda t: md.logistic(t, "binomial", max_iter=5)
    out = {r.group: r for r in md.leave_one_group_out(df, "seg", fit).collect()}
    assert set(out) == {None, "s1", "s2"} and all(r.test_auc > 0.75 for r in out.values())
    with pytest.raises(ValueError):
        md.leave_one_group_out(df, "seg", fit, max_groups=2)
