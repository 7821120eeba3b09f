"""Rows of the model queries: worked out once, in parts that follow their number."""

import re

import pytest
from pyspark.sql import functions as F

from scorecraft.operators import clustering as cl
from scorecraft.operators import ordering
from scorecraft.plans import load_all, q_ml, q_profile, views


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    i = F.col("id")
    spark.range(400).select(
        (i / 4).cast("long").alias("l_orderkey"), (i % 4).cast("int").alias("l_linenumber"),
        (i * 7 % 31).alias("l_partkey"), (i % 5).alias("l_suppkey"), (i * 17 % 50 + 1).cast("double").alias("l_quantity"),
        (i * 37 % 401 * 100.0).alias("l_extendedprice"), (i % 11 / 100).alias("l_discount"), (i % 9 / 100).alias("l_tax"),
        F.when(i % 3 == 0, "R").otherwise("N").alias("l_returnflag"), F.when(i % 2 == 0, "O").otherwise("F").alias("l_linestatus"),
    ).write.parquet(f"{d}/lineitem.parquet")
    spark.range(101).select(
        i.alias("o_orderkey"), (i % 21).alias("o_custkey"), (i * 10.0).alias("o_totalprice"), F.lit("1-URGENT").alias("o_orderpriority"),
        F.lit("F").alias("o_orderstatus")).write.parquet(f"{d}/orders.parquet")
    spark.range(20).select(i.alias("c_custkey"), (i * 3.0).alias("c_acctbal"), (i % 3).cast("string").alias("c_mktsegment")
                           ).write.parquet(f"{d}/customer.parquet")
    return d


def test_rows_are_kept_in_parts_that_grow_and_released(spark, tables, monkeypatch):
    load_all()
    joined = views.bank_view(spark, tables)
    for rows, parts in ((400, 8), (10, 40)):
        monkeypatch.setattr(q_ml, "_PART_ROWS", rows)
        with q_ml._model_frame(spark, tables) as frame:
            assert frame.rdd.getNumPartitions() == parts
            assert "InMemoryTableScan" in frame._jdf.queryExecution().executedPlan().toString()
            assert frame.count() == joined.count() == 384  # an order without its customer is left out
            got = {(r.l_orderkey, r.l_linenumber): r.features[0] for r in frame.collect()}
        assert got == {(r.l_orderkey, r.l_linenumber): r.l_quantity for r in joined.collect()}
        assert "InMemoryTableScan" not in frame.select("*")._jdf.queryExecution().executedPlan().toString()


def test_scores_outlive_the_kept_rows(spark, tables):
    load_all()
    scores = q_ml.batch_score(spark, tables)
    assert scores.count() == 384 and scores.filter("p1 BETWEEN 0 AND 1").count() == 384
    assert "Exchange" not in scores._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("kept", ["_model_frame", "_stored_pipeline"])
def test_every_join_behind_the_kept_rows_follows_the_rows(spark, tables, monkeypatch, kept):
    load_all()
    monkeypatch.setattr(q_ml, "_PART_ROWS", 10)
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with getattr(q_ml, kept)(spark, tables) as got:
            rows = got[0] if isinstance(got, tuple) else got
            plan = rows._jdf.queryExecution().executedPlan().toString()
            assert rows.count() == 384
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before["spark.sql.autoBroadcastJoinThreshold"])
    for key in ("o_custkey", "c_custkey", "o_orderkey", "l_orderkey"):
        assert set(re.findall(rf"hashpartitioning\({key}#\d+L?, (\d+)\)", plan)) == {"40"}
    assert spark.conf.get("spark.sql.shuffle.partitions") == before["spark.sql.shuffle.partitions"]


@pytest.mark.parametrize("name", ["model_roundtrip_scores", "model_validation", "model_validation_tables"])
def test_sorts_by_score_follow_the_rows(spark, tables, monkeypatch, name):
    load_all()
    parts, numbered = set(), ordering._numbered

    def seen(*args, **kw):
        tagged, n = numbered(*args, **kw)
        if {"_s", "score"} & set(args[0].columns):  # not the dictionary of the categories
            parts.add(n)
        return tagged, n

    monkeypatch.setattr(ordering, "_numbered", seen)
    monkeypatch.setattr(q_ml, "_PART_ROWS", 40)
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    getattr(q_ml, name)(spark, tables)
    assert parts == {10} and spark.conf.get("spark.sql.shuffle.partitions") == usual


def test_tasks_of_a_sweep_follow_the_rows(spark, monkeypatch):
    cached = spark.range(1000).repartition(50).persist()
    try:
        assert cl.in_few_tasks(cached).rdd.getNumPartitions() == 8
        monkeypatch.setattr(cl, "_TASK_ROWS", 50)
        few = cl.in_few_tasks(cached)
        assert few.rdd.getNumPartitions() == 20 and few.distinct().count() == 1000
    finally:
        cached.unpersist()


def test_median_gives_the_places_of_the_quantiles(spark, tables):
    load_all()
    got = {(r.column, r.prob): r for r in q_profile.approx_median(spark, tables).collect()}
    assert len(got) == 24 and all(r.within and r.n == 400 for r in got.values())
    lines = spark.read.parquet(f"{tables}/lineitem.parquet").toPandas()
    for (c, p), r in got.items():
        x = sorted(lines[c])
        assert r.position == pytest.approx((x[int(p * 400) - 1] - x[0]) / (x[-1] - x[0]), abs=0.0051)
