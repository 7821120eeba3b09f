"""Typed missing tests, casts, buckets, profiling and histograms."""

import math

import numpy as np
from pyspark.sql import functions as F

from scorecraft.functions import columns as C
from scorecraft.operators import profile, sampling
from conftest import SF_SMALL


def _t_missing(spark):
    rows = [(1, None, 1.0), (2, "", float("nan")), (3, "abc", None), (4, "1.5", 2.0)]
    return spark.createDataFrame(rows, "id int, s string, x double")


def test_is_missing_is_typed(spark):
    df = _t_missing(spark)
    got = {r.id: (r.ms, r.mx) for r in df.select(
        "id", C.is_missing(df, "s").alias("ms"), C.is_missing(df, "x").alias("mx")).collect()}
    assert got == {1: (True, False), 2: (True, True), 3: (False, True), 4: (False, False)}


def test_try_cast_bad_text_is_null(spark):
    df = _t_missing(spark)
    out = C.cast_by_type_lists(df, {"double": ["s"]}).orderBy("id").collect()
    assert [r.s for r in out] == [None, None, None, 1.5]


def test_bucket_null_falls_to_last(spark):
    df = spark.createDataFrame([(None,), (5.0,), (50.0,)], "v double")
    got = [r.b for r in df.select(C.buckets(F.col("v"), [(10, "Low"), (20, "Mid")], "High")
                                  .alias("b")).collect()]
    assert got == ["High", "Low", "High"]


def test_missing_profile_counts(spark):
    df = _t_missing(spark)
    got = {r.column: r.n_missing for r in profile.missing_counts(df, ["s", "x"]).collect()}
    assert got == {"s": 2, "x": 2}


def test_histogram_matches_numpy(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    got = [r["count"] for r in profile.histogram_equal_width(li, "l_extendedprice", 25)
           .orderBy("bin").collect()]
    x = np.array([r[0] for r in li.select("l_extendedprice").collect()])
    ref, _ = np.histogram(x, bins=25)
    assert got == list(ref)


def test_describe_matches_pandas(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    got = {r.column: r for r in profile.describe_long(li, ["l_quantity"]).collect()}
    pdf = li.select("l_quantity").toPandas()["l_quantity"]
    assert got["l_quantity"]["count"] == len(pdf)
    assert math.isclose(got["l_quantity"]["stddev"], round(pdf.std(), 6), abs_tol=1e-6)


def test_cardinality_flags_constant(spark):
    df = spark.createDataFrame([(1, 7), (2, 7), (3, 7)], "a int, b int")
    got = {r.column: r.flag for r in profile.cardinality_profile(df, exact=True).collect()}
    assert got == {"a": 0, "b": 1}


def test_stratified_split_is_exact_and_complete(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    out = sampling.stratified_split(li, "l_returnflag", [0.7, 0.3], ["train", "test"], seed=7)
    assert out.count() == li.count()
    per = {(r.l_returnflag, r.split): r["count"]
           for r in out.groupBy("l_returnflag", "split").count().collect()}
    for flag in {k[0] for k in per}:
        n = per.get((flag, "train"), 0) + per.get((flag, "test"), 0)
        assert per.get((flag, "train"), 0) == round(0.7 * n)


def test_hash_split_disjoint_and_complete(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    lab = o.withColumn("s", sampling.hash_split(F.col("o_orderkey"), [70, 30], ["a", "b"]))
    assert lab.filter(F.col("s").isNull()).count() == 0
    again = o.withColumn("s2", sampling.hash_split(F.col("o_orderkey"), [70, 30], ["a", "b"]))
    assert lab.join(again, "o_orderkey").filter("s != s2").count() == 0


def test_stratified_split_keeps_null_stratum(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select(
        "l_orderkey", F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")).alias("g"))
    out = sampling.stratified_split(li, "g", [0.7, 0.3], ["train", "test"], seed=7)
    assert out.count() == li.count()
    n_null = li.filter(F.col("g").isNull()).count()
    got = out.filter(F.col("g").isNull() & (F.col("split") == "train")).count()
    assert got == round(n_null * 0.7)
