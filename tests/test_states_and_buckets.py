"""Buckets by binary search, mergeable states and the category dictionary."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorecraft.operators import features as fe
from scorecraft.operators import profile as pr
from scorecraft.operators import selection as sel


def test_buckets_count_splits_up_to_the_value(spark):
    splits = [3.0, -math.inf, 1.0, 1.0, math.inf, 7.5]
    values = [None, math.nan, -math.inf, -5.0, 1.0, 2.9, 3.0, 7.5, 1e300, math.inf]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "x double, `a.b` int")
    got = {r["a.b"]: (r.n, r.none) for r in sel.with_buckets(
        df, {"n": (F.col("x"), splits), "none": (F.col("x"), [])}).collect()}
    for i, v in enumerate(values):
        known = v is not None and not math.isnan(v)
        assert got[i] == ((sum(s <= v for s in set(splits)), 0) if known else (None, None))


def test_many_bins_and_columns_compile(spark):
    """No step of a run with 20 bins and 20 columns falls back to interpretation."""
    cols = [f"c{i}" for i in range(20)]
    df = spark.range(4000).select(*[(F.xxhash64("id", F.lit(i)) % 1000 / 7).alias(c) for i, c in enumerate(cols)],
                                  (F.col("id") % 3 == 0).cast("int").alias("y"))
    only = {"spark.sql.codegen.fallback": "false", "spark.sql.codegen.factoryMode": "CODEGEN_ONLY"}
    for k, v in only.items():
        spark.conf.set(k, v)
    try:
        table = sel.woe_table(df, cols, [], "y").collect()
    finally:
        for k in only:
            spark.conf.unset(k)
    assert {r.varname for r in table} == set(cols)
    assert all(sum(r["count"] for r in table if r.varname == c) == 4000 for c in cols)


def test_exact_quantiles_with_infinite_values(spark):
    rng = np.random.default_rng(2)
    values = [*map(float, rng.integers(0, 50, 900)), *[math.inf] * 60, *[-math.inf] * 40]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    probs = [0.01, 0.04, 0.05, 0.5, 0.94, 0.95, 1.0]
    got = sel.exact_quantiles(df, ["x"], probs)["x"]
    assert got == {p: sorted(values)[max(1, math.ceil(p * len(values))) - 1] for p in probs}


def test_distinct_states_merge(spark):
    df = spark.range(5000).select((F.col("id") % 4).alias("day"), (F.col("id") * 7 % 901 - 300).alias("k"))
    df = df.unionAll(spark.createDataFrame([(9, None)], "day long, k long"))
    days = pr.distinct_state(df, "k", ["day"])
    want = {r.day: r.n for r in df.groupBy("day").agg(F.countDistinct("k").alias("n")).collect() if r.n}
    assert {r.day: r.n_distinct for r in pr.count_distinct_state(days, ["day"]).collect()} == want
    merged = pr.merge_distinct(days.unionAll(days))
    assert pr.count_distinct_state(merged).first().n_distinct == df.agg(F.countDistinct("k")).first()[0]
    assert pr.count_distinct_state(pr.distinct_state(df.filter("false"), "k")).first().n_distinct == 0


def test_cardinality_profile_copies_no_rows(spark):
    df = spark.createDataFrame([(i % 5, i * 10**15, f"s{i % 7}" if i % 3 else None, float("nan") if i % 2 else 0.0, None)
                                for i in range(200)], "a int, b long, c string, d double, e long")
    got = pr.cardinality_profile(df, cut_off=2, exact=True)
    assert {r.column: (r.n_distinct, r.flag) for r in got.collect()} == {
        "a": (5, 0), "b": (200, 0), "c": (7, 0), "d": (2, 1), "e": (0, 1)}
    assert "Expand" not in got._jdf.queryExecution().toString()


def test_quantile_sketches_merge(spark):
    df = spark.range(20_000).select((F.col("id") % 8).alias("day"), F.expr("cast(id * 7919 % 20011 as double)").alias("x"),
                                    F.lit(None).cast("double").alias("none"))
    state = pr.merge_quantiles(pr.quantile_state(df, ["x", "none"], ["day"]), ["x", "none"])
    answers = pr.quantiles_from(state, ["x", "none"], [0.1, 0.5, 0.9])
    assert all((r.value is None) == (r.column == "none") for r in answers.collect())
    checked = pr.rank_checked(df, answers.filter("column = 'x'"), 2 * pr.kll_rank_error(2000)).collect()
    assert len(checked) == 3 and all(r.within and r.n == 20_000 for r in checked)
    wrong = spark.createDataFrame([("x", 0.5, 1.0)], "column string, prob double, value double")
    assert not pr.rank_checked(df, wrong, 0.01).first().within


def test_dictionary_of_a_million_labels(spark):
    df = spark.range(1_000_000).select(F.concat(F.lit("v"), F.col("id")).alias("c")).unionAll(
        spark.createDataFrame([("v77",), ("v5",), ("v77",), (None,)], "c string"))
    out, model = fe.category_index(df, ["c"])
    rows = {r.c: r.c_index for r in out.filter("c IS NULL OR c IN ('v77', 'v5', 'v0', 'v1', 'v10')").collect()}
    assert rows == {"v77": 0.0, "v5": 1.0, "v0": 2.0, "v1": 3.0, "v10": 4.0, None: 1_000_000.0}
    back = fe.index_to_category(out, model, ["c"])
    assert back.filter("c IS DISTINCT FROM c_label").count() == 0 and back.count() == 1_000_004


@pytest.mark.parametrize("suffix", ["_index", "_no"])
def test_dictionary_of_no_rows(spark, suffix):
    df = spark.createDataFrame([], "c string")
    out, _ = fe.category_index(df, ["c"], suffix)
    assert out.columns == ["c", f"c{suffix}"] and out.count() == 0
