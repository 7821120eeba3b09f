"""Global ordering equals Spark's single-partition windows; tile properties."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from scorecraft.operators import ordering
from scorecraft.plans.views import score_order, score_view
from conftest import SF_SMALL


def test_global_row_number_matches_window(spark):
    s = score_view(spark, SF_SMALL)
    a = ordering.global_row_number(s, score_order(), out="rn", num_partitions=5)
    b = s.withColumn("rn2", F.row_number().over(Window.orderBy(*score_order())))
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    j = a.join(b, keys)
    assert j.count() == s.count()
    assert j.filter("rn != rn2").count() == 0


def test_global_ntile_matches_sql_ntile(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey", "o_totalprice")
    order = [F.col("o_totalprice").desc(), F.col("o_orderkey")]
    for k in (3, 10, 7):
        a = ordering.global_ntile(o, order, k, out="t", num_partitions=4)
        b = o.withColumn("t2", F.ntile(k).over(Window.orderBy(*order)))
        assert a.join(b, ["o_orderkey", "o_totalprice"]).filter("t != t2").count() == 0


def test_ntile_fewer_rows_than_tiles(spark):
    df = spark.createDataFrame([(1, 0.3), (2, 0.2), (3, 0.1)], "id int, score double")
    got = ordering.global_ntile(df, [F.col("score").desc()], 10, out="t").orderBy("id").collect()
    assert [r.t for r in got] == [1, 2, 3]


def test_tile_sizes_differ_by_at_most_one(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    t = ordering.global_ntile(li, [F.col("l_quantity").desc(), "l_orderkey", "l_linenumber",
                                   "l_partkey", "l_suppkey", "l_extendedprice"], 10, out="t")
    sizes = [r["count"] for r in t.groupBy("t").count().collect()]
    assert len(sizes) == 10 and max(sizes) - min(sizes) <= 1


def test_grouped_ntile_matches_window(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select(
        "o_orderkey", "o_orderpriority", "o_totalprice")
    order = [F.col("o_totalprice").desc(), F.col("o_orderkey")]
    a = ordering.grouped_ntile(o, ["o_orderpriority"], order, 4, out="t")
    b = o.withColumn("t2", F.ntile(4).over(Window.partitionBy("o_orderpriority").orderBy(*order)))
    assert a.join(b, ["o_orderkey"]).filter("t != t2").count() == 0


def test_grouped_running_sum_matches_window(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    c = li.groupBy("l_returnflag", "l_quantity").agg(F.count(F.lit(1)).alias("n"))
    a = ordering.grouped_running_sum(c, ["l_returnflag"], ["l_quantity"], ["n"])
    w = Window.partitionBy("l_returnflag").orderBy("l_quantity").rowsBetween(
        Window.unboundedPreceding, 0)
    b = c.withColumn("cum2", F.sum("n").over(w))
    assert a.join(b, ["l_returnflag", "l_quantity"]).filter("cum_n != cum2").count() == 0


def test_flag_max_marks_ties(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 7.0), (3, 7.0)], "id int, v double")
    got = {r.id: r.is_max for r in ordering.flag_max(df, "v").collect()}
    assert got == {1: 0, 2: 1, 3: 1}


def test_grouped_numbering_hot_and_null_groups(spark):
    """A group holding most rows spans many range partitions; a NULL group key
    is its own group; small Arrow batches exercise the carry between batches."""
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
        F.when(F.col("l_quantity") > 45, F.lit(None)).when(F.col("l_quantity") > 5, F.lit("hot"))
        .otherwise(F.col("l_returnflag")).alias("g"))
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    order = [F.col("l_quantity").desc()] + [F.col(c) for c in keys]
    w = Window.partitionBy("g").orderBy(*order)
    ref = li.select(*keys, F.ntile(7).over(w).alias("t2"),
                    F.sum("l_quantity").over(w.rowsBetween(Window.unboundedPreceding, 0))
                    .alias("cum2"))
    got = ordering.grouped_ntile(li, ["g"], order, 7, out="t", num_partitions=6)
    assert got.join(ref, keys).filter("t != t2").count() == 0
    assert got.count() == li.count()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        run = ordering.grouped_running_sum(li, ["g"], order, ["l_quantity"])
        j = run.join(ref, keys)
        assert j.count() == li.count()
        assert j.filter("cum_l_quantity != cum2").count() == 0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
