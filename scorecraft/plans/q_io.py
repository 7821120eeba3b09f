"""Sources, sinks and materialising actions.

Round-trip keys write a table Spark derives from the test tables to a fresh
folder under the shared checkpoint folder and read it back.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.evaluation import decile_table
from ..sources import io
from .q_evaluation import DECILES_SQL
from .registry import register
from .views import SCORE_VIEW_SQL, score_order, score_view, table, with_views

_PART_COLS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]


def _part(spark, d):
    return table(spark, d, "part").select(*_PART_COLS)


@register("csv_scan_strings", """
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type,
       CAST(p_size AS VARCHAR) AS p_size, CAST(p_retailprice AS VARCHAR) AS p_retailprice
FROM part""")
def csv_scan_strings(spark, d):
    path = io.write_csv(_part(spark, d), io.fresh_path(spark, "part_csv"), sep="|", header=True)
    return io.read_csv(spark, path, header=True, sep="|")


@register("csv_scan_headerless", """
SELECT CAST(p_partkey AS VARCHAR) AS _c0, p_name AS _c1, p_brand AS _c2, p_type AS _c3,
       CAST(p_size AS VARCHAR) AS _c4, CAST(p_retailprice AS VARCHAR) AS _c5
FROM part""")
def csv_scan_headerless(spark, d):
    path = io.write_csv(_part(spark, d), io.fresh_path(spark, "part_csv"), sep=",", header=False)
    return io.read_csv_headerless(spark, path)


@register("csv_scan_inferred", """
SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_type, p_size, p_retailprice
FROM part""")
def csv_scan_inferred(spark, d):
    path = io.write_csv(_part(spark, d), io.fresh_path(spark, "part_csv"), sep=";", header=True)
    return io.read_csv(spark, path, header=True, sep=";", infer_schema=True)


@register("range_filter_count", """
SELECT count(*) AS n_missing_keys
FROM (SELECT unnest(range(min(o_orderkey), max(o_orderkey) + 1)) AS id FROM orders) r
WHERE id NOT IN (SELECT o_orderkey FROM orders)""")
def range_filter_count(spark, d):
    # a distributed range over the order-key domain, filtered to keys no order
    # uses (anti join), then counted
    o = table(spark, d, "orders").select("o_orderkey")
    lo, hi = o.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    ids = io.range_source(spark, int(lo), int(hi) + 1)
    return (ids.join(o, ids.id == o.o_orderkey, "left_anti")
            .agg(F.count(F.lit(1)).alias("n_missing_keys")))


# The TPC-H return-flag codes and their meanings.
_FLAG_MEANINGS = [("A", "accepted"), ("N", "none"), ("R", "returned")]


@register("local_frame_source", """
SELECT l_returnflag, meaning, count(*) AS n
FROM lineitem JOIN (VALUES ('A', 'accepted'), ('N', 'none'), ('R', 'returned'))
     AS f(flag, meaning) ON l_returnflag = flag
GROUP BY l_returnflag, meaning""")
def local_frame_source(spark, d):
    lookup = io.local_lookup(spark, _FLAG_MEANINGS, "flag string, meaning string")
    counts = table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    return (counts.join(F.broadcast(lookup), counts.l_returnflag == lookup.flag)
            .select("l_returnflag", "meaning", "n"))


@register("sql_view_group_count", """
SELECT o_orderstatus, count(o_orderkey) AS n_orders FROM orders GROUP BY o_orderstatus""")
def sql_view_group_count(spark, d):
    return io.sql_on_view(table(spark, d, "orders"), "orders_view",
                          "SELECT o_orderstatus, count(o_orderkey) AS n_orders "
                          "FROM orders_view GROUP BY o_orderstatus")


@register("row_count", "SELECT count(*) AS n_rows FROM lineitem")
def row_count(spark, d):
    return table(spark, d, "lineitem").agg(F.count(F.lit(1)).alias("n_rows"))


_ORDERS_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.TimestampNTZType()),
    T.StructField("o_orderpriority", T.StringType())])


@register("csv_roundtrip", "SELECT * FROM orders")
def csv_roundtrip(spark, d):
    path = io.write_csv(table(spark, d, "orders"), io.fresh_path(spark, "orders_csv"), sep="|")
    return io.read_csv(spark, path, header=False, sep="|", schema=_ORDERS_SCHEMA)


@register("csv_single_file", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n FROM orders GROUP BY 1""")
def csv_single_file(spark, d):
    per_year = table(spark, d, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(
        F.count(F.lit(1)).alias("n"))
    path = io.write_single_csv(per_year, io.fresh_path(spark, "per_year_csv"))
    return io.read_csv(spark, path, header=False, sep="|", schema="year int, n long")


@register("partitioned_write_read", """
SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
WHERE year(o_orderdate) = 1997""")
def partitioned_write_read(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice",
                                         F.year("o_orderdate").alias("year"))
    path = io.write_partitioned(o, io.fresh_path(spark, "orders_by_year"), ["year"])
    # the filter on the partition column prunes directories at read time
    return spark.read.parquet(path).filter(F.col("year") == 1997).select(
        "o_orderkey", "o_totalprice", "year")


@register("table_roundtrip", "SELECT * FROM customer")
def table_roundtrip(spark, d):
    path = io.fresh_path(spark, "customer_table")
    name = path.rsplit("/", 1)[1].replace("-", "_")  # a name of its own
    io.save_table(table(spark, d, "customer"), name, path=path)
    return spark.table(name)


@register("report_export", with_views(DECILES_SQL + "SELECT * FROM t", score_view=SCORE_VIEW_SQL))
def report_export(spark, d):
    report = decile_table(score_view(spark, d), "label", score_order())
    path = io.export_report(report, io.fresh_path(spark, "decile_report"))
    return spark.read.parquet(path)
