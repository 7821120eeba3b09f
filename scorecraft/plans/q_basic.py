"""Columns, filters, scalars, aggregates, windows, sorts, sets and joins
(SURVEY §2.3–2.10) over the test tables and derived views."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import ordering, profile, shaping
from ..operators.evaluation import decile_table
from .q_evaluation import DECILES_SQL
from .registry import register
from .views import (BANK_VIEW_SQL, MISSING_VIEW_SQL, MOVIE_VIEW_SQL, SCORE_VIEW_SQL,
                    bank_view, missing_view, movie_view, score_order, score_view, table,
                    with_views)

# ------------------------------------------------------------------ 2.3 columns


@register("select_columns", with_views(
    "SELECT id, line, title, budget, popularity FROM movie_view", movie_view=MOVIE_VIEW_SQL))
def select_columns(spark, d):
    return movie_view(spark, d).select("id", "line", "title", "budget", "popularity")


@register("select_by_position", "SELECT l_partkey, l_quantity, l_extendedprice FROM lineitem")
def select_by_position(spark, d):
    li = table(spark, d, "lineitem")
    return li.select(*[li[i] for i in (1, 4, 5)])


@register("select_by_name_regex", "SELECT COLUMNS('^(l_s.*|.*e)$') FROM lineitem")
def select_by_name_regex(spark, d):
    li = table(spark, d, "lineitem")
    return li.select(li.colRegex("`l_s.*|.*e`"))


@register("add_computed_column", """
SELECT l_orderkey, l_linenumber, l_extendedprice, l_discount,
       l_extendedprice * (1 - l_discount) AS net_price, 'lineitem' AS source
FROM lineitem""")
def add_computed_column(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice",
                                             "l_discount")
    return li.withColumns({"net_price": F.col("l_extendedprice") * (1 - F.col("l_discount")),
                           "source": F.lit("lineitem")})


@register("drop_columns", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def drop_columns(spark, d):
    return table(spark, d, "orders").drop("o_orderstatus", "o_orderdate", "o_orderpriority")


@register("rename_columns", """
SELECT o_orderkey AS order_id, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       o_orderpriority FROM orders""")
def rename_columns(spark, d):
    return table(spark, d, "orders").withColumnRenamed("o_orderkey", "order_id")


@register("rename_pairs_select", """
SELECT o_orderkey AS order_id, o_totalprice AS budget, o_orderdate AS release_date FROM orders""")
def rename_pairs_select(spark, d):
    pairs = [("o_orderkey", "order_id"), ("o_totalprice", "budget"),
             ("o_orderdate", "release_date")]
    return table(spark, d, "orders").select(*[F.col(o).alias(n) for o, n in pairs])


@register("rename_by_mapping", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment_index AS c_mktsegment
FROM (SELECT *, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1
      WHEN 'FURNITURE' THEN 2 WHEN 'HOUSEHOLD' THEN 3 ELSE 4 END AS c_mktsegment_index
      FROM customer)""")
def rename_by_mapping(spark, d):
    cu = table(spark, d, "customer")
    idx = (F.when(F.col("c_mktsegment") == "AUTOMOBILE", 0)
           .when(F.col("c_mktsegment") == "BUILDING", 1)
           .when(F.col("c_mktsegment") == "FURNITURE", 2)
           .when(F.col("c_mktsegment") == "HOUSEHOLD", 3).otherwise(4))
    return C.rename_index_suffix(cu.withColumn("c_mktsegment_index", idx), ["c_mktsegment"])


@register("rename_positional", """
SELECT n_nationkey AS nation_id, n_name AS nation, n_regionkey AS region_id FROM nation""")
def rename_positional(spark, d):
    return table(spark, d, "nation").toDF("nation_id", "nation", "region_id")


_STRING_ORDERS_SQL = """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_totalprice AS VARCHAR) AS o_totalprice,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderpriority
FROM orders"""


def _string_orders(spark, d):
    o = table(spark, d, "orders")
    return o.select(F.col("o_orderkey").cast("string").alias("o_orderkey"),
                    F.col("o_totalprice").cast("string").alias("o_totalprice"),
                    F.col("o_orderdate").cast("date").cast("string").alias("o_orderdate"),
                    "o_orderpriority")


@register("cast_by_type_lists", with_views("""
SELECT TRY_CAST(o_orderkey AS INTEGER) AS o_orderkey,
       TRY_CAST(o_orderpriority AS FLOAT) AS o_orderpriority,
       TRY_CAST(o_totalprice AS FLOAT) AS o_totalprice,
       CAST(TRY_CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate
FROM s""", s=_STRING_ORDERS_SQL))
def cast_by_type_lists(spark, d):
    # '1-URGENT' is not a number: try_cast gives NULL where ANSI cast would fail.
    # The date is shown as text so both engines print it alike.
    s = _string_orders(spark, d)
    out = C.cast_by_type_lists(s, {"int": ["o_orderkey"],
                                   "float": ["o_totalprice", "o_orderpriority"],
                                   "date": ["o_orderdate"]})
    return out.withColumn("o_orderdate", F.col("o_orderdate").cast("string"))


_BUCKET_SQL = """
SELECT id, line,
       CASE WHEN budget < 100000 THEN 'Small' WHEN budget < 300000 THEN 'Medium'
            ELSE 'Big' END AS budget_cat,
       CASE WHEN popularity < 15 THEN 'Low' WHEN popularity < 35 THEN 'Mid'
            ELSE 'High' END AS popularity_cat
FROM movie_view"""


def _bucket_cols():
    return (C.buckets(F.col("budget"), [(100000, "Small"), (300000, "Medium")], "Big")
            .alias("budget_cat"),
            C.buckets(F.col("popularity"), [(15, "Low"), (35, "Mid")], "High")
            .alias("popularity_cat"))


@register("case_bucket", with_views(_BUCKET_SQL, movie_view=MOVIE_VIEW_SQL))
def case_bucket(spark, d):
    return movie_view(spark, d).select("id", "line", *_bucket_cols())


@register("struct_expand", with_views(_BUCKET_SQL, movie_view=MOVIE_VIEW_SQL))
def struct_expand(spark, d):
    b, p = _bucket_cols()
    packed = movie_view(spark, d).select("id", "line", F.struct(b, p).alias("cats"))
    return packed.select("id", "line", F.col("cats").getField("budget_cat").alias("budget_cat"),
                         F.col("cats").getField("popularity_cat").alias("popularity_cat"))


@register("binary_label", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS label,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS urgent
FROM orders""")
def binary_label(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey",
                    (1 - C.binary_label(F.col("o_orderstatus"), ["F"])).alias("label"),
                    C.binary_label(F.col("o_orderpriority"), ["1-URGENT", "2-HIGH"])
                    .alias("urgent"))


@register("variable_types", with_views("""
SELECT column_name AS "column",
       CASE WHEN column_type = 'VARCHAR' THEN 'character'
            WHEN column_type IN ('TINYINT','SMALLINT','INTEGER','BIGINT','FLOAT','DOUBLE')
                 THEN 'numeric' ELSE 'other' END AS kind
FROM (DESCRIBE SELECT * FROM bank_view)""", bank_view=BANK_VIEW_SQL))
def variable_types(spark, d):
    kinds = C.variable_kinds(bank_view(spark, d))
    return spark.createDataFrame(kinds, "column string, kind string")


@register("fill_constant", with_views("""
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_tax IS NULL OR isnan(l_tax) THEN 0 ELSE l_tax END AS l_tax,
       CASE WHEN l_discount IS NULL OR isnan(l_discount) THEN 0 ELSE l_discount END AS l_discount,
       CASE WHEN l_extendedprice IS NULL OR isnan(l_extendedprice) THEN 0
            ELSE l_extendedprice END AS l_extendedprice
FROM m""", m=MISSING_VIEW_SQL))
def fill_constant(spark, d):
    m = missing_view(spark, d).select("l_orderkey", "l_linenumber", "l_tax", "l_discount",
                                      "l_extendedprice")
    return m.fillna(0, subset=["l_tax", "l_discount", "l_extendedprice"])


@register("consecutive_row_id", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_id FROM orders""")
def consecutive_row_id(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return ordering.global_row_number(o, ["o_orderdate", "o_orderkey"], out="row_id").select(
        "o_orderkey", "row_id")


# ------------------------------------------------------------------ 2.4 filters
_MISSING_COLS = ["l_tax", "l_discount", "l_extendedprice", "l_returnflag"]


@register("filter_missing_count", with_views("""
SELECT count(*) AS n_rows FROM m
WHERE l_tax IS NULL OR l_discount IS NULL OR l_extendedprice IS NULL OR isnan(l_extendedprice)
   OR l_returnflag IS NULL OR l_returnflag = ''""", m=MISSING_VIEW_SQL))
def filter_missing_count(spark, d):
    m = missing_view(spark, d)
    cond = None
    for c in _MISSING_COLS:
        cond = C.is_missing(m, c) if cond is None else cond | C.is_missing(m, c)
    return m.filter(cond).agg(F.count(F.lit(1)).alias("n_rows"))


@register("filter_not_missing", with_views("""
SELECT l_orderkey, l_linenumber, l_tax FROM m
WHERE l_tax IS NOT NULL AND NOT isnan(l_tax) AND l_tax <> 0""", m=MISSING_VIEW_SQL))
def filter_not_missing(spark, d):
    m = missing_view(spark, d)
    return m.filter(~C.is_missing(m, "l_tax") & (F.col("l_tax") != 0)).select(
        "l_orderkey", "l_linenumber", "l_tax")


@register("filter_sql_range", """
SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem
WHERE l_quantity BETWEEN 10 AND 20 AND l_discount >= 0.05""")
def filter_sql_range(spark, d):
    return (table(spark, d, "lineitem")
            .filter("l_quantity BETWEEN 10 AND 20 AND l_discount >= 0.05")
            .select("l_orderkey", "l_linenumber", "l_quantity", "l_discount"))


@register("like_prefix", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'small%'")
def like_prefix(spark, d):
    return table(spark, d, "part").filter(F.col("p_name").like("small%")).select(
        "p_partkey", "p_name")


@register("not_like_suffix", "SELECT p_partkey, p_name FROM part WHERE p_name NOT LIKE '%t'")
def not_like_suffix(spark, d):
    return table(spark, d, "part").filter(~F.col("p_name").like("%t")).select(
        "p_partkey", "p_name")


@register("regex_match", """
SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, '^(red|blue) (bolt|gear)$')""")
def regex_match(spark, d):
    return table(spark, d, "part").filter(F.col("p_name").rlike("^(red|blue) (bolt|gear)$")).select(
        "p_partkey", "p_name")


@register("contains_match", "SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'ing')")
def contains_match(spark, d):
    return table(spark, d, "part").filter(F.col("p_name").contains("ing")).select(
        "p_partkey", "p_name")


# -------------------------------------------------------------------- 2.5 joins
@register("join_features_target", """
SELECT l_linenumber, l_quantity, l_extendedprice, l_discount,
       CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS label
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def join_features_target(spark, d):
    x = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("key"), "l_linenumber",
                                           "l_quantity", "l_extendedprice", "l_discount")
    y = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("key"),
        F.when(F.col("o_orderstatus") == "F", 0).otherwise(1).alias("label"))
    return x.join(y, "key", "inner").drop("key")


@register("merge_group_aggregates", """
SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(l_quantity) AS DOUBLE) AS sum_qty,
       round(avg(l_extendedprice), 6) AS avg_price, round(max(l_discount), 6) AS max_disc
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def merge_group_aggregates(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("sum_qty"),
        F.round(F.avg("l_extendedprice"), 6).alias("avg_price"),
        F.round(F.max("l_discount"), 6).alias("max_disc"))


# ------------------------------------------------------------- 2.6 aggregations
@register("group_count", """
SELECT o_orderpriority, count(*) AS count FROM orders GROUP BY o_orderpriority
ORDER BY count DESC""")
def group_count(spark, d):
    return table(spark, d, "orders").groupBy("o_orderpriority").count().orderBy(F.desc("count"))


@register("group_having", """
SELECT o_custkey, count(*) AS count FROM orders GROUP BY o_custkey HAVING count(*) >= 15""")
def group_having(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey").count().filter(F.col("count") >= 15)


@register("group_avg", """
SELECT c_mktsegment, round(avg(c_acctbal), 6) AS avg_acctbal,
       round(avg(c_nationkey), 6) AS avg_nation FROM customer GROUP BY c_mktsegment""")
def group_avg(spark, d):
    return table(spark, d, "customer").groupBy("c_mktsegment").agg(
        F.round(F.avg("c_acctbal"), 6).alias("avg_acctbal"),
        F.round(F.avg("c_nationkey"), 6).alias("avg_nation"))


@register("decile_min_max_count", """
SELECT deciles, min(o_totalprice) AS min_price, max(o_totalprice) AS max_price, count(*) AS n
FROM (SELECT o_totalprice, ntile(10) OVER (ORDER BY o_totalprice DESC, o_orderkey) AS deciles
      FROM orders) GROUP BY deciles""")
def decile_min_max_count(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    t = ordering.global_ntile(o, [F.col("o_totalprice").desc(), "o_orderkey"], 10, out="deciles")
    return t.groupBy("deciles").agg(F.min("o_totalprice").alias("min_price"),
                                    F.max("o_totalprice").alias("max_price"),
                                    F.count(F.lit(1)).alias("n"))


@register("count_distinct", """
SELECT count(DISTINCT l_partkey) AS n_parts, count(DISTINCT l_suppkey) AS n_suppliers
FROM lineitem""")
def count_distinct(spark, d):
    return table(spark, d, "lineitem").agg(F.countDistinct("l_partkey").alias("n_parts"),
                                          F.countDistinct("l_suppkey").alias("n_suppliers"))


@register("count_distinct_by_year", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(DISTINCT o_custkey) AS n_customers
FROM orders GROUP BY 1""")
def count_distinct_by_year(spark, d):
    orders = table(spark, d, "orders").select(F.year("o_orderdate").alias("year"), "o_custkey")
    return profile.count_distinct_state(profile.distinct_state(orders, "o_custkey", ["year"]), ["year"], "n_customers")


@register("count_distinct_merged", """
SELECT count(DISTINCT o_custkey) AS n_customers FROM orders""")
def count_distinct_merged(spark, d):
    # the whole from one state per year: customers of several years count once
    orders = table(spark, d, "orders").select(F.year("o_orderdate").alias("year"), "o_custkey")
    years = profile.distinct_state(orders, "o_custkey", ["year"])
    return profile.count_distinct_state(profile.merge_distinct(years), out="n_customers")


@register("distinct_values", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def distinct_values(spark, d):
    return table(spark, d, "lineitem").select("l_returnflag", "l_linestatus").distinct()


@register("drop_duplicates_subset", """
SELECT o_custkey, year, o_orderdate, o_orderkey, o_totalprice FROM (
  SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderdate, o_orderkey,
         o_totalprice,
         row_number() OVER (PARTITION BY o_custkey, year(o_orderdate)
                            ORDER BY o_orderdate, o_orderkey, o_totalprice) AS rn
  FROM orders) WHERE rn = 1""")
def drop_duplicates_subset(spark, d):
    o = table(spark, d, "orders").select(
        "o_custkey", F.year("o_orderdate").alias("year"), "o_orderdate", "o_orderkey",
        "o_totalprice")
    return shaping.first_by_order(o, ["o_custkey", "year"], ["o_orderdate", "o_orderkey"])


@register("collect_list_by_group", with_views("""
SELECT title, string_agg(release_year || ':' || n, ',' ORDER BY release_year) AS years,
       sum(n) AS n_rows
FROM (SELECT title, year(release_date) AS release_year, count(*) AS n FROM movie_view
      GROUP BY 1, 2) GROUP BY title""", movie_view=MOVIE_VIEW_SQL))
def collect_list_by_group(spark, d):
    # rows per (title, year) are combined map-side first; the list per title says
    # how often each value occurs, so it loses nothing and is bounded by the
    # number of distinct years, not by the group's rows
    per_year = movie_view(spark, d).groupBy("title", F.year("release_date").alias("y")).agg(
        F.count(F.lit(1)).alias("n"))
    return per_year.groupBy("title").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("y", "n"))), lambda p: F.concat_ws(
            ":", p["y"].cast("string"), p["n"].cast("string"))), ",").alias("years"),
        F.sum("n").alias("n_rows"))


@register("count_by_year_range", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS count FROM orders
WHERE year(o_orderdate) BETWEEN 1996 AND 2000 GROUP BY 1 ORDER BY 1""")
def count_by_year_range(spark, d):
    o = table(spark, d, "orders")
    return (o.filter((F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz"))
                     & (F.col("o_orderdate") < F.lit("2001-01-01").cast("timestamp_ntz")))
            .groupBy(F.year("o_orderdate").alias("year")).count().orderBy("year"))


# ------------------------------------------------------------------ 2.7 windows
@register("ntile_deciles", """
SELECT o_orderkey, o_totalprice, ntile(10) OVER (ORDER BY o_totalprice DESC, o_orderkey) AS decile
FROM orders""")
def ntile_deciles(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return ordering.global_ntile(o, [F.col("o_totalprice").desc(), "o_orderkey"], 10,
                                 out="decile")


@register("second_best_in_year", """
SELECT year, o_orderkey, o_totalprice, rank FROM (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderkey, o_totalprice,
         CAST(rank() OVER (PARTITION BY year(o_orderdate) ORDER BY o_totalprice DESC) AS INTEGER)
           AS rank
  FROM orders) WHERE rank = 2""")
def second_best_in_year(spark, d):
    o = table(spark, d, "orders").select(F.year("o_orderdate").alias("year"), "o_orderkey",
                                         "o_totalprice")
    return shaping.nth_largest_rows(o, ["year"], "o_totalprice", rank=2)


@register("gap_to_partition_max", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, o_totalprice,
       max(o_totalprice) OVER (PARTITION BY year(o_orderdate)) - o_totalprice AS gap_to_max
FROM orders""")
def gap_to_partition_max(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"),
                                         "o_totalprice")
    return shaping.gap_to_group_max(o, ["year"], "o_totalprice")


@register("row_number_ntile", with_views(
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, "
    "row_number() OVER (ORDER BY score DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey, "
    "l_extendedprice) AS row_number, ntile(10) OVER (ORDER BY score DESC, l_orderkey, "
    "l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS deciles FROM score_view",
    score_view=SCORE_VIEW_SQL))
def row_number_ntile(spark, d):
    s = score_view(spark, d).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                    "l_extendedprice", "score")
    t = ordering.global_ntile(s, score_order(), 10, out="deciles", row_number="row_number")
    return t.drop("score")


@register("running_sum", """
SELECT l_quantity, count(*) AS n,
       sum(count(*)) OVER (ORDER BY l_quantity ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
         AS cum_n
FROM lineitem GROUP BY l_quantity""")
def running_sum(spark, d):
    bins = table(spark, d, "lineitem").groupBy("l_quantity").agg(F.count(F.lit(1)).alias("n"))
    return ordering.global_running_sum(bins, ["l_quantity"], ["n"])


@register("share_of_total", """
SELECT l_linestatus, l_returnflag, count(*) AS n,
       round(count(*) * 1.0 / sum(count(*)) OVER (PARTITION BY l_linestatus), 6) AS share,
       round(count(*) * 1.0 / sum(count(*)) OVER (), 6) AS share_all
FROM lineitem GROUP BY l_linestatus, l_returnflag""")
def share_of_total(spark, d):
    g = table(spark, d, "lineitem").groupBy("l_linestatus", "l_returnflag").agg(
        F.count(F.lit(1)).alias("n"))
    g = shaping.share_of_group(g, ["l_linestatus"], "n", "share")
    g = shaping.share_of_group(g, [], "n", "share_all")
    return g.withColumn("share", F.round("share", 6)).withColumn("share_all",
                                                                  F.round("share_all", 6))


@register("flag_max", with_views(DECILES_SQL + """
SELECT deciles, spread, CAST(spread = max(spread) OVER () AS INTEGER) AS is_max FROM t""",
                                 score_view=SCORE_VIEW_SQL))
def flag_max(spark, d):
    tbl = decile_table(score_view(spark, d), "label", score_order())
    return ordering.flag_max(tbl.select("deciles", "spread"), "spread")


# -------------------------------------------------------------------- 2.8 sorts
@register("top_n_rows", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def top_n_rows(spark, d):
    return (table(spark, d, "orders").select("o_orderkey", "o_totalprice")
            .orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10))


@register("top_n_per_group", """
SELECT o_orderpriority, o_orderkey, o_totalprice, rank FROM (
  SELECT o_orderpriority, o_orderkey, o_totalprice,
         CAST(row_number() OVER (PARTITION BY o_orderpriority
                                 ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS rank
  FROM orders) WHERE rank <= 3""")
def top_n_per_group(spark, d):
    o = table(spark, d, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    return ordering.top_n_per_group(o, ["o_orderpriority"],
                                    [F.col("o_totalprice").desc(), "o_orderkey"], 3)


# --------------------------------------------------------------------- 2.9 sets
@register("union_all", with_views("""
SELECT l_orderkey, l_linenumber, label FROM s WHERE label = 1
UNION ALL SELECT l_orderkey, l_linenumber, label FROM s WHERE label = 0""", s=SCORE_VIEW_SQL))
def union_all(spark, d):
    s = score_view(spark, d).select("l_orderkey", "l_linenumber", "label")
    return s.filter("label = 1").unionByName(s.filter("label = 0"))


# ----------------------------------------------------------- 2.10 scalar functions
@register("concat_columns", "SELECT p_partkey, concat(p_name, ' ', p_brand) AS label FROM part")
def concat_columns(spark, d):
    return table(spark, d, "part").select(
        "p_partkey", F.concat(F.col("p_name"), F.lit(" "), F.col("p_brand")).alias("label"))


@register("lower_trim", """
SELECT p_partkey, trim(lower(concat('  ', p_type, ' '))) AS p_type FROM part""")
def lower_trim(spark, d):
    return table(spark, d, "part").select(
        "p_partkey", F.trim(F.lower(F.concat(F.lit("  "), "p_type", F.lit(" ")))).alias("p_type"))


@register("date_parts", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(month(o_orderdate) AS INTEGER) AS month,
       CAST(day(o_orderdate) AS INTEGER) AS day FROM orders""")
def date_parts(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"),
        F.dayofmonth("o_orderdate").alias("day"))


@register("squared_deviation", """
SELECT o_orderkey, round(pow(o_totalprice - (SELECT avg(o_totalprice) FROM orders), 2) / 1e6, 4)
       AS sq_dev FROM orders""")
def squared_deviation(spark, d):
    o = table(spark, d, "orders")
    mean = o.agg(F.avg("o_totalprice")).scalar()
    return o.select("o_orderkey",
                    F.round(F.pow(F.col("o_totalprice") - mean, 2) / 1e6, 4).alias("sq_dev"))


@register("math_scalars", """
SELECT l_orderkey, l_linenumber, round(abs(l_discount - 0.05), 6) AS abs_dev,
       round(l_extendedprice, 1) AS price_1dp,
       CASE WHEN l_quantity > 0 THEN round(ln(l_quantity), 6) END AS log_qty
FROM lineitem""")
def math_scalars(spark, d):
    li = table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     F.round(F.abs(F.col("l_discount") - 0.05), 6).alias("abs_dev"),
                     F.round("l_extendedprice", 1).alias("price_1dp"),
                     F.round(C.safe_log(F.col("l_quantity")), 6).alias("log_qty"))


@register("uppercase_names", """
SELECT o_orderkey AS O_ORDERKEY, o_custkey AS O_CUSTKEY, o_orderstatus AS O_ORDERSTATUS,
       o_totalprice AS O_TOTALPRICE, o_orderdate AS O_ORDERDATE,
       o_orderpriority AS O_ORDERPRIORITY FROM orders""")
def uppercase_names(spark, d):
    return C.uppercase_names(table(spark, d, "orders"))


@register("guarded_ratio", """
SELECT l_orderkey, l_linenumber, round(l_tax / nullif(l_discount, 0), 6) AS tax_per_discount
FROM lineitem""")
def guarded_ratio(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.round(C.guarded_ratio(F.col("l_tax"), F.col("l_discount")), 6).alias("tax_per_discount"))
