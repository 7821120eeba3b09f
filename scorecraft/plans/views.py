"""Derived views over the test tables (FIXTURES.md §3).

Each view is given twice: as a DataFrame built from the Parquet tables and as a
SQL text that DuckDB can run on the same tables, so oracle queries can start
from the identical definition (``with_views``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- score view
# Signal label and fixed score on lineitem (FIXTURES.md "Label with signal",
# "Fixed score"). Tie keys make every ordering total.
SCORE_TIE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def score_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    score = 1.0 / (1.0 + F.exp(-(F.col("l_quantity") - 25.5) / 10.0))
    return li.select(
        *SCORE_TIE_KEYS,
        "l_quantity",
        ((F.col("l_quantity") > 25) != ((F.col("l_orderkey") % 5) == 0)).cast("int").alias("label"),
        score.alias("score"),
    ).withColumn("prediction", (F.col("score") >= 0.5).cast("int"))


SCORE_VIEW_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity,
       CAST(((l_quantity > 25) <> (l_orderkey % 5 = 0)) AS INTEGER) AS label,
       1.0 / (1.0 + exp(-(l_quantity - 25.5) / 10.0)) AS score,
       CAST(1.0 / (1.0 + exp(-(l_quantity - 25.5) / 10.0)) >= 0.5 AS INTEGER) AS prediction
FROM lineitem
"""

SCORE_ORDER_SQL = ("score DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey, "
                   "l_extendedprice")


def score_order() -> list:
    return [F.col("score").desc()] + [F.col(c).asc() for c in SCORE_TIE_KEYS]


# ---------------------------------------------------------------- movie view
# part ⋈ lineitem ⋈ orders: title, release date, budget, popularity, revenue.
def movie_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .join(p, li.l_partkey == p.p_partkey)
            .select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"),
                    F.col("p_name").alias("title"),
                    F.col("o_orderdate").alias("release_date"),
                    F.col("o_totalprice").alias("budget"),
                    F.col("l_quantity").alias("popularity"),
                    F.col("l_extendedprice").alias("revenue")))


MOVIE_VIEW_SQL = """
SELECT l_orderkey AS id, l_linenumber AS line, p_name AS title, o_orderdate AS release_date,
       o_totalprice AS budget, l_quantity AS popularity, l_extendedprice AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
"""


# ----------------------------------------------------------------- bank view
# lineitem ⋈ orders ⋈ customer with the signal label (and a second label).
BANK_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "c_acctbal",
                "o_totalprice"]
BANK_CATEGORICAL = ["l_returnflag", "l_linestatus", "c_mktsegment", "o_orderpriority"]
BANK_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def bank_view(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """Orders take their customer first, so that lineitem, the largest table, moves once.
    ``partitions``: parts of the join with lineitem, where it should not be Spark's choice."""
    li = table(spark, sf_dir, "lineitem").select(
        *BANK_KEYS, "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus")
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    oc = o.join(c, o.o_custkey == c.c_custkey)
    if partitions:
        li, oc = li.repartition(partitions, "l_orderkey"), oc.repartition(partitions, "o_orderkey")
    return (li.join(oc, li.l_orderkey == oc.o_orderkey)
            .select(*BANK_KEYS, *BANK_NUMERIC, *BANK_CATEGORICAL,
                    ((F.col("l_quantity") > 25) != ((F.col("l_orderkey") % 5) == 0))
                    .cast("int").alias("label"),
                    F.when(F.col("o_orderstatus") == "F", 0).otherwise(1).alias("label2")))


BANK_VIEW_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       l_quantity, l_extendedprice, l_discount, l_tax, c_acctbal, o_totalprice,
       l_returnflag, l_linestatus, c_mktsegment, o_orderpriority,
       CAST(((l_quantity > 25) <> (l_orderkey % 5 = 0)) AS INTEGER) AS label,
       CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS label2
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
"""


# -------------------------------------------------------------- missing view
# Derived missing values on lineitem: NULL (nullif), NaN and empty string.
def missing_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        F.when(F.col("l_tax") != 0.0, F.col("l_tax")).alias("l_tax"),
        F.when(F.col("l_discount") != 0.0, F.col("l_discount")).alias("l_discount"),
        F.when(F.col("l_linenumber") == 7, F.lit(float("nan")))
        .otherwise(F.col("l_extendedprice")).alias("l_extendedprice"),
        F.when(F.col("l_returnflag") == "N", F.lit("")).otherwise(F.col("l_returnflag"))
        .alias("l_returnflag"),
        "l_linestatus", "l_shipdate",
        ((F.col("l_quantity") > 25) != ((F.col("l_orderkey") % 5) == 0)).cast("int").alias("label"),
    )


MISSING_VIEW_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
       nullif(l_tax, 0.0) AS l_tax, nullif(l_discount, 0.0) AS l_discount,
       CASE WHEN l_linenumber = 7 THEN 'NaN'::DOUBLE ELSE l_extendedprice END AS l_extendedprice,
       CASE WHEN l_returnflag = 'N' THEN '' ELSE l_returnflag END AS l_returnflag,
       l_linestatus, l_shipdate,
       CAST(((l_quantity > 25) <> (l_orderkey % 5 = 0)) AS INTEGER) AS label
FROM lineitem
"""


# --------------------------------------------------------- customer features
# Per customer: order count, sum/mean totalprice, balance, distinct order
# months. Left join keeps customers without orders, so NULLs arise.
CUSTOMER_FEATURES = ["n_orders", "sum_price", "avg_price", "c_acctbal", "n_months"]


def customer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum("o_totalprice").alias("sum_price"),
        F.avg("o_totalprice").alias("avg_price"),
        F.countDistinct(F.date_trunc("month", "o_orderdate")).alias("n_months"))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return (c.join(o, c.c_custkey == o.o_custkey, "left")
            .select("c_custkey",
                    F.col("n_orders").cast("double").alias("n_orders"),
                    "sum_price", "avg_price", "c_acctbal",
                    F.col("n_months").cast("double").alias("n_months")))


CUSTOMER_FEATURES_SQL = """
SELECT c_custkey, CAST(n_orders AS DOUBLE) AS n_orders, sum_price, avg_price, c_acctbal,
       CAST(n_months AS DOUBLE) AS n_months
FROM customer LEFT JOIN (
  SELECT o_custkey, count(*) AS n_orders, sum(o_totalprice) AS sum_price,
         avg(o_totalprice) AS avg_price,
         count(DISTINCT date_trunc('month', o_orderdate)) AS n_months
  FROM orders GROUP BY o_custkey) o ON c_custkey = o_custkey
"""


def with_views(sql: str, **views: str) -> str:
    """Prefix ``sql`` with CTEs for the named view texts. ``sql`` is either a
    SELECT or further CTEs (``x AS (...), ...``) followed by the SELECT."""
    ctes = ",\n".join(f"{name} AS ({text})" for name, text in views.items())
    body = sql.strip()
    if body[:6].upper() in ("SELECT", "(SELEC") or body[:4].upper() == "FROM":
        return f"WITH {ctes}\n{body}"
    return f"WITH {ctes},\n{body}"


# ------------------------------------------------------ model × dataset scores
# Five fixed-score "models" over lineitem, each row assigned to one of the five
# datasets by key arithmetic. Feeds the metrics table and model selection.
MODEL_SCORES = {
    "quantity": "(l_quantity - 25.5) / 10.0",
    "discount": "(l_discount - 0.05) * 20.0",
    "tax": "(l_tax - 0.04) * 50.0",
    "blend": "(l_quantity - 25.5) / 10.0 + (l_tax - 0.04) * 7.0",
    "price": "(l_extendedprice - 36000.0) / 20000.0",
}
DATASET_CUTS = [(40, "train"), (60, "valid"), (80, "test"), (90, "oot1")]


def _dataset_expr_sql() -> str:
    cases = " ".join(f"WHEN ((l_orderkey % 100) * 7919) % 100 < {c} THEN '{n}'" for c, n in DATASET_CUTS)
    return f"CASE {cases} ELSE 'oot2' END"


def model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    bucket = F.pmod(F.col("l_orderkey") % 100 * F.lit(7919), F.lit(100))
    ds = None
    for cut, name in DATASET_CUTS:
        ds = F.when(bucket < cut, name) if ds is None else ds.when(bucket < cut, name)
    ds = ds.otherwise("oot2")
    models = F.array(*[F.struct(F.lit(m).alias("model"),
                                (1.0 / (1.0 + F.exp(-F.expr(z)))).alias("score"))
                       for m, z in MODEL_SCORES.items()])
    base = li.select(*SCORE_TIE_KEYS, ds.alias("dataset"),
                     ((F.col("l_quantity") > 25) != ((F.col("l_orderkey") % 5) == 0))
                     .cast("int").alias("label"),
                     F.explode(models).alias("m"))
    return base.select("m.model", "dataset", *SCORE_TIE_KEYS, "label", "m.score",
                       (F.col("m.score") >= 0.5).cast("int").alias("prediction"))


MODEL_SCORES_SQL = "\nUNION ALL\n".join(
    f"""SELECT '{m}' AS model, {_dataset_expr_sql()} AS dataset,
       l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
       CAST(((l_quantity > 25) <> (l_orderkey % 5 = 0)) AS INTEGER) AS label,
       1.0 / (1.0 + exp(-({z}))) AS score,
       CAST(1.0 / (1.0 + exp(-({z}))) >= 0.5 AS INTEGER) AS prediction
FROM lineitem""" for m, z in MODEL_SCORES.items())
