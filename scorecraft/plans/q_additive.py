"""Keys built on sums and counts that add up over parts of a table: exact samples,
least squares by subtraction, naive Bayes as tables, a join of bucketed tables
(SURVEY §2.4, §2.13, §2.15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import moments, sampling
from ..operators.bayes import NaiveBayesTables
from ..sources import io
from .registry import register
from .views import BANK_CATEGORICAL, BANK_KEYS, BANK_VIEW_SQL, bank_view, table, with_views

# ------------------------------------------------------------- exact samples
# A draw by key arithmetic, which any SQL engine can repeat.
_DRAWS = 1_000_003
_DRAW_SQL = f"(o_orderkey * 7919) % {_DRAWS}"


def _draw():
    return F.col("o_orderkey") * 7919 % _DRAWS


@register("sample_exact_share", f"""
SELECT o_orderkey, o_custkey, o_totalprice FROM (
  SELECT *, row_number() OVER (ORDER BY {_DRAW_SQL}, o_orderkey) AS place, count(*) OVER () AS n FROM orders)
WHERE place <= round(n * 0.4)""")
def sample_exact_share(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return sampling.exact_sample(o, 0.4, ["o_orderkey"], draw=_draw(), draws=_DRAWS)


@register("sample_exact_by_stratum", f"""
SELECT o_orderkey, year FROM (
  SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
         row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY {_DRAW_SQL}, o_orderkey) AS place,
         count(*) OVER (PARTITION BY year(o_orderdate)) AS n FROM orders)
WHERE place <= CASE year WHEN 1995 THEN round(n * 0.2) WHEN 1996 THEN round(n * 0.4) WHEN 1997 THEN 100 ELSE 0 END""")
def sample_exact_by_stratum(spark, d):
    """Shares of two years and a number of rows of a third."""
    o = table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    return sampling.exact_sample(o, {1995: 0.2, 1996: 0.4, 1997: 100}, ["o_orderkey"], "year",
                                 draw=_draw(), draws=_DRAWS)


# ---------------------------------------------- fits by subtraction (one scan)
def _left_out_sql(group: str, view: str) -> str:
    """Each group's fit on the other groups' rows and its error on its own."""
    return f"""
rows_ AS (SELECT {group} AS g, l_extendedprice AS x, l_extendedprice * (1 - l_discount) AS y FROM {view}),
groups_ AS (SELECT g, count(*) AS n_test FROM rows_ GROUP BY g),
fits AS (SELECT k.g, any_value(k.n_test) AS n_test, count(*) AS n_train, regr_slope(r.y, r.x) AS slope,
                regr_intercept(r.y, r.x) AS intercept, regr_r2(r.y, r.x) AS train_r2
         FROM groups_ k JOIN rows_ r ON r.g IS DISTINCT FROM k.g GROUP BY k.g),
tests AS (SELECT f.g, 1 - sum(pow(r.y - f.intercept - f.slope * r.x, 2)) / (var_pop(r.y) * count(*)) AS test_r2
          FROM fits f JOIN rows_ r ON r.g IS NOT DISTINCT FROM f.g GROUP BY f.g)
"""


_GROUP_SQL = ("SELECT f.g AS \"group\", n_train, n_test, round(intercept, 4) AS intercept, round(slope, 6) AS slope, "
              "round(train_r2, 6) AS train_r2, round(test_r2, 6) AS test_r2 FROM fits f JOIN tests t "
              "ON f.g IS NOT DISTINCT FROM t.g")


def _net(spark, d):
    return bank_view(spark, d).withColumn("y", F.col("l_extendedprice") * (1 - F.col("l_discount")))


def _rounded(fits):
    return fits.select("group", "n_train", "n_test", F.round("intercept", 4).alias("intercept"),
                       F.round(F.col("coefficients")[0], 6).alias("slope"),
                       F.round("train_r2", 6).alias("train_r2"), F.round("test_r2", 6).alias("test_r2"))


@register("leave_one_group_out_linear", with_views(
    _left_out_sql("c_mktsegment", "bank_view") + _GROUP_SQL, bank_view=BANK_VIEW_SQL))
def leave_one_group_out_linear(spark, d):
    return _rounded(moments.leave_one_group_out_linear(_net(spark, d), "c_mktsegment", ["l_extendedprice"], "y"))


@register("leave_one_supplier_out", with_views("""
s AS (SELECT l_suppkey AS g, count(*) AS n, sum(l_extendedprice / 1000) AS sx, sum(l_discount) AS sy,
             sum(pow(l_extendedprice / 1000, 2)) AS sxx, sum(l_extendedprice / 1000 * l_discount) AS sxy
      FROM bank_view GROUP BY l_suppkey),
t AS (SELECT sum(n) AS n, sum(sx) AS sx, sum(sy) AS sy, sum(sxx) AS sxx, sum(sxy) AS sxy FROM s),
r AS (SELECT s.g, s.n AS n_test, t.n - s.n AS n_train, t.sx - s.sx AS sx, t.sy - s.sy AS sy,
             t.sxx - s.sxx AS sxx, t.sxy - s.sxy AS sxy FROM s, t),
b AS (SELECT *, (n_train * sxy - sx * sy) / (n_train * sxx - sx * sx) AS slope FROM r)
SELECT g AS "group", CAST(n_train AS BIGINT) AS n_train, n_test, round(slope, 6) AS slope,
       round((sy - slope * sx) / n_train, 6) AS intercept FROM b""", bank_view=BANK_VIEW_SQL))
def leave_one_supplier_out(spark, d):
    """As many groups as there are suppliers."""
    b = bank_view(spark, d).withColumn("x", F.col("l_extendedprice") / 1000)
    fits = moments.leave_one_group_out_linear(b, "l_suppkey", ["x"], "l_discount")
    return fits.select("group", "n_train", "n_test", F.round(F.col("coefficients")[0], 6).alias("slope"),
                       F.round("intercept", 6).alias("intercept"))


_FOLD_SQL = ("CASE WHEN ((l_orderkey % 100) * 7919) % 100 < 34 THEN 'a' "
             "WHEN ((l_orderkey % 100) * 7919) % 100 < 67 THEN 'b' ELSE 'c' END")


@register("cross_validate_linear", with_views(
    _left_out_sql(_FOLD_SQL, "bank_view") + _GROUP_SQL, bank_view=BANK_VIEW_SQL))
def cross_validate_linear(spark, d):
    """Three folds by key arithmetic, each fitted on the other two."""
    fold = sampling.hash_split(F.col("l_orderkey"), [34, 33, 33], ["a", "b", "c"], multiplier=7919)
    return _rounded(moments.leave_one_group_out_linear(
        _net(spark, d).withColumn("fold", fold), "fold", ["l_extendedprice"], "y"))


# ------------------------------------------------------ naive Bayes as tables
_BAYES_NUMERIC = ["l_quantity", "l_discount", "l_tax"]
_CELLS_SQL = "\nUNION ALL ".join(
    [f"SELECT {', '.join(BANK_KEYS)}, label, '{c}' AS c, NULL AS v, {c} AS w FROM bank_view" for c in _BAYES_NUMERIC]
    + [f"SELECT {', '.join(BANK_KEYS)}, label, '{c}', {c}, 1.0 FROM bank_view" for c in BANK_CATEGORICAL])
_BAYES_SQL = f"""
cells AS ({_CELLS_SQL}),
cnt AS (SELECT label, c, v, sum(w) AS w FROM cells GROUP BY ALL),
tot AS (SELECT label, sum(w) AS t FROM cnt GROUP BY label),
voc AS (SELECT DISTINCT c, v FROM cnt),
pri AS (SELECT label, ln(count(*) + 1.0) - ln((SELECT count(*) FROM bank_view)
               + (SELECT count(*) FROM tot)) AS prior FROM bank_view GROUP BY label),
freq AS (SELECT tot.label, voc.c, voc.v,
                ln((coalesce(cnt.w, 0) + 1.0) / (tot.t + (SELECT count(*) FROM voc))) AS logp
         FROM tot CROSS JOIN voc LEFT JOIN cnt
           ON cnt.label = tot.label AND cnt.c = voc.c AND cnt.v IS NOT DISTINCT FROM voc.v)
"""


def _bayes(spark, d):
    return NaiveBayesTables(bank_view(spark, d), "label", _BAYES_NUMERIC, BANK_CATEGORICAL)


@register("naive_bayes_tables", with_views(_BAYES_SQL + """
SELECT CAST(label AS VARCHAR) AS label, '(prior)' AS term, NULL AS value, round(prior, 6) AS logarithm FROM pri
UNION ALL SELECT CAST(label AS VARCHAR), c, v, round(logp, 6) FROM freq""", bank_view=BANK_VIEW_SQL))
def naive_bayes_tables(spark, d):
    model = _bayes(spark, d)
    priors = model.prior_table().select("label", F.lit("(prior)").alias("term"), F.lit(None).cast("string").alias("value"),
                                        F.round("log_prior", 6).alias("logarithm"))
    return priors.unionByName(model.frequency_table().select(
        "label", F.col("column").alias("term"), "value", F.round("log_frequency", 6).alias("logarithm")))


@register("naive_bayes_predictions", with_views(_BAYES_SQL + """,
scored AS (SELECT {k}, f.label, round(any_value(p.prior) + sum(x.w * f.logp), 6) AS s
           FROM (SELECT {k}, c, v, w FROM cells) x JOIN freq f ON f.c = x.c AND f.v IS NOT DISTINCT FROM x.v
           JOIN pri p ON p.label = f.label GROUP BY {k}, f.label)
SELECT {k}, arg_max(label, s) AS prediction, max(s) AS prediction_score FROM scored GROUP BY {k}""".format(
    k=", ".join(BANK_KEYS)), bank_view=BANK_VIEW_SQL))
def naive_bayes_predictions(spark, d):
    """One row per key: lines that share their key are scored together."""
    scored = _bayes(spark, d).transform(bank_view(spark, d), by=BANK_KEYS)
    return scored.select(*BANK_KEYS, "prediction", F.round("prediction_score", 6).alias("prediction_score"))


# -------------------------------------------------------------- bucketed join
@register("bucketed_join", """
SELECT l_orderkey, l_linenumber, l_extendedprice, o_totalprice,
       CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS label
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def bucketed_join(spark, d):
    """Features and labels stored in buckets of their key, sorted by it, then joined."""
    x = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    y = table(spark, d, "orders").select(
        F.col("o_orderkey"), "o_totalprice", F.when(F.col("o_orderstatus") == "F", 0).otherwise(1).alias("label"))
    features, labels = (io.save_bucketed(t, io.fresh_path(spark, name), [key], 16)
                        for t, name, key in ((x, "features", "l_orderkey"), (y, "labels", "o_orderkey")))
    joined = spark.table(features).join(spark.table(labels), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.drop("o_orderkey")
