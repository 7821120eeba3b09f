"""Profiling (A11–A19) and sampling/split keys (X1–X5b)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile, sampling
from .registry import register
from .views import (BANK_CATEGORICAL, BANK_KEYS, BANK_NUMERIC, BANK_VIEW_SQL, MISSING_VIEW_SQL, SCORE_VIEW_SQL, bank_view, missing_view,
                    score_view, table, with_views)

_DESC_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
              "l_extendedprice", "l_discount", "l_tax"]  # every numeric column


def _unpivot_sql(cols, select_expr, source):
    return "\nUNION ALL\n".join(select_expr(c) + f" FROM {source}" for c in cols)


@register("describe_table", _unpivot_sql(
    _DESC_COLS,
    lambda c: (f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 6) AS mean, "
               f"round(stddev_samp({c}), 6) AS stddev, round(min({c}), 6) AS min, "
               f"round(max({c}), 6) AS max"),
    "lineitem"))
def describe_table(spark, d):
    return profile.describe_long(table(spark, d, "lineitem"), _DESC_COLS)


@register("sample_variance", _unpivot_sql(
    _DESC_COLS, lambda c: f"SELECT '{c}' AS \"column\", round(var_samp({c}), 6) AS variance",
    "lineitem"))
def sample_variance(spark, d):
    return profile.sample_variance(table(spark, d, "lineitem"), _DESC_COLS)


_Q_COLS = _DESC_COLS
_PROBS = [0.25, 0.5, 0.75]


def _ranks_sql(error: float) -> str:
    """Answers are approximate; what must hold of each is its true rank."""
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", CAST({p} AS DOUBLE) AS prob, count({c}) AS n, true AS within FROM lineitem"
        for c in _Q_COLS for p in _PROBS)


@register("approx_median", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", CAST({p} AS DOUBLE) AS prob, "
    f"round((quantile_disc({c}, {p}) - min({c})) * 1.0 / (max({c}) - min({c})), 2) AS position, "
    f"count({c}) AS n, true AS within FROM lineitem"
    for c in _Q_COLS for p in _PROBS))
def approx_median(spark, d):
    # the place of each quantile in its column's range (an approximate quantile of
    # nearly distinct values may be a rank or two from the exact one), and whether its
    # true rank is within the error
    li = table(spark, d, "lineitem").select(*_Q_COLS)
    ends = li.agg(*[F.min(c).cast("double").alias(f"lo_{c}") for c in _Q_COLS],
                  *[F.max(c).cast("double").alias(f"hi_{c}") for c in _Q_COLS])
    span = ends.select(F.explode(F.array(*[F.struct(
        F.lit(c).alias("column"), F.col(f"lo_{c}").alias("lo"), F.col(f"hi_{c}").alias("hi"))
        for c in _Q_COLS])).alias("r")).select("r.*")
    q = profile.approx_quantiles(li, _Q_COLS, _PROBS, relative_error=1e-5)
    q = spark.createDataFrame(q.collect(), q.schema)  # a row per column and probability, used twice
    place = q.join(F.broadcast(span), "column").select("column", "prob", F.round(F.try_divide(
        F.col("value") - F.col("lo"), F.col("hi") - F.col("lo")), 2).alias("position"))
    return place.join(F.broadcast(profile.rank_checked(li, q, 1e-5)), ["column", "prob"])


_KLL = 2000


@register("quantile_sketch_merge", _ranks_sql(2 * profile.kll_rank_error(_KLL)))
def quantile_sketch_merge(spark, d):
    # one sketch per year of shipping, merged; twice the stated error holds for all answers
    li = table(spark, d, "lineitem").select("l_shipdate", *_Q_COLS)
    years = profile.quantile_state(li.withColumn("year", F.year("l_shipdate")), _Q_COLS, ["year"], _KLL)
    whole = profile.merge_quantiles(years, _Q_COLS, k=_KLL)
    return profile.rank_checked(li, profile.quantiles_from(whole, _Q_COLS, _PROBS), 2 * profile.kll_rank_error(_KLL))


_CARD_COLS = [*BANK_KEYS, *BANK_NUMERIC, *BANK_CATEGORICAL, "label", "label2"]


def _card_sql(c):
    return (f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct, "
            f"CAST(count(DISTINCT {c}) <= 5 AS INTEGER) AS flag")


@register("cardinality_profile", with_views(
    _unpivot_sql(_CARD_COLS, _card_sql, "bank_view"), bank_view=BANK_VIEW_SQL))
def cardinality_profile(spark, d):
    return profile.cardinality_profile(bank_view(spark, d), cut_off=5, exact=True)


@register("cardinality_profile_approx")
def cardinality_profile_approx(spark, d):
    return profile.cardinality_profile(bank_view(spark, d), cut_off=1, exact=False)


_MISS_DOUBLE = ["l_tax", "l_discount", "l_extendedprice"]
_MISS_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", *_MISS_DOUBLE,
              "l_returnflag", "l_linestatus", "l_shipdate", "label"]


def _miss_cond(c):
    if c in ("l_returnflag", "l_linestatus"):
        return f"{c} IS NULL OR {c} = ''"
    return f"{c} IS NULL OR isnan({c})" if c in _MISS_DOUBLE else f"{c} IS NULL"


@register("missing_counts", with_views(_unpivot_sql(
    _MISS_COLS, lambda c: f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {_miss_cond(c)}) "
                          "AS n_missing", "m"), m=MISSING_VIEW_SQL))
def missing_counts(spark, d):
    return profile.missing_counts(missing_view(spark, d))


def _miss_profile_sql(c):
    share = f"count(*) FILTER (WHERE {_miss_cond(c)}) * 1.0 / count(*)"
    return (f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {_miss_cond(c)}) AS n_missing, "
            f"round({share}, 6) AS missing_share, CAST({share} >= 0.05 AS INTEGER) AS \"drop\", "
            f"CAST({share} <= 0.02 AS INTEGER) AS keep")


@register("missing_profile", with_views(_unpivot_sql(_MISS_COLS, _miss_profile_sql, "m"),
                                        m=MISSING_VIEW_SQL))
def missing_profile(spark, d):
    # thresholds scaled to the derived view (5% / 2%), the reference's are 80% / 75%
    return profile.missing_profile(missing_view(spark, d), drop_at=0.05, keep_at=0.02)


def _hist_sql(source_filter: str) -> str:
    return f"""
WITH x AS (SELECT l_extendedprice AS x FROM lineitem WHERE isfinite(l_extendedprice)
           {source_filter}),
s AS (SELECT min(x) AS lo, max(x) AS hi, (max(x) - min(x)) / 25.0 AS w FROM x),
b AS (SELECT least(CAST(floor((x - lo) / w) AS INTEGER), 24) AS bin FROM x, s),
c AS (SELECT bin, count(*) AS n FROM b GROUP BY bin)
SELECT CAST(r.bin AS INTEGER) AS bin, round(lo + r.bin * w, 6) AS lo, round(lo + (r.bin + 1) * w, 6) AS hi,
       CAST(coalesce(n, 0) AS BIGINT) AS count
FROM (SELECT unnest(range(25)) AS bin) r CROSS JOIN s LEFT JOIN c ON r.bin = c.bin"""


@register("histogram_equal_width", _hist_sql(""))
def histogram_equal_width(spark, d):
    return profile.histogram_equal_width(table(spark, d, "lineitem"), "l_extendedprice", 25)


@register("histogram_filtered", _hist_sql("AND l_quantity BETWEEN 10 AND 40"))
def histogram_filtered(spark, d):
    li = table(spark, d, "lineitem").filter(F.col("l_quantity").between(10, 40))
    return profile.histogram_equal_width(li, "l_extendedprice", 25)


# ------------------------------------------------------------ sampling/splits
@register("sample_fraction")
def sample_fraction(spark, d):
    return sampling.sample_fraction(table(spark, d, "orders"), 0.4, seed=2023)


@register("sample_by_stratum")
def sample_by_stratum(spark, d):
    o = table(spark, d, "orders").withColumn("year", F.year("o_orderdate"))
    return sampling.sample_by_stratum(o, "year", {1995: 0.2, 1996: 0.4, 1997: 0.4}, seed=2023)


def _split_sql(percents, names) -> str:
    cases, acc = "", 0
    for p, n in list(zip(percents, names))[:-1]:
        acc += p
        cases += f"WHEN ((l_orderkey % 100) * 7919) % 100 < {acc} THEN '{n}' "
    return with_views(f"SELECT *, CASE {cases}ELSE '{names[-1]}' END AS split FROM s",
                      s=SCORE_VIEW_SQL)


def _split(spark, d, percents, names):
    return score_view(spark, d).withColumn("split", sampling.hash_split(
        F.col("l_orderkey"), percents, names, multiplier=7919))


@register("split_two_way", _split_sql([70, 30], ["train", "test"]))
def split_two_way(spark, d):
    return _split(spark, d, [70, 30], ["train", "test"])


@register("split_seeded")
def split_seeded(spark, d):
    return sampling.labelled_split(score_view(spark, d), [0.7, 0.3], ["train", "test"], seed=2023)


@register("split_70_20_10", _split_sql([70, 20, 10], ["train", "valid", "test"]))
def split_70_20_10(spark, d):
    return _split(spark, d, [70, 20, 10], ["train", "valid", "test"])


@register("split_three_way", _split_sql([40, 30, 30], ["train", "valid", "test"]))
def split_three_way(spark, d):
    return _split(spark, d, [40, 30, 30], ["train", "valid", "test"])


@register("stratified_split", with_views("""
c AS (SELECT label, count(*) AS n FROM s GROUP BY label)
SELECT 'train' AS split, label, CAST(round(n * 0.7) AS BIGINT) AS n FROM c
UNION ALL SELECT 'test' AS split, label, n - CAST(round(n * 0.7) AS BIGINT) AS n FROM c""",
                                         s=SCORE_VIEW_SQL))
def stratified_split(spark, d):
    s = score_view(spark, d).select("l_orderkey", "l_linenumber", "label")
    out = sampling.stratified_split(s, "label", [0.7, 0.3], ["train", "test"], seed=12345, keep=[])
    return out.groupBy("split", "label").agg(F.count(F.lit(1)).alias("n"))


@register("hash_split_counts", with_views("""
SELECT CASE WHEN ((l_orderkey % 100) * 7919) % 100 < 70 THEN 'train' ELSE 'test' END AS split, label,
       count(*) AS n
FROM s GROUP BY 1, 2""", s=SCORE_VIEW_SQL))
def hash_split_counts(spark, d):
    s = score_view(spark, d)
    split = sampling.hash_split(F.col("l_orderkey"), [70, 30], ["train", "test"], multiplier=7919)
    return s.groupBy(split.alias("split"), "label").agg(F.count(F.lit(1)).alias("n"))
