"""Variable-selection keys on the bank view."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import selection as sel
from .registry import register
from .views import BANK_NUMERIC, BANK_VIEW_SQL, bank_view, with_views

WOE_NUMERIC = BANK_NUMERIC
WOE_CATEGORICAL = ["l_returnflag", "l_linestatus", "c_mktsegment", "o_orderpriority"]
CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "c_acctbal", "o_totalprice",
             "net_price"]
# the raw test columns are nearly independent; the net price is not
CORR_VIEW_SQL = "SELECT *, l_extendedprice * (1 - l_discount) AS net_price FROM bank_view"


def corr_view(spark, d):
    b = bank_view(spark, d)
    return b.withColumn("net_price", F.col("l_extendedprice") * (1 - F.col("l_discount")))


def _monotonic_ctes(cols: list[str], max_bins: int = 20) -> str:
    """Monotonic binning in SQL, up to ``best`` (variable, n_bins, rho)."""
    ns = range(2, max_bins + 1)
    qcols = ", ".join(
        f"quantile_disc(x, [{', '.join(repr(i / n) for i in range(1, n))}]) AS q{n}" for n in ns)
    long = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS varname, CAST({c} AS DOUBLE) AS x, CAST(label AS DOUBLE) AS y "
        f"FROM bank_view" for c in cols)
    splits = "\nUNION ALL\n".join(
        f"SELECT varname, {n} AS n, list_distinct(q{n}) AS splits FROM q" for n in ns)
    names = ", ".join(f"'{c}'" for c in cols)
    return f"""
lg AS (SELECT * FROM ({long}) WHERE x IS NOT NULL AND NOT isnan(x)),
q AS (SELECT varname, {qcols} FROM lg GROUP BY varname),
sp AS ({splits}),
bk AS (SELECT lg.varname, sp.n, len(list_filter(sp.splits, lambda s: s <= lg.x)) AS bucket,
              lg.x, lg.y FROM lg JOIN sp ON lg.varname = sp.varname),
mb AS (SELECT varname, n, bucket, avg(x) AS mx, avg(y) AS my FROM bk GROUP BY varname, n, bucket),
rk AS (SELECT *,
         rank() OVER (PARTITION BY varname, n ORDER BY mx)
           + (count(*) OVER (PARTITION BY varname, n, mx) - 1) / 2.0 AS rx,
         rank() OVER (PARTITION BY varname, n ORDER BY my)
           + (count(*) OVER (PARTITION BY varname, n, my) - 1) / 2.0 AS ry FROM mb),
rh AS (SELECT varname, n, corr(rx, ry) AS rho, count(*) AS k FROM rk GROUP BY varname, n),
best AS (SELECT varname, max(n) AS n_bins, arg_max(rho, n) AS rho FROM rh
         WHERE k >= 2 AND abs(rho) >= 1 - 1e-9 GROUP BY varname),
names AS (SELECT unnest([{names}]) AS varname)"""


def _woe_sql() -> str:
    cat_cols = ", ".join(WOE_CATEGORICAL)
    return with_views(_monotonic_ctes(WOE_NUMERIC) + f""",
cut AS (SELECT names.varname, coalesce(sp.splits, []) AS splits FROM names
        LEFT JOIN best ON names.varname = best.varname
        LEFT JOIN sp ON sp.varname = best.varname AND sp.n = best.n_bins),
nb AS (SELECT lg.varname, x, y AS label,
              CAST(len(list_filter(splits, lambda s: s <= x)) AS VARCHAR) AS bin
       FROM lg JOIN cut ON lg.varname = cut.varname),
cat AS (SELECT varname, CAST(v AS VARCHAR) AS bin, label FROM
        (UNPIVOT (SELECT label, {cat_cols} FROM bank_view) ON {cat_cols}
         INTO NAME varname VALUE v)),
g AS (SELECT varname, bin, count(*) AS cnt, CAST(sum(label) AS BIGINT) AS event,
             CAST(min(x) AS VARCHAR) AS min_value, CAST(max(x) AS VARCHAR) AS max_value
      FROM nb GROUP BY varname, bin
      UNION ALL
      SELECT varname, bin, count(*), CAST(sum(label) AS BIGINT), bin, bin FROM cat
      GROUP BY varname, bin),
d AS (SELECT *, cnt - event AS non_event,
             event * 1.0 / sum(event) OVER (PARTITION BY varname) AS de,
             (cnt - event) * 1.0 / sum(cnt - event) OVER (PARTITION BY varname) AS dn FROM g),
w AS (SELECT *, CASE WHEN de > 0 AND dn > 0 THEN ln(de / dn) ELSE 0 END AS woe FROM d),
woe AS (SELECT varname, min_value, max_value, CAST(cnt AS BIGINT) AS count,
               CAST(event AS BIGINT) AS event, CAST(non_event AS BIGINT) AS non_event,
               round(event * 1.0 / cnt, 6) AS event_rate,
               round(non_event * 1.0 / cnt, 6) AS nonevent_rate,
               round(de, 6) AS dist_event, round(dn, 6) AS dist_nonevent, round(woe, 6) AS woe,
               round(sum((de - dn) * woe) OVER (PARTITION BY varname), 6) AS iv FROM w)
""", bank_view=BANK_VIEW_SQL)


def _woe(spark, d):
    return sel.woe_table(bank_view(spark, d), WOE_NUMERIC, WOE_CATEGORICAL, "label")


register("woe_table", _woe_sql() + "SELECT * FROM woe")(_woe)


@register("iv_table", _woe_sql() + 'SELECT varname, max(iv) AS "IV" FROM woe GROUP BY varname')
def iv_table(spark, d):
    return sel.iv_table(_woe(spark, d))


@register("quantile_bucket", with_views("""
sp AS (SELECT list_sort(list_distinct(quantile_disc(l_extendedprice,
                                      [0.2, 0.4, 0.6, 0.8]))) AS splits FROM bank_view)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(len(list_filter(splits, lambda s: s <= l_extendedprice)) AS INTEGER) AS bucket
FROM bank_view, sp""", bank_view=BANK_VIEW_SQL))
def quantile_bucket(spark, d):
    # exact equal-frequency buckets (QuantileDiscretizer with relativeError 0)
    b = bank_view(spark, d)
    splits = sel.quantile_splits(b, ["l_extendedprice"], 5)["l_extendedprice"]
    return sel.with_buckets(
        b.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"),
        {"bucket": (F.col("l_extendedprice"), splits)}).drop("l_extendedprice")


@register("monotonic_bins", with_views(_monotonic_ctes(WOE_NUMERIC) + """
SELECT names.varname, CAST(coalesce(best.n_bins, 1) AS INTEGER) AS n_bins,
       round(best.rho, 6) AS rho
FROM names LEFT JOIN best ON names.varname = best.varname""", bank_view=BANK_VIEW_SQL))
def monotonic_bins(spark, d):
    return sel.monotonic_bins(bank_view(spark, d), WOE_NUMERIC, "label")


def _corr_sql(method: str) -> str:
    if method == "pearson":
        src = "cv"
        cols = CORR_COLS
    else:
        src = "rk"
        cols = [f"r_{c}" for c in CORR_COLS]
    pairs = "\nUNION ALL\n".join(
        f"SELECT '{a}' AS var1, '{b}' AS var2, round(corr({ca}, {cb}), 6) AS corr FROM {src}"
        for a, ca in zip(CORR_COLS, cols) for b, cb in zip(CORR_COLS, cols))
    ranks = ", ".join(
        f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS r_{c}"
        for c in CORR_COLS)
    return with_views(f"cv AS ({CORR_VIEW_SQL}), rk AS (SELECT {ranks} FROM cv)\n{pairs}",
                      bank_view=BANK_VIEW_SQL)


@register("correlation_matrix_pearson", _corr_sql("pearson"))
def correlation_matrix_pearson(spark, d):
    return sel.correlation_matrix(corr_view(spark, d), CORR_COLS, "pearson")


@register("correlation_matrix_spearman", _corr_sql("spearman"))
def correlation_matrix_spearman(spark, d):
    return sel.correlation_matrix(corr_view(spark, d), CORR_COLS, "spearman")


_PAIRS_CUT = 0.5


@register("correlated_pairs", "SELECT * FROM (" + _corr_sql("pearson") +
          f") WHERE var1 <> var2 AND abs(corr) > {_PAIRS_CUT}")
def correlated_pairs(spark, d):
    corr = sel.correlation_matrix(corr_view(spark, d), CORR_COLS, "pearson")
    return sel.correlated_pairs(corr, _PAIRS_CUT)


@register("correlation_transformer", "SELECT * FROM (" + _corr_sql("spearman") +
          f") WHERE var1 <> var2 AND abs(corr) > {_PAIRS_CUT}")
def correlation_transformer(spark, d):
    stage = sel.CorrelationFilter(inputCols=CORR_COLS, correlationType="spearman",
                                  correlationCutoff=_PAIRS_CUT)
    return stage.transform(corr_view(spark, d))


@register("vif_table", with_views(f"""
cv AS ({CORR_VIEW_SQL}),
c AS (SELECT corr(net_price, l_extendedprice) AS r FROM cv)
SELECT 'net_price' AS feature, round(1 / (1 - r * r), 4) AS vif FROM c
UNION ALL SELECT 'l_extendedprice' AS feature, round(1 / (1 - r * r), 4) AS vif FROM c""",
                                  bank_view=BANK_VIEW_SQL))
def vif_table(spark, d):
    return sel.vif_table(corr_view(spark, d), ["net_price", "l_extendedprice"], digits=4)


@register("vif_table_all")
def vif_table_all(spark, d):
    return sel.vif_table(corr_view(spark, d), CORR_COLS)


def _chi_sql() -> str:
    parts = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, label FROM bank_view"
        for c in WOE_CATEGORICAL)
    return with_views(f"""
l AS ({parts}),
vals AS (SELECT DISTINCT feature, value FROM l), ys AS (SELECT DISTINCT feature, label FROM l),
o AS (SELECT feature, value, label, count(*) AS o FROM l GROUP BY ALL),
grid AS (SELECT v.feature, v.value, y.label, coalesce(o.o, 0) AS o
         FROM vals v JOIN ys y ON v.feature = y.feature
         LEFT JOIN o ON o.feature = v.feature AND o.value = v.value AND o.label = y.label),
e AS (SELECT *, sum(o) OVER (PARTITION BY feature, value) * sum(o) OVER (PARTITION BY feature, label)
              * 1.0 / sum(o) OVER (PARTITION BY feature) AS e FROM grid)
SELECT feature, round(sum((o - e) * (o - e) / e), 6) AS statistic,
       CAST((count(DISTINCT value) - 1) * (count(DISTINCT label) - 1) AS INTEGER) AS dof
FROM e GROUP BY feature""", bank_view=BANK_VIEW_SQL)


@register("chi_square_statistic", _chi_sql())
def chi_square_statistic(spark, d):
    return sel.chi_square_statistic(bank_view(spark, d), WOE_CATEGORICAL, "label")


def _vote_scores_sql() -> str:
    pear = "\nUNION ALL\n".join(
        f"SELECT 'pearson' AS method, '{c}' AS feature, abs(corr({c}, label)) AS score "
        f"FROM cv" for c in CORR_COLS)
    smd = "\nUNION ALL\n".join(
        f"SELECT 'mean_gap' AS method, '{c}' AS feature, "
        f"abs(avg({c}) FILTER (WHERE label = 1) - avg({c}) FILTER (WHERE label = 0)) "
        f"/ stddev_samp({c}) AS score FROM cv" for c in CORR_COLS)
    rng = "\nUNION ALL\n".join(
        f"SELECT 'iqr_gap' AS method, '{c}' AS feature, "
        f"abs(quantile_disc({c}, 0.5) FILTER (WHERE label = 1) - "
        f"quantile_disc({c}, 0.5) FILTER (WHERE label = 0)) "
        f"/ nullif(quantile_disc({c}, 0.75) - quantile_disc({c}, 0.25), 0) AS score "
        f"FROM cv" for c in CORR_COLS)
    return f"{pear}\nUNION ALL\n{smd}\nUNION ALL\n{rng}"


def _vote_scores(spark, d):
    """Three SQL-expressible importance scores per numeric feature."""
    b = corr_view(spark, d)
    y = F.col("label")
    rows = []
    for c in CORR_COLS:
        x = F.col(c)
        rows.append(F.struct(F.lit("pearson").alias("method"), F.lit(c).alias("feature"),
                             F.abs(F.corr(x, y)).alias("score")))
        gap = F.abs(F.avg(F.when(y == 1, x)) - F.avg(F.when(y == 0, x))) / F.stddev_samp(x)
        rows.append(F.struct(F.lit("mean_gap").alias("method"), F.lit(c).alias("feature"),
                             gap.alias("score")))
    agg = b.agg(F.array(*rows).alias("a")).select(F.explode("a").alias("r")).select("r.*")
    # medians per class and quartiles, exact, of all columns at once
    parts = b.select(*CORR_COLS, *[F.when(y == k, F.col(c)).alias(f"{c}__{k}")
                                   for c in CORR_COLS for k in (0, 1)])
    q = sel.exact_quantiles(parts, parts.columns, [0.25, 0.5, 0.75])
    gaps = []
    for c in CORR_COLS:
        spread = q[c][0.75] - q[c][0.25]
        gaps.append(("iqr_gap", c, abs(q[f"{c}__1"][0.5] - q[f"{c}__0"][0.5]) / spread if spread else None))
    iqr = spark.createDataFrame(gaps, "method string, feature string, score double")
    return agg.unionByName(iqr)


@register("voting_selection", with_views(f"""
cv AS ({CORR_VIEW_SQL}),
s AS ({_vote_scores_sql()}),
t AS (SELECT *, row_number() OVER (PARTITION BY method ORDER BY score DESC NULLS LAST, feature)
               AS r FROM s)
SELECT feature, count(*) AS votes FROM t WHERE r <= 3 GROUP BY feature""",
                                         bank_view=BANK_VIEW_SQL))
def voting_selection(spark, d):
    return sel.voting(_vote_scores(spark, d), top_n=3)
