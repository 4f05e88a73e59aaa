"""Descriptive statistics, profiles and hypothesis-test statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.cleaning import round_to
from tessera.operators import aggregates as A
from tessera.operators import stats as S
from tessera.plans.registry import register
from tessera.tables import Tables

_LINE_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
              "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
              "l_shipdate"]


def _r(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.select(*[round_to(c, digits[c]).alias(c) if c in digits else F.col(c)
                       for c in df.columns])


def t_p_value_sql(t: str, v: str) -> str:
    """DuckDB text of a two-sided t p-value: Simpson's rule over the density (nothing is left beyond 40)."""
    x, w = f"least(abs({t}), 40)", "CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    return (f"(SELECT greatest(0, 1 - 2 * exp(lgamma(({v} + 1) / 2) - lgamma({v} / 2)) / sqrt({v} * pi()) * {x} / 12000 "
            f"* sum({w} * power(1 + power({x} * i / 4000, 2) / {v}, -({v} + 1) / 2))) FROM generate_series(0, 4000) g(i))")


def t_quantile_sql(v: str) -> str:
    """DuckDB text of the 97.5% t quantile by its expansion for large degrees of freedom."""
    z = "1.959963984540054"
    return (f"({z} + (pow({z}, 3) + {z}) / (4 * {v}) + (5 * pow({z}, 5) + 16 * pow({z}, 3) + 3 * {z}) / (96 * pow({v}, 2)) "
            f"+ (3 * pow({z}, 7) + 19 * pow({z}, 5) + 17 * pow({z}, 3) - 15 * {z}) / (384 * pow({v}, 3)))")


@register("group_summary", "A02 J01", """
SELECT p.p_type, COUNT(l.l_extendedprice) AS n,
       ROUND(ROUND(SUM(l.l_extendedprice), 2) / COUNT(l.l_extendedprice), 4) AS mean,
       ROUND(median(l.l_extendedprice), 4) AS median, MIN(l.l_extendedprice) AS min,
       MAX(l.l_extendedprice) AS max, ROUND(stddev_samp(l.l_extendedprice), 4) AS sd
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY p.p_type""")
def q_group_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    li = t.lineitem.select("l_partkey", "l_extendedprice")
    j = li.join(t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    g = A.group_summary(j, ["p_type"], "l_extendedprice", [F.sum("l_extendedprice").alias("_sum")])
    # money average from the cent-exact sum (same value, engine-independent ties)
    g = g.withColumn("mean", round_to("_sum", 2) / F.col("n")).drop("_sum")
    return _r(g, {"mean": 4, "median": 4, "sd": 4})


@register("group_counts", "A01 O01", """
SELECT p_brand, COUNT(*) AS n FROM part GROUP BY p_brand""")
def q_group_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.group_counts(Tables(spark, sf_dir).part, ["p_brand"])


_MS_COLS = ["l_quantity", "l_discount", "l_tax"]


@register("multi_summary", "A18", "SELECT l_returnflag, " + ", ".join(
    f"ROUND(AVG({c}), 6) AS {c}_mean, ROUND(stddev_samp({c}), 6) AS {c}_sd" for c in _MS_COLS)
    + " FROM lineitem GROUP BY l_returnflag")
def q_multi_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = A.multi_summary(Tables(spark, sf_dir).lineitem, _MS_COLS, ["l_returnflag"])
    return _r(m, {c: 6 for c in m.columns if c != "l_returnflag"})


@register("null_profile", "A09 A19", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count FROM lineitem"
    for c in _LINE_COLS))
def q_null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.null_profile(Tables(spark, sf_dir).lineitem, _LINE_COLS)


@register("duplicate_rows", "A10", """
SELECT (SELECT COUNT(*) FROM lineitem) AS rows, COUNT(*) AS distinct_rows,
       (SELECT COUNT(*) FROM lineitem) - COUNT(*) AS duplicate_rows
FROM (SELECT DISTINCT * FROM lineitem)""")
def q_duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.duplicate_rows(Tables(spark, sf_dir).lineitem)


_CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("corr_matrix", "A12 A13", "\nUNION ALL\n".join(
    f"SELECT '{a}' AS var1, '{b}' AS var2, ROUND(corr({a}, {b}), 6) AS r FROM lineitem"
    for i, a in enumerate(_CORR_COLS) for b in _CORR_COLS[i + 1:]))
def q_corr_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r(A.correlation_matrix(Tables(spark, sf_dir).lineitem, _CORR_COLS), {"r": 6})


@register("contingency", "A14 M11", """
WITH r AS (SELECT DISTINCT o_orderpriority FROM orders),
c AS (SELECT DISTINCT o_orderstatus FROM orders),
n AS (SELECT o_orderpriority, o_orderstatus, COUNT(*) AS n FROM orders GROUP BY 1, 2)
SELECT r.o_orderpriority, c.o_orderstatus, COALESCE(n.n, 0) AS n
FROM r CROSS JOIN c LEFT JOIN n ON n.o_orderpriority = r.o_orderpriority
  AND n.o_orderstatus = c.o_orderstatus""")
def q_contingency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.contingency(Tables(spark, sf_dir).orders, "o_orderpriority", "o_orderstatus")


@register("shares", "A07 A15 W07", """
SELECT o_orderpriority, o_orderstatus, COUNT(*) AS n,
       ROUND(COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY o_orderpriority), 6) AS share
FROM orders GROUP BY 1, 2""")
def q_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = A.proportions(Tables(spark, sf_dir).orders, "o_orderpriority", "o_orderstatus")
    return _r(p, {"share": 6})


@register("histogram", "A16", """
WITH b AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
c AS (SELECT CAST(least(floor((l_extendedprice - lo) * 40 / (hi - lo)), 39) AS INTEGER) AS bin,
             COUNT(*) AS n
      FROM lineitem, b GROUP BY 1),
g AS (SELECT CAST(range AS INTEGER) AS bin FROM range(40))
SELECT g.bin, ROUND(lo + g.bin * (hi - lo) / 40, 4) AS lower,
       ROUND(lo + (g.bin + 1) * (hi - lo) / 40, 4) AS upper, COALESCE(c.n, 0) AS n
FROM g CROSS JOIN b LEFT JOIN c ON g.bin = c.bin""")
def q_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = A.histogram(Tables(spark, sf_dir).lineitem, "l_extendedprice", 40)
    return _r(h, {"lower": 4, "upper": 4})


@register("boxplot", "A17 G02", """
WITH q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1,
                  median(l_extendedprice) AS median, quantile_cont(l_extendedprice, 0.75) AS q3
           FROM lineitem GROUP BY 1),
w AS (SELECT l.l_returnflag,
             MIN(CASE WHEN l_extendedprice >= q1 - 1.5 * (q3 - q1) THEN l_extendedprice END) AS lower_whisker,
             MAX(CASE WHEN l_extendedprice <= q3 + 1.5 * (q3 - q1) THEN l_extendedprice END) AS upper_whisker,
             COUNT(*) FILTER (WHERE l_extendedprice < q1 - 1.5 * (q3 - q1)
                               OR l_extendedprice > q3 + 1.5 * (q3 - q1)) AS outliers
      FROM lineitem l JOIN q ON l.l_returnflag = q.l_returnflag GROUP BY 1)
SELECT q.l_returnflag, ROUND(q1, 4) AS q1, ROUND(median, 4) AS median, ROUND(q3, 4) AS q3,
       ROUND(q3 - q1, 4) AS iqr, lower_whisker, upper_whisker, outliers
FROM q JOIN w ON q.l_returnflag = w.l_returnflag""")
def q_boxplot(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = A.boxplot_stats(Tables(spark, sf_dir).lineitem, "l_returnflag", "l_extendedprice")
    return _r(b, {"q1": 4, "median": 4, "q3": 4, "iqr": 4})


_PROFILE_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                 "o_orderpriority"]


@register("table_profile", "Q12 A09 A21", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, COUNT(*) AS rows, COUNT(*) FILTER (WHERE {c} IS NULL) AS nulls, "
    f"COUNT(DISTINCT {c}) AS distinct_values, CAST(MIN({c}) AS VARCHAR) AS min_value, "
    f"CAST(MAX({c}) AS VARCHAR) AS max_value FROM orders" for c in _PROFILE_COLS))
def q_table_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.table_profile(Tables(spark, sf_dir).orders, _PROFILE_COLS)


# --------------------------------------------------------------- tests

@register("pearson", "T01 A12", """
WITH s AS (SELECT COUNT(*) AS n, corr(l_quantity, l_extendedprice) AS r FROM lineitem)
SELECT n, ROUND(r, 6) AS r, n - 2 AS df, ROUND(r * sqrt((n - 2) / (1 - r * r)), 4) AS t,
       ROUND(""" + t_p_value_sql("r * sqrt((n - 2) / (1 - r * r))", "(n - 2)") + """, 6) AS p_value,
       ROUND(tanh(atanh(r) - 1.959963984540054 / sqrt(n - 3)), 6) AS ci_low,
       ROUND(tanh(atanh(r) + 1.959963984540054 / sqrt(n - 3)), 6) AS ci_high
FROM s""")
def q_pearson(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = S.pearson(Tables(spark, sf_dir).lineitem, "l_quantity", "l_extendedprice")
    return _r(S.with_p_values(p, "pearson"), {"r": 6, "t": 4, "p_value": 6, "ci_low": 6, "ci_high": 6})


@register("welch", "T02", """
WITH s AS (
  SELECT COUNT(*) FILTER (WHERE l_returnflag = 'A') AS n1,
         AVG(l_quantity) FILTER (WHERE l_returnflag = 'A') AS mean1,
         var_samp(l_quantity) FILTER (WHERE l_returnflag = 'A') AS var1,
         COUNT(*) FILTER (WHERE l_returnflag = 'R') AS n2,
         AVG(l_quantity) FILTER (WHERE l_returnflag = 'R') AS mean2,
         var_samp(l_quantity) FILTER (WHERE l_returnflag = 'R') AS var2
  FROM lineitem),
d AS (SELECT *, mean1 - mean2 AS diff, sqrt(var1 / n1 + var2 / n2) AS se,
              power(var1 / n1 + var2 / n2, 2) / (power(var1 / n1, 2) / (n1 - 1) + power(var2 / n2, 2) / (n2 - 1)) AS v FROM s)
SELECT n1, ROUND(mean1, 6) AS mean1, ROUND(var1, 6) AS var1, n2, ROUND(mean2, 6) AS mean2,
       ROUND(var2, 6) AS var2, ROUND(diff, 6) AS mean_diff, ROUND(diff / se, 6) AS t, ROUND(v, 4) AS df,
       ROUND(""" + t_p_value_sql("diff / se", "v") + """, 6) AS p_value,
       ROUND(diff - """ + t_quantile_sql("v") + """ * se, 6) AS conf_low,
       ROUND(diff + """ + t_quantile_sql("v") + """ * se, 6) AS conf_high
FROM d""")
def q_welch(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = S.welch(Tables(spark, sf_dir).lineitem, "l_returnflag", "l_quantity", "A", "R")
    return _r(S.with_p_values(w, "welch"), {"mean1": 6, "var1": 6, "mean2": 6, "var2": 6, "mean_diff": 6, "t": 6, "df": 4,
                                            "p_value": 6, "conf_low": 6, "conf_high": 6})


_GROUP_SQL = """g AS (SELECT l_returnflag, COUNT(*) AS n, AVG(l_quantity) AS mean,
                  var_samp(l_quantity) AS var FROM lineitem GROUP BY 1)"""


@register("anova", "T03", f"""
WITH {_GROUP_SQL},
grand AS (SELECT SUM(n * mean) / SUM(n) AS gm FROM g),
s AS (SELECT COUNT(*) AS k, CAST(SUM(n) AS BIGINT) AS n, SUM(n * power(mean - gm, 2)) AS ssb,
             SUM(COALESCE((n - 1) * var, 0)) AS ssw FROM g, grand)
SELECT k, n, ROUND(ssb, 4) AS ssb, ROUND(ssw, 4) AS ssw, k - 1 AS df_between, n - k AS df_within,
       ROUND((ssb / (k - 1)) / (ssw / (n - k)), 6) AS f,
       -- closed form of the F tail for k - 1 = 2 (three return flags)
       ROUND(power(1 + ssb / ssw, -(n - k) / 2.0), 6) AS p_value
FROM s""")
def q_anova(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = S.anova(Tables(spark, sf_dir).lineitem, "l_returnflag", "l_quantity")
    return _r(S.with_p_values(a, "anova"), {"ssb": 4, "ssw": 4, "f": 6, "p_value": 6})


@register("tukey", "T04", f"""
WITH {_GROUP_SQL},
m AS (SELECT SUM(COALESCE((n - 1) * var, 0)) / (SUM(n) - COUNT(*)) AS mse,
             CAST(SUM(n) - COUNT(*) AS BIGINT) AS dfw, COUNT(*) AS k FROM g)
SELECT a.l_returnflag AS level_a, b.l_returnflag AS level_b, ROUND(b.mean - a.mean, 6) AS diff,
       ROUND(sqrt(mse / 2 * (1 / a.n + 1 / b.n)), 6) AS se,
       ROUND(abs(b.mean - a.mean) / sqrt(mse / 2 * (1 / a.n + 1 / b.n)), 6) AS q,
       k, dfw AS df_within
FROM g a JOIN g b ON a.l_returnflag < b.l_returnflag CROSS JOIN m""")
def q_tukey(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = S.tukey_pairs(Tables(spark, sf_dir).lineitem, "l_returnflag", "l_quantity")
    return _r(p, {"diff": 6, "se": 6, "q": 6})


@register("chi_square", "T05 A14", """
WITH c AS (SELECT o_orderpriority, o_orderstatus, COUNT(*) AS n FROM orders GROUP BY 1, 2),
r AS (SELECT o_orderpriority, SUM(n) AS rt FROM c GROUP BY 1),
k AS (SELECT o_orderstatus, SUM(n) AS ct FROM c GROUP BY 1),
tot AS (SELECT SUM(n) AS total FROM c),
e AS (SELECT c.n, r.rt * k.ct / tot.total AS expected
      FROM c JOIN r USING (o_orderpriority) JOIN k USING (o_orderstatus) CROSS JOIN tot),
x AS (SELECT SUM(power(n - expected, 2) / expected) AS stat, MIN(expected) AS low,
             CAST(((SELECT COUNT(*) FROM r) - 1) * ((SELECT COUNT(*) FROM k) - 1) AS BIGINT) AS v FROM e)
SELECT ROUND(stat, 6) AS statistic, v AS df, ROUND(low, 6) AS min_expected,
       -- closed form of the chi-square tail for an even number of degrees of freedom
       ROUND((SELECT exp(-stat / 2) * sum(power(stat / 2, i) / gamma(i + 1)) FROM range(v // 2) g(i)), 6) AS p_value
FROM x""")
def q_chi_square(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = S.chi_square(Tables(spark, sf_dir).orders, "o_orderpriority", "o_orderstatus")
    return _r(S.with_p_values(c.withColumn("df", F.col("df").cast("long")), "chi_square"),
              {"statistic": 6, "min_expected": 6, "p_value": 6})


@register("ols_price", "T06 T07", """
SELECT ROUND(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
       ROUND(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept,
       ROUND(regr_r2(l_extendedprice, l_quantity), 6) AS r2,
       regr_count(l_extendedprice, l_quantity) AS n,
       ROUND(sqrt(regr_syy(l_extendedprice, l_quantity) * (1 - regr_r2(l_extendedprice, l_quantity))
                  / (regr_count(l_extendedprice, l_quantity) - 2)), 4) AS sigma
FROM lineitem""")
def q_ols_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = S.simple_ols(Tables(spark, sf_dir).lineitem, "l_extendedprice", "l_quantity")
    return _r(f.select("slope", "intercept", "r2", "n", "sigma"),
              {"slope": 6, "intercept": 4, "r2": 6, "sigma": 4})


@register("ols_diagnostics", "T10 O03", """
WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a,
                  regr_count(l_extendedprice, l_quantity) AS n, regr_sxx(l_extendedprice, l_quantity) AS sxx,
                  avg(l_quantity) AS mx,
                  sqrt(regr_syy(l_extendedprice, l_quantity) * (1 - regr_r2(l_extendedprice, l_quantity))
                       / (regr_count(l_extendedprice, l_quantity) - 2)) AS sigma FROM lineitem),
d AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, a + b * l_quantity AS fitted,
             l_extendedprice - (a + b * l_quantity) AS residual,
             1 / n + power(l_quantity - mx, 2) / sxx AS leverage, sigma
      FROM lineitem, f),
s AS (SELECT *, residual / (sigma * sqrt(1 - leverage)) AS std_residual FROM d)
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, ROUND(fitted, 4) AS fitted,
       ROUND(residual, 4) AS residual, ROUND(leverage, 9) AS leverage,
       ROUND(std_residual, 6) AS std_residual,
       ROUND(power(std_residual, 2) / 2 * leverage / (1 - leverage), 9) AS cooks_d
FROM s ORDER BY power(std_residual, 2) / 2 * leverage / (1 - leverage) DESC, l_orderkey, l_linenumber
LIMIT 10""")
def q_ols_diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = S.ols_diagnostics(Tables(spark, sf_dir).lineitem, "l_extendedprice", "l_quantity",
                          ["l_orderkey", "l_linenumber"])
    # Top 10 by Cook's distance is the report itself (TakeOrderedAndProject).
    top = d.orderBy(F.col("cooks_d").desc(), "l_orderkey", "l_linenumber").limit(10)
    return _r(top, {"fitted": 4, "residual": 4, "leverage": 9, "std_residual": 6, "cooks_d": 9})


# One slope within groups and one intercept per group, from sums around the group means.
_ANCOVA_SQL = """
WITH g AS (SELECT l_returnflag AS level, COUNT(*) AS n, AVG(l_quantity) AS mx, AVG(l_extendedprice) AS my,
                  regr_sxx(l_extendedprice, l_quantity) AS sxx, regr_sxy(l_extendedprice, l_quantity) AS sxy,
                  regr_syy(l_extendedprice, l_quantity) AS syy FROM lineitem GROUP BY 1),
w AS (SELECT SUM(sxx) AS sxx, SUM(sxy) / SUM(sxx) AS b, SUM(syy) - SUM(sxy) * SUM(sxy) / SUM(sxx) AS sse,
             CAST(SUM(n) - COUNT(*) - 1 AS BIGINT) AS v, CAST(SUM(n) AS BIGINT) AS n FROM g),
base AS (SELECT * FROM g ORDER BY level LIMIT 1),
terms AS (
  SELECT 'l_quantity' AS term, b AS estimate, sqrt(sse / v / sxx) AS se, v FROM w
  UNION ALL SELECT '(Intercept)', base.my - b * base.mx, sqrt(sse / v * (1 / base.n + base.mx * base.mx / w.sxx)), v FROM w, base
  UNION ALL SELECT 'l_returnflag=' || g.level, (g.my - b * g.mx) - (base.my - b * base.mx),
                   sqrt(sse / v * (1 / g.n + 1 / base.n + power(g.mx - base.mx, 2) / w.sxx)), v
  FROM w, base, g WHERE g.level > base.level)
"""


@register("linear_model_terms", "T06 T07", _ANCOVA_SQL + """
SELECT term, ROUND(estimate, 4) AS estimate, ROUND(se, 4) AS std_error, ROUND(estimate / se, 4) AS t,
       ROUND(""" + t_p_value_sql("estimate / se", "v") + """, 6) AS p_value,
       ROUND(estimate - """ + t_quantile_sql("v") + """ * se, 4) AS conf_low,
       ROUND(estimate + """ + t_quantile_sql("v") + """ * se, 4) AS conf_high
FROM terms""")
def q_linear_model_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price by quantity and return flag: coefficient table with tests and limits."""
    fit = S.linear_model(Tables(spark, sf_dir).lineitem, "l_extendedprice", ["l_quantity"], ["l_returnflag"])
    return _r(S.coefficient_table(spark, fit), {"estimate": 4, "std_error": 4, "t": 4, "p_value": 6, "conf_low": 4, "conf_high": 4})


@register("linear_model_fit", "T09", _ANCOVA_SQL + """
, total AS (SELECT regr_syy(l_extendedprice, l_quantity) AS sst FROM lineitem)
SELECT w.n, v AS df, ROUND(1 - sse / sst, 6) AS r2, ROUND(1 - sse / sst * (w.n - 1) / v, 6) AS adj_r2,
       ROUND(sqrt(sse / v), 4) AS sigma
FROM w, total""")
def q_linear_model_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    fit = S.linear_model(Tables(spark, sf_dir).lineitem, "l_extendedprice", ["l_quantity"], ["l_returnflag"])
    row = spark.createDataFrame([(int(fit["n"]), int(fit["df"]), float(fit["r2"]), float(fit["adj_r2"]), fit["sigma"])],
                                "n long, df long, r2 double, adj_r2 double, sigma double")
    return _r(row, {"r2": 6, "adj_r2": 6, "sigma": 4})


@register("tukey_tests", "T04")
def q_tukey_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tukey pairs with adjusted p-values and simultaneous limits (no studentized range in SQL)."""
    p = S.with_p_values(S.tukey_pairs(Tables(spark, sf_dir).lineitem, "l_returnflag", "l_quantity"), "tukey")
    return _r(p, {"diff": 6, "se": 6, "q": 6, "p_adj": 4, "conf_low": 4, "conf_high": 4})


@register("covariance", "A12", """
SELECT ROUND(covar_samp(l_quantity, l_extendedprice), 4) AS cov_quantity_price,
       ROUND(covar_samp(l_quantity, l_discount), 6) AS cov_quantity_discount,
       ROUND(covar_pop(l_discount, l_tax), 9) AS cov_discount_tax FROM lineitem""")
def q_covariance(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Tables(spark, sf_dir).lineitem.agg(
        F.covar_samp("l_quantity", "l_extendedprice").alias("cov_quantity_price"),
        F.covar_samp("l_quantity", "l_discount").alias("cov_quantity_discount"),
        F.covar_pop("l_discount", "l_tax").alias("cov_discount_tax"))
    return _r(c, {"cov_quantity_price": 4, "cov_quantity_discount": 6, "cov_discount_tax": 9})
