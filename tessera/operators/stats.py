"""Hypothesis tests and linear models from distributed sufficient statistics.

Each test reduces the data with one Spark aggregation (per group where
needed) to a few numbers; the statistic is a column expression over that
result, so the whole computation stays lazy.  ``with_p_values`` adds the
tail probabilities on the small result.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.operators import distributions as D


def pearson(df: DataFrame, x: str, y: str) -> DataFrame:
    """n, r, t = r*sqrt((n-2)/(1-r^2)), df = n-2, Fisher-z 95% CI."""
    s = df.agg(F.count(F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), 1)).alias("n"),
               F.corr(x, y).alias("r"))
    z = F.atanh(F.col("r"))
    se = 1 / F.sqrt(F.col("n") - 3)
    return s.select("n", "r", (F.col("n") - 2).alias("df"),
                    (F.col("r") * F.sqrt((F.col("n") - 2) / (1 - F.col("r") ** 2))).alias("t"),
                    F.tanh(z - 1.959963984540054 * se).alias("ci_low"),
                    F.tanh(z + 1.959963984540054 * se).alias("ci_high"))


def welch(df: DataFrame, group: str, value: str, a, b) -> DataFrame:
    """Welch two-sample t-test of ``value`` between ``group == a`` and ``b``."""
    v = F.col(value)
    ga, gb = F.col(group) == F.lit(a), F.col(group) == F.lit(b)
    s = df.agg(F.count(F.when(ga, v)).alias("n1"), F.avg(F.when(ga, v)).alias("mean1"),
               F.var_samp(F.when(ga, v)).alias("var1"),
               F.count(F.when(gb, v)).alias("n2"), F.avg(F.when(gb, v)).alias("mean2"),
               F.var_samp(F.when(gb, v)).alias("var2"))
    se2_1 = F.col("var1") / F.col("n1")
    se2_2 = F.col("var2") / F.col("n2")
    return s.select(
        "*", (F.col("mean1") - F.col("mean2")).alias("mean_diff"),
        ((F.col("mean1") - F.col("mean2")) / F.sqrt(se2_1 + se2_2)).alias("t"),
        ((se2_1 + se2_2) ** 2 / (se2_1 ** 2 / (F.col("n1") - 1) + se2_2 ** 2 / (F.col("n2") - 1)))
        .alias("df"))


def group_moments(df: DataFrame, group: str, value: str) -> DataFrame:
    v = F.col(value)
    return df.where(v.isNotNull()).groupBy(group).agg(
        F.count(v).alias("n"), F.avg(v).alias("mean"), F.var_samp(v).alias("var"))


def anova(df: DataFrame, group: str, value: str) -> DataFrame:
    """One-way ANOVA: SSB, SSW, degrees of freedom, F.

    Per-group n/mean/var come from one aggregation; the grand mean is the
    n-weighted mean of group means, so the data is read once.
    """
    g = group_moments(df, group, value)
    all_groups = Window.partitionBy()  # one row per group level: bounded
    g = g.withColumn("_grand", F.sum(F.col("n") * F.col("mean")).over(all_groups)
                     / F.sum("n").over(all_groups))
    s = g.agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"),
              F.sum(F.col("n") * (F.col("mean") - F.col("_grand")) ** 2).alias("ssb"),
              F.sum(F.coalesce((F.col("n") - 1) * F.col("var"), F.lit(0.0))).alias("ssw"))
    return s.select("k", "n", "ssb", "ssw", (F.col("k") - 1).alias("df_between"),
                    (F.col("n") - F.col("k")).alias("df_within"),
                    ((F.col("ssb") / (F.col("k") - 1)) / (F.col("ssw") / (F.col("n") - F.col("k"))))
                    .alias("f"))


def tukey_pairs(df: DataFrame, group: str, value: str) -> DataFrame:
    """Tukey HSD pair table: diff, standard error and q statistic.

    Pairs are formed between group *levels* (bounded by the category), never
    between rows.
    """
    g = group_moments(df, group, value)
    all_groups = Window.partitionBy()
    g = (g.withColumn("_mse", F.sum(F.coalesce((F.col("n") - 1) * F.col("var"), F.lit(0.0)))
                      .over(all_groups) / (F.sum("n").over(all_groups) - F.count(F.lit(1)).over(all_groups)))
          .withColumn("_dfw", F.sum("n").over(all_groups) - F.count(F.lit(1)).over(all_groups))
          .withColumn("_k", F.count(F.lit(1)).over(all_groups)))
    a = g.select(*[F.col(c).alias(f"a_{c}") for c in g.columns])
    b = g.select(*[F.col(c).alias(f"b_{c}") for c in [group, "n", "mean"]])
    p = a.join(b, F.col(f"a_{group}") < F.col(f"b_{group}"))
    se = F.sqrt(F.col("a__mse") / 2 * (1 / F.col("a_n") + 1 / F.col("b_n")))
    return p.select(F.col(f"a_{group}").alias("level_a"), F.col(f"b_{group}").alias("level_b"),
                    (F.col("b_mean") - F.col("a_mean")).alias("diff"), se.alias("se"),
                    (F.abs(F.col("b_mean") - F.col("a_mean")) / se).alias("q"),
                    F.col("a__k").alias("k"), F.col("a__dfw").alias("df_within"))


def chi_square(df: DataFrame, row: str, col: str) -> DataFrame:
    """Pearson chi-square test of independence: statistic and df.

    Expected counts come from the margins of the cell counts; zero cells are
    included through the full level grid (see ``aggregates.contingency``).
    """
    from tessera.operators.aggregates import contingency
    cells = contingency(df, row, col)
    rows = cells.groupBy(row).agg(F.sum("n").alias("_rt"))
    cols = cells.groupBy(col).agg(F.sum("n").alias("_ct"))
    total = cells.select(F.sum("n")).scalar()
    e = cells.join(rows, row).join(cols, col).withColumn("expected", F.col("_rt") * F.col("_ct") / total)
    return e.agg(F.sum((F.col("n") - F.col("expected")) ** 2 / F.col("expected")).alias("statistic"),
                 ((F.count_distinct(row) - 1) * (F.count_distinct(col) - 1)).alias("df"),
                 F.min("expected").alias("min_expected"))


def simple_ols(df: DataFrame, y: str, x: str) -> DataFrame:
    """Slope, intercept, R^2, n and residual sd of ``y ~ x`` (T06, one regressor)."""
    s = df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
               F.regr_r2(y, x).alias("r2"), F.regr_count(y, x).alias("n"),
               F.regr_sxx(y, x).alias("sxx"), F.regr_syy(y, x).alias("syy"))
    return s.withColumn("sigma", F.sqrt(F.col("syy") * (1 - F.col("r2")) / (F.col("n") - 2)))


def ols_diagnostics(df: DataFrame, y: str, x: str, key: Sequence[str]) -> DataFrame:
    """Fitted, residual, leverage, standardised residual, Cook's D per row.

    The fit is a one-row aggregate referenced as scalar subqueries; each row
    then needs only its own x and y.
    """
    fit = simple_ols(df, y, x)
    mean_x = df.select(F.avg(F.when(F.col(y).isNotNull(), F.col(x)))).scalar()
    slope = fit.select("slope").scalar()
    inter = fit.select("intercept").scalar()
    n = fit.select("n").scalar()
    sxx = fit.select("sxx").scalar()
    sigma = fit.select("sigma").scalar()
    fitted = inter + slope * F.col(x)
    h = 1 / n + (F.col(x) - mean_x) ** 2 / sxx
    resid = F.col(y) - fitted
    std = resid / (sigma * F.sqrt(1 - h))
    return df.select(*key, x, y, fitted.alias("fitted"), resid.alias("residual"),
                     h.alias("leverage"), std.alias("std_residual"),
                     (std ** 2 / 2 * h / (1 - h)).alias("cooks_d"))


def ols(df: DataFrame, y: str, xs: Sequence[str]) -> dict:
    """Multiple regression from distributed X'X and X'y.

    One aggregation computes every cross product (p small); the p x p system
    is solved on the driver.  Returns coefficient table rows and fit summary.
    """
    cols = ["_one", *xs]
    d = df.select(F.lit(1.0).alias("_one"), *[F.col(f"`{c}`").cast("double").alias(c) for c in xs],
                  F.col(y).cast("double").alias("_y")).dropna()
    aggs = [F.sum(F.col(f"`{a}`") * F.col(f"`{b}`")).alias(f"{a}*{b}") for i, a in enumerate(cols) for b in cols[i:]]
    aggs += [F.sum(F.col(f"`{a}`") * F.col("_y")).alias(f"{a}*y") for a in cols]
    aggs += [F.sum(F.col("_y") ** 2).alias("yy"), F.count(F.lit(1)).alias("n"),
             F.sum("_y").alias("sy")]
    r = d.agg(*aggs).first().asDict()
    p = len(cols)
    xtx = np.zeros((p, p))
    for i, a in enumerate(cols):
        for j in range(i, p):
            xtx[i, j] = xtx[j, i] = r[f"{a}*{cols[j]}"]
    xty = np.array([r[f"{a}*y"] for a in cols])
    inv = np.linalg.inv(xtx)
    beta = inv @ xty
    n = r["n"]
    sse = r["yy"] - 2 * beta @ xty + beta @ xtx @ beta
    sst = r["yy"] - r["sy"] ** 2 / n
    dfr = n - p
    sigma2 = sse / dfr
    se = np.sqrt(np.diag(inv) * sigma2)
    tcrit = D.t_ppf(0.975, dfr)
    coefs = []
    for name, b, s in zip(["(Intercept)", *xs], beta, se):
        t = b / s
        coefs.append({"term": name, "estimate": float(b), "std_error": float(s), "t": float(t),
                      "p_value": float(D.t_sf2(t, dfr)), "conf_low": float(b - tcrit * s),
                      "conf_high": float(b + tcrit * s)})
    r2 = 1 - sse / sst
    return {"coefficients": coefs, "r2": r2, "adj_r2": 1 - (1 - r2) * (n - 1) / dfr,
            "sigma": float(np.sqrt(sigma2)), "n": n, "df": dfr, "xtx_inv": inv, "beta": beta}


def linear_model(df: DataFrame, y: str, numeric: Sequence[str], categorical: Sequence[str] = (), max_levels: int = 500) -> dict:
    """Linear model with categorical terms (T06): treatment contrasts against the first level.

    The levels of a category are listed once (a category's domain, not rows of
    data) and become 0/1 regressors called ``column=level``.  A column with more than ``max_levels``
    levels, such as a key, is an error: each level is a row and column of X'X on the driver.
    """
    xs = list(numeric)
    for c in categorical:
        levels = [r[0] for r in df.where(F.col(c).isNotNull()).select(c).distinct().limit(max_levels + 1).collect()]
        if len(levels) > max_levels:
            raise ValueError(f"{c} has more than {max_levels} levels")
        levels = sorted(levels)
        for level in levels[1:]:
            df = df.withColumn(f"{c}={level}", F.when(F.col(c).isNotNull(), (F.col(c) == level).cast("double")))
            xs.append(f"{c}={level}")
    return ols(df, y, xs)


def coefficient_table(spark, fit: dict) -> DataFrame:
    """term, estimate, std_error, t, p_value, 95% limits (T07): one row per regressor."""
    return spark.createDataFrame(fit["coefficients"], "term string, estimate double, std_error double, t double, "
                                                      "p_value double, conf_low double, conf_high double")


def prediction_interval(df: DataFrame, fit: dict, xs: Sequence[str], level: float = 0.95) -> DataFrame:
    """y-hat +- t * sigma * sqrt(1 + h) with h = x' (X'X)^-1 x.

    The p x p inverse is bounded by the number of regressors and enters the
    plan as literals.
    """
    inv, beta = fit["xtx_inv"], fit["beta"]
    xs_cols = [F.lit(1.0), *[F.col(c).cast("double") for c in xs]]
    yhat = sum((float(b) * c for b, c in zip(beta, xs_cols)), F.lit(0.0))
    h = F.lit(0.0)
    for i, ci in enumerate(xs_cols):
        for j, cj in enumerate(xs_cols):
            h = h + float(inv[i, j]) * ci * cj
    tcrit = D.t_ppf(0.5 + level / 2, fit["df"])
    half = tcrit * fit["sigma"] * F.sqrt(1 + h)
    return df.select("*", yhat.alias("fit"), (yhat - half).alias("lwr"), (yhat + half).alias("upr"))


# ------------------------------------------------------------- p-values

def with_p_values(result: DataFrame, kind: str) -> DataFrame:
    """Attach p-values to a (small) test result computed by this module."""
    rows = [r.asDict() for r in result.collect()]  # test results: a few rows
    for r in rows:
        if kind == "pearson":
            r["p_value"] = D.t_sf2(r["t"], r["df"])
        elif kind == "welch":
            r["p_value"] = D.t_sf2(r["t"], r["df"])
            half = D.t_ppf(0.975, r["df"]) * r["mean_diff"] / r["t"] if r["t"] else 0.0
            r["conf_low"], r["conf_high"] = r["mean_diff"] - half, r["mean_diff"] + half
        elif kind == "anova":
            r["p_value"] = D.f_sf(r["f"], r["df_between"], r["df_within"])
        elif kind == "chi_square":
            r["p_value"] = D.chi2_sf(r["statistic"], r["df"])
        elif kind == "tukey":
            r["p_adj"] = 1 - D.ptukey(r["q"], r["k"], r["df_within"])
            half = D.qtukey(0.95, r["k"], r["df_within"]) * r["se"]
            r["conf_low"], r["conf_high"] = r["diff"] - half, r["diff"] + half
    return result.sparkSession.createDataFrame(rows) if rows else result
