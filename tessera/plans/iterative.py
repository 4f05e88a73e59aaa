"""Queries whose core is iterative, random or write-then-read.

Quantiles that DuckDB lacks are written out as formulas for both engines.  The
portfolio comparison and the forest have no SQL form; the pytest invariants
check them.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.cleaning import round_to
from tessera.operators import allocate as X
from tessera.operators import distributions as D
from tessera.operators import model as M
from tessera.operators import scd
from tessera.operators import stats as S
from tessera.operators.windows import global_row_number
from tessera.plans.analysis import t_quantile_sql
from tessera.plans.evaluation import customer_segments, scenario_options
from tessera.plans.modeling import PREDICTORS, SEED, document_features
from tessera.plans.relational import SNAPSHOT_1, SNAPSHOT_2, _SCD_ATTRS, _snapshot_sql, customer_snapshot
from tessera.plans.registry import register
from tessera.session import materialise, scratch_path
from tessera.sinks.writers import replace_partitions, write_with_run_log
from tessera.tables import Tables


_PI_SQL = """
WITH m AS (SELECT COUNT(*) AS n, AVG(l_quantity) AS mx, AVG(l_discount) AS mz, AVG(l_extendedprice) AS my,
                  regr_sxx(l_extendedprice, l_quantity) AS sxx, regr_sxx(l_extendedprice, l_discount) AS szz,
                  regr_sxy(l_discount, l_quantity) AS sxz, regr_sxy(l_extendedprice, l_quantity) AS sxy,
                  regr_sxy(l_extendedprice, l_discount) AS szy, regr_syy(l_extendedprice, l_quantity) AS syy FROM lineitem),
b AS (SELECT *, sxx * szz - sxz * sxz AS det, (szz * sxy - sxz * szy) / (sxx * szz - sxz * sxz) AS b1,
             (sxx * szy - sxz * sxy) / (sxx * szz - sxz * sxz) AS b2, CAST(n - 3 AS DOUBLE) AS v FROM m),
r AS (SELECT l_orderkey, l_linenumber, l_extendedprice, my + b1 * (l_quantity - mx) + b2 * (l_discount - mz) AS fit,
             """ + t_quantile_sql("v") + """ * sqrt((syy - b1 * sxy - b2 * szy) / v)
             * sqrt(1 + 1 / n + (szz * power(l_quantity - mx, 2) + sxx * power(l_discount - mz, 2)
                                 - 2 * sxz * (l_quantity - mx) * (l_discount - mz)) / det) AS half
      FROM lineitem, b)
SELECT l_orderkey, l_linenumber, l_extendedprice, ROUND(fit, 4) AS fit, ROUND(fit - half, 4) AS lwr,
       ROUND(fit + half, 4) AS upr, abs(l_extendedprice - fit) <= half AS inside
FROM r"""


@register("prediction_interval", "T11 J14", _PI_SQL)
def q_prediction_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount",
                                               "l_extendedprice")
    fit = S.ols(li, "l_extendedprice", ["l_quantity", "l_discount"])
    pi = S.prediction_interval(li, fit, ["l_quantity", "l_discount"])
    return pi.select("l_orderkey", "l_linenumber", "l_extendedprice",
                     *[round_to(c, 4).alias(c) for c in ("fit", "lwr", "upr")],
                     ((F.col("l_extendedprice") >= F.col("lwr")) & (F.col("l_extendedprice") <= F.col("upr")))
                     .alias("inside"))


@register("qq_points", "T12", """
WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a,
                  regr_count(l_extendedprice, l_quantity) AS n, regr_sxx(l_extendedprice, l_quantity) AS sxx,
                  avg(l_quantity) AS mx,
                  sqrt(regr_syy(l_extendedprice, l_quantity) * (1 - regr_r2(l_extendedprice, l_quantity))
                       / (regr_count(l_extendedprice, l_quantity) - 2)) AS sigma FROM lineitem),
d AS (SELECT ROUND((l_extendedprice - a - b * l_quantity)
                   / (sigma * sqrt(1 - 1 / n - power(l_quantity - mx, 2) / sxx)), 6) AS sample, l_orderkey, l_linenumber
      FROM lineitem, f),
o AS (SELECT row_number() OVER (ORDER BY sample, l_orderkey, l_linenumber) AS i, sample, COUNT(*) OVER () AS n FROM d)
SELECT i, sample, ROUND(""" + D.normal_quantile_sql("(i - 5e-1) / n") + """, 6) AS theoretical FROM o""")
def q_qq_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = Tables(spark, sf_dir).lineitem
    d = (S.ols_diagnostics(li, "l_extendedprice", "l_quantity", ["l_orderkey", "l_linenumber"])
         .select("l_orderkey", "l_linenumber", round_to("std_residual", 6).alias("sample")))
    r = global_row_number(d, [F.col("sample"), F.col("l_orderkey"), F.col("l_linenumber")],
                          "i", total_name="n")
    return r.select("i", "sample", round_to(F.expr(D.normal_quantile_sql("(i - 5e-1) / n")), 6).alias("theoretical"))


@register("random_forest_quality", "M30 M09")
def q_random_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    feats = document_features(Tables(spark, sf_dir))
    m = M.random_forest(feats, "quality", PREDICTORS, seed=SEED)
    return spark.createDataFrame(M.normalized_importance(m.featureImportances, PREDICTORS),
                                 "feature string, importance double")


@register("approach_comparison", "X06 U01 A22 X04")
def q_approach_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    opts = scenario_options(t).where(F.col("scenario") == f"budget_{X.ANNUAL_BUDGET}")
    exact = X.exact_portfolio(opts, ["scenario"], "segment", "budget").withColumn("approach", F.lit("optimized"))
    heur = X.heuristic_portfolio(X.decision_options(customer_segments(t)), "segment").withColumn(
        "approach", F.lit("risk ranking"))
    both = exact.unionByName(heur, allowMissingColumns=True)
    tot = both.groupBy("approach").agg(F.count(F.lit(1)).alias("programs"),
                                       F.sum("program_cost").alias("total_program_cost"),
                                       F.sum("expected_net_benefit").alias("total_net_benefit"))
    return tot.select("approach", "programs", "total_program_cost",
                      (F.lit(X.ANNUAL_BUDGET) - F.col("total_program_cost")).alias("unused_budget"),
                      round_to("total_net_benefit", 4).alias("total_net_benefit"),
                      round_to(F.col("total_net_benefit") / F.col("total_program_cost"), 6).alias("portfolio_roi"))


@register("scd2_assertions", "W12 Q13", f"""
WITH {_snapshot_sql('s1', SNAPSHOT_1)}, {_snapshot_sql('s2', SNAPSHOT_2)},
pairs AS (SELECT s1.o_custkey IS NOT NULL AS was, s2.o_custkey IS NOT NULL AS now, COALESCE(s1.o_custkey, s2.o_custkey) AS k,
                (s1.last_status, s1.last_priority) IS NOT DISTINCT FROM (s2.last_status, s2.last_priority) AS same
         FROM s1 FULL JOIN s2 ON s1.o_custkey = s2.o_custkey),
n AS (SELECT k, CAST(was AS INT) + CAST(now AND NOT (was AND same) AS INT) AS versions,
             CAST(now AS INT) AS current_rows FROM pairs)
SELECT CAST(SUM(versions) AS BIGINT) AS versions, COUNT(DISTINCT k) AS keys, COUNT(*) - COUNT(DISTINCT k) AS dup_version_keys,
       0 AS overlaps, COUNT(*) FILTER (WHERE current_rows > 1) AS keys_with_several_current, 0 AS rows_changed_by_rerun
FROM n""")
def q_scd2_assertions(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    h = scd.scd2_init(customer_snapshot(t, SNAPSHOT_1), "o_custkey", _SCD_ATTRS, SNAPSHOT_1)
    # The history is read by each assertion: written once, like the table it stands for.
    h = materialise(scd.scd2_apply(h, customer_snapshot(t, SNAPSHOT_2), "o_custkey", _SCD_ATTRS, SNAPSHOT_2), "history")
    rerun = scd.scd2_apply(h, customer_snapshot(t, SNAPSHOT_2), "o_custkey", _SCD_ATTRS, SNAPSHOT_2)
    overl = scd.overlap_violations(h, "o_custkey").select(F.count(F.lit(1))).scalar()
    per_key = h.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("versions"), F.count_if("is_current").alias("current"))
    keys = per_key.agg(F.sum("versions").alias("versions"), F.count(F.lit(1)).alias("keys"),
                       F.count_if(F.col("current") > 1).alias("keys_with_several_current"))
    dup = (h.groupBy("version_key").agg(F.count(F.lit(1)).alias("n"))
           .select(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)))).scalar()
    changed = rerun.exceptAll(h).select(F.count(F.lit(1))).scalar()
    return keys.select("versions", "keys", dup.alias("dup_version_keys"), overl.alias("overlaps"),
                       "keys_with_several_current", changed.alias("rows_changed_by_rerun"))


# Sample size and seed of the deterministic sample.
SAMPLE_ROWS = 3000


@register("sample_orders", "P16 O02", f"""
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY md5(o_orderkey || ':{SEED}'), o_orderkey LIMIT {SAMPLE_ROWS}""")
def q_sample_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    # Deterministic sample: the n smallest seeded hashes (top-n is the feature).
    h = F.md5(F.concat(F.col("o_orderkey").cast("string"), F.lit(f":{SEED}")))
    return o.withColumn("_h", h).orderBy("_h", "o_orderkey").limit(SAMPLE_ROWS).drop("_h")


@register("partition_load", "K06 K12", """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS event_day, event_type, value FROM events""")
def q_partition_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write events by day, reload one day's slice twice (idempotent), read back."""
    e = Tables(spark, sf_dir).events.select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("event_day"),
                                            "event_type", "value")
    run = uuid.uuid4().hex[:12]
    path = scratch_path(spark, os.path.join("loads", run, "events_by_day"))
    write_with_run_log(e, path, scratch_path(spark, os.path.join("loads", run, "run_log")), run, "events",
                       ["event_day"])
    first_day = e.select(F.min("event_day")).first()[0]
    again = e.where(F.col("event_day") == first_day)
    replace_partitions(again, path, ["event_day"])
    replace_partitions(again, path, ["event_day"])
    return spark.read.parquet(path).select("event_id", "event_day", "event_type", "value")
