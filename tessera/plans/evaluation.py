"""Model evaluation and prescriptive allocation over the driver tables.

Binary task: document quality labels scored by two deterministic models
(text length and line count).  Multi-class task: embedding labels predicted
by the nearest label centroid.  Regression task: order totals predicted from
their lines.  Allocation: customer segments (nation x market segment) with
a risk proxy (share of pending orders) and balance-based exposure.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.cleaning import round_to, sign_label
from tessera.operators import allocate as X
from tessera.operators import evaluate as E
from tessera.plans.registry import register
from tessera.tables import Tables

# Threshold grid 0.10 .. 0.70 by 0.05 and review share 20%.
THRESHOLDS = [round(0.10 + 0.05 * i, 2) for i in range(13)]
REVIEW_SHARE = 0.20


def _r(df: DataFrame, digits: int, skip: tuple = ()) -> DataFrame:
    dbl = {f.name for f in df.schema.fields if f.dataType.typeName() == "double"}
    return df.select(*[round_to(c, digits).alias(c) if c in dbl and c not in skip else F.col(c)
                       for c in df.columns])


# ---------------------------------------------------------------- binary task

def scored_documents(t: Tables) -> DataFrame:
    d = t.documents.select("doc_id", "n_chars", "text")
    lab = t.labels.select("doc_id", F.col("quality").alias("truth"))
    j = lab.join(d, "doc_id")
    n_lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    models = F.array(
        F.struct(F.lit("length").alias("model"),
                 F.least(F.lit(1.0), F.log(1 + F.col("n_chars")) / 10).alias("score")),
        F.struct(F.lit("lines").alias("model"),
                 F.least(F.lit(1.0), n_lines / 20).alias("score")))
    return j.select("doc_id", "truth", F.explode(models).alias("m")).select(
        "doc_id", "truth", "m.model", "m.score")


_SCORED_SQL = """d AS (
  SELECT l.doc_id, l.quality AS truth, d.n_chars,
         length(d.text) - length(replace(d.text, chr(10), '')) + 1 AS n_lines
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
scored AS (
  SELECT doc_id, truth, 'length' AS model, least(1.0::DOUBLE, ln(1 + n_chars) / 10) AS score FROM d
  UNION ALL
  SELECT doc_id, truth, 'lines' AS model, least(1.0::DOUBLE, n_lines / 20) AS score FROM d)"""


@register("binary_metrics", "M10 M11 M12 M33", f"""
WITH {_SCORED_SQL},
c AS (SELECT model, COUNT(*) AS n,
             COUNT(*) FILTER (WHERE truth = 1 AND score >= 0.5) AS tp,
             COUNT(*) FILTER (WHERE truth <> 1 AND score >= 0.5) AS fp,
             COUNT(*) FILTER (WHERE truth = 1 AND score < 0.5) AS fn,
             COUNT(*) FILTER (WHERE truth <> 1 AND score < 0.5) AS tn
      FROM scored GROUP BY model),
s AS (SELECT model, score, COUNT(*) FILTER (WHERE truth = 1) AS pos,
             COUNT(*) FILTER (WHERE truth <> 1) AS neg FROM scored GROUP BY 1, 2),
auc AS (SELECT s.model, SUM(s.pos * (s.nb + 0.5 * s.neg)) / (SUM(s.pos) * SUM(s.neg)) AS auc
        FROM (SELECT *, SUM(neg) OVER (PARTITION BY model ORDER BY score ROWS UNBOUNDED PRECEDING) - neg AS nb
              FROM s) s GROUP BY s.model),
m AS (SELECT *, tp / NULLIF(tp + fp, 0) AS precision, tp / NULLIF(tp + fn, 0) AS recall,
             tn / NULLIF(tn + fp, 0) AS specificity FROM c)
SELECT m.model, n, tp, fp, fn, tn, ROUND((tp + tn) / n, 6) AS accuracy, ROUND(precision, 6) AS precision,
       ROUND(recall, 6) AS recall,
       ROUND(2 * precision * recall / NULLIF(precision + recall, 0), 6) AS f1,
       ROUND(specificity, 6) AS specificity, ROUND((recall + specificity) / 2, 6) AS balanced_accuracy,
       ROUND(auc.auc, 6) AS auc
FROM m JOIN auc ON m.model = auc.model""")
def q_binary_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = scored_documents(Tables(spark, sf_dir))
    c = E.with_rates(E.confusion_counts(s, "truth", F.col("score") >= 0.5, ["model"]))
    a = E.auc(s, "truth", "score", ["model"])
    return _r(c.join(a, "model"), 6)


@register("audit_metrics", "M33", f"""
WITH {_SCORED_SQL},
c AS (SELECT lang, COUNT(*) AS n, COUNT(*) FILTER (WHERE truth = 1 AND score >= 0.5) AS tp,
             COUNT(*) FILTER (WHERE truth <> 1 AND score >= 0.5) AS fp,
             COUNT(*) FILTER (WHERE truth = 1 AND score < 0.5) AS fn,
             COUNT(*) FILTER (WHERE truth <> 1 AND score < 0.5) AS tn
      FROM scored JOIN documents USING (doc_id) WHERE model = 'length' GROUP BY lang),
m AS (SELECT *, tp / NULLIF(tp + fp, 0) AS precision, tp / NULLIF(tp + fn, 0) AS recall,
             tn / NULLIF(tn + fp, 0) AS specificity FROM c)
SELECT lang, n, tp, fp, fn, tn, ROUND((tp + tn) / n, 6) AS accuracy, ROUND(precision, 6) AS precision,
       ROUND(recall, 6) AS recall, ROUND(2 * precision * recall / NULLIF(precision + recall, 0), 6) AS f1,
       ROUND(specificity, 6) AS specificity, ROUND((recall + specificity) / 2, 6) AS balanced_accuracy
FROM m""")
def q_audit_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary metrics within each audit group (language)."""
    t = Tables(spark, sf_dir)
    s = scored_documents(t).where(F.col("model") == "length").join(t.documents.select("doc_id", "lang"), "doc_id")
    return _r(E.with_rates(E.confusion_counts(s, "truth", F.col("score") >= 0.5, ["lang"])), 6)


@register("threshold_sweep", "M14 U02", f"""
WITH {_SCORED_SQL},
th AS (SELECT unnest([{", ".join(f"{t}::DOUBLE" for t in THRESHOLDS)}]) AS threshold)
SELECT model, threshold, COUNT(*) FILTER (WHERE score >= threshold) AS flagged,
       ROUND(COUNT(*) FILTER (WHERE score >= threshold AND truth = 1)
             / NULLIF(COUNT(*) FILTER (WHERE truth = 1), 0), 6) AS recall,
       ROUND(COUNT(*) FILTER (WHERE score >= threshold AND truth = 1)
             / NULLIF(COUNT(*) FILTER (WHERE score >= threshold), 0), 6) AS precision,
       COUNT(*) FILTER (WHERE score < threshold AND truth = 1) AS missed
FROM scored CROSS JOIN th GROUP BY model, threshold""")
def q_threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = scored_documents(Tables(spark, sf_dir))
    return _r(E.threshold_sweep(s, "truth", "score", THRESHOLDS, ["model"]), 6, skip=("threshold",))


_SWEEP_SQL = f"""th AS (SELECT unnest([{", ".join(f"{t}::DOUBLE" for t in THRESHOLDS)}]) AS threshold),
sweep AS (
  SELECT model, threshold, COUNT(*) FILTER (WHERE score >= threshold) AS flagged,
         COUNT(*) FILTER (WHERE score >= threshold AND truth = 1)
           / NULLIF(COUNT(*) FILTER (WHERE truth = 1), 0) AS recall,
         COUNT(*) FILTER (WHERE score >= threshold AND truth = 1)
           / NULLIF(COUNT(*) FILTER (WHERE score >= threshold), 0) AS precision
  FROM scored CROSS JOIN th GROUP BY model, threshold),
cap AS (SELECT CAST(ceil({REVIEW_SHARE} * COUNT(*)) AS BIGINT) AS capacity FROM labels)"""


@register("capacity_threshold", "M15 O04 W06", f"""
WITH {_SCORED_SQL}, {_SWEEP_SQL}
SELECT model, threshold, flagged, ROUND(recall, 6) AS recall, ROUND(precision, 6) AS precision, capacity
FROM sweep CROSS JOIN cap WHERE flagged <= capacity
QUALIFY row_number() OVER (PARTITION BY model ORDER BY recall DESC NULLS LAST, threshold) = 1""")
def q_capacity_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    s = scored_documents(t)
    cap = E.capacity(t.labels.select(F.count(F.lit(1))).scalar(), REVIEW_SHARE)
    sweep = E.threshold_sweep(s, "truth", "score", THRESHOLDS, ["model"])
    best = E.capacity_threshold(sweep, cap, ["model"])
    return _r(best.select("model", "threshold", "flagged", "recall", "precision",
                          cap.alias("capacity")), 6, skip=("threshold",))


@register("review_summary", "M16 O04", f"""
WITH {_SCORED_SQL},
cap AS (SELECT CAST(ceil({REVIEW_SHARE} * COUNT(*)) AS BIGINT) AS capacity FROM labels),
r AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY score DESC, doc_id) AS rk FROM scored)
SELECT model, COUNT(*) AS reviewed, COUNT(*) FILTER (WHERE truth = 1) AS captured,
       ROUND(COUNT(*) FILTER (WHERE truth = 1) / COUNT(*), 6) AS precision
FROM r CROSS JOIN cap WHERE rk <= capacity GROUP BY model""")
def q_review_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    cap = E.capacity(t.labels.select(F.count(F.lit(1))).scalar(), REVIEW_SHARE)
    r = E.ranked_review(scored_documents(t), "truth", "score", "doc_id", cap, ["model"])
    return _r(r, 6)


@register("roc_curve", "M13", f"""
WITH {_SCORED_SQL},
s AS (SELECT model, score, COUNT(*) FILTER (WHERE truth = 1) AS pos,
             COUNT(*) FILTER (WHERE truth <> 1) AS neg FROM scored GROUP BY 1, 2)
SELECT model, score AS threshold,
       ROUND(SUM(pos) OVER w / SUM(pos) OVER (PARTITION BY model), 6) AS tpr,
       ROUND(SUM(neg) OVER w / SUM(neg) OVER (PARTITION BY model), 6) AS fpr
FROM s WINDOW w AS (PARTITION BY model ORDER BY score DESC ROWS UNBOUNDED PRECEDING)""")
def q_roc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = E.roc_points(scored_documents(Tables(spark, sf_dir)), "truth", "score", ["model"])
    return _r(r, 6, skip=("threshold",))


@register("stratified_split", "M01", """
WITH c AS (SELECT quality, COUNT(*) AS n FROM labels GROUP BY quality)
SELECT quality, 'train' AS split, CAST(round(n * 0.8) AS BIGINT) AS n FROM c
UNION ALL
SELECT quality, 'test' AS split, CAST(n - round(n * 0.8) AS BIGINT) AS n FROM c""")
def q_stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = E.stratified_split(Tables(spark, sf_dir).labels, "quality", "doc_id", 0.8)
    return s.groupBy("quality", "split").agg(F.count(F.lit(1)).alias("n"))


@register("ari", "M21 A14", """
WITH c AS (SELECT lang, source, COUNT(*) AS n FROM documents GROUP BY 1, 2),
idx AS (SELECT SUM(n * (n - 1) / 2) AS idx, SUM(n) AS total FROM c),
a AS (SELECT SUM(s * (s - 1) / 2) AS sa FROM (SELECT SUM(n) AS s FROM c GROUP BY lang)),
b AS (SELECT SUM(s * (s - 1) / 2) AS sb FROM (SELECT SUM(n) AS s FROM c GROUP BY source))
SELECT CAST(idx AS DOUBLE) AS index, CAST(sa AS DOUBLE) AS sum_a, CAST(sb AS DOUBLE) AS sum_b,
       ROUND((idx - sa * sb / (total * (total - 1) / 2))
             / ((sa + sb) / 2 - sa * sb / (total * (total - 1) / 2)), 9) AS ari
FROM idx, a, b""")
def q_ari(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = E.adjusted_rand_index(Tables(spark, sf_dir).documents, "lang", "source")
    return a.select(*[F.col(c).cast("double").alias(c) for c in ("index", "sum_a", "sum_b")],
                    round_to("ari", 9).alias("ari"))


# ------------------------------------------------------------ multi-class task

def nearest_centroid(t: Tables) -> DataFrame:
    """Predict each embedding's label by the nearest label centroid (M18/M20 style).

    The centroids are a scalar subquery of one row (labels x dimension values),
    so the model never leaves the cluster.
    """
    e = t.embeddings
    ex = e.select("label", F.posexplode("embedding").alias("i", "v"))
    cent = ex.groupBy("label", "i").agg(F.avg("v").alias("cv"))
    per_label = cent.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "cv"))),
                                                      lambda x: x["cv"]).alias("c"))
    model = per_label.select(F.collect_list(F.struct("label", "c"))).scalar()
    emb = F.transform("embedding", lambda x: x.cast("double"))

    def distance(c):
        return F.aggregate(F.zip_with(emb, c["c"], lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, x: acc + x)
    cands = F.transform("_model", lambda c: F.struct(distance(c).alias("d"), c["label"].alias("label")))
    return (e.withColumn("_model", model)
            .select("vec_id", F.col("label").alias("truth"), F.array_min(cands)["label"].alias("pred")))


_CENTROID_SQL = """ex AS (SELECT label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
c AS (SELECT label, i, avg(v) AS cv FROM ex GROUP BY 1, 2),
cl AS (SELECT label, list(cv ORDER BY i) AS centroid FROM c GROUP BY 1),
dist AS (SELECT e.vec_id, e.label AS truth, cl.label AS cand,
                list_distance(CAST(e.embedding AS DOUBLE[]), cl.centroid) AS d
         FROM embeddings e CROSS JOIN cl),
pairs AS (SELECT vec_id, truth, cand AS pred FROM dist
          QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, cand) = 1)"""


@register("class_metrics", "M22 M20", f"""
WITH {_CENTROID_SQL},
t AS (SELECT truth AS label, COUNT(*) AS support FROM pairs GROUP BY 1),
p AS (SELECT pred AS label, COUNT(*) AS predicted FROM pairs GROUP BY 1),
tp AS (SELECT truth AS label, COUNT(*) AS tp FROM pairs WHERE truth = pred GROUP BY 1),
m AS (SELECT COALESCE(t.label, p.label) AS label, COALESCE(support, 0) AS support,
             COALESCE(predicted, 0) AS predicted, COALESCE(tp, 0) AS tp
      FROM t FULL JOIN p ON t.label = p.label LEFT JOIN tp ON tp.label = COALESCE(t.label, p.label)),
r AS (SELECT *, tp / NULLIF(predicted, 0) AS precision, tp / NULLIF(support, 0) AS recall FROM m)
SELECT label, support, predicted, tp, ROUND(precision, 6) AS precision, ROUND(recall, 6) AS recall,
       ROUND(2 * precision * recall / NULLIF(precision + recall, 0), 6) AS f1
FROM r""")
def q_class_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r(E.class_metrics(nearest_centroid(Tables(spark, sf_dir)), "truth", "pred"), 6)


@register("macro_metrics", "M22", f"""
WITH {_CENTROID_SQL},
t AS (SELECT truth AS label, COUNT(*) AS support FROM pairs GROUP BY 1),
p AS (SELECT pred AS label, COUNT(*) AS predicted FROM pairs GROUP BY 1),
tp AS (SELECT truth AS label, COUNT(*) AS tp FROM pairs WHERE truth = pred GROUP BY 1),
m AS (SELECT COALESCE(support, 0) AS support, COALESCE(predicted, 0) AS predicted, COALESCE(tp, 0) AS tp
      FROM t FULL JOIN p ON t.label = p.label LEFT JOIN tp ON tp.label = COALESCE(t.label, p.label)),
r AS (SELECT tp / NULLIF(predicted, 0) AS precision, tp / NULLIF(support, 0) AS recall FROM m)
SELECT ROUND((SELECT AVG(CASE WHEN truth = pred THEN 1.0 ELSE 0.0 END) FROM pairs), 6) AS accuracy,
       ROUND(AVG(precision), 6) AS macro_precision, ROUND(AVG(recall), 6) AS macro_recall,
       ROUND(AVG(2 * precision * recall / NULLIF(precision + recall, 0)), 6) AS macro_f1,
       COUNT(*) AS classes
FROM r""")
def q_macro_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r(E.macro_metrics(nearest_centroid(Tables(spark, sf_dir)), "truth", "pred"), 6)


@register("confused_pairs", "M29", f"""
WITH {_CENTROID_SQL}
SELECT truth, pred, COUNT(*) AS n FROM pairs WHERE truth <> pred GROUP BY 1, 2""")
def q_confused_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.confused_pairs(nearest_centroid(Tables(spark, sf_dir)), "truth", "pred")


# ------------------------------------------------------------ regression task

def order_predictions(t: Tables) -> DataFrame:
    net = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    lines = t.lineitem.groupBy("l_orderkey").agg(F.sum(net).alias("pred"))
    o = t.orders.select("o_orderkey", "o_orderpriority", F.col("o_totalprice").alias("truth"))
    return o.join(lines, o.o_orderkey == lines.l_orderkey).drop("l_orderkey")


_PRED_SQL = """p AS (
  SELECT o.o_orderkey, o.o_orderpriority, o.o_totalprice AS truth, l.pred
  FROM orders o JOIN (SELECT l_orderkey, SUM(l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS pred
                      FROM lineitem GROUP BY 1) l ON o.o_orderkey = l.l_orderkey)"""

_REG_SELECT = """COUNT(*) AS n, ROUND(AVG(abs(pred - truth)), 4) AS mae,
       ROUND(AVG((pred - truth) * (pred - truth)), 2) AS mse,
       ROUND(sqrt(AVG((pred - truth) * (pred - truth))), 4) AS rmse,
       ROUND(AVG(abs((pred - truth) / NULLIF(truth, 0))), 6) AS mape,
       ROUND(power(corr(truth, pred), 2), 6) AS rsq, ROUND(AVG(pred - truth), 4) AS bias,
       ROUND(sqrt(AVG(power(ln(1 + pred) - ln(1 + truth), 2))), 6) AS rmsle,
       ROUND(median(abs(pred - truth)), 4) AS median_ae"""


def _reg_round(df: DataFrame) -> DataFrame:
    digits = {"mae": 4, "mse": 2, "rmse": 4, "mape": 6, "rsq": 6, "bias": 4, "rmsle": 6,
              "median_ae": 4}
    return df.select(*[round_to(c, digits[c]).alias(c) if c in digits else F.col(c) for c in df.columns])


@register("regression_metrics", "M25 M36", f"WITH {_PRED_SQL} SELECT {_REG_SELECT} FROM p")
def q_regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reg_round(E.regression_metrics(order_predictions(Tables(spark, sf_dir)), "truth", "pred"))


@register("grouped_errors", "M28", f"""
WITH {_PRED_SQL} SELECT o_orderpriority, {_REG_SELECT} FROM p GROUP BY o_orderpriority""")
def q_grouped_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = order_predictions(Tables(spark, sf_dir))
    return _reg_round(E.regression_metrics(p, "truth", "pred", ["o_orderpriority"]))


@register("improvement", "M26 M04", f"""
WITH {_PRED_SQL},
b AS (SELECT AVG(truth) AS mean_truth FROM p),
m AS (SELECT AVG(abs(pred - truth)) AS mae_model, sqrt(AVG(power(pred - truth, 2))) AS rmse_model,
             AVG(abs(mean_truth - truth)) AS mae_base, sqrt(AVG(power(mean_truth - truth, 2))) AS rmse_base
      FROM p, b)
SELECT 'mae' AS metric, ROUND(mae_base, 4) AS baseline, ROUND(mae_model, 4) AS model,
       ROUND(1 - mae_model / mae_base, 6) AS improvement FROM m
UNION ALL
SELECT 'rmse', ROUND(rmse_base, 4), ROUND(rmse_model, 4), ROUND(1 - rmse_model / rmse_base, 6) FROM m""")
def q_improvement(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = order_predictions(Tables(spark, sf_dir))
    mean_truth = p.select(F.avg("truth")).scalar()  # the mean baseline (M04)
    m = p.agg(F.avg(F.abs(F.col("pred") - F.col("truth"))).alias("mae_model"),
              F.sqrt(F.avg((F.col("pred") - F.col("truth")) ** 2)).alias("rmse_model"),
              F.avg(F.abs(mean_truth - F.col("truth"))).alias("mae_base"),
              F.sqrt(F.avg((mean_truth - F.col("truth")) ** 2)).alias("rmse_base"))
    rows = F.explode(F.array(
        F.struct(F.lit("mae").alias("metric"), F.col("mae_base").alias("baseline"),
                 F.col("mae_model").alias("model")),
        F.struct(F.lit("rmse").alias("metric"), F.col("rmse_base").alias("baseline"),
                 F.col("rmse_model").alias("model"))))
    out = m.select(rows.alias("r")).select("r.*")
    return out.select("metric", round_to("baseline", 4).alias("baseline"),
                      round_to("model", 4).alias("model"),
                      round_to(E.improvement(F.col("model"), F.col("baseline")), 6).alias("improvement"))


@register("review_queue", "M27 O03 P09", f"""
WITH {_PRED_SQL}
SELECT o_orderkey, truth, ROUND(pred, 4) AS pred, ROUND(pred - truth, 4) AS error,
       ROUND(abs(pred - truth), 4) AS abs_error,
       CASE WHEN pred - truth > 0 THEN 'Over-predicted' WHEN pred - truth < 0 THEN 'Under-predicted'
            ELSE 'Exact' END AS direction
FROM p ORDER BY abs(pred - truth) DESC, o_orderkey LIMIT 15""")
def q_review_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = order_predictions(Tables(spark, sf_dir))
    err = F.col("pred") - F.col("truth")
    # A top-15 report: the limit is the feature (TakeOrderedAndProject).
    top = p.orderBy(F.abs(err).desc(), F.col("o_orderkey")).limit(15)
    return top.select("o_orderkey", "truth", round_to("pred", 4).alias("pred"),
                      round_to(err, 4).alias("error"), round_to(F.abs(err), 4).alias("abs_error"),
                      sign_label(err).alias("direction"))


# ------------------------------------------------------------- allocation

def customer_segments(t: Tables, multiplier: Column | float = 1.0) -> DataFrame:
    o = t.orders.groupBy("o_custkey").agg(
        (F.count_if(F.col("o_orderstatus") == "P") / F.count(F.lit(1))).alias("risk"))
    nation = F.broadcast(t.nation.select("n_nationkey", "n_name"))  # 25 rows
    c = (t.customer.join(o, F.col("c_custkey") == F.col("o_custkey"))
         .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
         .withColumn("monthly_value", F.greatest(F.col("c_acctbal"), F.lit(0.0)))
         .withColumn("segment", F.concat_ws(" | ", "n_name", "c_mktsegment")))
    scored = X.expected_exposure(c, "risk", "monthly_value")
    seg = X.segment_summary(scored, ["segment"], "risk")
    # Segment sums are rounded once so every derived option value is computed
    # from the same numbers regardless of summation order.
    return seg.withColumns({"mean_risk": round_to("mean_risk", 9),
                            "expected_cases": round_to("expected_cases", 9),
                            "total_exposure": round_to("total_exposure", 6)})


_SEG_SQL = """cust AS (
  SELECT n.n_name || ' | ' || c.c_mktsegment AS segment, o.risk,
         o.risk * (greatest(c.c_acctbal, 0.0) * 6) AS exposure
  FROM customer c
  JOIN (SELECT o_custkey, COUNT(*) FILTER (WHERE o_orderstatus = 'P') / COUNT(*) AS risk
        FROM orders GROUP BY 1) o ON c.c_custkey = o.o_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey),
seg AS (SELECT segment, COUNT(*) AS members, ROUND(AVG(risk), 9) AS mean_risk,
               ROUND(SUM(risk), 9) AS expected_cases, ROUND(SUM(exposure), 6) AS total_exposure
        FROM cust GROUP BY 1),
iv AS (SELECT * FROM (VALUES """ + ", ".join(
    f"('{n}', {c}, {e}::DOUBLE)" for n, c, e in X.INTERVENTIONS) + """)
       AS t(intervention, cost_per_member, effectiveness)),
opt AS (SELECT seg.*, iv.intervention, iv.effectiveness, seg.members * iv.cost_per_member AS program_cost,
               seg.total_exposure * iv.effectiveness AS avoided
        FROM seg CROSS JOIN iv)"""


@register("exposure_options", "X01 X02 X03 A23 J08", f"""
WITH {_SEG_SQL}
SELECT segment, intervention, members, ROUND(mean_risk, 6) AS mean_risk,
       ROUND(expected_cases, 4) AS expected_cases, ROUND(total_exposure, 4) AS total_exposure,
       CAST(program_cost AS BIGINT) AS program_cost, ROUND(avoided, 4) AS expected_avoided_cost,
       ROUND(avoided - program_cost, 4) AS expected_net_benefit,
       ROUND((avoided - program_cost) / program_cost, 6) AS expected_roi
FROM opt""")
def q_exposure_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = X.decision_options(customer_segments(Tables(spark, sf_dir)))
    return o.select("segment", "intervention", "members", round_to("mean_risk", 6).alias("mean_risk"),
                    round_to("expected_cases", 4).alias("expected_cases"),
                    round_to("total_exposure", 4).alias("total_exposure"), "program_cost",
                    round_to("expected_avoided_cost", 4).alias("expected_avoided_cost"),
                    round_to("expected_net_benefit", 4).alias("expected_net_benefit"),
                    round_to("expected_roi", 6).alias("expected_roi"))


@register("heuristic_portfolio", "X05 W05 W06", f"""
WITH {_SEG_SQL},
best AS (SELECT * FROM opt
         QUALIFY row_number() OVER (PARTITION BY segment ORDER BY effectiveness DESC, intervention) = 1),
r AS (SELECT *, SUM(program_cost) OVER w AS cumulative_cost, row_number() OVER w AS rank
      FROM best WINDOW w AS (ORDER BY mean_risk DESC, segment ROWS UNBOUNDED PRECEDING))
SELECT segment, intervention, CAST(program_cost AS BIGINT) AS program_cost,
       CAST(cumulative_cost AS BIGINT) AS cumulative_cost, rank,
       ROUND(avoided - program_cost, 4) AS expected_net_benefit
FROM r WHERE cumulative_cost <= {X.ANNUAL_BUDGET} AND rank <= {X.MAXIMUM_PROGRAMS}""")
def q_heuristic_portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = X.decision_options(customer_segments(Tables(spark, sf_dir)))
    h = X.heuristic_portfolio(o, "segment")
    return h.select("segment", "intervention", "program_cost",
                    F.col("cumulative_cost").cast("long").alias("cumulative_cost"), "rank",
                    round_to("expected_net_benefit", 4).alias("expected_net_benefit"))


def scenario_options(t: Tables) -> DataFrame:
    """Options under every scenario: the budget sweep and the effectiveness cases."""
    scen = [F.struct(F.lit(f"budget_{b}").alias("scenario"), F.lit(b).alias("budget"),
                     F.lit(1.0).alias("multiplier")) for b in X.BUDGET_SWEEP]
    scen += [F.struct(F.lit(f"effect_{name}").alias("scenario"), F.lit(X.ANNUAL_BUDGET).alias("budget"),
                      F.lit(m).alias("multiplier")) for name, m in X.EFFECTIVENESS_SCENARIOS]
    seg = customer_segments(t).select("*", F.explode(F.array(*scen)).alias("s")).select("*", "s.*").drop("s")
    return X.decision_options(seg, F.col("multiplier"))


@register("portfolio_exact", "X04 X06 X07 X08")
def q_portfolio_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    opts = scenario_options(Tables(spark, sf_dir))
    chosen = X.exact_portfolio(opts, ["scenario"], "segment", "budget")
    return chosen.select("scenario", "budget", "segment", "intervention", "program_cost",
                         round_to("expected_net_benefit", 4).alias("expected_net_benefit"))
