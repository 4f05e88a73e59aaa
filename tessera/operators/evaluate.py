"""Model evaluation from conditional counts.

Scored rows are reduced first: binary metrics, ROC and threshold sweeps all
run on ``(group, score) -> positives, negatives`` counts, so their cost is
one partial aggregation over the data plus work on distinct scores.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.operators.windows import (exact_quantiles, global_row_number, join_null_safe, running_total,
                                       running_totals)
from tessera.session import materialise


def _div(a: Column, b: Column) -> Column:
    return a / F.nullif(b, F.lit(0))


def confusion_counts(scored: DataFrame, truth: str, pred: Column, by: Sequence[str] = ()) -> DataFrame:
    """tp, fp, fn, tn per group for a boolean prediction."""
    t = F.col(truth) == 1
    aggs = [F.count(F.lit(1)).alias("n"), F.count_if(t & pred).alias("tp"),
            F.count_if(~t & pred).alias("fp"), F.count_if(t & ~pred).alias("fn"),
            F.count_if(~t & ~pred).alias("tn")]
    return scored.groupBy(*by).agg(*aggs) if by else scored.agg(*aggs)


def with_rates(c: DataFrame) -> DataFrame:
    """accuracy, precision, recall, F1, specificity, balanced accuracy."""
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    precision = _div(tp, tp + fp)
    recall = _div(tp, tp + fn)
    spec = _div(tn, tn + fp)
    return c.select("*", _div(tp + tn, F.col("n")).alias("accuracy"), precision.alias("precision"),
                    recall.alias("recall"),
                    _div(2 * precision * recall, precision + recall).alias("f1"),
                    spec.alias("specificity"), ((recall + spec) / 2).alias("balanced_accuracy"))


def score_counts(scored: DataFrame, truth: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score (the input to ROC/AUC/sweeps)."""
    return scored.groupBy(*by, score).agg(
        F.count_if(F.col(truth) == 1).alias("pos"), F.count_if(F.col(truth) != 1).alias("neg"))


def auc(scored: DataFrame, truth: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """ROC AUC by the rank-sum identity with ties counted half.

    Negatives below each distinct score come from a keyed running total over
    the distinct scores, so no pairs of rows are formed.
    """
    sc = score_counts(scored, truth, score, by)
    sc = running_total(sc, [F.col(score).asc()], "neg", "_neg_le", keys=list(by))
    contrib = F.col("pos") * (F.col("_neg_le") - F.col("neg") + 0.5 * F.col("neg"))
    aggs = [_div(F.sum(contrib), F.sum("pos") * F.sum("neg")).alias("auc")]
    return sc.groupBy(*by).agg(*aggs) if by else sc.agg(*aggs)


def roc_points(scored: DataFrame, truth: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """TPR/FPR when flagging ``score >= s`` for every distinct score."""
    sc = score_counts(scored, truth, score, by)
    sc = running_totals(sc, [F.col(score).desc()], {"tp": "pos", "fp": "neg"}, totals={"tp": "_p", "fp": "_n"},
                        keys=list(by))
    return sc.select(*by, F.col(score).alias("threshold"), _div(F.col("tp"), F.col("_p")).alias("tpr"),
                     _div(F.col("fp"), F.col("_n")).alias("fpr"))


def threshold_sweep(scored: DataFrame, truth: str, score: str, thresholds: Sequence[float],
                    by: Sequence[str] = ()) -> DataFrame:
    """flagged, recall, precision, missed at each threshold.

    The thresholds (a parameter list) are applied to the per-score counts,
    not to the data rows.
    """
    sc = score_counts(scored, truth, score, by)
    th = F.explode(F.array(*[F.lit(float(t)) for t in thresholds])).alias("threshold")
    x = sc.select("*", th)
    hit = F.col(score) >= F.col("threshold")
    s = x.groupBy(*by, "threshold").agg(
        F.sum(F.when(hit, F.col("pos") + F.col("neg")).otherwise(0)).alias("flagged"),
        F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum("pos").alias("_p"))
    return s.select(*by, "threshold", F.col("flagged").cast("long").alias("flagged"),
                    _div(F.col("tp"), F.col("_p")).alias("recall"),
                    _div(F.col("tp"), F.col("flagged")).alias("precision"),
                    (F.col("_p") - F.col("tp")).cast("long").alias("missed"))


def capacity_threshold(sweep: DataFrame, capacity: Column, by: Sequence[str] = ()) -> DataFrame:
    """Best-recall threshold per group whose flagged count fits the capacity.

    Ties keep the lowest threshold (first in sweep order).  Runs on the
    sweep table (groups x thresholds rows).
    """
    ok = sweep.where(F.col("flagged") <= capacity)
    w = Window.partitionBy(*by).orderBy(F.col("recall").desc_nulls_last(), F.col("threshold").asc())
    return ok.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def ranked_review(scored: DataFrame, truth: str, score: str, key: str, capacity: Column,
                  by: Sequence[str] = ()) -> DataFrame:
    """Top-``capacity`` rows by score per group: captured positives, precision.

    Ranks come from a keyed range-partitioned row number, so a group far
    larger than one task is still split.
    """
    r = global_row_number(scored, [F.col(score).desc(), F.col(key).asc()], "_rank", keys=list(by))
    top = r.where(F.col("_rank") <= capacity)
    aggs = [F.count(F.lit(1)).alias("reviewed"), F.count_if(F.col(truth) == 1).alias("captured")]
    s = top.groupBy(*by).agg(*aggs) if by else top.agg(*aggs)
    return s.withColumn("precision", _div(F.col("captured"), F.col("reviewed")))


def adjusted_rand_index(df: DataFrame, a: str, b: str) -> DataFrame:
    """ARI from the contingency table's pair counts."""
    def c2(x):
        return x * (x - 1) / 2
    cells = materialise(df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n")), "cells")  # the only pass over rows
    rows = cells.groupBy(a).agg(F.sum("n").alias("s"))
    cols = cells.groupBy(b).agg(F.sum("n").alias("s"))
    idx = cells.select(F.sum(c2(F.col("n")))).scalar()
    sa = rows.select(F.sum(c2(F.col("s")))).scalar()
    sb = cols.select(F.sum(c2(F.col("s")))).scalar()
    n = cells.select(F.sum("n")).scalar()
    expected = sa * sb / c2(n)
    return df.sparkSession.range(1).select(
        idx.alias("index"), sa.alias("sum_a"), sb.alias("sum_b"),
        ((idx - expected) / ((sa + sb) / 2 - expected)).alias("ari"))


def confusion_cells(pairs: DataFrame, truth: str, pred: str, *extra: Column) -> DataFrame:
    """Rows per (truth, prediction), and further aggregates: the only pass over scored rows."""
    return pairs.groupBy(truth, pred).agg(F.count(F.lit(1)).alias("n"), *extra)


def class_metrics(pairs: DataFrame, truth: str, pred: str) -> DataFrame:
    """Per-class one-vs-rest precision, recall, F1 (M22), from one confusion count."""
    return _class_table(confusion_cells(pairs, truth, pred), truth, pred)


def _class_table(cells: DataFrame, truth: str, pred: str) -> DataFrame:
    none, n = F.lit(0).cast("long"), F.col("n")
    sides = F.array(
        F.struct(F.col(truth).alias("label"), n.alias("support"), none.alias("predicted"),
                 F.when(F.col(truth) == F.col(pred), n).otherwise(none).alias("tp")),
        F.struct(F.col(pred).alias("label"), none.alias("support"), n.alias("predicted"), none.alias("tp")))
    m = (cells.select(F.explode(sides).alias("s")).groupBy("s.label")
         .agg(*[F.sum(f"s.{c}").alias(c) for c in ("support", "predicted", "tp")]))
    precision = _div(F.col("tp"), F.col("predicted"))
    recall = _div(F.col("tp"), F.col("support"))
    return m.select("label", "support", "predicted", "tp", precision.alias("precision"),
                    recall.alias("recall"),
                    _div(2 * precision * recall, precision + recall).alias("f1"))


def macro_metrics(pairs: DataFrame, truth: str, pred: str, mean_of: str | None = None) -> DataFrame:
    """Accuracy and NULL-skipping macro averages over classes.

    The scored rows are read once; ``mean_of`` adds the mean of one of their columns.
    """
    extra = [F.sum(mean_of).alias("_sum")] if mean_of else []
    cells = materialise(confusion_cells(pairs, truth, pred, *extra), "confusion")
    out = _class_table(cells, truth, pred).agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"), F.avg("precision").alias("macro_precision"),
        F.avg("recall").alias("macro_recall"), F.avg("f1").alias("macro_f1"),
        F.count(F.lit(1)).alias("classes"))
    if mean_of:
        out = out.withColumn(f"mean_{mean_of}", cells.select(F.sum("_sum") / F.sum("n")).scalar())
    return out


def confused_pairs(pairs: DataFrame, truth: str, pred: str) -> DataFrame:
    """Most frequent truth -> prediction mistakes."""
    return (pairs.where(F.col(truth) != F.col(pred)).groupBy(truth, pred)
            .agg(F.count(F.lit(1)).alias("n")))


def regression_metrics(df: DataFrame, truth: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """MAE, MSE, RMSE, MAPE, R^2 (squared correlation), bias, RMSLE."""
    e = F.col(pred) - F.col(truth)
    aggs = [F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"),
            F.sqrt(F.avg(e * e)).alias("rmse"),
            F.avg(F.abs(_div(e, F.col(truth)))).alias("mape"),
            (F.corr(truth, pred) ** 2).alias("rsq"), F.avg(e).alias("bias"),
            F.sqrt(F.avg((F.log(1 + F.col(pred)) - F.log(1 + F.col(truth))) ** 2)).alias("rmsle")]
    rest = df.groupBy(*by).agg(*aggs)
    middle = exact_quantiles(df.select(*by, F.abs(e).alias("_ae")), "_ae", {"median_ae": 0.5}, by)
    return join_null_safe(rest, middle, list(by))


def improvement(new: Column, old: Column) -> Column:
    """1 - new/old."""
    return 1 - _div(new, old)


def stratified_split(df: DataFrame, strata: str, key: str, train_share: float = 0.8,
                     seed: int = 123) -> DataFrame:
    """Exact, deterministic per-stratum split.

    Rows are ordered inside each stratum by a seeded hash of the key; the
    first ``round(share * n)`` go to training.  Ranks come from a keyed
    range-partitioned row number, so a large stratum is split across tasks.
    """
    h = df.withColumn("_h", F.xxhash64(F.col(key), F.lit(seed)))
    r = global_row_number(h, [F.col("_h"), F.col(key)], "_rank", total_name="_n", keys=[strata])
    return (r.withColumn("split", F.when(F.col("_rank") <= F.round(F.col("_n") * train_share),
                                         F.lit("train")).otherwise(F.lit("test")))
            .drop("_h", "_rank", "_n"))


def chronological_split(df: DataFrame, ts: str, train_share: float = 0.8) -> DataFrame:
    """Earliest ``train_share`` of rows by time go to training."""
    micros = df.select(F.unix_micros(F.col(ts).cast("timestamp")).alias("_t"))
    cut = exact_quantiles(micros, "_t", {"cut": train_share}).scalar()
    return df.withColumn("split", F.when(F.unix_micros(F.col(ts).cast("timestamp")) <= cut, "train")
                         .otherwise("test"))


def majority_class(df: DataFrame, label: str) -> DataFrame:
    """Zero-rule baseline: most frequent class, ties to the smallest."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    w = Window.orderBy(F.col("n").desc(), F.col(label).asc())  # one row per class
    return c.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def capacity(n_rows: Column, share: float = 0.20) -> Column:
    """Review capacity ``ceil(share * N)``."""
    return F.ceil(n_rows * F.lit(share)).cast("long")


__all__ = [n for n in dir() if not n.startswith("_") and n not in ("math", "annotations")]
