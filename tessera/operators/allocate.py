"""Expected value, option enumeration and budgeted selection.

Fixed values below must equal the retention notebook's assumptions.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.windows import running_selection

# Intervention alternatives (name, cost per member, effectiveness).
INTERVENTIONS = [
    ("Flexible work", 500, 0.10),
    ("Career development", 1500, 0.22),
    ("Training program", 1200, 0.18),
    ("Compensation review", 2500, 0.30),
]
# Replacement months, annual budget, maximum number of programs,
# budget sweep and effectiveness scenarios.
REPLACEMENT_MONTHS = 6
ANNUAL_BUDGET = 150000
MAXIMUM_PROGRAMS = 6
BUDGET_SWEEP = list(range(50000, 300001, 25000))
EFFECTIVENESS_SCENARIOS = [("Pessimistic", 0.60), ("Expected", 1.00), ("Optimistic", 1.30)]


def expected_exposure(df: DataFrame, prob: str, monthly_value: str,
                      months: int = REPLACEMENT_MONTHS) -> DataFrame:
    """cost = value x months; exposure = p x cost."""
    cost = F.col(monthly_value) * months
    return df.withColumns({"estimated_cost": cost, "expected_exposure": F.col(prob) * cost})


def segment_summary(df: DataFrame, by: Sequence[str], prob: str) -> DataFrame:
    """members, mean risk, expected cases, total exposure per segment."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("members"), F.avg(prob).alias("mean_risk"),
        F.sum(prob).alias("expected_cases"), F.sum("expected_exposure").alias("total_exposure"))


def _intervention_array(multiplier: Column | float = 1.0) -> Column:
    return F.array(*[F.struct(F.lit(n).alias("intervention"), F.lit(c).alias("cost_per_member"),
                              F.least(F.lit(e) * multiplier, F.lit(1.0)).alias("effectiveness"))
                     for n, c, e in INTERVENTIONS])


def decision_options(segments: DataFrame, multiplier: Column | float = 1.0) -> DataFrame:
    """Every segment x intervention with cost, avoided cost, net benefit, ROI.

    The intervention list is a fixed literal exploded per segment (a
    generator, not a join).
    """
    x = segments.select("*", F.explode(_intervention_array(multiplier)).alias("_i"))
    cost = (F.col("members") * F.col("_i.cost_per_member")).cast("long")
    avoided = F.col("total_exposure") * F.col("_i.effectiveness")
    return (x.select("*", F.col("_i.intervention").alias("intervention"),
                     F.col("_i.cost_per_member").alias("cost_per_member"),
                     F.col("_i.effectiveness").alias("effectiveness"),
                     cost.alias("program_cost"), avoided.alias("expected_avoided_cost"))
            .drop("_i")
            .withColumn("expected_net_benefit", F.col("expected_avoided_cost") - F.col("program_cost"))
            .withColumn("expected_roi", F.col("expected_net_benefit") / F.nullif(F.col("program_cost"), F.lit(0))))


def heuristic_portfolio(options: DataFrame, segment: str, budget: float = ANNUAL_BUDGET,
                        max_programs: int = MAXIMUM_PROGRAMS,
                        rank_by: Column | None = None) -> DataFrame:
    """Strongest intervention per segment, highest risk first, within budget."""
    from pyspark.sql.window import Window
    w = Window.partitionBy(segment).orderBy(F.col("effectiveness").desc(), F.col("intervention"))
    best = options.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    order = [rank_by if rank_by is not None else F.col("mean_risk").desc(), F.col(segment).asc()]
    return running_selection(best, order, "program_cost", budget, max_programs)


# ------------------------------------------------------------- exact

def solve_mckp(seg: np.ndarray, cost: np.ndarray, value: np.ndarray, budget: int,
               max_items: int) -> list[int]:
    """Exact multiple-choice knapsack: at most one option per segment, total
    cost <= budget, at most ``max_items`` options, maximise total value.

    Dynamic programme over (items used, cost in units of the cost gcd).
    Options with non-positive value are never useful and are skipped.
    Returns the chosen row indices.
    """
    keep = np.where(value > 0)[0]
    if len(keep) == 0 or budget <= 0:
        return []
    g = 0
    for c in list(cost[keep]) + [budget]:
        g = gcd(g, int(c))
    g = max(g, 1)
    units = (cost // g).astype(np.int64)
    cap = int(budget // g)
    neg = -np.inf
    best = np.full((max_items + 1, cap + 1), neg)
    best[0, :] = 0.0
    choice = []
    groups: dict = {}
    for i in keep:
        groups.setdefault(seg[i], []).append(i)
    for s, idx in groups.items():
        new = best.copy()
        pick = np.full(best.shape, -1, dtype=np.int64)
        for i in idx:
            u = int(units[i])
            if u > cap:
                continue
            cand = np.full(best.shape, neg)
            cand[1:, u:] = best[:-1, :cap + 1 - u] + value[i]
            better = cand > new
            new[better] = cand[better]
            pick[better] = i
        choice.append(pick)
        best = new
    k, c = np.unravel_index(np.argmax(best), best.shape)
    chosen = []
    for pick in reversed(choice):
        i = pick[k, c]
        if i >= 0:
            chosen.append(int(i))
            k, c = k - 1, c - int(units[i])
    return chosen


def exact_portfolio(options: DataFrame, scenario_cols: Sequence[str], segment: str,
                    budget_col: str, max_programs: int = MAXIMUM_PROGRAMS) -> DataFrame:
    """Optimal option set per scenario.

    Scenarios are the parallel axis: one ``applyInPandas`` group per
    scenario holds that scenario's options, which are bounded by segments x
    interventions (a dimension, not the data volume).
    """
    cols = [*scenario_cols, segment, "intervention", "program_cost", "expected_net_benefit",
            budget_col]
    schema = options.select(*cols).schema

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        if pdf.empty:
            return pdf
        chosen = solve_mckp(pdf[segment].to_numpy(), pdf["program_cost"].to_numpy().astype(np.int64),
                            pdf["expected_net_benefit"].to_numpy().astype(float),
                            int(pdf[budget_col].iloc[0]), max_programs)
        return pdf.iloc[sorted(chosen)][cols]

    return options.select(*cols).groupBy(*scenario_cols).applyInPandas(solve, schema)
