"""Queries without a SQL twin: what must hold of their results, whatever the fit."""

import numpy as np
import pytest

import __spark_entry__ as entry
from tessera.operators import allocate as X
from tessera.plans.registry import all_queries
from tests.test_text_and_oracle import SMALL


@pytest.fixture(scope="module")
def rows(spark):
    cache = {}

    def get(name):
        if name not in cache:
            cache[name] = all_queries()[name].build(spark, SMALL).toPandas()
        return cache[name]
    return get


def test_every_query_without_oracle_is_checked_here():
    checked = {"portfolio_exact", "approach_comparison", "logistic_quality", "odds_ratios", "tree_importance", "boosted_importance",
               "random_forest_quality", "kmeans", "cluster_search", "pca", "pca_loadings", "pca_scores", "mlp_embeddings",
               "model_comparison", "turn_role_classifier", "tukey_tests", "tree_pruning", "relu_network"}
    assert {n for n in all_queries() if n not in entry.oracle_sql()} == checked


@pytest.mark.parametrize("name", ["tree_importance", "boosted_importance", "random_forest_quality"])
def test_importances_are_shares(rows, name):
    d = rows(name)
    assert len(d) == 6 and d.importance.sum() == pytest.approx(1) and (d.importance >= 0).all()
    assert d.importance.is_monotonic_decreasing


def test_pruned_trees_are_nested_and_the_least_error_is_chosen(rows):
    d = rows("tree_pruning")
    assert d.penalty.is_monotonic_increasing and d.leaves.is_monotonic_decreasing and d.train_error.is_monotonic_increasing
    assert d.chosen.sum() == 1 and d.cv_error[d.chosen].iloc[0] == d.cv_error.min() and d.leaves.iloc[-1] == 1


def test_logistic_counts_and_rates(rows):
    r = rows("logistic_quality").iloc[0]
    assert r.tp + r.fp + r.fn + r.tn == r.n > 0
    assert r.accuracy == pytest.approx((r.tp + r.tn) / r.n, abs=1e-6) and 0 <= r.auc <= 1


def test_odds_ratio_limits_enclose_the_estimate(rows):
    d = rows("odds_ratios")
    assert (d.conf_low <= d.odds_ratio).all() and (d.odds_ratio <= d.conf_high).all()
    assert d.log_odds.abs().is_monotonic_decreasing


def test_clusters_partition_the_vectors(rows, spark):
    d, n = rows("kmeans"), spark.read.parquet(f"{SMALL}/embeddings.parquet").count()
    assert d["size"].sum() == n and ((d.majority_n / d["size"]) == d.purity).all()
    assert d.ari.nunique() == 1 and d.ari.between(-1, 1).all() and d.silhouette.between(-1, 1).all()


def test_cluster_search_is_ordered(rows):
    d = rows("cluster_search")
    assert len(d) == 9 and d.silhouette.is_monotonic_decreasing


def test_pca_components_are_orthonormal(rows):
    d = rows("pca")
    assert d.cumulative.is_monotonic_increasing and d.explained_variance.is_monotonic_decreasing and d.cumulative.iloc[-1] <= 1 + 1e-9
    m = rows("pca_loadings").pivot(index="feature", columns="component", values="loading").to_numpy()
    assert np.allclose(m.T @ m, np.eye(m.shape[1]), atol=1e-6)
    s = rows("pca_scores")
    assert s.groupby("vec_id").size().eq(20).all() and (s.vec_id % 5 == 0).all()


@pytest.mark.parametrize("name", ["mlp_embeddings", "relu_network", "turn_role_classifier", "model_comparison"])
def test_metrics_are_rates(rows, name):
    d = rows(name)
    for c in ("accuracy", "macro_precision", "macro_recall", "macro_f1"):
        assert d[c].between(0, 1).all()
    if name == "model_comparison":
        assert len(d) == 4


def test_tukey_limits(rows):
    d = rows("tukey_tests")
    assert (d.conf_low <= d["diff"]).all() and (d["diff"] <= d.conf_high).all() and d.p_adj.between(0, 1).all()
    # A pair differs at 5% exactly if its limits leave out zero.
    assert ((d.p_adj < 0.05) == ((d.conf_low > 0) | (d.conf_high < 0))).all()


def test_exact_portfolio_keeps_its_limits(rows):
    d = rows("portfolio_exact")
    g = d.groupby("scenario")
    assert (g.program_cost.sum() <= g.budget.first()).all() and (g.size() <= X.MAXIMUM_PROGRAMS).all()
    assert not d.duplicated(["scenario", "segment"]).any() and (d.expected_net_benefit > 0).all()
    c = rows("approach_comparison").set_index("approach")
    assert c.total_net_benefit["optimized"] >= c.total_net_benefit["risk ranking"] - 1e-6
    assert (c.unused_budget >= 0).all()
    best = g.expected_net_benefit.sum()
    sweep = sorted((int(s.split("_")[1]), v) for s, v in best.items() if s.startswith("budget_"))
    assert all(a[1] <= b[1] + 1e-6 for a, b in zip(sweep, sweep[1:], strict=False))  # more budget is never worse
