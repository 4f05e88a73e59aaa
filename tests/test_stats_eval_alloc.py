"""Statistics against NumPy, evaluation invariants, exact allocation against brute force."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import allocate as X
from tessera.operators import distributions as D
from tessera.operators import evaluate as E
from tessera.operators import stats as S


def test_distribution_known_values():
    assert D.t_sf2(2.0, 10) == pytest.approx(0.07338803, abs=1e-7)
    assert D.t_ppf(0.975, 10) == pytest.approx(2.228139, abs=1e-5)
    assert D.f_sf(3.0, 2, 20) == pytest.approx(1.3 ** -10, abs=1e-10)  # closed form for d1 = 2
    assert D.chi2_sf(3.84145882, 1) == pytest.approx(0.05, abs=1e-7)
    assert D.norm_cdf(1.959963985) == pytest.approx(0.975, abs=1e-9)
    # studentized range: qtukey(0.95, 3, 10) = 3.877
    assert D.ptukey(3.877, 3, 10) == pytest.approx(0.95, abs=2e-3)
    # Fixed values from tables, also for very small and very large degrees of freedom.
    assert D.ptukey(3.314, 3, 1e6) == pytest.approx(0.95, abs=2e-3)
    assert D.t_ppf(0.9999, 1) == pytest.approx(3183.0988, rel=1e-6)
    assert D.t_ppf(0.025, 10) == pytest.approx(-2.228139, abs=1e-5)
    assert D.t_ppf(0.975, 1e7) == pytest.approx(1.959964, abs=1e-5)
    assert D.chi2_sf(1e6, 1e6) == pytest.approx(0.49981, abs=1e-4)
    assert D.f_sf(1.0, 1e5, 1e5) == pytest.approx(0.5, abs=1e-6)


def _groups(spark):
    rng = np.random.default_rng(1)
    rows = [(g, float(x)) for g, mu in (("a", 0.0), ("b", 0.5), ("c", 1.0))
            for x in rng.normal(mu, 1 + (g == "c"), 40 + 10 * (g == "b"))]
    return spark.createDataFrame(rows, "g string, x double"), rows


def test_welch_and_anova_match_numpy(spark):
    df, rows = _groups(spark)
    a = np.array([x for g, x in rows if g == "a"])
    b = np.array([x for g, x in rows if g == "b"])
    w = S.welch(df, "g", "x", "a", "b").first()
    se2 = a.var(ddof=1) / len(a) + b.var(ddof=1) / len(b)
    assert w.t == pytest.approx((a.mean() - b.mean()) / math.sqrt(se2))
    dfw = se2 ** 2 / ((a.var(ddof=1) / len(a)) ** 2 / (len(a) - 1) + (b.var(ddof=1) / len(b)) ** 2 / (len(b) - 1))
    assert w.df == pytest.approx(dfw)
    an = S.anova(df, "g", "x").first()
    xs = {g: np.array([x for gg, x in rows if gg == g]) for g in "abc"}
    allx = np.concatenate(list(xs.values()))
    ssb = sum(len(v) * (v.mean() - allx.mean()) ** 2 for v in xs.values())
    ssw = sum(((v - v.mean()) ** 2).sum() for v in xs.values())
    assert an.ssb == pytest.approx(ssb) and an.ssw == pytest.approx(ssw)
    assert len(S.with_p_values(S.tukey_pairs(df, "g", "x"), "tukey").collect()) == 3


def test_ols_matches_lstsq(spark):
    rng = np.random.default_rng(3)
    x1, x2 = rng.normal(size=200), rng.normal(size=200)
    y = 1.5 + 2 * x1 - x2 + rng.normal(scale=0.3, size=200)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for a, b, c in zip(x1, x2, y)],
                               "x1 double, x2 double, y double")
    fit = S.ols(df, "y", ["x1", "x2"])
    beta, *_ = np.linalg.lstsq(np.column_stack([np.ones(200), x1, x2]), y, rcond=None)
    assert [c["estimate"] for c in fit["coefficients"]] == pytest.approx(list(beta))
    pi = S.prediction_interval(df.limit(3), fit, ["x1", "x2"]).collect()
    assert all(r.lwr < r.fit < r.upr for r in pi)


def test_binary_metric_invariants(spark):
    rng = random.Random(5)
    rows = [(i, int(rng.random() < 0.4), round(rng.random(), 2)) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, truth int, score double")
    c = E.with_rates(E.confusion_counts(df, "truth", F.col("score") >= 0.5)).first()
    assert c.tp + c.fp + c.fn + c.tn == c.n == 400
    auc = E.auc(df, "truth", "score").first().auc
    pos = [s for _, t, s in rows if t == 1]
    neg = [s for _, t, s in rows if t == 0]
    brute = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert auc == pytest.approx(brute)
    sweep = E.threshold_sweep(df, "truth", "score", [0.1, 0.5, 0.9]).orderBy("threshold").collect()
    assert [r.flagged for r in sweep] == [sum(s >= t for *_, s in rows) for t in (0.1, 0.5, 0.9)]


def test_ari_identity_and_macro(spark):
    df = spark.createDataFrame([(i % 3, i % 3) for i in range(30)], "a int, b int")
    assert E.adjusted_rand_index(df, "a", "b").first().ari == pytest.approx(1.0)
    pairs = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 1)], "t int, p int")
    m = E.macro_metrics(pairs, "t", "p").first()
    assert m.accuracy == pytest.approx(0.5)
    # class 2 is never predicted: its precision is NULL and skipped
    assert m.macro_precision == pytest.approx((1.0 + 1 / 3) / 2)


def test_stratified_split_is_exact(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(101)], "id int, s int")
    out = E.stratified_split(df, "s", "id", 0.8).groupBy("s", "split").count().collect()
    got = {(r.s, r.split): r["count"] for r in out}
    for s in range(3):
        n = sum(1 for i in range(101) if i % 3 == s)
        assert got[(s, "train")] == round(n * 0.8)


def _brute(seg, cost, val, budget, kmax):
    best, best_set = 0.0, []
    segs = sorted(set(seg))
    opts = {s: [i for i in range(len(seg)) if seg[i] == s] for s in segs}
    for pick in itertools.product(*[[None] + opts[s] for s in segs]):
        ch = [i for i in pick if i is not None]
        if len(ch) <= kmax and sum(cost[i] for i in ch) <= budget:
            v = sum(val[i] for i in ch)
            if v > best + 1e-9:
                best, best_set = v, ch
    return best


@pytest.mark.parametrize("seed", range(12))
def test_mckp_matches_brute_force(seed):
    rng = random.Random(seed)
    n_seg = rng.randint(1, 6)
    seg, cost, val = [], [], []
    for s in range(n_seg):
        for _ in range(rng.randint(1, 3)):
            seg.append(s)
            cost.append(rng.choice([500, 1200, 1500, 2500]) * rng.randint(1, 6))
            val.append(rng.uniform(-3000, 9000))
    budget = rng.choice([0, 400, 5000, 15000, 40000])
    kmax = rng.randint(1, 4)
    chosen = X.solve_mckp(np.array(seg), np.array(cost), np.array(val), budget, kmax)
    assert len({seg[i] for i in chosen}) == len(chosen) <= kmax
    assert sum(cost[i] for i in chosen) <= budget
    assert sum(val[i] for i in chosen) == pytest.approx(_brute(seg, cost, val, budget, kmax))


def test_exact_portfolio_beats_heuristic(spark):
    seg = spark.createDataFrame(
        [("s1", 12, 0.4, 300000.0), ("s2", 3, 0.9, 20000.0), ("s3", 30, 0.2, 900000.0)],
        "segment string, members long, mean_risk double, total_exposure double")
    opts = X.decision_options(seg).withColumn("scenario", F.lit("base")).withColumn("budget", F.lit(150000))
    exact = X.exact_portfolio(opts, ["scenario"], "segment", "budget").collect()
    heur = X.heuristic_portfolio(X.decision_options(seg), "segment").collect()
    assert sum(r.expected_net_benefit for r in exact) >= sum(r.expected_net_benefit for r in heur) - 1e-6
    assert sum(r.program_cost for r in exact) <= 150000
