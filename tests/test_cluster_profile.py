"""Silhouette widths and profile-likelihood limits against direct computation."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.operators import cluster, profile
from tessera.session import materialise


def direct_width(points, labels):
    keep = [i for i, c in enumerate(labels) if c is not None]
    points, labels = points[keep], np.array([labels[i] for i in keep])
    d = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
    out = []
    for i, c in enumerate(labels):
        if (labels == c).sum() == 1:
            out.append(0.0)
            continue
        a = d[i, labels == c].sum() / ((labels == c).sum() - 1)
        b = min(d[i, labels == o].mean() for o in set(labels.tolist()) - {c})
        out.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return float(np.mean(out))


def test_silhouette_widths_equal_all_pairs(spark):
    rng = np.random.default_rng(2)
    x = np.round(np.concatenate([rng.normal(m, 0.6, (60, 4)) for m in (0, 2, 5)]), 1)
    labels = {"three": [i // 60 for i in range(180)], "alone": [0 if i else 1 for i in range(180)], "some": [None if i % 7 == 0 else i % 4 for i in range(180)]}
    rows = [(x[i].tolist(), *[labels[c][i] for c in labels]) for i in range(180)] + [(None, 0, 0, 0), ([1.0, None, 2.0, 3.0], 0, 0, 0), ([float("nan")] * 4, 0, 0, 0)]
    frame = spark.createDataFrame(rows, "v array<double>, three int, alone int, some int").repartition(3)
    subsets = {"all": [0, 1, 2, 3], "last": [3], "pair": [0, 2]}
    got = {(r.subset, r.labelling): r.silhouette for r in cluster.silhouette_widths(frame, "v", list(labels), subsets, block=40, part=70).collect()}
    assert got.keys() == {(s, c) for s in subsets for c in labels}
    for (s, c), value in got.items():
        assert math.isclose(value, direct_width(x[:, subsets[s]], labels[c]), abs_tol=1e-12), (s, c)


def test_silhouette_widths_of_long_vectors(spark):
    """Repeated points and points much nearer to each other than to the origin; rows of several parts meet again."""
    rng = np.random.default_rng(6)
    x = rng.normal(0, 1, (150, 20)) + 1e3
    x[40:80], x[100:110] = x[7], x[90] + 1e-7
    labels = {"two": [i % 2 for i in range(150)], "five": [i // 30 for i in range(150)]}
    frame = spark.createDataFrame([(x[i].tolist(), labels["two"][i], labels["five"][i]) for i in range(150)], "v array<double>, two int, five int").repartition(3)
    subsets = {"all": list(range(20)), "eight": list(range(3, 11)), "two": [4, 9]}
    found = cluster.silhouette_widths(frame, "v", list(labels), subsets, block=40, part=70)
    got = {(r.subset, r.labelling): r.silhouette for r in found.collect()}
    assert got.keys() == {(s, c) for s in subsets for c in labels}
    for (s, c), value in got.items():
        assert math.isclose(value, direct_width(x[:, subsets[s]], labels[c]), abs_tol=1e-9), (s, c)
    # Points' sums are added up and turned into widths as arrays: no row per point, subset and cluster is shuffled.
    assert "posexplode(sums" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_silhouette_of_one_cluster_and_of_no_points(spark):
    frame = spark.createDataFrame([([0.0, 1.0], 0), ([2.0, 1.0], 0), ([2.0, 1.0], 0)], "v array<double>, c int")
    assert [r.silhouette for r in cluster.silhouette_widths(frame, "v", ["c"], {"x": [0]}).collect()] == [None]
    assert cluster.silhouette_widths(frame.limit(0), "v", ["c"], {"x": [0]}).collect() == []


@pytest.mark.parametrize("subsets", [{"one": [1], "two": [0, 2], "all": [0, 1, 2]}, {"eight": list(range(8)), "all": list(range(12))}])
def test_silhouette_takes_each_distance_once(spark, monkeypatch, subsets):
    """A pair's distance counts for both of its points; it is not taken a second time for the other."""
    n, taken = 1500, [0]
    rng = np.random.default_rng(9)
    x, label = rng.normal(0, 1, (n, 12)), rng.integers(0, 3, n)
    x[::50] = x[7] + 1e-7 * (label[::50, None] == 0)

    class Counted:
        def __getattr__(self, name):
            return getattr(np, name)

        def sqrt(self, values, *args, **kwargs):
            taken[0] += values.size
            return np.sqrt(values, *args, **kwargs)

    def here(frame, function, schema):
        """What the tasks do, in this process."""
        return frame.sparkSession.createDataFrame(pa.Table.from_batches([*function(iter(frame.toArrow().to_batches()))]), schema)
    frame = spark.createDataFrame([(x[i].tolist(), int(label[i])) for i in range(n)], "v array<double>, c int").repartition(3)
    monkeypatch.setattr(cluster, "np", Counted())
    monkeypatch.setattr(type(frame), "mapInArrow", here)
    got = {r.subset: r.silhouette for r in cluster.silhouette_widths(frame, "v", ["c"], subsets).collect()}
    for s, places in subsets.items():
        assert math.isclose(got[s], direct_width(x[:, places], label.tolist()), abs_tol=1e-12), s
    # Within a strip of up to 512 points each is compared with each; of one dimension, a distance needs no root.
    assert taken[0] < len([s for s in subsets if s != "one"]) * n * n * 0.75


def test_points_of_a_cell_keep_their_sums_apart():
    """Sums of a cell's two groups, and of one with itself, with kinds that share a strip and with more kinds than columns."""
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (1300, 10))
    own = np.stack([rng.integers(0, 2, 1300), rng.integers(-1, 3, 1300)], axis=1).astype(np.int32)
    subsets = [[0, 1, 2], [2, 0, 1], [0, 1], list(range(10)), [3], [3]]

    def columns(c):
        return [at + k for at, k in zip((0, 2), c, strict=True) if k >= 0]

    def group(some):
        return cluster._Group(np.arange(1300)[some], x[some], own[some], len(subsets), columns, 5)

    def expected(some, others):
        member = np.array([[float(k in columns(c)) for k in range(5)] for c in own[others]])
        return np.array([np.sqrt(((x[some][:, None, dims] - x[others][None, :, dims]) ** 2).sum(axis=2)) @ member for dims in subsets])
    for some, others in ((slice(0, 700), slice(700, 1300)), (slice(0, 700), None)):
        left = group(some)
        right = group(others) if others else left
        cluster._compare(left, right, subsets)
        for g, mine, theirs in ((left, some, others or some), (right, others or some, some)):
            assert np.allclose(g.sums.transpose(1, 2, 0), expected(mine, theirs)[:, g.rows - mine.start], rtol=1e-12, atol=1e-9)


def constrained(x, y, j, value):
    """Maximal log-likelihood with coefficient ``j`` held at ``value``."""
    rest = [k for k in range(x.shape[1]) if k != j]
    offset, z, beta = x[:, j] * value, x[:, rest], np.zeros(len(rest))

    def height(b):
        return float((y * (offset + z @ b) - np.logaddexp(0, offset + z @ b)).sum())
    for _ in range(100):
        mu = np.exp(-np.logaddexp(0, -(offset + z @ beta)))
        step = np.linalg.lstsq(z.T @ (z * (mu * (1 - mu))[:, None]) + 1e-12 * np.eye(len(rest)), z.T @ (y - mu), rcond=None)[0]
        while height(beta + step) < height(beta) and np.abs(step).max() > 1e-14:
            step = step / 2
        beta = beta + step
    return height(beta)


@pytest.mark.parametrize("n", [60, 400])
def test_limits_lie_where_the_likelihood_has_fallen(spark, n):
    """At each limit twice the fall of the profile log-likelihood is the chi-square quantile."""
    rng = np.random.default_rng(n)
    x = np.column_stack([rng.normal(10, 3, n), rng.exponential(200, n), rng.integers(0, 2, n)])
    eta = -3 + 0.25 * x[:, 0] + 0.002 * x[:, 1] - 0.8 * x[:, 2]
    y = (rng.random(n) < 1 / (1 + np.exp(-eta))).astype(float)
    rows = materialise(spark.createDataFrame([(float(a), *map(float, b)) for a, b in zip(y, x, strict=True)], "y double, a double, b double, c double").repartition(3), "test-odds")
    got = {r["term"]: r for r in profile.profile_odds(rows, "y", ["a", "b", "c"])}
    whole = np.column_stack([np.ones(n), x])
    for j, name in enumerate("abc", 1):
        peak = constrained(whole, y, j, got[name]["log_odds"])
        for side in ("conf_low", "conf_high"):
            fall = 2 * (peak - constrained(whole, y, j, math.log(got[name][side])))
            assert abs(fall - 3.841458820694124) < 1e-6, (name, side, fall)
        assert got[name]["conf_low"] < got[name]["odds_ratio"] < got[name]["conf_high"]


def test_separated_classes_are_an_error(spark):
    rows = materialise(spark.range(40).select((F.col("id") >= 20).cast("double").alias("y"), F.col("id").cast("double").alias("a")), "test-odds")
    with pytest.raises(ValueError):
        profile.profile_odds(rows, "y", ["a"])
