"""The dense network against finite differences and whole-table sums; merged profiles against exact ones."""

import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import network as N
from tessera.operators import sketches as K
from tessera.session import scratch_path


def sample(n, seed=1):
    """Three classes that no straight line separates: rings around the origin."""
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 3, n)
    angle, radius = rng.uniform(0, 2 * np.pi, n), y + rng.uniform(0.2, 0.7, n)
    return np.column_stack([radius * np.cos(angle), radius * np.sin(angle)]), y


def test_gradient_equals_finite_differences():
    x, y = sample(40)
    layers = N.start_weights([2, 7, 5, 3], 4)
    layers = [(w, b + 0.05 * (k + 1)) for k, (w, b) in enumerate(layers)]
    flat, got = N._flat(layers), N.loss_and_gradient(x, y, layers)
    assert got[0] == 40
    for k in range(len(flat)):
        up, down = flat.copy(), flat.copy()
        up[k] += 1e-6
        down[k] -= 1e-6
        slope = (N.loss_and_gradient(x, y, N._shaped(up, layers))[1] - N.loss_and_gradient(x, y, N._shaped(down, layers))[1]) / 2e-6
        assert slope == pytest.approx(got[2 + k], abs=1e-4), k


def test_sums_over_partitions_equal_one_pass(spark):
    x, y = sample(101)
    layers = N.start_weights([2, 6, 3], 9)
    rows = spark.createDataFrame([(int(c), v.tolist()) for c, v in zip(y, x)], "class int, v array<double>")
    for parts in (1, 5, 120):
        assert np.allclose(N.batch_sums(rows.repartition(parts), layers), N.loss_and_gradient(x, y, layers), atol=1e-9)
    assert not N.batch_sums(rows.limit(0), layers).any()


def test_network_learns_rings_and_leaves_unusable_rows_out(spark):
    (x, y), (tx, ty) = sample(600), sample(300, 2)
    names = ["inner", "middle", "outer"]
    rows = [(i, names[c], v.tolist()) for i, (c, v) in enumerate(zip(y, x))]
    odd = [(900, None, [1.0, 1.0]), (901, "inner", None), (902, "inner", [1.0]), (903, "outer", [float("nan"), 1.0]), (904, "outer", [None, 1.0]),
           (905, "odd", [float("inf"), 0.0])]
    schema = "id int, label string, v array<double>"
    net = N.dense_network(spark.createDataFrame(rows + odd, schema), "label", "v", "id", hidden=(16, 8), epochs=25, batches=4, rate=0.03)
    assert net.classes == names and net.losses[-1] < net.losses[0] / 2
    test = spark.createDataFrame([(i, names[c], v.tolist()) for i, (c, v) in enumerate(zip(ty, tx))] + odd, schema)
    got = net.predict(test, "v").select("id", "label", "prediction").collect()
    assert len(got) == 306
    assert np.mean([r.label == r.prediction for r in got if r.id < 900]) > 0.9
    assert [r.prediction is None for r in got if r.id > 900] == [True] * 5
    p = test.where("id < 900").select(net.scores("v").alias("p")).select(F.aggregate("p", F.lit(0.0), lambda a, b: a + b).alias("s")).collect()
    assert all(abs(r.s - 1) < 1e-9 for r in p)
    assert net.predict(test.limit(0), "v").count() == 0


def test_network_needs_rows_and_classes(spark):
    empty = spark.createDataFrame([], "id int, label int, v array<double>")
    one = spark.createDataFrame([(1, 5, [1.0]), (2, 5, [2.0]), (3, None, [1.0])], empty.schema)
    for frame in (empty, one):
        with pytest.raises(ValueError):
            N.dense_network(frame, "label", "v", "id")


def test_loads_unite_without_reading_earlier_ones(spark):
    path = scratch_path(spark, f"profile-test-{uuid.uuid4().hex[:8]}")
    base = spark.range(60_000).select(F.when(F.col("id") % 10 != 0, (F.col("id") * 7919 % 20_011)).alias("n"), (F.col("id") % 7).cast("string").alias("s"),
                                      F.when(F.col("id") % 1000 == 1, float("nan")).otherwise(F.col("id").cast("double")).alias("x"),
                                      F.lit(None).cast("double").alias("none"), (F.col("id") % 3).alias("day"))
    cols = ["n", "s", "x", "none"]
    K.store_loads(K.sketch_loads(base.where("day < 2"), cols, F.col("day")), path)
    K.store_loads(K.sketch_loads(base.where("day = 2").limit(10), cols, F.col("day")), path)
    K.store_loads(K.sketch_loads(base.where("day = 2"), cols, F.col("day")), path)  # again, whole: replaces that load
    stored = spark.read.parquet(path)
    assert stored.count() == 12
    got = {r.column_name: r for r in K.united_profile(stored, {"q1": 0.25, "median": 0.5}).collect()}
    for c in cols:
        exact = base.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(c).isNull()).alias("nulls"), F.count_distinct(c).alias("d")).first()
        assert (got[c].rows, got[c].nulls) == (exact.rows, exact.nulls)
        assert abs(got[c].distinct_values - exact.d) <= K.DISTINCT_ERROR * exact.d
    good = sorted(r.n for r in base.where("n IS NOT NULL").select("n").collect())
    for name, q in (("q1", 0.25), ("median", 0.5)):
        rank = np.searchsorted(good, getattr(got["n"], name)) / len(good)
        assert abs(rank - q) <= K.RANK_ERROR
    assert (got["n"].low, got["n"].high, got["s"].first_text, got["s"].last_text) == (good[0], good[-1], "0", "6")
    assert got["x"].low == 0 and got["x"].high == 59_999
    assert got["none"].median is None and got["none"].low is None and got["s"].median is None
    assert K.united_profile(K.sketch_loads(base.limit(0), cols, F.col("day")), {"median": 0.5}).count() == 0
