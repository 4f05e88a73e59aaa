import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import four_russians as fr

SCHEMA = "vec_id long, label int, embedding array<float>, row long, anchor_id string, score string"


def brute(rows, low=80, high=100):
    """Rows of (id, label, vector); anchors are ids divisible by 10."""
    ok = [(i, c, v) for i, c, v in rows if i is not None and c is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    ok = [(i, c, [math.floor(256 * float(x)) for x in np.array(v, np.float32)]) for i, c, v in ok]
    out = []
    for a, label, v in ok:
        if a % 10:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(v, w)), i, c) for i, c, w in ok if i != a))
        for s, p, _ in [x for x in scored if x[2] == label][:5]:
            inside = [x for x in scored if x[2] != label and low * -s <= 100 * -x[0] <= high * -s][:5]
            out += [(a, p, k + 1, i, -s, -t) for k, (t, i, _) in enumerate(inside)]
    return sorted(out)


def mined(spark, rows, **options):
    frame = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in fr.mine(frame, F.col("vec_id") % 10 == 0, **options).collect())


@pytest.mark.parametrize("dims", [1, 8, 13])
def test_look_ups_equal_products(dims):
    rng = np.random.default_rng(dims)
    a, x = rng.integers(-70_000, 70_000, (9, dims)), rng.integers(-300, 300, (50, dims))
    x[0] = 0
    assert (fr.scores(fr.planes(x), fr.subset_sums(a)) == x @ a.T).all()
    assert fr.planes(x).shape == (50, 10, -(-dims // 8))
    low = fr.planes(np.array([[-1, 0]]))
    assert fr.scores(low, fr.subset_sums(np.array([[5, 7]]))).tolist() == [[-5]]


def test_matches_brute_force(spark, rng, monkeypatch):
    monkeypatch.setattr(fr, "ANCHORS", 4)
    monkeypatch.setattr(fr, "PART", 50)
    monkeypatch.setattr(fr, "STEP", 3)
    # Few values, so that scores tie; half of all rows in one label; repeated vectors.
    rows = [(i, int(rng.integers(0, 3)) if i % 2 else 0, np.round(rng.normal(0.1, 0.2, 10), 1).tolist()) for i in range(150)]
    rows += [(200 + i, i % 2, rows[20][2]) for i in range(12)]
    want = brute(rows)
    assert want and mined(spark, rows) == want
    assert mined(spark, rows, low_percent=95) == brute(rows, low=95)


def test_odd_rows(spark):
    v = [0.5, -0.25, 0.125]
    rows = [(0, 1, v), (1, 1, v), (2, 1, None), (3, None, v), (None, 1, v), (4, 2, [0.5, None, 0.0]), (5, 2, [float("nan"), 0.0, 0.0]),
            (6, 2, [float("inf"), 0.0, 0.0]), (7, 2, v), (8, 2, [0.5, -0.25]), (9, 2, v + [9.0] * 9), (10, 3, []), (20, 3, []), (11, 1, [])]
    assert mined(spark, rows) == brute(rows)
    # Equal rows are rows of their own.
    assert mined(spark, [(0, 1, v), (1, 1, v), (1, 1, v), (7, 2, v)]) == [(0, 1, 1, 7, 21504, 21504)] * 2
    assert mined(spark, []) == [] and mined(spark, [(1, 1, v), (2, 2, v)]) == [] and mined(spark, [(0, 1, v), (2, 2, v)]) == []


def test_huge_components(spark):
    """Scores beyond 64 bits are held at the highest long; they break nothing for other rows."""
    rows = [(0, 1, [1e30, 1.0]), (1, 1, [1e30, 1.0]), (2, 2, [1e30, 0.5]), (3, 2, [0.0, 2.0]), (10, 2, [0.0, 1.0]), (11, 2, [0.0, 2.0]), (12, 1, [0.0, 1.9])]
    got = mined(spark, rows)
    top = (1 << 63) - 1
    assert (0, 1, 1, 2, top, top) in got
    assert [r for r in got if r[0] == 10] == [r for r in brute(rows) if r[0] == 10]
