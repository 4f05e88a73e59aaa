import numpy as np

from tessera.llm import pivot_search

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every, k=10):
    usable = []
    for i, v in rows:
        if i is not None and v is not None and not any(x is None or not np.isfinite(x) for x in v):
            usable.append((i, tuple(int(np.floor(1024 * float(np.float32(x)))) for x in v)))
    usable = sorted(set(usable))
    out = []
    for i, q in {u for u in usable if u[0] % every == 0}:
        found = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), j) for j, v in usable if j != i)[:k]
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(found)]
    return sorted(out)


def check(spark, rows, every, cell):
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).withColumnRenamed("label", "score")
    got = sorted(tuple(r) for r in pivot_search.top_k(frame, every=every, cell=cell).collect())
    assert got == brute(rows, every)


def test_matches_brute_force(spark, rng):
    centres = rng.normal(0, 1, (6, 12))
    rows = [(i, (centres[i % 6] + rng.normal(0, 0.2, 12)).astype(np.float32).tolist()) for i in range(600)]
    same = rows[7][1]
    rows += [(1_000 + i, same) for i in range(200)] + [(7, same), (7, same)]
    rows += [(2_000, None), (2_010, [1.0, None]), (2_020, [float("nan")] * 12), (2_030, [float("inf")] * 12), (None, same), (2_040, []),
             (2_050, [0.5]), (2_060, [0.0] * 12)]
    for cell in (4096, 60):
        check(spark, rows, 10, cell)


def test_fewer_candidates_than_k(spark):
    check(spark, [(0, [1.0]), (1, [2.0]), (10, [3.0])], 10, 4096)
    check(spark, [(0, [1.0])], 10, 4096)


def test_large_components_are_exact(spark):
    check(spark, [(i, [float(2 ** 20 + i), -float(i)]) for i in range(0, 30, 3)], 10, 4)


def test_empty_table(spark):
    assert pivot_search.top_k(spark.createDataFrame([], SCHEMA)).count() == 0
