"""Running totals, ranks, preferred records, interval merges and as-of lookups."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.operators import aggregates as A
from tessera.operators import evaluate as E
from tessera.operators import scd
from tessera.operators.joins import as_of_lookup, interval_join, orphans, point_in_time_join, top1_lateral
from tessera.operators.windows import (exact_quantiles, global_row_number, group_size, latest_per_key,
                                       ntile_from_rank, running_total, running_totals, share_of_group)


def test_running_total_matches_pandas_with_hot_key(spark):
    rng = random.Random(7)
    # one key holds far more than a third of the rows
    rows = [("hot" if rng.random() < 0.6 else f"k{rng.randint(0, 20)}", i, rng.randint(-5, 9))
            for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, i long, v long")
    got = running_total(df, [F.col("i")], "v", "cum", num_ranges=7, total_name="tot", keys=["k"]).toPandas()
    pdf = pd.DataFrame(rows, columns=["k", "i", "v"]).sort_values(["k", "i"])
    pdf["cum"] = pdf.groupby("k")["v"].cumsum()
    pdf["tot"] = pdf.groupby("k")["v"].transform("sum")
    m = got.merge(pdf, on=["k", "i"], suffixes=("", "_exp"))
    assert len(m) == len(rows)
    assert (m["cum"] == m["cum_exp"]).all()
    assert (m["tot"] == m["tot_exp"]).all()


def test_global_row_number_is_dense_and_ordered(spark):
    df = spark.createDataFrame([(i % 17, i) for i in range(500)], "g int, i int")
    r = global_row_number(df, [F.col("g").desc(), F.col("i")], "rn", num_ranges=5).toPandas()
    r = r.sort_values("rn")
    assert list(r["rn"]) == list(range(1, 501))
    exp = sorted(((-g, i) for g, i in zip(r["g"], r["i"])))
    assert [(-g, i) for g, i in zip(r["g"], r["i"])] == exp


def test_ntile_matches_sql(spark):
    for n in (1, 5, 7, 12):
        df = spark.range(n).withColumn("rank", F.col("id") + 1).withColumn("n", F.lit(n))
        mine = [r[0] for r in df.select(ntile_from_rank(F.col("rank"), F.col("n"), 4)).orderBy("rank").collect()]
        sql = [r[0] for r in spark.sql(f"select ntile(4) over (order by id) from range({n})").collect()]
        assert sorted(mine) == sorted(sql)


def test_latest_per_key_ties_and_nulls(spark):
    df = spark.createDataFrame(
        [(1, None, 1), (1, dt.date(2020, 1, 1), 2), (1, dt.date(2020, 1, 1), 3), (2, None, 4)],
        "k int, d date, id int")
    got = latest_per_key(df, ["k"], [F.col("d").desc_nulls_last(), F.col("id").desc()])
    assert sorted((r.k, r.id) for r in got.collect()) == [(1, 3), (2, 4)]


def test_top1_lateral_keeps_outer_rows(spark):
    outer = spark.createDataFrame([(1,), (2,), (3,)], "c int")
    inner = spark.createDataFrame([(1, 5.0, 10), (1, 7.0, 11), (2, 1.0, 12)], "c int, v double, k int")
    got = top1_lateral(outer, inner, "c", "c", [F.col("v").desc()], [F.col("k").alias("best")])
    assert sorted((r.c, r.best) for r in got.collect()) == [(1, 11), (2, 12), (3, None)]


def _d(s):
    return dt.date.fromisoformat(s)


def _hist(spark, rows, name):
    return spark.createDataFrame([(k, _d(a), _d(b), v) for k, a, b, v in rows],
                                 f"k int, {name}_from date, {name}_to date, {name} string")


def test_timeline_merge_equals_overlap_join(spark):
    a = _hist(spark, [
        (1, "2020-01-01", "2020-03-01", "a1"), (1, "2020-03-01", "9999-12-31", "a2"),  # touching
        (2, "2020-01-01", "2020-02-01", "a3"), (2, "2020-02-02", "2020-05-01", "a4"),  # one-day gap
        (3, "2020-01-01", "9999-12-31", "a5"),                                          # open
        (4, "2020-01-01", "2020-02-01", "a6"),                                          # no b history
    ], "a")
    b = _hist(spark, [
        (1, "2020-02-01", "2020-02-15", "b1"), (1, "2020-02-15", "9999-12-31", "b2"),
        (2, "2020-01-15", "2020-04-01", "b3"),                                          # nested/overlap
        (3, "2020-01-01", "9999-12-31", "b4"),                                          # identical
        (5, "2020-01-01", "2020-02-01", "b5"),
    ], "b")
    cols = ["k", "a", "b", "valid_from", "valid_to", "is_current"]
    sweep = scd.timeline_merge(a, b, "k", "a_from", "a_to", "b_from", "b_to", ["a"], ["b"])
    s = sorted(tuple(r) for r in sweep.select(*cols).collect())
    pairs = [(x, y, max(x.a_from, y.b_from), min(x.a_to, y.b_to)) for x in a.collect() for y in b.collect() if x.k == y.k]
    assert s == sorted((x.k, x.a, y.b, lo, hi, hi == _d("9999-12-31")) for x, y, lo, hi in pairs if lo < hi)
    assert len(s) == 6


def _spans(rng, n, hot, length):
    """Rows (key, from, to, value) with a share of ``hot`` in key 0, overlapping each other."""
    rows = []
    for i in range(n):
        k = 0 if rng.random() < hot else int(rng.integers(1, 6))
        start = int(rng.integers(0, 300))
        rows.append((k, start, start + int(rng.integers(0, length)), f"v{i}"))
    return rows


@pytest.mark.parametrize("cell, length", [(7, 20), (50, 400), (10_000, 20)])
def test_interval_join_equals_range_join(spark, cell, length):
    """Histories that overlap themselves; most rows in one key, which is cut into cells and ranges; open ends; odd rows."""
    rng = np.random.default_rng(cell)
    a, b = _spans(rng, 300, 0.8, length), _spans(rng, 200, 0.8, length)
    a += [(0, 5, 10 ** 6, "open"), (0, 5, 10 ** 6, "open"), (1, 9, 9, "empty"), (1, 9, 3, "back"), (None, 1, 5, "x"), (1, None, 5, "y"), (2, 4, None, "z")]
    b += [(0, 0, 10 ** 6, "open"), (0, 10 ** 6, 10 ** 7, "touches"), (7, 1, 2, "alone"), (None, 1, 5, "x")]
    random.Random(1).shuffle(a)
    fa = spark.createDataFrame(a, "k int, a_from int, a_to int, a string").repartition(3)
    fb = spark.createDataFrame(b, "k int, b_from int, b_to int, b string")
    got = interval_join(fa, fb, "k", "a_from", "a_to", "b_from", "b_to", cell=cell, num_ranges=6)
    want = [(*x, *y[1:], max(x[1], y[1]), min(x[2], y[2])) for x in a for y in b
            if None not in x[:3] + y[:3] and x[0] == y[0] and x[1] < x[2] and y[1] < y[2] and x[1] < y[2] and y[1] < x[2]]
    assert got.columns == ["k", "a_from", "a_to", "a", "b_from", "b_to", "b", "overlap_from", "overlap_to"]
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 500
    none = interval_join(fa.limit(0), fb, "k", "a_from", "a_to", "b_from", "b_to")
    assert none.count() == 0


def test_timeline_of_a_hot_key_is_cut_over_ranges(spark):
    """One key with nearly all versions, swept in six ranges; gaps, touching versions and a key without partner."""
    rng = np.random.default_rng(3)

    def history(n, name):
        rows, t = [], 0
        for i in range(n):
            t += int(rng.integers(0, 3))
            end = t + int(rng.integers(1, 6))
            rows.append((1, t, end, f"{name}{i}"))
            t = end
        return [*rows, (2, 0, 10, f"{name}x"), (None, 0, 10, f"{name}n"), (3 if name == "a" else 4, 0, 10, f"{name}y")]
    a, b = history(200, "a"), history(150, "b")
    fa = spark.createDataFrame(a, "k int, a_from int, a_to int, a string").repartition(3)
    fb = spark.createDataFrame(b, "k int, b_from int, b_to int, b string")
    merged = scd.timeline_merge(fa.withColumns({c: F.date_add(F.lit("2020-01-01").cast("date"), F.col(c)) for c in ("a_from", "a_to")}),
                                fb.withColumns({c: F.date_add(F.lit("2020-01-01").cast("date"), F.col(c)) for c in ("b_from", "b_to")}),
                                "k", "a_from", "a_to", "b_from", "b_to", ["a"], ["b"], num_ranges=6)
    day = dt.date(2020, 1, 1)
    got = sorted((r.k, r.a, r.b, (r.valid_from - day).days, (r.valid_to - day).days) for r in merged.collect())
    want = sorted((x[0], x[3], y[3], max(x[1], y[1]), min(x[2], y[2])) for x in a for y in b
                  if x[0] is not None and x[0] == y[0] and x[1] < y[2] and y[1] < x[2])
    assert got == want and len(want) > 150
    assert scd.self_overlaps(fa, "k", "a_from", "a_to", num_ranges=6).count() == 0
    late = fa.unionByName(spark.createDataFrame([(1, 100, 200, "over")], fa.schema))
    found = scd.self_overlaps(late, "k", "a_from", "a_to", num_ranges=6).collect()
    order = sorted([x for x in a if x[0] == 1] + [(1, 100, 200, "over")], key=lambda x: x[1:])
    assert sorted(r.a for r in found) == sorted(x[3] for x, y in zip(order, order[1:]) if y[1] < x[2]) and found


def test_as_of_lookup_equals_range_join(spark):
    hist = spark.createDataFrame(
        [(1, _d("2020-01-01"), _d("2020-02-01"), "x"), (1, _d("2020-02-05"), _d("9999-12-31"), "y"),
         (2, _d("2020-03-01"), _d("9999-12-31"), "z")],
        "k int, valid_from date, valid_to date, v string")
    facts = spark.createDataFrame(
        [(1, _d(s)) for s in ["2019-12-31", "2020-01-01", "2020-01-31", "2020-02-01", "2020-02-04",
                               "2020-02-05", "2021-01-01"]] + [(2, _d("2020-03-01")), (3, _d("2020-03-01"))],
        "k int, t date")
    a = as_of_lookup(facts, hist, "k", "t", "valid_from", "valid_to", ["v"]).select("k", "t", "v")
    b = point_in_time_join(facts, hist, "k", "t").select("k", "t", "v")
    assert sorted(a.collect()) == sorted(b.collect())
    assert a.where(F.col("v").isNull()).count() == 4


def test_orphans(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "p int")
    parent = spark.createDataFrame([(1,)], "id int")
    assert sorted(r.p for r in orphans(child, parent, "p", "id").collect() if r.p) == [2]


def _many_rows(spark, n=300_000):
    # A hot key with a third of the rows, NULL keys, a wide column that plans may prune.
    i = F.col("id")
    return (spark.range(0, n, 1, 12)
            .select(i, F.when(i % 3 == 0, F.lit("hot")).when(i % 50 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), i % 7)).alias("k"),
                    F.pmod(F.xxhash64(i), F.lit(1000)).alias("v"), F.repeat(F.lit("x"), 40).alias("wide")))


def test_global_row_number_is_exact_and_repeatable(spark):
    df = _many_rows(spark)
    for _ in range(2):
        r = global_row_number(df, [F.col("v"), F.col("id")], "n", num_ranges=9, total_name="t")
        got = r.agg(F.count_distinct("n"), F.min("n"), F.max("n"), F.max("t"), F.count("wide")).first()
        assert tuple(got) == (300_000, 1, 300_000, 300_000, 300_000)


def test_keyed_running_totals_match_pandas(spark):
    df = _many_rows(spark)
    got = running_totals(df, [F.col("v"), F.col("id")], {"cum": "v", "pos": F.lit(1).cast("long")}, num_ranges=7,
                         totals={"cum": "all"}, keys=["k"]).drop("wide").toPandas().sort_values("id")
    want = df.drop("wide").toPandas().sort_values(["v", "id"])
    g = want.groupby("k", dropna=False, sort=False)
    want = want.assign(cum=g["v"].cumsum(), pos=g.cumcount() + 1, all=g["v"].transform("sum")).sort_values("id")
    for c in ("v", "cum", "pos", "all"):
        assert (got[c].to_numpy() == want[c].to_numpy()).all(), c


def test_null_groups_are_kept(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 2.0), (None, 6.0)], "g string, v double")
    assert sorted(r.n for r in group_size(df, ["g"], "n").collect()) == [2, 2, 2, 2]
    assert sorted(r.s for r in share_of_group(df, ["g"], "v", "s").collect()) == [0.25, 0.25, 0.75, 0.75]
    assert A.proportions(df.withColumn("c", F.lit("x")), "g", "c").count() == 2
    assert {r.g: r.median for r in A.boxplot_stats(df, "g", "v").collect()} == {"a": 2.0, None: 4.0}
    assert {r.g: r.median for r in A.group_summary(df, ["g"], "v").collect()} == {"a": 2.0, None: 4.0}
    cells = {(r.g, r.v): r.n for r in A.contingency(df, "g", "v").collect()}
    assert len(cells) == 8 and cells[(None, 2.0)] == 1 and cells[("a", 2.0)] == 0
    split = E.stratified_split(df.withColumn("id", F.col("v").cast("int")), "g", "id", 0.5)
    assert split.count() == 4 and split.where("split = 'train'").count() == 2


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_exact_quantiles_match_numpy(spark, monkeypatch, limit):
    """Totals of the counts by a window, and over ranges."""
    monkeypatch.setattr("tessera.operators.windows._WINDOW_ROWS", limit)
    rows = [(int(x), float(x % 17)) for x in range(1000)]
    df = spark.createDataFrame([(i % 3, v) for i, v in rows] + [(5, None), (None, 4.0)], "g int, v double")
    got = {r.g: (r.a, r.b) for r in exact_quantiles(df, "v", {"a": 0.25, "b": 0.9}, ["g"], num_ranges=5).collect()}
    for g in range(3):
        v = [x for i, x in rows if i % 3 == g]
        assert got[g] == pytest.approx((np.quantile(v, 0.25), np.quantile(v, 0.9)))
    assert got[None] == (4.0, 4.0) and got[5] == (None, None)
