"""Data-quality rules, splits and SCD application."""

import datetime as dt
import math

from pyspark.sql import functions as F

from tessera.functions import (blank_to_null, change_hash, clean_text, decode_flag, display_name,
                               round_to, safe_cast)
from tessera.operators import quality as Q
from tessera.operators import scd


def _rules():
    c = F.col
    return [Q.Rule("DQ001", "a_not_null", c("a").isNotNull(), "completeness"),
            Q.Rule("DQ002", "a_non_negative", c("a") >= 0, "reasonability"),
            Q.Rule("DQ003", "code_known", c("code").isin("x", "y"), "validity")]


def test_flags_never_null_and_split_is_partition(spark):
    df = spark.createDataFrame(
        [(1.0, "x"), (None, "x"), (-1.0, "z"), (float("nan"), "y"), (0.0, None)], "a double, code string")
    f = Q.dq_flags(df, _rules())
    rows = f.collect()
    for r in rows:
        for rule in _rules():
            assert r[rule.flag] is not None
    by_a = {(None if r.a is None else ("nan" if math.isnan(r.a) else r.a)): r for r in rows}
    assert by_a[None].dq_failed_rules == ["DQ001", "DQ002"]
    assert by_a[-1.0].dq_failed_rules == ["DQ002", "DQ003"] and by_a[-1.0].dq_failed_rule_count == 2
    assert by_a["nan"].dq_status == "PASS"  # NaN >= 0 holds in Spark
    assert by_a[0.0].dq_failed_rules == ["DQ003"]
    valid = Q.split_valid(f, _rules())
    quarantine = Q.split_quarantine(f)
    assert valid.count() + quarantine.count() == df.count()
    assert set(valid.columns) == set(df.columns)
    card = {r.rule_id: r.failed for r in Q.scorecard(f, _rules()).collect()}
    assert card == {"DQ001": 1, "DQ002": 2, "DQ003": 2}


def test_broken_rules_null_is_no_match(spark):
    df = spark.createDataFrame([(None,), (-2.0,)], "v double")
    rules = [Q.Rule("NEG", "v", F.col("v") >= 0), Q.Rule("MISSING", "v", F.col("v").isNotNull()),
             Q.Rule("SMALL", "v", F.col("v") > 10, severity="warning")]
    out = df.select(Q.broken_rules(rules, "error").alias("e"), Q.broken_rules(rules, "warning").alias("w")).collect()
    assert [(r.e, r.w) for r in out] == [(["MISSING"], []), (["NEG"], ["SMALL"])]


def test_numeric_rules_nonfinite(spark):
    df = spark.createDataFrame([(float("inf"),), (-1.0,), (1.0,)], "x double")
    q = Q.quality_arrays(df, Q.numeric_rules(["x"])).orderBy("x").collect()
    assert [list(r.quality_errors) for r in q] == [[], [], ["NONFINITE_X"]]
    assert [list(r.quality_warnings) for r in q] == [["NEGATIVE_X"], [], []]
    assert [r.is_valid for r in q] == [True, True, False]


def test_cleaning_helpers(spark):
    df = spark.createDataFrame([("  a \t b\n c ", " ", "TRUE", "12x", "N/A")],
                               "t string, b string, f string, n string, keep string")
    assert df.select(clean_text("b")).first()[0] is None
    r = df.select(clean_text("t").alias("t"), blank_to_null("b").alias("b"), decode_flag("f").alias("f"),
                  safe_cast("n", "int").alias("n"), blank_to_null("keep").alias("keep"),
                  display_name(F.lit("Ann"), F.lit(" "), F.lit("Lee")).alias("name")).first()
    assert (r.t, r.b, r.f, r.n, r.keep, r.name) == ("a b c", None, True, None, "N/A", "Ann Lee")


def test_round_to_half_cases(spark):
    r = spark.createDataFrame([(12005.59875,), (2.5,), (-2.5,)], "x double").select(
        round_to("x", 4).alias("a"), round_to("x", 0).alias("b")).collect()
    assert r[1].b == 3.0 and r[2].b == -3.0
    assert abs(r[0].a - 12005.5987) < 1e-9  # binary value lies just below the tie


def test_change_hash_includes_nulls(spark):
    df = spark.createDataFrame([("a", None), ("a", "")], "x string, y string")
    h = [r[0] for r in df.select(change_hash({"x": F.col("x"), "y": F.col("y")})).collect()]
    assert h[0] != h[1]


def _snap(spark, rows):
    return spark.createDataFrame(rows, "k int, a string")


def test_scd2_apply_changes_and_idempotence(spark):
    h0 = scd.scd2_init(_snap(spark, [(1, "x"), (2, "y"), (3, "z")]), "k", ["a"], "2020-01-01")
    snap = _snap(spark, [(1, "x"), (2, "Y"), (4, "n")])  # unchanged, changed, vanished, new
    h1 = scd.scd2_apply(h0, snap, "k", ["a"], "2020-06-01")
    rows = sorted((r.k, r.a, str(r.valid_from), str(r.valid_to), r.is_current) for r in h1.collect())
    assert rows == [(1, "x", "2020-01-01", "9999-12-31", True),
                    (2, "Y", "2020-06-01", "9999-12-31", True),
                    (2, "y", "2020-01-01", "2020-06-01", False),
                    (3, "z", "2020-01-01", "2020-06-01", False),
                    (4, "n", "2020-06-01", "9999-12-31", True)]
    h2 = scd.scd2_apply(h1, snap, "k", ["a"], "2020-06-01")
    assert sorted(map(tuple, h2.drop("version_key").collect())) == sorted(map(tuple, h1.drop("version_key").collect()))
    assert scd.current_row_violations(h2.where("k <> 3"), "k").count() == 0
    assert scd.overlap_violations(h2, "k").count() == 0


def test_scd1_apply(spark):
    d = _snap(spark, [(1, "x"), (2, "y")])
    out = scd.scd1_apply(d, _snap(spark, [(2, "Y"), (3, "z")]), "k", ["a"])
    assert sorted(map(tuple, out.collect())) == [(1, "x"), (2, "Y"), (3, "z")]


def test_duplicate_keys_and_one_hot(spark):
    df = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 1, 1)], "k int, a int, b int")
    assert [r.k for r in Q.duplicate_keys(df, ["k"]).collect()] == [1]
    assert sorted(r.k for r in Q.one_hot_violations(df, ["a", "b"]).collect()) == [1, 2]


def test_date_dimension_weekday(spark):
    from tessera.operators.dims import calendar, date_dimension, fiscal_calendar
    d = date_dimension(calendar(spark, "2024-01-06", "2024-01-08")).orderBy("full_date").collect()
    assert [(r.day_name, r.day_of_week, r.is_weekend) for r in d] == [
        ("Saturday", 6, True), ("Sunday", 0, True), ("Monday", 1, False)]
    f = fiscal_calendar(calendar(spark, "2023-10-31", "2023-11-01")).orderBy("full_date").collect()
    assert [(r.fiscal_year, r.fiscal_month) for r in f] == [(2023, 12), (2024, 1)]
    assert d[0].full_date == dt.date(2024, 1, 6)


def test_minutes_ignore_session_time_zone(spark):
    from tessera.functions.dates import minutes_between, whole_minutes
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.sql("select timestamp_ntz'2024-03-09 12:00:00' a, timestamp_ntz'2024-03-10 12:00:30' b")
        r = df.select(whole_minutes("a", "b").alias("m"), minutes_between("a", "b").alias("f")).first()
        assert (r.m, r.f) == (1440, 1440.5)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
