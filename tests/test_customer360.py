"""The wide customer row: its width, customers without any order or event, and the change hash."""

import datetime as dt
from types import SimpleNamespace

import pytest

from tessera.operators.stats import linear_model
from tessera.plans import customer360 as C


@pytest.fixture
def tables(spark):
    day = dt.datetime(2020, 1, 2)
    return SimpleNamespace(
        nation=spark.createDataFrame([(1, "FRANCE", 3)], "n_nationkey long, n_name string, n_regionkey long"),
        region=spark.createDataFrame([(3, "EUROPE")], "r_regionkey long, r_name string"),
        supplier=spark.createDataFrame([(7, 1, 5.0)], "s_suppkey long, s_nationkey long, s_acctbal double"),
        customer=spark.createDataFrame([(0, " House ", 1, 1.0, "A&B"), (1, "Ann", 1, -2.0, "AUTO"), (2, "Bob", None, 3.0, "AUTO")],
                                       "c_custkey long, c_name string, c_nationkey long, c_acctbal double, c_mktsegment string"),
        orders=spark.createDataFrame([(10, 1, "O", 100.0, day, "2-HIGH"), (11, 1, "F", 51.0, dt.datetime(2021, 3, 4), "5-LOW")],
                                     "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
        lineitem=spark.createDataFrame([(10, 1, 5, 7, 2.0, "A", dt.datetime(2022, 1, 1)), (10, 2, 6, 7, 3.0, "R", day), (11, 1, 8, 7, 4.0, "R", day),
                                        (11, 2, 9, 7, 4.0, "R", None)],
                                       "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_returnflag string, l_shipdate timestamp_ntz"),
        events=spark.createDataFrame([(1, dt.datetime(2023, 5, 6, 7), 2, "click", 1.5)],
                                     "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"))


def test_wide_row(tables):
    rows = {r.c_custkey: r for r in C.customer_360(tables).collect()}
    assert len(rows[0]) == 1 + 45 + 2
    ann, bob, house = rows[1], rows[2], rows[0]
    # The best line: returned ones first, then the latest shipment (unknown ones last), then the smallest keys.
    assert (ann.preferred_line_order, ann.preferred_part, ann.preferred_ship) == ("10", "6", "2020-01-02")
    assert (ann.annual_sales, ann.year_opened, ann.specialty, ann.internet, ann.lines_per_order) == ("75", "2020", "HIGH", None, "2")
    assert ann.modified_at == "2022-01-01" and bob.modified_at == "2023-05-06" and house.modified_at is None
    assert bob.internet == "web" and bob.annual_sales is None and bob.nation is None and bob.account_holder == "House"
    assert house.business_type == "A&" and house.preferred_part is None


def test_hash_follows_every_attribute(spark, tables):
    before = {r.c_custkey: r.row_hash for r in C.customer_360(tables).collect()}
    tables.lineitem = tables.lineitem.replace(6, 66, ["l_partkey"])
    after = {r.c_custkey: r.row_hash for r in C.customer_360(tables).collect()}
    assert [k for k in before if before[k] != after[k]] == [1]


def test_a_key_as_category_is_refused(spark):
    df = spark.range(50).selectExpr("cast(id as double) y", "cast(id as string) k", "cast(id % 3 as string) c")
    assert len(linear_model(df, "y", [], ["c"])["coefficients"]) == 3
    with pytest.raises(ValueError, match="more than 20 levels"):
        linear_model(df, "y", [], ["k"], max_levels=20)
