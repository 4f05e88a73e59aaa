"""Business questions on the star schema (G16) and further cuts that the briefs ask for.

Money is summed as decimals on both sides, so sums do not depend on their order.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions import geo
from tessera.functions.cleaning import round_to
from tessera.functions.dates import fiscal_parts
from tessera.functions.geo import EARTH_KM
from tessera.operators import sketches as K
from tessera.operators import text as X
from tessera.operators.aggregates import table_profile
from tessera.operators.quality import Rule
from tessera.operators.windows import exact_quantiles, global_row_number, ntile_from_rank
from tessera.plans.registry import register
from tessera.session import scratch_path
from tessera.tables import Tables

_NET_SQL = "(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))))"
#: Fixed value: share of the retail price that a unit costs (the tables hold no purchase cost).
COST_SHARE = "0.6"
_PROFIT_SQL = f"({_NET_SQL} - CAST(l_quantity AS DECIMAL(18,2)) * CAST(p_retailprice AS DECIMAL(18,2)) * CAST({COST_SHARE} AS DECIMAL(2,1)))"


def _net() -> Column:
    return F.col("l_extendedprice").cast("decimal(18,2)") * (1 - F.col("l_discount").cast("decimal(4,2)"))


def _profit() -> Column:
    cost = F.col("l_quantity").cast("decimal(18,2)") * F.col("p_retailprice").cast("decimal(18,2)") * F.lit(COST_SHARE).cast("decimal(2,1)")
    return _net() - cost


def sales_lines(t: Tables) -> DataFrame:
    """Line grain with order, customer, place and part attributes."""
    nation = F.broadcast(t.nation.select("n_nationkey", "n_name", "n_regionkey"))  # 25 rows
    region = F.broadcast(t.region.select("r_regionkey", "r_name"))                 # 5 rows
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_linestatus", "l_shipdate")
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority")
    c = t.customer.select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    p = t.part.select("p_partkey", "p_type", "p_retailprice")
    return (li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey"))
            .join(p, F.col("l_partkey") == F.col("p_partkey"))
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey")))


_LINES_SQL = """FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN part ON l_partkey = p_partkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
_MEASURES_SQL = f"""CAST(SUM({_NET_SQL}) AS DOUBLE) AS sales, SUM(l_quantity) AS quantity, CAST(SUM({_PROFIT_SQL}) AS DOUBLE) AS profit"""


def _measures() -> list[Column]:
    return [F.sum(_net()).cast("double").alias("sales"), F.sum("l_quantity").alias("quantity"), F.sum(_profit()).cast("double").alias("profit")]


@register("sales_by_month", "G16 A26", f"""
SELECT CAST(year(o_orderdate + INTERVAL 2 MONTH) AS INTEGER) AS fiscal_year, strftime(o_orderdate, '%Y-%m') AS month, {_MEASURES_SQL}
{_LINES_SQL} GROUP BY 1, 2""")
def q_sales_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sales_lines(Tables(spark, sf_dir))
    return s.groupBy(fiscal_parts("o_orderdate")["fiscal_year"].alias("fiscal_year"),
                     F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(*_measures())


@register("sales_by_category", "G16", f"""
SELECT p_type, {_MEASURES_SQL}, CAST(rank() OVER (ORDER BY SUM({_NET_SQL}) DESC) AS INTEGER) AS sales_rank {_LINES_SQL} GROUP BY p_type""")
def q_sales_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = sales_lines(Tables(spark, sf_dir)).groupBy("p_type").agg(*_measures(), F.sum(_net()).alias("_net"))
    # One row per category.
    return g.withColumn("sales_rank", F.rank().over(Window.orderBy(F.col("_net").desc())).cast("int")).drop("_net")


@register("revenue_by_segment", "G16", f"""
WITH g AS (SELECT c_mktsegment, COUNT(DISTINCT c_custkey) AS customers, SUM({_NET_SQL}) AS net {_LINES_SQL} GROUP BY 1)
SELECT c_mktsegment, customers, CAST(net AS DOUBLE) AS sales, ROUND(CAST(net AS DOUBLE) / CAST(SUM(net) OVER () AS DOUBLE), 6) AS share FROM g""")
def q_revenue_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Customers are counted in two steps, so no task holds a set of all of them.
    per = sales_lines(Tables(spark, sf_dir)).groupBy("c_mktsegment", "c_custkey").agg(F.sum(_net()).alias("net"))
    g = per.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("customers"), F.sum("net").alias("net"))
    total = F.sum("net").over(Window.partitionBy()).cast("double")  # five segments
    return g.select("c_mktsegment", "customers", F.col("net").cast("double").alias("sales"),
                    round_to(F.col("net").cast("double") / total, 6).alias("share"))


@register("sales_by_place", "G16", f"""
SELECT r_name, n_name, {_MEASURES_SQL} {_LINES_SQL} GROUP BY ROLLUP (r_name, n_name)""")
def q_sales_by_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region, nation and the totals of each level."""
    return sales_lines(Tables(spark, sf_dir)).rollup("r_name", "n_name").agg(*_measures())


@register("sales_by_priority", "G16", f"""
WITH o AS (SELECT o_orderkey, o_orderpriority, SUM({_NET_SQL}) AS net {_LINES_SQL} GROUP BY 1, 2)
SELECT o_orderpriority, COUNT(*) AS orders, CAST(MAX(net) AS DOUBLE) AS largest, CAST(SUM(net) AS DOUBLE) AS sales FROM o GROUP BY 1""")
def q_sales_by_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Value of orders by the desk that handles them (order priority)."""
    o = sales_lines(Tables(spark, sf_dir)).groupBy("o_orderkey", "o_orderpriority").agg(F.sum(_net()).alias("net"))
    return o.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("orders"), F.max("net").cast("double").alias("largest"),
                                            F.sum("net").cast("double").alias("sales"))


@register("backorders", "G16", f"""
SELECT o_orderstatus, COUNT(DISTINCT o_orderkey) AS orders, CAST(SUM({_NET_SQL}) AS DOUBLE) AS open_value {_LINES_SQL}
WHERE l_linestatus = 'O' GROUP BY 1""")
def q_backorders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with open lines and what these are worth."""
    s = sales_lines(Tables(spark, sf_dir)).where(F.col("l_linestatus") == "O")
    per = s.groupBy("o_orderstatus", "o_orderkey").agg(F.sum(_net()).alias("net"))
    return per.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"), F.sum("net").cast("double").alias("open_value"))


@register("attribute_changes", "G16 D10", """
WITH o AS (SELECT o_custkey, o_orderstatus, lag(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS before FROM orders)
SELECT before, o_orderstatus AS after, COUNT(*) AS changes FROM o WHERE before IS NOT NULL AND before <> o_orderstatus GROUP BY 1, 2""")
def q_attribute_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How a tracked attribute (status of the latest order) moved over time."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    o = Tables(spark, sf_dir).orders.withColumn("before", F.lag("o_orderstatus").over(w))
    return (o.where(F.col("before") != F.col("o_orderstatus"))
            .groupBy("before", F.col("o_orderstatus").alias("after")).agg(F.count(F.lit(1)).alias("changes")))


# ------------------------------------------------------------ G01 G02 G08 G14

@register("seasonality", "G01", """
WITH m AS (SELECT year(o_orderdate) AS y, CAST(month(o_orderdate) AS INTEGER) AS month, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS revenue, COUNT(*) AS orders
           FROM orders GROUP BY 1, 2)
SELECT month, COUNT(*) AS years, CAST(SUM(orders) AS BIGINT) AS orders,
       ROUND(CAST(SUM(revenue) AS DOUBLE) / COUNT(*) / (SELECT CAST(SUM(revenue) AS DOUBLE) / COUNT(*) FROM m), 6) AS seasonal_index
FROM m GROUP BY month""")
def q_seasonality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean revenue of a calendar month against the mean of all months."""
    o = Tables(spark, sf_dir).orders
    m = o.groupBy(F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("month")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("revenue"), F.count(F.lit(1)).alias("orders"))
    mean = m.select(F.sum("revenue").cast("double") / F.count(F.lit(1))).scalar()
    return m.groupBy("month").agg(F.count(F.lit(1)).alias("years"), F.sum("orders").alias("orders"),
                                  (F.sum("revenue").cast("double") / F.count(F.lit(1))).alias("_m")).select(
        "month", "years", "orders", round_to(F.col("_m") / mean, 6).alias("seasonal_index"))


@register("zscore_outliers", "G02", """
WITH s AS (SELECT o_orderpriority, AVG(o_totalprice) AS mean, stddev_samp(o_totalprice) AS sd FROM orders GROUP BY 1)
SELECT o_orderkey, o_orderpriority, ROUND((o_totalprice - mean) / sd, 4) AS z FROM orders JOIN s USING (o_orderpriority)
WHERE abs(ROUND((o_totalprice - mean) / sd, 4)) > 1.5""")
def q_zscore_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = Tables(spark, sf_dir).orders
    s = o.groupBy("o_orderpriority").agg(F.avg("o_totalprice").alias("mean"), F.stddev_samp("o_totalprice").alias("sd"))
    z = round_to((F.col("o_totalprice") - F.col("mean")) / F.col("sd"), 4)
    return o.join(s, "o_orderpriority").select("o_orderkey", "o_orderpriority", z.alias("z")).where(F.abs("z") > 1.5)


@register("late_share_by_supplier", "G08", """
SELECT l_suppkey, COUNT(*) AS lines, ROUND(AVG(date_diff('day', o_orderdate::DATE, l_shipdate::DATE)), 4) AS avg_days,
       ROUND(AVG(CASE WHEN date_diff('day', o_orderdate::DATE, l_shipdate::DATE) > 60 THEN 1.0 ELSE 0.0 END), 6) AS late_share
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_suppkey""")
def q_late_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    j = t.lineitem.select("l_orderkey", "l_suppkey", "l_shipdate").join(t.orders.select("o_orderkey", "o_orderdate"),
                                                                       F.col("l_orderkey") == F.col("o_orderkey"))
    days = F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate"))
    return j.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("lines"), round_to(F.avg(days), 4).alias("avg_days"),
                                      round_to(F.avg(F.when(days > 60, 1.0).otherwise(0.0)), 6).alias("late_share"))


@register("origin_destination", "G14", """
WITH f AS (SELECT s.s_nationkey AS origin, c.c_nationkey AS destination, date_diff('day', o_orderdate::DATE, l_shipdate::DATE) AS days
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier s ON l_suppkey = s_suppkey JOIN customer c ON o_custkey = c_custkey)
SELECT origin, destination, COUNT(*) AS lines, ROUND(AVG(days), 4) AS avg_days, ROUND(median(days), 4) AS median_days FROM f GROUP BY 1, 2""")
def q_origin_destination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier nation to customer nation: demand and times."""
    t = Tables(spark, sf_dir)
    days = F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate"))
    f = (t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
         .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
         .select(F.col("s_nationkey").alias("origin"), F.col("c_nationkey").alias("destination"), days.alias("days")))
    g = f.groupBy("origin", "destination").agg(F.count(F.lit(1)).alias("lines"), round_to(F.avg("days"), 4).alias("avg_days"))
    m = exact_quantiles(f, "days", {"median_days": 0.5}, ["origin", "destination"])
    return g.join(m, ["origin", "destination"]).withColumn("median_days", round_to("median_days", 4))


# ---------------------------------------------------------- M01 M04 M36 Q12 Q15

@register("numeric_strata_split", "M01", """
WITH q AS (SELECT o_orderkey, ntile(4) OVER (ORDER BY o_totalprice, o_orderkey) AS quartile FROM orders)
SELECT CAST(quartile AS INTEGER) AS quartile, COUNT(*) AS rows, CAST(round(COUNT(*) * 0.8::DOUBLE) AS BIGINT) AS train FROM q GROUP BY 1""")
def q_numeric_strata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A split that keeps the distribution of a number: strata are its quartile bins."""
    from tessera.operators import evaluate as E

    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_totalprice")
    r = global_row_number(o, [F.col("o_totalprice"), F.col("o_orderkey")], "_r", total_name="_n")
    q = r.select("o_orderkey", ntile_from_rank(F.col("_r"), F.col("_n"), 4).alias("quartile"))
    s = E.stratified_split(q, "quartile", "o_orderkey", 0.8)
    return s.groupBy("quartile").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("split") == "train").alias("train"))


@register("group_baselines", "M04 M36", """
WITH b AS (SELECT median(o_totalprice) AS overall FROM orders),
g AS (SELECT o_orderpriority, AVG(o_totalprice) AS mean, median(o_totalprice) AS mid FROM orders GROUP BY 1)
SELECT o.o_orderpriority, COUNT(*) AS rows, ROUND(AVG(abs(o_totalprice - overall)), 4) AS mae_median,
       ROUND(AVG(abs(o_totalprice - mid)), 4) AS mae_group_median, ROUND(AVG(abs(o_totalprice - mean)), 4) AS mae_group_mean,
       ROUND(AVG(overall - o_totalprice), 4) AS bias_median
FROM orders o JOIN g USING (o_orderpriority), b GROUP BY o.o_orderpriority""")
def q_group_baselines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median overall, median and mean by group: error and signed bias in each segment."""
    o = Tables(spark, sf_dir).orders.select("o_orderpriority", "o_totalprice")
    overall = exact_quantiles(o, "o_totalprice", {"m": 0.5}).scalar()
    mids = exact_quantiles(o, "o_totalprice", {"mid": 0.5}, ["o_orderpriority"])
    means = o.groupBy("o_orderpriority").agg(F.avg("o_totalprice").alias("mean"))
    j = o.join(mids, "o_orderpriority").join(means, "o_orderpriority").withColumn("overall", overall)
    v = F.col("o_totalprice")
    return j.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("rows"), round_to(F.avg(F.abs(v - F.col("overall"))), 4).alias("mae_median"),
        round_to(F.avg(F.abs(v - F.col("mid"))), 4).alias("mae_group_median"), round_to(F.avg(F.abs(v - F.col("mean"))), 4).alias("mae_group_mean"),
        round_to(F.avg(F.col("overall") - v), 4).alias("bias_median"))


_DRIFT_COLUMNS = ("l_quantity", "l_discount", "l_tax")


@register("drift_by_column", "Q15", "\nUNION ALL\n".join(f"""
SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE early) AS expected_rows, COUNT(*) FILTER (WHERE NOT early) AS actual_rows,
       ROUND(AVG({c}) FILTER (WHERE early), 6) AS expected_mean, ROUND(AVG({c}) FILTER (WHERE NOT early), 6) AS actual_mean,
       ROUND((AVG({c}) FILTER (WHERE NOT early) - AVG({c}) FILTER (WHERE early)) / stddev_samp({c}) FILTER (WHERE early), 6) AS standardised_shift
FROM (SELECT *, l_shipdate < TIMESTAMP '1996-01-01' AS early FROM lineitem)""" for c in _DRIFT_COLUMNS))
def q_drift_by_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distribution shift of several predictors between two periods, in one pass."""
    li = Tables(spark, sf_dir).lineitem
    early = F.col("l_shipdate") < F.lit("1996-01-01").cast("timestamp_ntz")
    sides = {"e": early, "a": ~early}
    wide = li.agg(*[f(F.when(cond, F.col(c))).alias(f"{c}_{k}_{name}") for c in _DRIFT_COLUMNS for k, cond in sides.items()
                    for name, f in (("n", F.count), ("mean", F.avg), ("sd", F.stddev_samp))])
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"{c}_e_n").alias("expected_rows"), F.col(f"{c}_a_n").alias("actual_rows"),
                     round_to(f"{c}_e_mean", 6).alias("expected_mean"), round_to(f"{c}_a_mean", 6).alias("actual_mean"),
                     round_to((F.col(f"{c}_a_mean") - F.col(f"{c}_e_mean")) / F.col(f"{c}_e_sd"), 6).alias("standardised_shift"))
            for c in _DRIFT_COLUMNS]
    return wide.select(F.inline(F.array(*rows)))


@register("profile_keys", "Q12", """
SELECT 'orders' AS table_name, COUNT(*) AS rows, COUNT(*) - COUNT(DISTINCT o_orderkey) AS duplicate_keys,
       COUNT(*) FILTER (WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)) AS orphans,
       strftime(MIN(o_orderdate), '%Y-%m-%d') AS first_date, strftime(MAX(o_orderdate), '%Y-%m-%d') AS last_date FROM orders
UNION ALL SELECT 'lineitem', COUNT(*), COUNT(*) - COUNT(DISTINCT (l_orderkey, l_linenumber)),
       COUNT(*) FILTER (WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)),
       strftime(MIN(l_shipdate), '%Y-%m-%d'), strftime(MAX(l_shipdate), '%Y-%m-%d') FROM lineitem""")
def q_profile_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicate keys, dangling references and date ranges of the fact tables."""
    from tessera.operators.joins import orphans

    t = Tables(spark, sf_dir)

    def row(name, df, keys, parent, fk, pk, date):
        per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(date).alias("lo"), F.max(date).alias("hi"))
        lost = orphans(df, parent, fk, pk).select(F.count(F.lit(1))).scalar()
        return per_key.agg(F.sum("n").alias("rows"), F.sum(F.col("n") - 1).alias("duplicate_keys"),
                           F.date_format(F.min("lo"), "yyyy-MM-dd").alias("first_date"), F.date_format(F.max("hi"), "yyyy-MM-dd").alias("last_date")).select(
            F.lit(name).alias("table_name"), "rows", "duplicate_keys", lost.alias("orphans"), "first_date", "last_date")
    return row("orders", t.orders, ["o_orderkey"], t.customer, "o_custkey", "c_custkey", "o_orderdate").unionByName(
        row("lineitem", t.lineitem, ["l_orderkey", "l_linenumber"], t.orders, "l_orderkey", "o_orderkey", "l_shipdate"))


_SKETCHED = {"l_partkey": True, "l_quantity": True, "l_extendedprice": True, "l_returnflag": False, "l_shipdate": False}


@register("merged_profile", "Q12", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, COUNT(*) AS rows, COUNT(*) - COUNT({c}) AS nulls, "
    + (f"ROUND(CAST(MIN({c}) AS DOUBLE), 6) AS low, ROUND(CAST(MAX({c}) AS DOUBLE), 6) AS high, CAST(NULL AS VARCHAR) AS first_text, CAST(NULL AS VARCHAR) AS last_text, "
       if number else f"CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(MIN({c}) AS VARCHAR), CAST(MAX({c}) AS VARCHAR), ")
    + f"TRUE AS distinct_within_error, {'TRUE' if number else 'CAST(NULL AS BOOLEAN)'} AS median_within_error FROM lineitem"
    for c, number in _SKETCHED.items()))
def q_merged_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile of all lines from sketches stored by year of shipping, the last years as a second load,
    and whether its estimates are within their stated errors of exact counts."""
    li, path = Tables(spark, sf_dir).lineitem, scratch_path(spark, f"profile-{uuid.uuid4().hex[:12]}")
    year = F.year("l_shipdate")
    for late in (False, True):  # a later load reads its own rows only
        K.store_loads(K.sketch_loads(li.where((year >= 1996) == late), list(_SKETCHED), year), path)
    numbers = [c for c, number in _SKETCHED.items() if number]
    found = K.united_profile(spark.read.parquet(path), {"median": 0.5})
    medians = found.groupBy().pivot("column_name", numbers).agg(F.first("median"))  # one row
    exact = li.join(F.broadcast(medians.select(*[F.col(c).alias(f"m_{c}") for c in numbers]))).agg(
        *[F.count_if(f(F.col(c), F.col(f"m_{c}"))).alias(f"{name}_{c}") for c in numbers
          for name, f in (("below", lambda a, b: a < b), ("upto", lambda a, b: a <= b))])
    ranks = exact.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"below_{c}").alias("below"), F.col(f"upto_{c}").alias("upto"))
                                            for c in numbers])))
    distinct = table_profile(li, list(_SKETCHED)).select("column_name", F.col("distinct_values").alias("exact_values"))
    n = F.col("rows") - F.col("nulls")
    return found.join(distinct, "column_name").join(ranks, "column_name", "left").select(
        "column_name", "rows", "nulls", round_to("low", 6).alias("low"), round_to("high", 6).alias("high"), "first_text", "last_text",
        (F.abs(F.col("distinct_values") - F.col("exact_values")) <= F.ceil(K.DISTINCT_ERROR * F.col("exact_values"))).alias("distinct_within_error"),
        ((F.col("below") <= (0.5 + K.RANK_ERROR) * n) & (F.col("upto") >= (0.5 - K.RANK_ERROR) * n)).alias("median_within_error"))


# --------------------------------------------------------------- X24 X27 X30

CHUNK_WORDS, FLOOR = 50, 0.2


@register("word_chunks", "X27", f"""
WITH w AS (SELECT doc_id, source, regexp_extract_all(text, '[^\\s]+') AS w FROM documents)
SELECT doc_id, source, CAST(i + 1 AS INTEGER) AS chunk_id, array_to_string(list_slice(w, i * {CHUNK_WORDS} + 1, (i + 1) * {CHUNK_WORDS}), ' ') AS chunk_text
FROM w, unnest(range((len(w) + {CHUNK_WORDS - 1}) // {CHUNK_WORDS})) u(i)""")
def q_word_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.word_chunks(Tables(spark, sf_dir).documents, "text", CHUNK_WORDS, ["doc_id", "source"])


@register("padded_both_ways", "X22 X24", """
WITH t AS (SELECT conv_id, turn, list_transform(regexp_extract_all(lower(text), '[a-z0-9]+'), lambda x: x) AS w FROM conversations),
e AS (SELECT conv_id, turn, len(w) AS n, list_transform(w[1:12], lambda x: length(x) + 3) AS ids FROM t)
SELECT conv_id, turn, array_to_string(list_resize(ids, 12, 0), ' ') AS post_padded,
       array_to_string(list_transform(list_filter(list_resize(ids, 12, 0), lambda i: i >= 4), lambda i: i - 3), ' ') AS decoded
FROM e""")
def q_padded_both_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Post-padded ids with 0 to 3 reserved and an offset of 3 (ids are word lengths here), and back."""
    c = Tables(spark, sf_dir).conversations
    words = F.regexp_extract_all(F.lower("text"), F.lit("[a-z0-9]+"), F.lit(0))
    ids = X.reserve_ids(F.transform(words, lambda w: F.length(w)))
    post = X.post_pad(ids, 12)
    return c.select("conv_id", "turn", F.array_join(F.transform(post, lambda i: i.cast("string")), " ").alias("post_padded"),
                    F.array_join(F.transform(X.unreserve_ids(post), lambda i: i.cast("string")), " ").alias("decoded"))


@register("prompts", "X30", f"""
WITH q AS (SELECT conv_id, turn, text AS question FROM conversations WHERE role = 'user'),
qw AS (SELECT conv_id, turn, question, list_distinct(regexp_extract_all(lower(question), '[a-z0-9]+')) AS qs FROM q),
h AS (SELECT q.conv_id, q.turn, q.question, c.turn AS source_turn, c.text,
             len(list_intersect(qs, list_distinct(regexp_extract_all(lower(c.text), '[a-z0-9]+')))) / greatest(len(qs), 1) AS score
      FROM qw q JOIN conversations c ON c.conv_id = q.conv_id AND c.turn < q.turn),
g AS (SELECT conv_id, turn, string_agg(text, chr(10) ORDER BY source_turn) AS context FROM h WHERE score >= {FLOOR} GROUP BY 1, 2)
SELECT q.conv_id, q.turn, CASE WHEN context IS NULL THEN 'not available'
       ELSE 'Context:' || chr(10) || context || chr(10) || 'Question: ' || question END AS prompt
FROM q LEFT JOIN g USING (conv_id, turn)""")
def q_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Question with the earlier turns that share enough of its words, or "not available"."""
    c = Tables(spark, sf_dir).conversations.withColumn("_w", F.array_distinct(
        F.regexp_extract_all(F.lower("text"), F.lit("[a-z0-9]+"), F.lit(0))))
    q = c.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"), F.col("_w").alias("_q"))
    earlier = c.select("conv_id", F.col("turn").alias("source_turn"), "text", "_w")
    # Pairs of turns of one conversation: bounded by the conversation itself.
    h = q.join(earlier, "conv_id").where(F.col("source_turn") < F.col("turn"))
    score = F.size(F.array_intersect("_q", "_w")) / F.greatest(F.size("_q"), F.lit(1))
    context = X.ordered_context(h.where(score >= FLOOR), ["conv_id", "turn"], "source_turn", F.col("text"))
    return q.join(context, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", F.when(F.col("context").isNull(), "not available").otherwise(
            F.concat(F.lit("Context:\n"), "context", F.lit("\nQuestion: "), "question")).alias("prompt"))


#: Scenario assumption: the given nations are invented, so their places are too, by a rule on the nation's number.
_PLACE = "CAST(n_nationkey * 29 % 121 - 60 AS DOUBLE)", "CAST(n_nationkey * 67 % 360 - 180 AS DOUBLE)"


@register("trade_distances", "G12 S11", f"""
WITH place AS (SELECT n_nationkey, {_PLACE[0]} AS lat, {_PLACE[1]} AS lon FROM nation),
flows AS (SELECT s_nationkey, c_nationkey, COUNT(*) AS lines FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2),
x AS (SELECT f.*, a.lat AS lat1, a.lon AS lon1, b.lat AS lat2, b.lon AS lon2
  FROM flows f JOIN place a ON s_nationkey = a.n_nationkey JOIN place b ON c_nationkey = b.n_nationkey)
SELECT s_nationkey, c_nationkey, lines,
  ROUND(2 * {EARTH_KM} * asin(least(1.0, sqrt(sin(radians(lat2 - lat1) / 2) ^ 2 + cos(radians(lat1)) * cos(radians(lat2)) * sin(radians(lon2 - lon1) / 2) ^ 2))), 3) AS distance_km,
  ROUND(2 * {EARTH_KM} * asin(abs(sin(radians(lat2 - lat1) / 2))) + 2 * {EARTH_KM} * asin(least(1.0, cos(radians(lat2)) * abs(sin(radians(lon2 - lon1) / 2)))), 3) AS manhattan_km,
  lat2 - lat1 AS lat_delta, lon2 - lon1 AS lon_delta, lat2 BETWEEN -23 AND 23 AS to_tropics
FROM x""")
def q_trade_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far lines travel from the supplier's to the customer's nation, by pair of nations."""
    t = Tables(spark, sf_dir)
    place = t.nation.select("n_nationkey", F.expr(_PLACE[0]).alias("lat"), F.expr(_PLACE[1]).alias("lon"))
    flows = (t.lineitem.select("l_orderkey", "l_suppkey").join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
             .join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
             .join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
             .groupBy("s_nationkey", "c_nationkey").agg(F.count(F.lit(1)).alias("lines")))
    for side, n in (("s", 1), ("c", 2)):  # a row per nation
        flows = flows.join(F.broadcast(place.select(F.col("n_nationkey").alias(f"n{n}"), F.col("lat").alias(f"lat{n}"), F.col("lon").alias(f"lon{n}"))),
                           F.col(f"{side}_nationkey") == F.col(f"n{n}"))
    way = ("lat1", "lon1", "lat2", "lon2")
    return flows.select("s_nationkey", "c_nationkey", "lines", round_to(geo.haversine_km(*way), 3).alias("distance_km"),
                        round_to(geo.manhattan_km(*way), 3).alias("manhattan_km"), (F.col("lat2") - F.col("lat1")).alias("lat_delta"),
                        (F.col("lon2") - F.col("lon1")).alias("lon_delta"), geo.in_box("lat2", "lon2", -23, -180, 23, 180).alias("to_tropics"))


#: Scenario assumptions for movements: days from order to shipping stand for the duration.
_LONGEST_DAYS, _FASTEST_KM = 120, 1000

#: rule id, what it looks at, and when a movement passes, in terms of ``days`` and ``distance_km``.
_MOVEMENT_RULES = (("M01", "positive duration", "days > 0"), ("M02", "duration not extreme", f"days <= {_LONGEST_DAYS}"),
                   ("M03", "places differ", "distance_km > 0"), ("M04", "places on the globe", "lat1 BETWEEN -90 AND 90 AND lat2 BETWEEN -90 AND 90"),
                   ("M05", "implied speed", f"days > 0 AND distance_km / days <= {_FASTEST_KM}"))


@register("movement_checks", "G13 Q01 Q10", f"""
WITH place AS (SELECT n_nationkey, {_PLACE[0]} AS lat, {_PLACE[1]} AS lon FROM nation),
x AS (SELECT date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS days, a.lat AS lat1, b.lat AS lat2,
    2 * {EARTH_KM} * asin(least(1.0, sqrt(sin(radians(b.lat - a.lat) / 2) ^ 2 + cos(radians(a.lat)) * cos(radians(b.lat)) * sin(radians(b.lon - a.lon) / 2) ^ 2))) AS distance_km
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN place a ON s_nationkey = a.n_nationkey JOIN place b ON c_nationkey = b.n_nationkey)
""" + "\nUNION ALL\n".join(f"SELECT '{i}' AS rule_id, '{name}' AS rule_name, COUNT(*) AS evaluated, COUNT(*) FILTER (WHERE ({c}) IS NOT TRUE) AS failed FROM x"
                          for i, name, c in _MOVEMENT_RULES))
def q_movement_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose duration, places or implied speed cannot be true; speed serves these checks only."""
    t = Tables(spark, sf_dir)
    a = t.nation.select(F.col("n_nationkey").alias("n1"), F.expr(_PLACE[0]).alias("lat1"), F.expr(_PLACE[1]).alias("lon1"))
    b = t.nation.select(F.col("n_nationkey").alias("n2"), F.expr(_PLACE[0]).alias("lat2"), F.expr(_PLACE[1]).alias("lon2"))
    # The distance of each pair of the 25 nations once, not of each line.
    pairs = a.join(b).withColumn("distance_km", geo.haversine_km("lat1", "lon1", "lat2", "lon2")).drop("lon1", "lon2")
    lines = (t.lineitem.select("l_orderkey", "l_suppkey", "l_shipdate")
             .join(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
             .join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
             .join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey")))
    moved = lines.join(F.broadcast(pairs), (F.col("s_nationkey") == F.col("n1")) & (F.col("c_nationkey") == F.col("n2"))).withColumn(
        "days", F.date_diff("l_shipdate", "o_orderdate"))
    rules = [Rule(i, name, F.expr(c), "reasonability") for i, name, c in _MOVEMENT_RULES]
    failed = moved.agg(F.count(F.lit(1)).alias("evaluated"), *[F.count_if(~F.coalesce(r.condition, F.lit(False))).alias(r.rule_id) for r in rules])
    return failed.select("evaluated", F.inline(F.array(*[F.struct(F.lit(r.rule_id).alias("rule_id"), F.lit(r.name).alias("rule_name"),
                                                                  F.col(r.rule_id).alias("failed")) for r in rules])))
