"""Relational queries: preferred records, lateral top-1, validity intervals,
timeline merge, change hash, SCD2, point-in-time lookup, date dimensions,
concentration and RFM, XML extraction, ordered string aggregation.

DATE outputs are rendered as ``yyyy-MM-dd`` text in the registered results
so that both engines hand identical values to the comparison.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.cleaning import blank_to_null, clean_text, money_sum, round_to, safe_cast
from tessera.functions.dates import date_key, fiscal_parts, open_end
from tessera.functions.hashing import change_hash
from tessera.functions.xml import xml_join, xml_value
from tessera.operators import dims, joins, scd
from tessera.operators.joins import as_of_lookup, orphans, resolve_unknown, top1_lateral
from tessera.operators.windows import (global_row_number, join_null_safe, latest_per_key, ntile_from_rank, pareto,
                                       period_change, validity_from_starts, group_size)
from tessera.plans.registry import register
from tessera.session import materialise
from tessera.tables import Tables


def _d(c: str | Column) -> Column:
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyy-MM-dd")


# ---------------------------------------------------------------- W01 / P07

@register("latest_order_per_customer", "W01 W06 P07", """
SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus, o_totalprice
FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def q_latest_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = Tables(spark, sf_dir).orders
    return latest_per_key(o, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]
                          ).select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus",
                                   "o_totalprice")


# ---------------------------------------------------------------------- J04

@register("lateral_top_order", "J04 J01", """
SELECT c.c_custkey, c.c_name, t.o_orderkey AS top_orderkey, t.o_totalprice AS top_totalprice,
       t.o_orderdate AS top_orderdate
FROM customer c
LEFT JOIN LATERAL (
  SELECT o_orderkey, o_totalprice, o_orderdate FROM orders o
  WHERE o.o_custkey = c.c_custkey ORDER BY o_totalprice DESC, o_orderkey ASC LIMIT 1) t ON TRUE""")
def q_lateral_top_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    out = top1_lateral(t.customer.select("c_custkey", "c_name"), t.orders, "c_custkey", "o_custkey",
                       [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()],
                       [F.col("o_orderkey").alias("top_orderkey"),
                        F.col("o_totalprice").alias("top_totalprice"),
                        F.col("o_orderdate").alias("top_orderdate")])
    return out


# ---------------------------------------------------------------- W02 / W03

def status_history(t: Tables) -> DataFrame:
    """Per customer and order day: status of that day's last order, valid to the next day."""
    o = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus",
                        F.to_date("o_orderdate").alias("day"))
    per_day = o.groupBy("o_custkey", "day").agg(
        F.max_by("o_orderstatus", "o_orderkey").alias("status"))
    return (validity_from_starts(per_day, ["o_custkey"], "day", "status_to")
            .withColumnRenamed("day", "status_from"))


_STATUS_HISTORY_SQL = """
status_history AS (
  SELECT o_custkey, day AS status_from, status,
         COALESCE(lead(day) OVER (PARTITION BY o_custkey ORDER BY day), DATE '9999-12-31') AS status_to
  FROM (SELECT o_custkey, o_orderdate::DATE AS day, arg_max(o_orderstatus, o_orderkey) AS status
        FROM orders GROUP BY 1, 2))"""


@register("order_validity", "W02 W03 A21", f"""
WITH {_STATUS_HISTORY_SQL}
SELECT o_custkey, strftime(status_from, '%Y-%m-%d') AS valid_from,
       strftime(status_to, '%Y-%m-%d') AS valid_to, status,
       COUNT(*) OVER (PARTITION BY o_custkey) AS n_versions,
       status_to = DATE '9999-12-31' AS is_current
FROM status_history""")
def q_order_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = group_size(status_history(Tables(spark, sf_dir)), ["o_custkey"], "n_versions")
    return h.select("o_custkey", _d("status_from").alias("valid_from"),
                    _d("status_to").alias("valid_to"), "status", "n_versions",
                    (F.col("status_to") == open_end()).alias("is_current"))


# ---------------------------------------------------------------- D01 / J03

def shipment_history(t: Tables) -> DataFrame:
    """Per customer and ship day: lines shipped that day, valid to the next ship day."""
    li = t.lineitem.select("l_orderkey", F.to_date("l_shipdate").alias("day"))
    o = t.orders.select("o_orderkey", "o_custkey")
    per_day = (li.join(o, li.l_orderkey == o.o_orderkey)
               .groupBy("o_custkey", "day").agg(F.count(F.lit(1)).alias("ship_lines")))
    return (validity_from_starts(per_day, ["o_custkey"], "day", "ship_to")
            .withColumnRenamed("day", "ship_from"))


@register("timeline_merge", "D01 D02 J03 W02 W03 P06", f"""
WITH {_STATUS_HISTORY_SQL},
ship_history AS (
  SELECT o_custkey, day AS ship_from, ship_lines,
         COALESCE(lead(day) OVER (PARTITION BY o_custkey ORDER BY day), DATE '9999-12-31') AS ship_to
  FROM (SELECT o.o_custkey, l.l_shipdate::DATE AS day, COUNT(*) AS ship_lines
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2)),
edges AS (
  SELECT o_custkey, unnest([status_from, status_to]) AS d FROM status_history
  UNION SELECT o_custkey, unnest([ship_from, ship_to]) FROM ship_history),
slices AS (SELECT o_custkey, d AS valid_from, lead(d) OVER (PARTITION BY o_custkey ORDER BY d) AS valid_to FROM edges),
known AS (
  SELECT e.o_custkey, s.status, s.status_from, s.status_to, h.ship_lines, h.ship_from, h.ship_to,
         e.valid_from, e.valid_to
  FROM slices e
  JOIN status_history s ON s.o_custkey = e.o_custkey AND e.valid_from BETWEEN s.status_from AND s.status_to - 1
  JOIN ship_history h ON h.o_custkey = e.o_custkey AND e.valid_from BETWEEN h.ship_from AND h.ship_to - 1
  WHERE e.valid_to IS NOT NULL),
sizes AS (SELECT o_custkey, COUNT(*) AS n_segments FROM known GROUP BY o_custkey HAVING COUNT(*) > 1)
SELECT k.o_custkey, status, strftime(status_from, '%Y-%m-%d') AS status_from,
       strftime(status_to, '%Y-%m-%d') AS status_to, ship_lines,
       strftime(ship_from, '%Y-%m-%d') AS ship_from, strftime(ship_to, '%Y-%m-%d') AS ship_to,
       strftime(valid_from, '%Y-%m-%d') AS valid_from, strftime(valid_to, '%Y-%m-%d') AS valid_to,
       valid_to = DATE '9999-12-31' AS is_current, n_segments
FROM known k JOIN sizes z ON k.o_custkey = z.o_custkey""")
def q_timeline_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    m = scd.timeline_merge(status_history(t), shipment_history(t), "o_custkey",
                           "status_from", "status_to", "ship_from", "ship_to",
                           ["status"], ["ship_lines"])
    # Read twice, for the counts and the rows.
    m = group_size(materialise(m, "timeline"), ["o_custkey"], "n_segments").where(F.col("n_segments") > 1)
    return m.select("o_custkey", "status", _d("status_from").alias("status_from"),
                    _d("status_to").alias("status_to"), "ship_lines",
                    _d("ship_from").alias("ship_from"), _d("ship_to").alias("ship_to"),
                    _d("valid_from").alias("valid_from"), _d("valid_to").alias("valid_to"),
                    "is_current", "n_segments")


_WAITS_SQL = """
WITH lines AS (
  SELECT o_custkey, l_orderkey, l_linenumber, o_orderdate::DATE AS wait_from, l_shipdate::DATE AS wait_to
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
open_orders AS (SELECT o_custkey, l_orderkey AS open_order, min(wait_from) AS open_from, max(wait_to) AS open_to FROM lines GROUP BY 1, 2)
"""


def open_orders_and_waits(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Two histories per customer that overlap themselves: orders until their last shipment, and lines that wait for theirs."""
    lines = (t.lineitem.select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("wait_to"))
             .join(t.orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("wait_from")), F.col("l_orderkey") == F.col("o_orderkey")))
    orders = (lines.groupBy("o_custkey", F.col("l_orderkey").alias("open_order"))
              .agg(F.min("wait_from").alias("open_from"), F.max("wait_to").alias("open_to")))
    return orders, lines.select("o_custkey", "l_orderkey", "l_linenumber", "wait_from", "wait_to")


@register("waiting_overlaps", "J03", _WAITS_SQL + """
SELECT a.o_custkey, open_order, l_orderkey, l_linenumber, strftime(greatest(open_from, wait_from), '%Y-%m-%d') AS overlap_from,
       strftime(least(open_to, wait_to), '%Y-%m-%d') AS overlap_to
FROM open_orders a JOIN lines b ON a.o_custkey = b.o_custkey AND open_from < wait_to AND wait_from < open_to AND open_order <> l_orderkey
  AND open_from < open_to AND wait_from < wait_to""")
def q_waiting_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that waited for shipment while another order of the customer was open."""
    orders, waits = open_orders_and_waits(Tables(spark, sf_dir))
    pairs = joins.interval_join(orders, waits, "o_custkey", "open_from", "open_to", "wait_from", "wait_to")
    return (pairs.where(F.col("open_order") != F.col("l_orderkey"))
            .select("o_custkey", "open_order", "l_orderkey", "l_linenumber", _d("overlap_from").alias("overlap_from"), _d("overlap_to").alias("overlap_to")))


@register("open_order_clashes", "J03 W12", _WAITS_SQL + """
SELECT o_custkey, open_order, strftime(open_from, '%Y-%m-%d') AS open_from, strftime(open_to, '%Y-%m-%d') AS open_to,
       strftime(next_start, '%Y-%m-%d') AS next_start
FROM (SELECT *, lead(open_from) OVER (PARTITION BY o_custkey ORDER BY open_from, open_to, open_order) AS next_start FROM open_orders WHERE open_from < open_to)
WHERE next_start < open_to""")
def q_open_order_clashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders still open when the customer's next one begins: why no timeline can be merged from them."""
    orders, _ = open_orders_and_waits(Tables(spark, sf_dir))
    found = scd.self_overlaps(orders, "o_custkey", "open_from", "open_to")
    return found.select("o_custkey", "open_order", *[_d(c).alias(c) for c in ("open_from", "open_to", "next_start")])


# ---------------------------------------------------------------- D03 / D04

def customer_dimension(t: Tables) -> DataFrame:
    nation = F.broadcast(t.nation.select("n_nationkey", "n_name", "n_regionkey"))  # 25 rows
    region = F.broadcast(t.region.select("r_regionkey", "r_name"))                 # 5 rows
    c = (t.customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
         .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left"))
    bal = F.col("c_acctbal")
    band = (F.when(bal < 0, "negative").when(bal < 1000, "low")
            .when(bal < 5000, "medium").otherwise("high"))
    attrs = {
        "customer_name": clean_text("c_name"),
        "market_segment": F.lower(blank_to_null("c_mktsegment")),
        "nation_name": F.col("n_name"),
        "region_name": F.col("r_name"),
        "account_balance": bal.cast("decimal(18,2)"),
        "balance_band": band,
        "is_in_debt": bal < 0,
    }
    return c.select(F.col("c_custkey").alias("customer_key"),
                    *[v.alias(k) for k, v in attrs.items()],
                    change_hash(attrs).alias("row_hash"))


@register("customer_dim_hash", "D04 J01 P08 P10 P11", """
WITH c AS (
  SELECT c.c_custkey AS customer_key,
         NULLIF(trim(regexp_replace(c.c_name, '\\s+', ' ', 'g')), '') AS customer_name,
         lower(NULLIF(trim(c.c_mktsegment), '')) AS market_segment,
         n.n_name AS nation_name, r.r_name AS region_name,
         CAST(c.c_acctbal AS DECIMAL(18,2)) AS account_balance,
         CASE WHEN c.c_acctbal < 0 THEN 'negative' WHEN c.c_acctbal < 1000 THEN 'low'
              WHEN c.c_acctbal < 5000 THEN 'medium' ELSE 'high' END AS balance_band,
         c.c_acctbal < 0 AS is_in_debt
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)
SELECT customer_key, customer_name, market_segment, nation_name, region_name,
       CAST(account_balance AS DOUBLE) AS account_balance, balance_band, is_in_debt,
       md5(to_json(struct_pack(
         customer_name := customer_name::VARCHAR, market_segment := market_segment::VARCHAR,
         nation_name := nation_name::VARCHAR, region_name := region_name::VARCHAR,
         account_balance := account_balance::VARCHAR, balance_band := balance_band::VARCHAR,
         is_in_debt := is_in_debt::VARCHAR))) AS row_hash
FROM c""")
def q_customer_dim_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = customer_dimension(Tables(spark, sf_dir))
    return d.withColumn("account_balance", F.col("account_balance").cast("double"))


# ---------------------------------------------------------------- D10 / D12

SNAPSHOT_1 = "1998-01-01"
SNAPSHOT_2 = "2000-01-01"
_SCD_ATTRS = ["last_status", "last_priority"]


def customer_snapshot(t: Tables, as_of: str) -> DataFrame:
    """Customer attributes as known at ``as_of``: the latest order before it."""
    o = t.orders.where(F.col("o_orderdate") < F.lit(as_of).cast("timestamp_ntz"))
    top = latest_per_key(o, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])
    return top.select("o_custkey", F.col("o_orderstatus").alias("last_status"),
                      F.col("o_orderpriority").alias("last_priority"))


def _snapshot_sql(name: str, as_of: str) -> str:
    return f"""{name} AS (
  SELECT o_custkey, o_orderstatus AS last_status, o_orderpriority AS last_priority
  FROM orders WHERE o_orderdate < TIMESTAMP '{as_of}'
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)"""


_HASH_SQL = ("md5(to_json(struct_pack(last_status := last_status::VARCHAR, "
             "last_priority := last_priority::VARCHAR)))")


@register("scd2_apply", "D10", f"""
WITH {_snapshot_sql('s1', SNAPSHOT_1)}, {_snapshot_sql('s2', SNAPSHOT_2)},
hist AS (SELECT o_custkey, last_status, last_priority, {_HASH_SQL} AS row_hash,
                DATE '{SNAPSHOT_1}' AS valid_from, DATE '9999-12-31' AS valid_to, TRUE AS is_current
         FROM s1),
snap AS (SELECT o_custkey, last_status, last_priority, {_HASH_SQL} AS row_hash FROM s2),
j AS (SELECT h.o_custkey AS h_key, h.last_status AS h_status, h.last_priority AS h_priority,
             h.row_hash AS h_hash, h.valid_from AS h_from,
             s.o_custkey AS s_key, s.last_status AS s_status, s.last_priority AS s_priority,
             s.row_hash AS s_hash
      FROM hist h FULL OUTER JOIN snap s ON h.o_custkey = s.o_custkey),
out AS (
  SELECT h_key AS o_custkey, h_status AS last_status, h_priority AS last_priority, h_hash AS row_hash,
         h_from AS valid_from, DATE '9999-12-31' AS valid_to, TRUE AS is_current
  FROM j WHERE h_key IS NOT NULL AND s_key IS NOT NULL AND h_hash = s_hash
  UNION ALL
  SELECT h_key, h_status, h_priority, h_hash, h_from, DATE '{SNAPSHOT_2}', FALSE
  FROM j WHERE h_key IS NOT NULL AND (s_key IS NULL OR h_hash <> s_hash)
  UNION ALL
  SELECT s_key, s_status, s_priority, s_hash, DATE '{SNAPSHOT_2}', DATE '9999-12-31', TRUE
  FROM j WHERE s_key IS NOT NULL AND (h_key IS NULL OR h_hash <> s_hash))
SELECT o_custkey, last_status, last_priority, row_hash, strftime(valid_from, '%Y-%m-%d') AS valid_from,
       strftime(valid_to, '%Y-%m-%d') AS valid_to, is_current
FROM out""")
def q_scd2_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    hist = scd.scd2_init(customer_snapshot(t, SNAPSHOT_1), "o_custkey", _SCD_ATTRS, SNAPSHOT_1)
    out = scd.scd2_apply(hist, customer_snapshot(t, SNAPSHOT_2), "o_custkey", _SCD_ATTRS, SNAPSHOT_2)
    return out.select("o_custkey", *_SCD_ATTRS, "row_hash", _d("valid_from").alias("valid_from"),
                      _d("valid_to").alias("valid_to"), "is_current")


# ---------------------------------------------------------------- J09 / J10

@register("point_in_time_join", "J09 J10", f"""
WITH {_STATUS_HISTORY_SQL}
SELECT l.l_orderkey, l.l_linenumber, o.o_custkey, strftime(l.l_shipdate::DATE, '%Y-%m-%d') AS ship_day,
       COALESCE(h.status, 'UNKNOWN') AS status_at_ship,
       COALESCE(strftime(h.status_from, '%Y-%m-%d'), 'none') AS status_since,
       COALESCE(CAST(strftime(h.status_from, '%Y%m%d') AS BIGINT), -1) AS status_date_key,
       h.status_from IS NULL AS unknown_member
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN status_history h ON h.o_custkey = o.o_custkey
  AND h.status_from <= l.l_shipdate::DATE AND l.l_shipdate::DATE < h.status_to""")
def q_point_in_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    li = t.lineitem.select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("ship_day"))
    o = t.orders.select("o_orderkey", "o_custkey")
    facts = li.join(o, li.l_orderkey == o.o_orderkey).drop("o_orderkey")
    resolved = as_of_lookup(facts, status_history(t), "o_custkey", "ship_day",
                            "status_from", "status_to", ["status", "status_from"])
    resolved = resolve_unknown(resolved.withColumn("status_date_key", date_key("status_from").cast("long")), "status_date_key")
    return resolved.select(
        "l_orderkey", "l_linenumber", "o_custkey", _d("ship_day").alias("ship_day"), "status_date_key",
        F.coalesce("status", F.lit("UNKNOWN")).alias("status_at_ship"),
        F.coalesce(_d("status_from"), F.lit("none")).alias("status_since"),
        F.col("status_from").isNull().alias("unknown_member"))


# ------------------------------------------------------------ S10 D05 D06

_SPAN_SQL = """days AS (
  SELECT CAST(unnest(generate_series((SELECT min(o_orderdate) FROM orders),
                                     (SELECT max(l_shipdate) FROM lineitem),
                                     INTERVAL 1 DAY)) AS DATE) AS d)"""


def _span(t: Tables) -> DataFrame:
    lo = t.orders.select(F.min(F.to_date("o_orderdate")).alias("lo"))
    hi = t.lineitem.select(F.max(F.to_date("l_shipdate")).alias("hi"))
    return lo.select(F.explode(F.sequence(
        F.col("lo"), hi.scalar(), F.expr("INTERVAL 1 DAY"))).alias("full_date"))


@register("dim_date", "S10 D05", f"""
WITH {_SPAN_SQL}
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, strftime(d, '%Y-%m-%d') AS full_date,
       CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
       CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day_of_month,
       CAST(dayofweek(d) AS INTEGER) AS day_of_week, strftime(d, '%A') AS day_name,
       strftime(d, '%B') AS month_name, strftime(d, '%Y-%m') AS year_month,
       dayofweek(d) IN (0, 6) AS is_weekend
FROM days""")
def q_dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = dims.date_dimension(_span(Tables(spark, sf_dir)))
    return d.withColumn("full_date", _d("full_date"))


@register("fiscal_calendar", "D06", f"""
WITH {_SPAN_SQL}
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, strftime(d, '%Y-%m-%d') AS full_date,
       CAST(year(d + INTERVAL 2 MONTH) AS INTEGER) AS fiscal_year,
       CAST(quarter(d + INTERVAL 2 MONTH) AS INTEGER) AS fiscal_quarter,
       CAST(month(d + INTERVAL 2 MONTH) AS INTEGER) AS fiscal_month
FROM days""")
def q_fiscal_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = dims.fiscal_calendar(_span(Tables(spark, sf_dir)))
    return d.withColumn("full_date", _d("full_date"))


@register("fiscal_sales", "A26 D06", """
SELECT CAST(year(o_orderdate + INTERVAL 2 MONTH) AS INTEGER) AS fiscal_year,
       CAST(month(o_orderdate + INTERVAL 2 MONTH) AS INTEGER) AS fiscal_month,
       COUNT(*) AS orders, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM orders GROUP BY 1, 2""")
def q_fiscal_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = Tables(spark, sf_dir).orders
    p = fiscal_parts("o_orderdate")
    return (o.groupBy(p["fiscal_year"].alias("fiscal_year"), p["fiscal_month"].alias("fiscal_month"))
            .agg(F.count(F.lit(1)).alias("orders"),
                 money_sum("o_totalprice").alias("revenue")))


# ------------------------------------------------------------------- W10

@register("pareto", "W10 A07 W08", """
WITH r AS (SELECT o_custkey, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS revenue FROM orders GROUP BY o_custkey),
c AS (SELECT *, row_number() OVER w AS rank, SUM(revenue) OVER w AS cum,
             SUM(revenue) OVER () AS total, COUNT(*) OVER () AS n
      FROM r WINDOW w AS (ORDER BY revenue DESC, o_custkey ASC ROWS UNBOUNDED PRECEDING))
SELECT o_custkey, CAST(revenue AS DOUBLE) AS revenue, rank, CAST(cum AS DOUBLE) AS cumulative_value,
       ROUND(CAST(cum AS DOUBLE) / CAST(total AS DOUBLE), 6) AS cumulative_share, ROUND(rank / n, 6) AS entity_share
FROM c""")
def q_pareto(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pareto(Tables(spark, sf_dir).orders.select("o_custkey", F.col("o_totalprice").cast("decimal(18,2)").alias("revenue")),
               "o_custkey", "revenue")
    return p.select("o_custkey", F.col("revenue").cast("double").alias("revenue"), "rank",
                    F.col("cumulative_value").cast("double").alias("cumulative_value"),
                    round_to("cumulative_share", 6).alias("cumulative_share"),
                    round_to("entity_share", 6).alias("entity_share"))


# ------------------------------------------------------------------- G04

@register("rfm", "G04 W08", """
WITH c AS (
  SELECT o_custkey, date_diff('day', max(o_orderdate)::DATE,
                              (SELECT max(o_orderdate) FROM orders)::DATE) AS recency_days,
         COUNT(*) AS frequency, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS monetary
  FROM orders GROUP BY o_custkey)
SELECT o_custkey, recency_days, frequency, CAST(monetary AS DOUBLE) AS monetary,
       CAST(ntile(4) OVER (ORDER BY recency_days DESC, o_custkey) AS INTEGER) AS r_score,
       CAST(ntile(4) OVER (ORDER BY frequency ASC, o_custkey) AS INTEGER) AS f_score,
       CAST(ntile(4) OVER (ORDER BY monetary ASC, o_custkey) AS INTEGER) AS m_score
FROM c""")
def q_rfm(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = Tables(spark, sf_dir).orders
    last = o.select(F.max(F.to_date("o_orderdate"))).scalar()
    c = o.groupBy("o_custkey").agg(
        F.datediff(last, F.max(F.to_date("o_orderdate"))).alias("recency_days"),
        F.count(F.lit(1)).alias("frequency"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("monetary"))
    c = materialise(c, "rfm")
    out = c
    for score, order in [("r_score", [F.col("recency_days").desc(), F.col("o_custkey")]),
                         ("f_score", [F.col("frequency").asc(), F.col("o_custkey")]),
                         ("m_score", [F.col("monetary").asc(), F.col("o_custkey")])]:
        # Each ranking starts from the customer table, so the plan does not grow with the scores.
        r = global_row_number(c, order, "_rank", total_name="_n")
        out = join_null_safe(out, r.select("o_custkey", ntile_from_rank(F.col("_rank"), F.col("_n"), 4).alias(score)),
                             ["o_custkey"])
    c = out
    return c.select("o_custkey", "recency_days", "frequency", F.col("monetary").cast("double").alias("monetary"),
                    "r_score", "f_score", "m_score")


# ------------------------------------------------------------- J05 / A08

def _customer_xml(nation_name: Column) -> Column:
    c = F.col
    return F.concat(
        F.lit("<Customer><Name>"), c("c_name"), F.lit("</Name><Segment>"), c("c_mktsegment"),
        F.lit("</Segment><Balance>"), c("c_acctbal").cast("decimal(18,2)").cast("string"),
        F.lit("</Balance><Note></Note><Tag>"), F.lower(c("c_mktsegment")), F.lit("</Tag><Tag></Tag><Tag>"),
        nation_name, F.lit("</Tag></Customer>"))


@register("xml_extract", "J05 A08 P12", """
WITH x AS (
  SELECT c.c_custkey,
         '<Customer><Name>' || c.c_name || '</Name><Segment>' || c.c_mktsegment ||
         '</Segment><Balance>' || CAST(CAST(c.c_acctbal AS DECIMAL(18,2)) AS VARCHAR) ||
         '</Balance><Note></Note><Tag>' || lower(c.c_mktsegment) || '</Tag><Tag></Tag><Tag>' ||
         n.n_name || '</Tag></Customer>' AS doc
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey)
SELECT c_custkey,
       NULLIF(regexp_extract(doc, '<Name>([^<]*)</Name>', 1), '') AS name,
       NULLIF(regexp_extract(doc, '<Segment>([^<]*)</Segment>', 1), '') AS segment,
       TRY_CAST(NULLIF(regexp_extract(doc, '<Balance>([^<]*)</Balance>', 1), '') AS DOUBLE) AS balance,
       NULLIF(regexp_extract(doc, '<Note>([^<]*)</Note>', 1), '') AS note,
       NULLIF(array_to_string(list_filter(regexp_extract_all(doc, '<Tag>([^<]*)</Tag>', 1),
                                          lambda v: v <> ''), ' | '), '') AS tags
FROM x""")
def q_xml_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    nation = F.broadcast(t.nation.select("n_nationkey", "n_name"))
    x = (t.customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
         .select("c_custkey", _customer_xml(F.col("n_name")).alias("doc")))
    return x.select("c_custkey", xml_value("doc", "Name").alias("name"),
                    xml_value("doc", "Segment").alias("segment"),
                    safe_cast(xml_value("doc", "Balance"), "double").alias("balance"),
                    xml_value("doc", "Note").alias("note"),
                    xml_join("doc", "Tag", " | ").alias("tags"))


@register("ordered_string_agg", "A08", """
WITH firsts AS (
  SELECT o_custkey, o_orderpriority, min(o_orderdate) AS first_seen
  FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2)
SELECT c.c_custkey,
       string_agg(f.o_orderpriority, ' | ' ORDER BY f.first_seen, f.o_orderpriority) AS finished_priorities
FROM customer c LEFT JOIN firsts f ON f.o_custkey = c.c_custkey
GROUP BY c.c_custkey""")
def q_ordered_string_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    # Pre-aggregate to at most one row per (customer, priority): the per-group
    # list is bounded by the number of priority codes.
    firsts = (t.orders.where(F.col("o_orderstatus") == "F")
              .groupBy("o_custkey", "o_orderpriority")
              .agg(F.min("o_orderdate").alias("first_seen")))
    agg = firsts.groupBy("o_custkey").agg(F.array_sort(F.collect_list(
        F.struct("first_seen", "o_orderpriority"))).alias("_items"))
    agg = agg.select(F.col("o_custkey").alias("c_custkey"),
                     F.array_join(F.transform("_items", lambda s: s["o_orderpriority"]), " | ")
                     .alias("finished_priorities"))
    return t.customer.select("c_custkey").join(agg, "c_custkey", "left")


# ----------------------------------------------------------- G08 / W11

@register("delivery_delay", "G08 A06", """
WITH l AS (
  SELECT strftime(o.o_orderdate, '%Y-%m') AS order_month, o.o_orderpriority,
         date_diff('day', o.o_orderdate::DATE, l.l_shipdate::DATE) AS lag_days
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
SELECT order_month, o_orderpriority, COUNT(*) AS lines, ROUND(AVG(lag_days), 4) AS avg_lag_days,
       COUNT(*) FILTER (WHERE lag_days < 0) AS shipped_before_order,
       ROUND(AVG(CASE WHEN lag_days > 90 THEN 1.0 ELSE 0.0 END), 6) AS late_share
FROM l GROUP BY 1, 2""")
def q_delivery_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    li = t.lineitem.select("l_orderkey", "l_shipdate")
    o = t.orders.select("o_orderkey", "o_orderdate", "o_orderpriority")
    j = li.join(o, li.l_orderkey == o.o_orderkey).withColumn(
        "lag_days", F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate")))
    return (j.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("order_month"), "o_orderpriority")
            .agg(F.count(F.lit(1)).alias("lines"),
                 round_to(F.avg("lag_days"), 4).alias("avg_lag_days"),
                 F.count_if(F.col("lag_days") < 0).alias("shipped_before_order"),
                 round_to(F.avg(F.when(F.col("lag_days") > 90, 1.0).otherwise(0.0)), 6)
                 .alias("late_share")))


@register("monthly_trend", "W11 G01", """
WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS year_month, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
                  COUNT(*) AS orders FROM orders GROUP BY 1)
SELECT year_month, orders, ROUND(revenue, 2) AS revenue,
       ROUND(lag(revenue) OVER (ORDER BY year_month), 2) AS previous_value,
       ROUND(revenue - lag(revenue) OVER (ORDER BY year_month), 2) AS change
FROM m""")
def q_monthly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = Tables(spark, sf_dir).orders
    m = o.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("year_month")).agg(
        money_sum("o_totalprice").alias("revenue"), F.count(F.lit(1)).alias("orders"))
    # Aggregated to one row per month: the ordered window runs on that.
    m = period_change(m, "year_month", "revenue")
    return m.select("year_month", "orders", round_to("revenue", 2).alias("revenue"),
                    round_to("previous_value", 2).alias("previous_value"),
                    round_to("change", 2).alias("change"))


@register("customer_value", "A24 G07", """
WITH c AS (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY 1)
SELECT COUNT(*) AS unique_customers, COUNT(*) FILTER (WHERE n > 1) AS repeat_customers,
       COUNT(*) FILTER (WHERE n = 1) AS one_time_customers,
       ROUND(COUNT(*) FILTER (WHERE n > 1) / COUNT(*), 6) AS repeat_share,
       ROUND((SELECT CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) FROM orders), 4) AS avg_order_value
FROM c""")
def q_customer_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = Tables(spark, sf_dir).orders
    aov = o.select(money_sum("o_totalprice") / F.count(F.lit(1))).scalar()
    c = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return c.agg(F.count(F.lit(1)).alias("unique_customers"),
                 F.count_if(F.col("n") > 1).alias("repeat_customers"),
                 F.count_if(F.col("n") == 1).alias("one_time_customers"),
                 round_to(F.count_if(F.col("n") > 1) / F.count(F.lit(1)), 6).alias("repeat_share"),
                 round_to(aov, 4).alias("avg_order_value"))


# ------------------------------------------------------------ J11 / A11

@register("orphans", "J11 Q13", """
SELECT d.doc_id, d.source, d.lang FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def q_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return orphans(t.documents.select("doc_id", "source", "lang"), t.labels, "doc_id", "doc_id")


@register("dup_keys", "A11 Q13", """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem
GROUP BY 1, 2 HAVING COUNT(*) > 1""")
def q_dup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.operators.quality import duplicate_keys
    return duplicate_keys(Tables(spark, sf_dir).lineitem, ["l_orderkey", "l_linenumber"])


@register("role_playing_view", "J07 D09 J01", """
SELECT l.l_orderkey, l.l_linenumber, cn.n_name AS customer_nation, sn.n_name AS supplier_nation,
       cr.r_name AS customer_region, sr.r_name AS supplier_region,
       cn.n_nationkey = sn.n_nationkey AS domestic
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN nation cn ON c.c_nationkey = cn.n_nationkey
LEFT JOIN nation sn ON s.s_nationkey = sn.n_nationkey
LEFT JOIN region cr ON cn.n_regionkey = cr.r_regionkey
LEFT JOIN region sr ON sn.n_regionkey = sr.r_regionkey""")
def q_role_playing_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.operators.joins import role_playing
    t = Tables(spark, sf_dir)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey")
    o = t.orders.select("o_orderkey", "o_custkey")
    cust = t.customer.select("c_custkey", "c_nationkey")
    supp = t.supplier.select("s_suppkey", "s_nationkey")
    f = (li.join(o, li.l_orderkey == o.o_orderkey).join(cust, F.col("o_custkey") == F.col("c_custkey"))
         .join(supp, F.col("l_suppkey") == F.col("s_suppkey")))
    geo = F.broadcast(t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
                      .select("n_nationkey", F.col("n_name").alias("nation"),
                              F.col("r_name").alias("region")))  # 25 rows
    v = role_playing(f, geo, "n_nationkey",
                     {"customer": "c_nationkey", "supplier": "s_nationkey"}, ["nation", "region"])
    return v.select("l_orderkey", "l_linenumber", "customer_nation", "supplier_nation",
                    "customer_region", "supplier_region",
                    (F.col("c_nationkey") == F.col("s_nationkey")).alias("domestic"))
