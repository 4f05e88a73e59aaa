"""Governed mart: staging -> rule flags -> valid/quarantine -> daily fact -> view.

Re-aimed to the line-item star: the staging table is one row per line with
its order's date and customer; the rule set mirrors the eight-rule
completeness / consistency / reasonability / validity view.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.cleaning import round_to
from tessera.functions.dates import date_key, whole_minutes
from tessera.operators import quality as Q
from tessera.operators.joins import role_playing
from tessera.plans.registry import register
from tessera.tables import Tables


def line_staging(t: Tables) -> DataFrame:
    """One row per line item with order date, priority and customer."""
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                           "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
                           "l_linestatus", "l_shipdate")
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    return li.join(o, li.l_orderkey == o.o_orderkey, "inner").drop("o_orderkey")


def line_rules() -> list[Q.Rule]:
    c = F.col
    return [
        Q.Rule("DQ001", "shipdate_not_null", c("l_shipdate").isNotNull(), "completeness",
               "lineitem", "l_shipdate", "ship date is required"),
        Q.Rule("DQ002", "orderdate_not_null", c("o_orderdate").isNotNull(), "completeness",
               "orders", "o_orderdate", "order date is required"),
        Q.Rule("DQ003", "ship_after_order",
               c("l_shipdate").isNotNull() & c("o_orderdate").isNotNull()
               & (c("l_shipdate") >= c("o_orderdate")), "consistency",
               "lineitem", "l_shipdate", "a line cannot ship before it was ordered"),
        Q.Rule("DQ004", "quantity_non_negative", c("l_quantity") >= 0, "reasonability",
               "lineitem", "l_quantity", "quantities are not negative"),
        Q.Rule("DQ005", "discount_in_range", c("l_discount").between(0, 0.10), "reasonability",
               "lineitem", "l_discount", "discounts lie between 0 and 10%"),
        Q.Rule("DQ006", "price_non_negative", c("l_extendedprice") >= 0, "reasonability",
               "lineitem", "l_extendedprice", "prices are not negative"),
        Q.Rule("DQ007", "returnflag_valid", c("l_returnflag").isin("A", "N", "R"), "validity",
               "lineitem", "l_returnflag", "return flag is a known code"),
        Q.Rule("DQ008", "tax_in_range", c("l_tax").between(0, 0.08), "validity",
               "lineitem", "l_tax", "tax rate lies between 0 and 8%"),
    ]


def flagged_lines(t: Tables) -> DataFrame:
    return Q.dq_flags(line_staging(t), line_rules())


# The rules once more for the oracle, as data: predicates over the staged line, each put
# beside every line as a row (line, rule, held) and then folded back per line.
_SQL_RULES = [
    ("DQ001", "shipdate_not_null", "completeness", "l_shipdate IS NOT NULL"),
    ("DQ002", "orderdate_not_null", "completeness", "o_orderdate IS NOT NULL"),
    ("DQ003", "ship_after_order", "consistency", "l_shipdate >= o_orderdate"),
    ("DQ004", "quantity_non_negative", "reasonability", "l_quantity >= 0"),
    ("DQ005", "discount_in_range", "reasonability", "l_discount BETWEEN 0 AND 0.10"),
    ("DQ006", "price_non_negative", "reasonability", "l_extendedprice >= 0"),
    ("DQ007", "returnflag_valid", "validity", "l_returnflag IN ('A', 'N', 'R')"),
    ("DQ008", "tax_in_range", "validity", "l_tax BETWEEN 0 AND 0.08"),
]
_STG_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
             "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
             "l_shipdate", "o_custkey", "o_orderdate", "o_orderpriority"]
_FLAGS = [f"{rid.lower()}_{name}" for rid, name, _, _ in _SQL_RULES]
_FLAGS_SQL = f"""
WITH line AS (
  SELECT row_number() OVER () AS rid, {", ".join(_STG_COLS)}
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
), held AS (
  SELECT rid, unnest([{", ".join(f"'{r}'" for r, *_ in _SQL_RULES)}]) AS rule,
         unnest([{", ".join(f"coalesce({test}, FALSE)" for *_, test in _SQL_RULES)}]) AS ok
  FROM line
), folded AS (
  SELECT rid, {", ".join(f"bool_and(ok) FILTER (WHERE rule = '{r}') AS {f}" for (r, *_), f in zip(_SQL_RULES, _FLAGS, strict=True))},
         CASE WHEN bool_and(ok) THEN 'PASS' ELSE 'FAIL' END AS dq_status,
         CAST(count(*) FILTER (WHERE NOT ok) AS INTEGER) AS dq_failed_rule_count,
         coalesce(string_agg(rule, ',' ORDER BY rule) FILTER (WHERE NOT ok), '') AS dq_failed_rules
  FROM held GROUP BY rid
), results AS (SELECT * EXCLUDE (rid) FROM line JOIN folded USING (rid))
"""
_FLAG_COLS = ", ".join(_FLAGS)


# ------------------------------------------------------------------ daily fact

def daily_fact(t: Tables) -> DataFrame:
    """A03-A05 over valid lines, then the J07 role-playing nation view."""
    valid = Q.valid_rows(line_staging(t), line_rules())
    cust = t.customer.select(F.col("c_custkey"), F.col("c_nationkey"))
    supp = t.supplier.select(F.col("s_suppkey"), F.col("s_nationkey"))
    lines = (valid.join(cust, valid.o_custkey == cust.c_custkey, "inner")
             .join(supp, valid.l_suppkey == supp.s_suppkey, "inner"))
    gross = F.col("l_extendedprice")
    disc_amt = gross * F.col("l_discount")
    tax_amt = gross * (1 - F.col("l_discount")) * F.col("l_tax")
    net = gross * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    fact = (lines.groupBy(date_key("l_shipdate").alias("date_key"),
                          F.col("c_nationkey").alias("customer_nationkey"),
                          F.col("s_nationkey").alias("supplier_nationkey"))
            .agg(F.count(F.lit(1)).alias("line_count"),
                 F.sum("l_quantity").alias("total_quantity"),
                 F.sum(gross).alias("total_gross"),
                 F.sum(disc_amt).alias("total_discount"),
                 F.sum(tax_amt).alias("total_tax"),
                 F.sum(net).alias("total_net"),
                 F.avg("l_quantity").alias("avg_quantity"),
                 F.avg(net).alias("avg_net"),
                 # Average of guarded ratios (NULL when the guard fails)
                 F.avg(F.when(F.col("l_quantity") > 0, gross / F.col("l_quantity")))
                 .alias("avg_unit_price"),
                 # Truncated whole minutes between order and shipment
                 F.avg(whole_minutes("o_orderdate", "l_shipdate")).alias("avg_ship_lag_minutes")))
    nation = F.broadcast(t.nation.select("n_nationkey", "n_name"))  # 25 rows by definition
    view = role_playing(fact, nation, "n_nationkey",
                        {"customer": "customer_nationkey", "supplier": "supplier_nationkey"},
                        ["n_name"])
    dbl = ["total_quantity", "total_gross", "total_discount", "total_tax", "total_net",
           "avg_quantity", "avg_net", "avg_unit_price", "avg_ship_lag_minutes"]
    return view.select(
        "date_key", "customer_nationkey", "supplier_nationkey",
        F.col("customer_n_name").alias("customer_nation"),
        F.col("supplier_n_name").alias("supplier_nation"),
        "line_count", *[round_to(c, 4).alias(c) for c in dbl])


DAILY_FACT_SQL = _FLAGS_SQL + """
, valid AS (SELECT * FROM results WHERE dq_status = 'PASS')
, fact AS (
  SELECT CAST(strftime(v.l_shipdate, '%Y%m%d') AS INTEGER) AS date_key,
         c.c_nationkey AS customer_nationkey, s.s_nationkey AS supplier_nationkey,
         COUNT(*) AS line_count,
         SUM(l_quantity) AS total_quantity,
         SUM(l_extendedprice) AS total_gross,
         SUM(l_extendedprice * l_discount) AS total_discount,
         SUM(l_extendedprice * (1 - l_discount) * l_tax) AS total_tax,
         SUM(l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS total_net,
         AVG(l_quantity) AS avg_quantity,
         AVG(l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS avg_net,
         AVG(CASE WHEN l_quantity > 0 THEN l_extendedprice / l_quantity END) AS avg_unit_price,
         AVG(date_sub('minute', o_orderdate, l_shipdate)) AS avg_ship_lag_minutes
  FROM valid v
  JOIN customer c ON v.o_custkey = c.c_custkey
  JOIN supplier s ON v.l_suppkey = s.s_suppkey
  GROUP BY 1, 2, 3
)
SELECT f.date_key, f.customer_nationkey, f.supplier_nationkey,
       cn.n_name AS customer_nation, sn.n_name AS supplier_nation, f.line_count,
       ROUND(total_quantity, 4) AS total_quantity, ROUND(total_gross, 4) AS total_gross,
       ROUND(total_discount, 4) AS total_discount, ROUND(total_tax, 4) AS total_tax,
       ROUND(total_net, 4) AS total_net, ROUND(avg_quantity, 4) AS avg_quantity,
       ROUND(avg_net, 4) AS avg_net, ROUND(avg_unit_price, 4) AS avg_unit_price,
       ROUND(avg_ship_lag_minutes, 4) AS avg_ship_lag_minutes
FROM fact f
LEFT JOIN nation cn ON f.customer_nationkey = cn.n_nationkey
LEFT JOIN nation sn ON f.supplier_nationkey = sn.n_nationkey
"""


@register("daily_fact", "Q01 Q03 Q04 A03 A04 A05 J07 D09", DAILY_FACT_SQL)
def q_daily_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_fact(Tables(spark, sf_dir))


# ----------------------------------------------------------- rule flags / split

@register("dq_flags", "Q01 Q02 Q03", _FLAGS_SQL + f"""
SELECT {", ".join(_STG_COLS)}, {_FLAG_COLS}, dq_status, dq_failed_rule_count,
       dq_failed_rules
FROM results""")
def q_dq_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = flagged_lines(Tables(spark, sf_dir))
    return f.withColumn("dq_failed_rules", F.array_join("dq_failed_rules", ","))


@register("dq_valid", "Q04 P03", _FLAGS_SQL + f"""
SELECT {", ".join(_STG_COLS)} FROM results WHERE dq_status = 'PASS'""")
def q_dq_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.valid_rows(line_staging(Tables(spark, sf_dir)), line_rules())


@register("dq_quarantine", "Q04 P04", _FLAGS_SQL + f"""
SELECT {", ".join(_STG_COLS)}, {_FLAG_COLS}, dq_status, dq_failed_rule_count,
       dq_failed_rules
FROM results WHERE dq_status = 'FAIL'""")
def q_dq_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = Q.split_quarantine(flagged_lines(Tables(spark, sf_dir)))
    return q.withColumn("dq_failed_rules", F.array_join("dq_failed_rules", ","))


@register("dq_scorecard", "Q10", _FLAGS_SQL + """
, totals AS (SELECT COUNT(*) AS evaluated,
                    COUNT(*) FILTER (WHERE dq_status = 'PASS') AS valid FROM results)
, catalogue AS (SELECT unnest([""" + ", ".join(f"'{r}'" for r, *_ in _SQL_RULES) + """]) AS rule_id,
                       unnest([""" + ", ".join(f"'{d}'" for _, _, d, _ in _SQL_RULES) + """]) AS dimension)
, per_rule AS (SELECT rule_id, dimension, (SELECT COUNT(*) FROM held WHERE rule = rule_id AND NOT ok) AS failed
               FROM catalogue)
SELECT p.rule_id, p.dimension, t.evaluated, t.valid, t.evaluated - t.valid AS quarantined,
       p.failed, ROUND(p.failed / t.evaluated, 6) AS fail_rate,
       ROUND(1 - p.failed / t.evaluated, 6) AS pass_rate,
       CAST(RANK() OVER (ORDER BY p.failed DESC) AS INTEGER) AS failure_rank
FROM per_rule p, totals t""")
def q_dq_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql.window import Window
    card = Q.scorecard(flagged_lines(Tables(spark, sf_dir)), line_rules())
    # one row per rule: a global rank over eight rows
    return card.select(
        "rule_id", "dimension", "evaluated", "valid", "quarantined", "failed",
        round_to("fail_rate", 6).alias("fail_rate"), round_to("pass_rate", 6).alias("pass_rate"),
        F.rank().over(Window.orderBy(F.col("failed").desc())).cast("int").alias("failure_rank"))


# ------------------------------------------------------- silver quality arrays

_EVENT_TYPES = ("click", "view", "purchase", "signup", "error")


def event_rules() -> list[Q.Rule]:
    """Row rules of the events table, the same for the batch and the stream."""
    c = F.col
    return [
        Q.Rule("MISSING_TIMESTAMP", "ts", c("ts").isNotNull(), "completeness", "events", "ts"),
        Q.Rule("MISSING_USER", "user", c("user_id").isNotNull(), "completeness", "events", "user_id"),
        Q.Rule("NONPOSITIVE_EVENT_ID", "event_id", c("event_id") > 0, "validity", "events", "event_id"),
        Q.Rule("UNKNOWN_EVENT_TYPE", "event_type", c("event_type").isin(*_EVENT_TYPES), "validity",
               "events", "event_type", severity="warning"),
        Q.Rule("ZERO_VALUE", "value", c("value") != 0, "reasonability", "events", "value", severity="warning"),
        Q.Rule("HIGH_VALUE", "value", c("value") <= 100, "reasonability", "events", "value", severity="warning"),
        Q.Rule("PROPS_NOT_JSON", "props", F.get_json_object("props", "$.k").isNotNull(), "validity",
               "events", "props", severity="warning"),
        Q.Rule("WEEKEND_EVENT", "ts", ~F.dayofweek("ts").isin(1, 7), "reasonability", "events", "ts",
               severity="warning"),
        *Q.numeric_rules(["value"]),
    ]


def event_quality(t: Tables) -> DataFrame:
    """Silver-style errors/warnings on the events stream (Q05-Q07)."""
    return Q.quality_arrays(t.events, event_rules())


@register("quality_arrays", "Q05 Q06 Q07", """
SELECT event_id, user_id, event_type,
  concat_ws(',',
    CASE WHEN ts IS NULL THEN 'MISSING_TIMESTAMP' END,
    CASE WHEN user_id IS NULL THEN 'MISSING_USER' END,
    CASE WHEN event_id <= 0 THEN 'NONPOSITIVE_EVENT_ID' END,
    CASE WHEN isnan(value) OR abs(value) = 'inf'::DOUBLE THEN 'NONFINITE_VALUE' END)
    AS quality_errors,
  concat_ws(',',
    CASE WHEN event_type NOT IN ('click', 'view', 'purchase', 'signup', 'error') THEN 'UNKNOWN_EVENT_TYPE' END,
    CASE WHEN value = 0 THEN 'ZERO_VALUE' END,
    CASE WHEN value > 100 THEN 'HIGH_VALUE' END,
    CASE WHEN json_extract(props, '$.k') IS NULL THEN 'PROPS_NOT_JSON' END,
    CASE WHEN dayofweek(ts) IN (0, 6) THEN 'WEEKEND_EVENT' END,
    CASE WHEN value < 0 THEN 'NEGATIVE_VALUE' END) AS quality_warnings
FROM events""")
def q_quality_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = event_quality(Tables(spark, sf_dir))
    return q.select("event_id", "user_id", "event_type",
                    F.array_join("quality_errors", ",").alias("quality_errors"),
                    F.array_join("quality_warnings", ",").alias("quality_warnings"))


@register("load_stats", "A20 Q07", """
WITH q AS (
  SELECT (ts IS NULL OR user_id IS NULL OR event_id <= 0 OR isnan(value)
          OR abs(value) = 'inf'::DOUBLE) AS has_error,
         (event_type NOT IN ('click', 'view', 'purchase', 'signup', 'error') OR value = 0
          OR value > 100 OR json_extract(props, '$.k') IS NULL OR dayofweek(ts) IN (0, 6)
          OR value < 0) AS has_warning
  FROM events)
SELECT COUNT(*) AS rows, COUNT(*) FILTER (WHERE has_error) AS invalid,
       COUNT(*) FILTER (WHERE has_warning) AS with_warnings
FROM q""")
def q_load_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.load_stats(event_quality(Tables(spark, sf_dir)))


# --------------------------------------------------- reconciliation

@register("reconcile_totals", "Q02 J12", """
WITH lines AS (
  SELECT l_orderkey, COUNT(*) AS line_count,
         SUM(l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS line_total
  FROM lineitem GROUP BY l_orderkey)
SELECT o.o_orderkey, COALESCE(l.line_count, 0) AS line_count,
       ROUND(COALESCE(l.line_total, 0), 2) AS line_total, o.o_totalprice AS stated_total,
       ROUND(o.o_totalprice - COALESCE(l.line_total, 0), 2) AS difference,
       ROUND(ABS(o.o_totalprice - COALESCE(l.line_total, 0)), 6) <= 0.01 AS reconciles
FROM orders o LEFT JOIN lines l ON o.o_orderkey = l.l_orderkey""")
def q_reconcile_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    from tessera.operators.joins import grain_safe_join
    net = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    j = grain_safe_join(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey",
                        [(t.lineitem, "l_orderkey",
                          [F.count(F.lit(1)).alias("line_count"), F.sum(net).alias("line_total")])])
    total = F.coalesce(F.col("line_total"), F.lit(0.0))
    return j.select(
        "o_orderkey", F.coalesce("line_count", F.lit(0)).alias("line_count"),
        round_to(total, 2).alias("line_total"), F.col("o_totalprice").alias("stated_total"),
        round_to(F.col("o_totalprice") - total, 2).alias("difference"),
        (round_to(F.abs(F.col("o_totalprice") - total), 6) <= 0.01).alias("reconciles"))
