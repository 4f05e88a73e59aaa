"""Brief-level queries and the remaining inventory items over the driver tables."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.cleaning import round_to
from tessera.functions.dates import date_key, iso_weekday
from tessera.operators import allocate as X
from tessera.operators import evaluate as E
from tessera.operators import quality as Q
from tessera.operators import stats as S
from tessera.operators.windows import global_row_number, join_null_safe, ntile_from_rank, running_total
from tessera.plans.evaluation import _SCORED_SQL, _SEG_SQL, customer_segments, scored_documents
from tessera.plans.registry import register
from tessera.session import materialise
from tessera.sources.readers import read_parquet_cast
from tessera.tables import Tables, table_path


def _d(c) -> F.Column:
    return F.date_format(c, "yyyy-MM-dd")


@register("prior_spend", "W04 W08", """
SELECT o_custkey, o_orderkey, ROUND(o_totalprice, 2) AS o_totalprice,
       ROUND(COALESCE(SUM(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 2) AS prior_spend
FROM orders""")
def q_prior_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = Tables(spark, sf_dir).orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    # Exclusive prefix per customer from the range-partitioned running total,
    # so a customer with a third of all orders is still split across tasks.
    r = running_total(o, [F.col("o_orderdate"), F.col("o_orderkey")], "o_totalprice", "_cum",
                      keys=["o_custkey"])
    return r.select("o_custkey", "o_orderkey", round_to("o_totalprice", 2).alias("o_totalprice"),
                    round_to(F.col("_cum") - F.col("o_totalprice"), 2).alias("prior_spend"))


@register("fulfilment", "A25 G16 J02", """
SELECT o.o_orderpriority, COUNT(*) AS lines,
       ROUND(AVG(CASE WHEN l.l_linestatus = 'F' THEN 1.0 ELSE 0.0 END), 6) AS shipped_share,
       ROUND(AVG(date_diff('day', o.o_orderdate::DATE, l.l_shipdate::DATE)), 4) AS avg_days_to_ship,
       COUNT(*) FILTER (WHERE l.l_linestatus = 'O') AS open_lines
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1""")
def q_fulfilment(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    li = t.lineitem.select("l_orderkey", "l_linestatus", "l_shipdate")
    o = t.orders.select("o_orderkey", "o_orderdate", "o_orderpriority")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("lines"),
        round_to(F.avg(F.when(F.col("l_linestatus") == "F", 1.0).otherwise(0.0)), 6).alias("shipped_share"),
        round_to(F.avg(F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate"))), 4).alias("avg_days_to_ship"),
        F.count_if(F.col("l_linestatus") == "O").alias("open_lines"))


@register("dim_nation", "D07 D08 J01 P01", """
SELECT n.n_nationkey AS nation_key, n.n_name AS nation_name, r.r_name AS region_name
FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")
def q_dim_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return (t.nation.join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey"), "left")
            .select(F.col("n_nationkey").alias("nation_key"), F.col("n_name").alias("nation_name"),
                    F.col("r_name").alias("region_name")))


@register("fact_order_lines", "D13 J02 P01 P02 G16", """
SELECT l.l_orderkey, l.l_linenumber, o.o_custkey, l.l_partkey, l.l_suppkey,
       CAST(strftime(o.o_orderdate, '%Y%m%d') AS INTEGER) AS order_date_key,
       CAST(strftime(l.l_shipdate, '%Y%m%d') AS INTEGER) AS ship_date_key,
       l.l_quantity AS quantity, l.l_extendedprice AS extended_amount,
       ROUND(l.l_extendedprice * l.l_discount, 4) AS discount_amount,
       ROUND(l.l_extendedprice * (1 - l.l_discount) * l.l_tax, 4) AS tax_amount,
       ROUND(l.l_extendedprice * (1 - l.l_discount) * (1 + l.l_tax), 4) AS net_amount,
       date_diff('day', o.o_orderdate::DATE, l.l_shipdate::DATE) AS ship_lag_days
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")
def q_fact_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    li = t.lineitem
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    p, d, x = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    return j.select("l_orderkey", "l_linenumber", "o_custkey", "l_partkey", "l_suppkey",
                    date_key("o_orderdate").alias("order_date_key"),
                    date_key("l_shipdate").alias("ship_date_key"),
                    F.col("l_quantity").alias("quantity"), p.alias("extended_amount"),
                    round_to(p * d, 4).alias("discount_amount"),
                    round_to(p * (1 - d) * x, 4).alias("tax_amount"),
                    round_to(p * (1 - d) * (1 + x), 4).alias("net_amount"),
                    F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate")).cast("long")
                    .alias("ship_lag_days"))


@register("silver_events", "D14 G11 P11", """
SELECT event_id, user_id, upper(trim(event_type)) AS event_type, strftime(ts, '%Y-%m-%d') AS event_date,
       CAST(year(ts) AS INTEGER) AS event_year, CAST(month(ts) AS INTEGER) AS event_month,
       CAST(hour(ts) AS INTEGER) AS event_hour, CAST(isodow(ts) AS INTEGER) AS iso_weekday,
       isodow(ts) IN (6, 7) AS is_weekend,
       CAST(hour(ts) * 60 + minute(ts) AS INTEGER) AS minutes_since_midnight,
       hour(ts) BETWEEN 7 AND 9 OR hour(ts) BETWEEN 16 AND 19 AS rush_hour,
       ROUND(sin(2 * pi() * hour(ts) / 24), 6) AS hour_sin,
       ROUND(cos(2 * pi() * hour(ts) / 24), 6) AS hour_cos,
       TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS props_k
FROM events""")
def q_silver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = Tables(spark, sf_dir).events
    h = F.hour("ts")
    return e.select(
        "event_id", "user_id", F.upper(F.trim("event_type")).alias("event_type"),
        _d("ts").alias("event_date"), F.year("ts").alias("event_year"), F.month("ts").alias("event_month"),
        h.alias("event_hour"), iso_weekday("ts").alias("iso_weekday"),
        iso_weekday("ts").isin(6, 7).alias("is_weekend"),
        (h * 60 + F.minute("ts")).alias("minutes_since_midnight"),
        (h.between(7, 9) | h.between(16, 19)).alias("rush_hour"),
        round_to(F.sin(2 * math.pi * h / 24), 6).alias("hour_sin"),
        round_to(F.cos(2 * math.pi * h / 24), 6).alias("hour_cos"),
        F.get_json_object("props", "$.k").try_cast("int").alias("props_k"))


@register("demand_profile", "G14 A01", """
SELECT CAST(isodow(ts) AS INTEGER) AS iso_weekday, CAST(hour(ts) AS INTEGER) AS event_hour,
       COUNT(*) AS events, ROUND(AVG(value), 6) AS avg_value
FROM events GROUP BY 1, 2""")
def q_demand_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = Tables(spark, sf_dir).events
    return e.groupBy(iso_weekday("ts").alias("iso_weekday"), F.hour("ts").alias("event_hour")).agg(
        F.count(F.lit(1)).alias("events"), round_to(F.avg("value"), 6).alias("avg_value"))


@register("product_performance", "G03 A02", """
WITH p AS (SELECT l_partkey, SUM(l_quantity) AS units,
                  ROUND(SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))), 2) AS revenue
           FROM lineitem GROUP BY 1)
SELECT l_partkey, CAST(revenue AS DOUBLE) AS revenue, units,
       CAST(ntile(4) OVER (ORDER BY revenue, l_partkey) AS INTEGER) AS revenue_quartile,
       CAST(ntile(4) OVER (ORDER BY units, l_partkey) AS INTEGER) AS units_quartile
FROM p""")
def q_product_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = Tables(spark, sf_dir).lineitem
    price, discount = F.col("l_extendedprice").cast("decimal(18,2)"), F.col("l_discount").cast("decimal(4,2)")
    p = materialise(li.groupBy("l_partkey").agg(
        F.sum(price * (1 - discount)).cast("decimal(28,2)").alias("revenue"),
        F.sum("l_quantity").alias("units")), "products")
    out = p
    for name, order in [("revenue_quartile", [F.col("revenue"), F.col("l_partkey")]),
                        ("units_quartile", [F.col("units"), F.col("l_partkey")])]:
        r = global_row_number(p, order, "_r", total_name="_n")
        out = join_null_safe(out, r.select("l_partkey", ntile_from_rank(F.col("_r"), F.col("_n"), 4).alias(name)),
                             ["l_partkey"])
    return out.withColumn("revenue", F.col("revenue").cast("double"))


@register("market_comparison", "G05 A24", """
SELECT n.n_name AS nation, COUNT(DISTINCT o.o_custkey) AS customers, COUNT(*) AS orders,
       CAST(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
       ROUND(CAST(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*), 4) AS avg_order_value
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY 1""")
def q_market_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    cust = t.customer.select("c_custkey", "c_nationkey")
    nation = F.broadcast(t.nation.select("n_nationkey", F.col("n_name").alias("nation")))
    j = (t.orders.select("o_custkey", "o_totalprice")
         .join(cust, F.col("o_custkey") == F.col("c_custkey"))
         .join(nation, F.col("c_nationkey") == F.col("n_nationkey")))
    # Customers first, nations second: no task holds the set of a nation's customers.
    per = j.groupBy("nation", "o_custkey").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("s"))
    revenue = F.sum("s").cast("double")
    return per.groupBy("nation").agg(F.count(F.lit(1)).alias("customers"), F.sum("n").alias("orders"), revenue.alias("revenue"),
                                     round_to(revenue / F.sum("n"), 4).alias("avg_order_value"))


@register("return_rate", "G06 J13 A06 A07", """
WITH j AS (SELECT n.n_name AS nation, l.l_returnflag, l.l_extendedprice
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
           JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey),
g AS (SELECT nation, COUNT(*) AS lines, COUNT(*) FILTER (WHERE l_returnflag = 'R') AS returned,
             SUM(CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0 END) AS returned_value FROM j GROUP BY 1)
SELECT nation, lines, returned, ROUND(returned_value, 2) AS returned_value,
       ROUND(returned / lines, 6) AS return_rate,
       ROUND(round(returned_value, 2) / SUM(round(returned_value, 2)) OVER (), 6) AS value_share
FROM g""")
def q_return_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    cust = t.customer.select("c_custkey", "c_nationkey")
    nation = F.broadcast(t.nation.select("n_nationkey", F.col("n_name").alias("nation")))
    j = (t.lineitem.select("l_orderkey", "l_returnflag", "l_extendedprice")
         .join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
         .join(cust, F.col("o_custkey") == F.col("c_custkey"))
         .join(nation, F.col("c_nationkey") == F.col("n_nationkey")))
    ret = F.col("l_returnflag") == "R"
    g = j.groupBy("nation").agg(F.count(F.lit(1)).alias("lines"), F.count_if(ret).alias("returned"),
                                round_to(F.sum(F.when(ret, F.col("l_extendedprice")).otherwise(0.0)), 2)
                                .alias("returned_value"))
    total = g.select(F.sum("returned_value")).scalar()  # one row per nation
    return g.select("nation", "lines", "returned", "returned_value",
                    round_to(F.col("returned") / F.col("lines"), 6).alias("return_rate"),
                    round_to(F.col("returned_value") / total, 6).alias("value_share"))


@register("chronological_split", "M02", """
WITH c AS (SELECT quantile_cont(epoch_us(o_orderdate), 0.8) AS cut FROM orders)
SELECT CASE WHEN epoch_us(o_orderdate) <= cut THEN 'train' ELSE 'test' END AS split, COUNT(*) AS n,
       strftime(min(o_orderdate), '%Y-%m-%d') AS first_date, strftime(max(o_orderdate), '%Y-%m-%d') AS last_date
FROM orders, c GROUP BY 1""")
def q_chronological_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = E.chronological_split(Tables(spark, sf_dir).orders, "o_orderdate", 0.8)
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n"), _d(F.min("o_orderdate")).alias("first_date"),
                                  _d(F.max("o_orderdate")).alias("last_date"))


@register("zero_rule", "M03", """
SELECT quality AS majority_class, COUNT(*) AS n, ROUND(COUNT(*) / (SELECT COUNT(*) FROM labels), 6) AS accuracy
FROM labels GROUP BY quality ORDER BY n DESC, quality LIMIT 1""")
def q_zero_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = Tables(spark, sf_dir).labels
    total = lab.select(F.count(F.lit(1))).scalar()
    m = E.majority_class(lab, "quality")
    return m.select(F.col("quality").alias("majority_class"), "n", round_to(F.col("n") / total, 6).alias("accuracy"))


@register("one_rule", "M34", "\nUNION ALL\n".join(f"""
SELECT '{f}' AS feature, COUNT(*) AS levels, ROUND(SUM(best) / SUM(total), 6) AS accuracy FROM (
  SELECT {f}, MAX(n) AS best, SUM(n) AS total FROM (
    SELECT d.{f}, l.quality, COUNT(*) AS n FROM labels l JOIN documents d ON l.doc_id = d.doc_id GROUP BY 1, 2)
  GROUP BY 1)""" for f in ("lang", "source")))
def q_one_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    j = t.labels.join(t.documents.select("doc_id", "lang", "source"), "doc_id")
    out = None
    for f in ("lang", "source"):
        per = j.groupBy(f, "quality").agg(F.count(F.lit(1)).alias("n")).groupBy(f).agg(
            F.max("n").alias("best"), F.sum("n").alias("total"))
        r = per.agg(F.lit(f).alias("feature"), F.count(F.lit(1)).alias("levels"),
                    round_to(F.sum("best") / F.sum("total"), 6).alias("accuracy"))
        out = r if out is None else out.unionByName(r)
    return out


@register("fold_stability", "M35", f"""
WITH {_SCORED_SQL},
f AS (SELECT *, ntile(5) OVER (ORDER BY doc_id) AS fold FROM scored WHERE model = 'length'),
a AS (SELECT fold, AVG(CASE WHEN (score >= 0.5) = (truth = 1) THEN 1.0 ELSE 0.0 END) AS acc FROM f GROUP BY 1)
SELECT COUNT(*) AS folds, ROUND(AVG(acc), 6) AS mean_accuracy, ROUND(stddev_samp(acc), 6) AS sd_accuracy FROM a""")
def q_fold_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = scored_documents(Tables(spark, sf_dir)).where(F.col("model") == "length")
    s = global_row_number(s, [F.col("doc_id")], "_r", total_name="_n")
    s = s.withColumn("fold", ntile_from_rank(F.col("_r"), F.col("_n"), 5))
    hit = ((F.col("score") >= 0.5) == (F.col("truth") == 1)).cast("double")
    a = s.groupBy("fold").agg(F.avg(hit).alias("acc"))
    return a.agg(F.count(F.lit(1)).alias("folds"), round_to(F.avg("acc"), 6).alias("mean_accuracy"),
                 round_to(F.stddev_samp("acc"), 6).alias("sd_accuracy"))


# Unit steps reported for the fitted slope.
UNIT_STEPS = [1, 100, 500]


@register("unit_effects", "T08 T06", "SELECT units, ROUND(units * regr_slope(l_extendedprice, l_quantity), 4) AS effect "
          "FROM lineitem, (SELECT unnest([" + ", ".join(map(str, UNIT_STEPS)) + "]) AS units) u GROUP BY units")
def q_unit_effects(spark: SparkSession, sf_dir: str) -> DataFrame:
    fit = S.simple_ols(Tables(spark, sf_dir).lineitem, "l_extendedprice", "l_quantity")
    u = fit.select(F.explode(F.array(*[F.lit(x) for x in UNIT_STEPS])).alias("units"), "slope")
    return u.select("units", round_to(F.col("units") * F.col("slope"), 4).alias("effect"))


@register("fit_compare", "T09 U01", "\nUNION ALL\n".join(f"""
SELECT '{x}' AS predictor, ROUND(regr_r2(l_extendedprice, {x}), 6) AS r2, regr_count(l_extendedprice, {x}) AS n,
       ROUND(sqrt(regr_syy(l_extendedprice, {x}) * (1 - regr_r2(l_extendedprice, {x})) / (regr_count(l_extendedprice, {x}) - 2)), 4) AS sigma
FROM lineitem""" for x in ("l_quantity", "l_discount")))
def q_fit_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = Tables(spark, sf_dir).lineitem
    out = None
    for x in ("l_quantity", "l_discount"):
        f = S.simple_ols(li, "l_extendedprice", x).select(
            F.lit(x).alias("predictor"), round_to("r2", 6).alias("r2"), "n", round_to("sigma", 4).alias("sigma"))
        out = f if out is None else out.unionByName(f)
    return out


@register("heuristic_roi_portfolio", "X09 X05 W05", f"""
WITH {_SEG_SQL},
best AS (SELECT *, (avoided - program_cost) / program_cost AS roi FROM opt
         QUALIFY row_number() OVER (PARTITION BY segment ORDER BY (avoided - program_cost) / program_cost DESC, intervention) = 1),
r AS (SELECT *, SUM(program_cost) OVER w AS cumulative_cost, row_number() OVER w AS rank
      FROM best WINDOW w AS (ORDER BY roi DESC, segment ROWS UNBOUNDED PRECEDING))
SELECT segment, intervention, CAST(program_cost AS BIGINT) AS program_cost,
       CAST(cumulative_cost AS BIGINT) AS cumulative_cost, rank, ROUND(roi, 6) AS expected_roi
FROM r WHERE cumulative_cost <= {X.ANNUAL_BUDGET} AND rank <= {X.MAXIMUM_PROGRAMS}""")
def q_heuristic_roi_portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql.window import Window
    from tessera.operators.windows import running_selection
    o = X.decision_options(customer_segments(Tables(spark, sf_dir)))
    w = Window.partitionBy("segment").orderBy(F.col("expected_roi").desc(), F.col("intervention"))
    best = o.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    h = running_selection(best, [F.col("expected_roi").desc(), F.col("segment").asc()], "program_cost",
                          X.ANNUAL_BUDGET, X.MAXIMUM_PROGRAMS)
    return h.select("segment", "intervention", "program_cost",
                    F.col("cumulative_cost").cast("long").alias("cumulative_cost"), "rank",
                    round_to("expected_roi", 6).alias("expected_roi"))


#: Programs of one intervention at most, and the replacement times to compare (months).
PER_INTERVENTION, MONTHS = 2, (3, 6, 9, 12)


@register("heuristic_capped_portfolio", "X09", f"""
WITH {_SEG_SQL},
ranked AS (SELECT *, ROUND((avoided - program_cost) / program_cost, 9) AS roi FROM opt),
best AS (SELECT * FROM ranked QUALIFY row_number() OVER (PARTITION BY segment ORDER BY roi DESC, intervention) = 1),
few AS (SELECT * FROM best QUALIFY row_number() OVER (PARTITION BY intervention ORDER BY roi DESC, segment) <= {PER_INTERVENTION}),
r AS (SELECT *, SUM(program_cost) OVER w AS cumulative_cost, row_number() OVER w AS rank
      FROM few WINDOW w AS (ORDER BY roi DESC, segment ROWS UNBOUNDED PRECEDING))
SELECT segment, intervention, CAST(program_cost AS BIGINT) AS program_cost, CAST(cumulative_cost AS BIGINT) AS cumulative_cost, rank
FROM r WHERE cumulative_cost <= {X.ANNUAL_BUDGET} AND rank <= {X.MAXIMUM_PROGRAMS}""")
def q_heuristic_capped_portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best return first, with a few programs of each intervention at most."""
    from tessera.operators.windows import latest_per_key, running_selection
    o = X.decision_options(customer_segments(Tables(spark, sf_dir))).withColumn("roi", round_to("expected_roi", 9))
    best = latest_per_key(o, ["segment"], [F.col("roi").desc(), F.col("intervention")])
    few = latest_per_key(best, ["intervention"], [F.col("roi").desc(), F.col("segment")], PER_INTERVENTION)
    h = running_selection(few, [F.col("roi").desc(), F.col("segment").asc()], "program_cost", X.ANNUAL_BUDGET, X.MAXIMUM_PROGRAMS)
    return h.select("segment", "intervention", "program_cost", F.col("cumulative_cost").cast("long").alias("cumulative_cost"), "rank")


@register("replacement_months", "X09 X01", f"""
WITH {_SEG_SQL}
SELECT m.months, COUNT(*) AS segments, ROUND(SUM(total_exposure * m.months / {X.REPLACEMENT_MONTHS}), 2) AS total_exposure,
       COUNT(*) FILTER (WHERE total_exposure * m.months / {X.REPLACEMENT_MONTHS} > 100000) AS large_segments
FROM seg, (SELECT unnest([{", ".join(map(str, MONTHS))}]) AS months) m GROUP BY m.months""")
def q_replacement_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exposure under other replacement times: the months are a parameter list applied to segments."""
    seg = customer_segments(Tables(spark, sf_dir)).withColumn("months", F.explode(F.array(*[F.lit(m) for m in MONTHS])))
    e = F.col("total_exposure") * F.col("months") / X.REPLACEMENT_MONTHS
    return seg.groupBy("months").agg(F.count(F.lit(1)).alias("segments"), round_to(F.sum(e), 2).alias("total_exposure"),
                                     F.count_if(e > 100000).alias("large_segments"))


@register("drift_psi", "Q15", """
WITH d AS (SELECT d.lang, l.doc_id IS NOT NULL AS labelled FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
e AS (SELECT lang, COUNT(*) AS e_n FROM d WHERE labelled GROUP BY 1),
a AS (SELECT lang, COUNT(*) AS a_n FROM d WHERE NOT labelled GROUP BY 1),
j AS (SELECT COALESCE(e.lang, a.lang) AS lang, COALESCE(e_n, 0) AS e_n, COALESCE(a_n, 0) AS a_n
      FROM e FULL JOIN a ON e.lang = a.lang),
p AS (SELECT lang, greatest(e_n / SUM(e_n) OVER (), 1e-6) AS e_p, greatest(a_n / SUM(a_n) OVER (), 1e-6) AS a_p FROM j)
SELECT lang, ROUND(e_p, 6) AS expected_share, ROUND(a_p, 6) AS actual_share,
       ROUND((a_p - e_p) * ln(a_p / e_p), 9) AS psi FROM p""")
def q_drift_psi(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    d = t.documents.select("doc_id", "lang")
    lab = t.labels.select("doc_id")
    expected = d.join(lab, "doc_id", "left_semi")
    actual = d.join(lab, "doc_id", "left_anti")
    p = Q.population_stability(expected, actual, "lang")
    return p.select("lang", round_to("e_p", 6).alias("expected_share"), round_to("a_p", 6).alias("actual_share"),
                    round_to("psi", 9).alias("psi"))


@register("segment_review_flags", "Q16 X02", f"""
WITH {_SEG_SQL}
SELECT segment, members, ROUND(mean_risk, 6) AS mean_risk, members < 10 AS small_group,
       mean_risk >= 0.5 AS high_risk FROM seg""")
def q_segment_review_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = Q.review_flags(customer_segments(Tables(spark, sf_dir)), "members", "mean_risk")
    return s.select("segment", "members", round_to("mean_risk", 6).alias("mean_risk"), "small_group", "high_risk")


@register("typed_lineitem", "S06 P12 P01", """
SELECT CAST(l_orderkey AS BIGINT) AS order_key, CAST(l_linenumber AS INTEGER) AS line_number,
       CAST(l_quantity AS INTEGER) AS quantity, CAST(l_extendedprice AS DOUBLE) AS extended_price,
       strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d') AS ship_date
FROM lineitem""")
def q_typed_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read_parquet_cast(spark, table_path(sf_dir, "lineitem"),
                           {"l_orderkey": "bigint", "l_linenumber": "int", "l_quantity": "int",
                            "l_extendedprice": "double", "l_shipdate": "date"},
                           {"l_orderkey": "order_key", "l_linenumber": "line_number", "l_quantity": "quantity",
                            "l_extendedprice": "extended_price", "l_shipdate": "ship_date"})
    return df.withColumn("ship_date", _d("ship_date"))


# ------------------------------------------------------------ guards, cleaning

_KEYS = [("orders", "o_orderkey"), ("customer", "c_custkey"), ("part", "p_partkey"),
         ("supplier", "s_suppkey")]


@register("load_guard_report", "Q08 A11", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS rows, COUNT(*) FILTER (WHERE {k} IS NULL OR {k} <= 0) AS invalid_ids, "
    f"COUNT({k}) - COUNT(DISTINCT {k}) AS duplicate_ids FROM {t}" for t, k in _KEYS))
def q_load_guard_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    out = None
    for name, key in _KEYS:
        df = getattr(t, name)
        r = df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows"),
                   F.count_if(F.col(key).isNull() | (F.col(key) <= 0)).alias("invalid_ids"),
                   (F.count(key) - F.count_distinct(key)).alias("duplicate_ids"))
        out = r if out is None else out.unionByName(r)
    return out


@register("period_consistency", "Q09 A06", """
SELECT strftime(o.o_orderdate, '%Y-%m') AS order_month, COUNT(*) AS lines,
       COUNT(*) FILTER (WHERE strftime(l.l_shipdate, '%Y-%m') <> strftime(o.o_orderdate, '%Y-%m')) AS shipped_outside_month
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1""")
def q_period_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    j = (t.lineitem.select("l_orderkey", "l_shipdate")
         .join(t.orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey")))
    month = F.date_format("o_orderdate", "yyyy-MM")
    return j.groupBy(month.alias("order_month")).agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.date_format("l_shipdate", "yyyy-MM") != month).alias("shipped_outside_month"))


@register("one_hot_check", "Q14", """
WITH h AS (SELECT (l_returnflag = 'A')::INT + (l_returnflag = 'N')::INT + (l_returnflag = 'R')::INT AS active
           FROM lineitem)
SELECT COUNT(*) AS rows, COUNT(*) FILTER (WHERE active <> 1) AS violations FROM h""")
def q_one_hot_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = Tables(spark, sf_dir).lineitem
    ind = li.select(*[(F.col("l_returnflag") == v).cast("int").alias(f"flag_{v}") for v in "ANR"])
    v = Q.one_hot_violations(ind, ["flag_A", "flag_N", "flag_R"])
    return li.agg(F.count(F.lit(1)).alias("rows")).select("rows", v.select(F.count(F.lit(1))).scalar()
                                                          .alias("violations"))


@register("customer_profile", "P05 P10 P14 P15 P17 P18", """
SELECT c_custkey AS c_custkey, COALESCE(NULLIF(trim(c_name), ''), 'Customer ' || CAST(c_custkey AS VARCHAR)) AS display_name,
       lower(c_mktsegment) AS market_segment, c_acctbal AS account_balance,
       c_acctbal BETWEEN 0 AND 5000 AND c_mktsegment IN ('AUTOMOBILE', 'BUILDING') AS in_target
FROM customer WHERE c_custkey IS NOT NULL""")
def q_customer_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.functions.cleaning import blank_to_null, clean_names, drop_if_present
    c = Tables(spark, sf_dir).customer
    # source-style names -> snake_case (P17); absent names are ignored
    src = c.toDF("C Custkey", "C Name", "C-Nationkey", "C Acctbal", "C.Mktsegment")
    d = drop_if_present(clean_names(src), "c_nationkey", "c_comment")
    d = d.dropna(subset=["c_custkey"])  # listwise deletion on the key (P15)
    # BETWEEN and IN as a flag: every customer stays
    target = F.col("c_acctbal").between(0, 5000) & F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING")
    name = F.coalesce(blank_to_null("c_name"), F.concat(F.lit("Customer "), F.col("c_custkey").cast("string")))
    return d.select("c_custkey", name.alias("display_name"), F.lower("c_mktsegment").alias("market_segment"),
                    F.col("c_acctbal").alias("account_balance"), target.alias("in_target"))


@register("category_standardization", "G10 P11 A01", """
SELECT upper(substr(lower(trim(p_type)), 1, 1)) || substr(lower(trim(p_type)), 2) AS category,
       COUNT(*) AS parts, ROUND(AVG(p_retailprice), 4) AS avg_price
FROM part GROUP BY 1""")
def q_category_standardization(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.functions.cleaning import clean_text
    p = Tables(spark, sf_dir).part
    v = F.lower(clean_text("p_type"))
    cat = F.concat(F.upper(F.substring(v, 1, 1)), F.substr(v, F.lit(2)))
    return p.groupBy(cat.alias("category")).agg(F.count(F.lit(1)).alias("parts"),
                                                round_to(F.avg("p_retailprice"), 4).alias("avg_price"))
