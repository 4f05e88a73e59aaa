"""Customer 360: one wide row per customer from eight tables, three ranked contacts (order, event, line),
a survey document in XML and a change hash over all 45 attributes (D03, D04, W01, J01), and XML documents
with namespaces, attributes, ordinality and outer unnest (J05)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.cleaning import clean_text
from tessera.functions.hashing import change_hash
from tessera.functions.xml import parse_xml
from tessera.operators.joins import coalesced_key_join
from tessera.operators.windows import latest_per_key
from tessera.plans.registry import register
from tessera.tables import Tables

# Which order, event and line of a customer is the preferred one, best first.
ORDER_RANKS = {"1-URGENT": 0, "2-HIGH": 1}
EVENT_RANKS = {"purchase": 0, "signup": 1}
LINE_RANKS = {"R": 0, "A": 1}
#: Nodes of a customer's survey document and their types; a node without a value is left out.
SURVEY = {"AnnualSales": "long", "YearOpened": "int", "BusinessType": "string", "Specialty": "string",
          "Internet": "string", "LinesPerOrder": "long"}


def _rank(column: str, ranks: dict[str, int]) -> Column:
    out = None
    for value, place in ranks.items():
        out = F.when(F.col(column) == value, place) if out is None else out.when(F.col(column) == value, place)
    return out.otherwise(len(ranks))


def _rank_sql(column: str, ranks: dict[str, int]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{v}' THEN {n}" for v, n in ranks.items()) + f" ELSE {len(ranks)} END"


def _day(c: str | Column) -> Column:
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyy-MM-dd")


def _money(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def survey_document(values: dict[str, Column]) -> Column:
    """A namespaced document with one node per value that is not NULL."""
    nodes = [F.coalesce(F.concat(F.lit(f"<s:{k}>"), _escaped(v.cast("string")), F.lit(f"</s:{k}>")), F.lit("")) for k, v in values.items()]
    return F.concat(F.lit('<s:Survey xmlns:s="urn:survey">'), *nodes, F.lit("</s:Survey>"))


def customer_360(t: Tables) -> DataFrame:
    """The wide row; every join is on an aggregate or a ranked single row per customer."""
    one = F.count(F.lit(1))
    nation = F.broadcast(t.nation.select("n_nationkey", "n_name", "n_regionkey"))  # 25 rows
    region = F.broadcast(t.region.select("r_regionkey", "r_name"))                 # 5 rows
    suppliers = F.broadcast(t.supplier.groupBy("s_nationkey").agg(                 # one row per nation
        one.alias("suppliers_in_nation"), F.max(_money("s_acctbal")).alias("best_supplier_balance")))
    orders = t.orders.groupBy("o_custkey").agg(
        one.alias("n_orders"), F.sum(_money("o_totalprice")).alias("total_spent"), F.max(_money("o_totalprice")).alias("largest_order"),
        F.min("o_orderdate").alias("first_order"), F.max("o_orderdate").alias("last_order"),
        F.count_if(F.col("o_orderstatus") == "O").alias("open_orders"), F.count_if(F.col("o_orderstatus") == "P").alias("partial_orders"))
    # The preferred line comes from the same pass as the sums: the least of its rank, latest shipment, then keys.
    contact = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", _money("l_quantity").alias("l_quantity"))
    latest = -F.unix_micros(F.col("l_shipdate").cast("timestamp"))
    place = F.struct(_rank("l_returnflag", LINE_RANKS), F.col("l_shipdate").isNull(), latest,
                     "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    lines = (t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_shipdate")
             .join(t.orders.select("o_orderkey", F.col("o_custkey").alias("line_custkey")), F.col("l_orderkey") == F.col("o_orderkey"))
             .groupBy("line_custkey").agg(one.alias("n_lines"), F.sum(_money("l_quantity")).alias("quantity"),
                                          F.count_if(F.col("l_returnflag") == "R").alias("returned_lines"),
                                          F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"),
                                          F.min_by(contact, place).alias("line")))
    events = t.events.groupBy("user_id").agg(
        one.alias("n_events"), F.count_if(F.col("event_type") == "error").alias("n_errors"),
        F.sum(F.when(F.col("event_type") == "purchase", _money("value"))).alias("purchase_value"), F.max("ts").alias("last_event"))
    best_order = latest_per_key(t.orders, ["o_custkey"], [
        _rank("o_orderpriority", ORDER_RANKS), F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey")]).select(
        F.col("o_custkey").alias("best_custkey"), F.col("o_orderkey").alias("preferred_order"),
        F.col("o_orderpriority").alias("preferred_priority"), F.col("o_orderdate").alias("preferred_date"),
        _money("o_totalprice").alias("preferred_price"))
    best_event = latest_per_key(t.events, ["user_id"], [
        _rank("event_type", EVENT_RANKS), F.col("ts").desc_nulls_last(), F.col("event_id")]).select(
        F.col("user_id").alias("best_user"), F.col("event_id").alias("preferred_event"), F.col("event_type").alias("preferred_type"),
        F.col("ts").alias("preferred_event_at"))
    c = t.customer
    w = (c.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
         .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
         .join(suppliers, F.col("c_nationkey") == F.col("s_nationkey"), "left")
         .join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
         .join(lines, F.col("c_custkey") == F.col("line_custkey"), "left")
         .join(best_order, F.col("c_custkey") == F.col("best_custkey"), "left")
         .join(events, F.col("c_custkey") == F.col("user_id"), "left")
         .join(best_event, F.col("c_custkey") == F.col("best_user"), "left"))
    # A customer without a preferred order is referred to customer 0 as its account holder.
    holders = c.select(F.col("c_custkey").alias("holder_key"), clean_text("c_name").alias("account_holder"))
    w = coalesced_key_join(w.withColumns({"own": F.when(F.col("preferred_order").isNotNull(), F.col("c_custkey")),
                                          "house": F.lit(0).cast("long")}), holders, ["own", "house"], "holder_key")
    zero, balance = F.lit(0), F.col("c_acctbal")
    years = F.year("last_order") - F.year("first_order") + 1
    survey = parse_xml(survey_document({
        "AnnualSales": F.floor(F.col("total_spent") / years), "YearOpened": F.year("first_order"), "BusinessType": F.upper(F.substring("c_mktsegment", 1, 2)),
        "Specialty": F.regexp_replace("preferred_priority", "^[0-9]-", ""), "Internet": F.when(F.col("n_events").isNotNull(), "web"),
        "LinesPerOrder": F.floor(F.col("n_lines") / F.col("n_orders"))}), ", ".join(f"{k} {v}" for k, v in SURVEY.items()))
    w = w.withColumn("survey", survey)
    attributes = {
        "customer_name": clean_text("c_name"), "market_segment": F.lower("c_mktsegment"), "nation": F.col("n_name"), "region": F.col("r_name"),
        "account_balance": _money("c_acctbal"), "balance_band": F.when(balance < 0, "negative").when(balance < 5000, "medium").otherwise("high"),
        "suppliers_in_nation": F.coalesce("suppliers_in_nation", zero), "best_supplier_balance": F.col("best_supplier_balance"),
        "n_orders": F.coalesce("n_orders", zero), "total_spent": F.coalesce("total_spent", _money(zero)),
        "largest_order": F.col("largest_order"), "first_order": _day("first_order"), "last_order": _day("last_order"),
        "open_orders": F.coalesce("open_orders", zero), "partial_orders": F.coalesce("partial_orders", zero),
        "n_lines": F.coalesce("n_lines", zero), "quantity": F.col("quantity"), "returned_lines": F.coalesce("returned_lines", zero),
        "last_ship": _day("last_ship"), "preferred_order": F.col("preferred_order"), "preferred_priority": F.col("preferred_priority"),
        "preferred_date": _day("preferred_date"), "preferred_price": F.col("preferred_price"), "account_holder": F.col("account_holder"),
        "n_events": F.coalesce("n_events", zero), "n_errors": F.coalesce("n_errors", zero), "purchase_value": F.col("purchase_value"),
        "preferred_event": F.col("preferred_event"), "preferred_type": F.col("preferred_type"),
        "is_repeat": F.coalesce("n_orders", zero) > 1, "is_active_online": F.col("n_events").isNotNull(),
        "preferred_event_at": _day("preferred_event_at"), "first_ship": _day("first_ship"),
        "mean_order": F.floor(F.col("total_spent") / F.col("n_orders")).cast("long"),
        "preferred_line_order": F.col("line.l_orderkey"), "preferred_part": F.col("line.l_partkey"), "preferred_supplier": F.col("line.l_suppkey"),
        "preferred_quantity": F.col("line.l_quantity"), "preferred_ship": _day(F.col("line.l_shipdate")),
        "annual_sales": F.col("survey.AnnualSales"), "year_opened": F.col("survey.YearOpened"), "business_type": F.col("survey.BusinessType"),
        "specialty": F.col("survey.Specialty"), "internet": F.col("survey.Internet"), "lines_per_order": F.col("survey.LinesPerOrder"),
    }
    modified = F.greatest("first_order", "last_order", "last_ship", "last_event", "preferred_date", "preferred_event_at", "line.l_shipdate")
    return w.select("c_custkey", *[v.cast("string").alias(k) for k, v in attributes.items()], _day(modified).alias("modified_at"),
                    change_hash(attributes).alias("row_hash"))


_ATTRIBUTES_SQL = {
    "customer_name": "NULLIF(trim(regexp_replace(c_name, '\\s+', ' ', 'g')), '')", "market_segment": "lower(c_mktsegment)", "nation": "n_name", "region": "r_name",
    "account_balance": "CAST(c_acctbal AS DECIMAL(18,2))",
    "balance_band": "CASE WHEN c_acctbal < 0 THEN 'negative' WHEN c_acctbal < 5000 THEN 'medium' ELSE 'high' END",
    "suppliers_in_nation": "coalesce(s.suppliers_in_nation, 0)", "best_supplier_balance": "best_supplier_balance",
    "n_orders": "coalesce(n_orders, 0)", "total_spent": "coalesce(total_spent, CAST(0 AS DECIMAL(18,2)))", "largest_order": "largest_order",
    "first_order": "strftime(first_order, '%Y-%m-%d')", "last_order": "strftime(last_order, '%Y-%m-%d')",
    "open_orders": "coalesce(open_orders, 0)", "partial_orders": "coalesce(partial_orders, 0)", "n_lines": "coalesce(n_lines, 0)",
    "quantity": "quantity", "returned_lines": "coalesce(returned_lines, 0)", "last_ship": "strftime(last_ship, '%Y-%m-%d')",
    "preferred_order": "b.o_orderkey", "preferred_priority": "b.o_orderpriority", "preferred_date": "strftime(b.o_orderdate, '%Y-%m-%d')",
    "preferred_price": "CAST(b.o_totalprice AS DECIMAL(18,2))",
    "account_holder": "(SELECT NULLIF(trim(regexp_replace(h.c_name, '\\s+', ' ', 'g')), '') FROM customer h WHERE h.c_custkey = CASE WHEN b.o_orderkey IS NULL THEN 0 ELSE c.c_custkey END)",
    "n_events": "coalesce(n_events, 0)", "n_errors": "coalesce(n_errors, 0)", "purchase_value": "purchase_value",
    "preferred_event": "p.event_id", "preferred_type": "p.event_type",
    "is_repeat": "coalesce(n_orders, 0) > 1", "is_active_online": "n_events IS NOT NULL",
    "preferred_event_at": "strftime(p.ts, '%Y-%m-%d')", "first_ship": "strftime(l.first_ship, '%Y-%m-%d')",
    "mean_order": "CAST(floor(o.total_spent / o.n_orders) AS BIGINT)",
    "preferred_line_order": "k.l_orderkey", "preferred_part": "k.l_partkey", "preferred_supplier": "k.l_suppkey",
    "preferred_quantity": "CAST(k.l_quantity AS DECIMAL(18,2))", "preferred_ship": "strftime(k.l_shipdate, '%Y-%m-%d')",
    "annual_sales": "CAST(floor(o.total_spent / (year(o.last_order) - year(o.first_order) + 1)) AS BIGINT)", "year_opened": "year(o.first_order)",
    "business_type": "upper(substr(c_mktsegment, 1, 2))", "specialty": "regexp_replace(b.o_orderpriority, '^[0-9]-', '')",
    "internet": "CASE WHEN n_events IS NOT NULL THEN 'web' END", "lines_per_order": "l.n_lines // o.n_orders",
}


@register("customer_360", "D03 D04 W01 J01 J06", f"""
WITH s AS (SELECT s_nationkey, COUNT(*) AS suppliers_in_nation, MAX(CAST(s_acctbal AS DECIMAL(18,2))) AS best_supplier_balance FROM supplier GROUP BY 1),
o AS (SELECT o_custkey, COUNT(*) AS n_orders, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS total_spent, MAX(CAST(o_totalprice AS DECIMAL(18,2))) AS largest_order,
             MIN(o_orderdate) AS first_order, MAX(o_orderdate) AS last_order, COUNT(*) FILTER (WHERE o_orderstatus = 'O') AS open_orders,
             COUNT(*) FILTER (WHERE o_orderstatus = 'P') AS partial_orders FROM orders GROUP BY 1),
l AS (SELECT o_custkey, COUNT(*) AS n_lines, SUM(CAST(l_quantity AS DECIMAL(18,2))) AS quantity, COUNT(*) FILTER (WHERE l_returnflag = 'R') AS returned_lines,
             MIN(l_shipdate) AS first_ship, MAX(l_shipdate) AS last_ship FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1),
e AS (SELECT user_id, COUNT(*) AS n_events, COUNT(*) FILTER (WHERE event_type = 'error') AS n_errors,
             SUM(CAST(value AS DECIMAL(18,2))) FILTER (WHERE event_type = 'purchase') AS purchase_value, MAX(ts) AS last_event FROM events GROUP BY 1),
b AS (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY {_rank_sql('o_orderpriority', ORDER_RANKS)}, o_orderdate DESC NULLS LAST, o_orderkey) = 1),
k AS (SELECT o_custkey, lineitem.* FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY {_rank_sql('l_returnflag', LINE_RANKS)}, l_shipdate DESC NULLS LAST, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity) = 1),
p AS (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY {_rank_sql('event_type', EVENT_RANKS)}, ts DESC NULLS LAST, event_id) = 1),
w AS (SELECT c.c_custkey, {", ".join(f"CAST({v} AS VARCHAR) AS {k}" for k, v in _ATTRIBUTES_SQL.items())},
             strftime(greatest(first_order, last_order, last_ship, last_event, b.o_orderdate, p.ts, k.l_shipdate), '%Y-%m-%d') AS modified_at
      FROM customer c LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
      LEFT JOIN s ON s_nationkey = c_nationkey LEFT JOIN o ON o.o_custkey = c.c_custkey LEFT JOIN l ON l.o_custkey = c.c_custkey
      LEFT JOIN k ON k.o_custkey = c.c_custkey LEFT JOIN b ON b.o_custkey = c.c_custkey LEFT JOIN e ON e.user_id = c.c_custkey LEFT JOIN p ON p.user_id = c.c_custkey)
SELECT *, md5(to_json(struct_pack({", ".join(f"{k} := {k}" for k in _ATTRIBUTES_SQL)}))) AS row_hash FROM w""")
def q_customer_360(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_360(Tables(spark, sf_dir))


# ------------------------------------------------------------------- J05

def _escaped(c: str | Column) -> Column:
    out = F.col(c) if isinstance(c, str) else c
    for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(char), F.lit(name))
    return out


def conversation_xml(t: Tables) -> DataFrame:
    """(conv_id, doc): a namespaced document with one element per user turn (none: an empty root)."""
    turn = F.concat(F.lit('<x:Turn n="'), F.col("turn").cast("string"), F.lit('"><x:Text>'), _escaped("text"), F.lit("</x:Text></x:Turn>"))
    said = F.struct("turn", F.when(F.col("role") == "user", turn).alias("xml"))
    g = t.conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(said)).alias("_s"))  # one document's own turns
    body = F.array_join(F.transform("_s", lambda s: s["xml"]), "")
    return g.select("conv_id", F.concat(F.lit('<x:Conversation xmlns:x="urn:turns" id="'), F.col("conv_id").cast("string"),
                                        F.lit('">'), body, F.lit("</x:Conversation>")).alias("doc"))


@register("xml_turns", "J05", """
WITH u AS (SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS place FROM conversations WHERE role = 'user')
SELECT c.conv_id, c.conv_id AS id, CAST(u.place AS INTEGER) AS place, u.turn, u.text
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN u ON c.conv_id = u.conv_id""")
def q_xml_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents parsed by schema: attributes, place of each element, documents without elements kept."""
    parsed = conversation_xml(Tables(spark, sf_dir)).withColumn(
        "d", parse_xml("doc", "_id long, Turn array<struct<_n: long, Text: string>>"))
    return (parsed.select("conv_id", F.col("d._id").alias("id"), F.posexplode_outer("d.Turn").alias("place", "turn"))
            .select("conv_id", "id", (F.col("place") + 1).alias("place"), F.col("turn._n").alias("turn"), F.col("turn.Text").alias("text")))
