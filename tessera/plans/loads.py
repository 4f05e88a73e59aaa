"""Readers and load steps on the given tables: each query writes a table in the
format a reader is for (below the shared checkpoint folder), reads it back with
the operator under test, and must give the source table again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera import sinks, sources
from tessera.functions.cleaning import decode_flag
from tessera.functions.hashing import surrogate_key
from tessera.operators import quality as Q
from tessera.operators import scd
from tessera.operators.joins import coalesced_key_join
from tessera.plans.governed import _SQL_RULES, flagged_lines, line_rules
from tessera.functions.text import strip_html
from tessera.plans.registry import register
from tessera.plans.relational import SNAPSHOT_1, SNAPSHOT_2, _SCD_ATTRS, _snapshot_sql, customer_snapshot
from tessera.session import materialise, scratch_path
from tessera.tables import Tables


def _new(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"loads/{name}-{uuid.uuid4().hex[:12]}")


def _texts(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


# ---------------------------------------------------------------- S01 - S05

_CUSTOMER_TEXT_SQL = """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment
FROM customer"""
_CUSTOMER_COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]


@register("read_tab_delimited", "S01", _CUSTOMER_TEXT_SQL)
def q_read_tab(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _new(spark, "tab")
    Tables(spark, sf_dir).customer.select(*_CUSTOMER_COLUMNS).write.option("sep", "\t").csv(path)
    return sources.read_delimited(spark, path, _CUSTOMER_COLUMNS)


@register("read_multichar_delimited", "S02", _CUSTOMER_TEXT_SQL)
def q_read_multichar(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _new(spark, "multichar")
    c = _texts(Tables(spark, sf_dir).customer.select(*_CUSTOMER_COLUMNS))
    c.select(F.concat(F.concat_ws("+|", *_CUSTOMER_COLUMNS), F.lit("&|"))).write.text(path)
    return sources.read_delimited(spark, path, _CUSTOMER_COLUMNS, sep="+|", record_tail="&|")


_NOTE_SQL = """
SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name || chr(10) || 'nation ' || s_nationkey AS note,
       CAST(s_nationkey AS VARCHAR) AS s_nationkey
FROM supplier"""
_NOTE_COLUMNS = ["s_suppkey", "note", "s_nationkey"]


def _supplier_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = Tables(spark, sf_dir).supplier
    note = F.concat("s_name", F.lit("\nnation "), F.col("s_nationkey").cast("string"))
    return _texts(s.select("s_suppkey", note.alias("note"), "s_nationkey"))


@register("read_terminated", "S03", _NOTE_SQL)
def q_read_terminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _new(spark, "terminated")
    (_supplier_notes(spark, sf_dir).select(F.concat_ws("+|", *_NOTE_COLUMNS))
     .write.option("lineSep", "&|\n").text(path))
    return sources.read_terminated_records(spark, path, _NOTE_COLUMNS)


@register("read_counted_fields", "S04", _NOTE_SQL)
def q_read_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose second field holds a line break: only the number of tabs tells them apart."""
    path = _new(spark, "counted")
    _supplier_notes(spark, sf_dir).select(F.concat_ws("\t", *_NOTE_COLUMNS)).write.text(path)
    return sources.read_by_field_count(spark, path, _NOTE_COLUMNS)


@register("read_strict_csv", "S05", """
SELECT o_orderkey, o_custkey, o_orderstatus, ROUND(o_totalprice, 2) AS o_totalprice FROM orders""")
def q_read_strict_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _new(spark, "csv")
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    o.write.option("header", "true").csv(path)
    return sources.read_csv_strict(spark, path, T.StructType([T.StructField(f.name, f.dataType) for f in o.schema]))


# ------------------------------------------------------- S07 - S12, K07

@register("staged_with_lineage", "S07 K07", """
SELECT event_id, event_type, TRUE AS has_path, TRUE AS has_size, TRUE AS loaded FROM events""")
def q_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, staged = _new(spark, "raw"), _new(spark, "staged")
    Tables(spark, sf_dir).events.select("event_id", "event_type").write.parquet(raw)
    sinks.stage(spark.read.parquet(raw), staged)
    s = spark.read.parquet(staged)
    return s.select("event_id", "event_type", F.endswith("source_path", F.col("source_file")).alias("has_path"),
                    (F.col("source_size") > 0).alias("has_size"),
                    (F.col("loaded_at") >= F.col("source_modified_at")).alias("loaded"))


@register("pinned_snapshots", "S08", """
SELECT 'latest' AS pin, o_orderkey, o_orderstatus FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'
UNION ALL SELECT 'pinned', o_orderkey, o_orderstatus FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'""")
def q_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _new(spark, "snapshots")
    late = F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    (Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderstatus", F.when(late, "b2").otherwise("b1").alias("batch_id"))
     .write.partitionBy("batch_id").parquet(base))
    pins = {"latest": sources.read_snapshot(spark, base), "pinned": sources.read_snapshot(spark, base, "b1")}
    parts = [d.select(F.lit(pin).alias("pin"), "o_orderkey", "o_orderstatus") for pin, d in pins.items()]
    return parts[0].unionByName(parts[1])


@register("registered_files", "S09 K09", "SELECT p_partkey, p_type, p_size FROM part")
def q_registered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every CSV part becomes a view named after its file; the named layer is their union."""
    folder = _new(spark, "files")
    Tables(spark, sf_dir).part.select("p_partkey", "p_type", "p_size").write.option("header", "true").csv(folder)
    names = sources.register_inferred(spark, folder)
    out = spark.table(names[0])
    for n in names[1:]:
        out = out.unionByName(spark.table(n))
    layer = f"parts_{uuid.uuid4().hex[:8]}"
    sinks.create_view(out.select(F.col("p_partkey").cast("long").alias("p_partkey"), "p_type",
                                 F.col("p_size").cast("int").alias("p_size")), layer)
    return spark.table(layer)


# Scenario assumptions.
SCENARIOS = [("base", "A", 1.0), ("base", "R", 0.5), ("stress", "A", 1.2), ("stress", "R", 0.1)]


@register("scenario_table", "S11", """
SELECT s.scenario, l.l_returnflag, COUNT(*) AS lines, ROUND(COUNT(*) * s.factor, 4) AS weighted
FROM lineitem l JOIN (VALUES """ + ", ".join(f"('{s}', '{f}', {w})" for s, f, w in SCENARIOS) + """) s(scenario, flag, factor)
  ON l.l_returnflag = s.flag GROUP BY s.scenario, l.l_returnflag, s.factor""")
def q_scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sources.literal_table(spark, SCENARIOS, "scenario string, flag string, factor double")
    counts = Tables(spark, sf_dir).lineitem.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("lines"))
    return counts.join(s, F.col("l_returnflag") == F.col("flag")).select(
        "scenario", "l_returnflag", "lines", F.round(F.col("lines") * F.col("factor"), 4).alias("weighted"))


@register("file_check", "S12", """
SELECT event_type, COUNT(*) AS rows, TRUE AS files_are_valid FROM events GROUP BY event_type""")
def q_file_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _new(spark, "checked")
    Tables(spark, sf_dir).events.select("event_id", "event_type").write.parquet(path)
    files = sources.check_parquet_files(spark, f"{path}/*.parquet")
    valid = files.agg(F.min(F.col("is_valid").cast("int"))).first()[0]
    return (spark.read.parquet(path).groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"))
            .withColumn("files_are_valid", F.lit(valid == 1)))


@register("corpus_files", "S13", """
SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
         '(?is)<script[^>]*>.*?</script>', ' ', 'g'), '(?is)<style[^>]*>.*?</style>', ' ', 'g'),
         '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')) AS text
FROM pages""")
def q_corpus_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as records of a bounded number of corpus files, the id inside the record."""
    folder = _new(spark, "corpus")
    Tables(spark, sf_dir).pages.select("page_id", "html").write.json(folder)
    corpus = sources.read_corpus(spark, folder, "jsonl", schema="page_id long, html string")
    return corpus.select("page_id", strip_html("html").alias("text"))


# ------------------------------------------------------- K02 K03 K05 K08 K10

@register("layered_load", "K01 K02 K03 K05 K08 K10", """
SELECT c_custkey, CAST(c_acctbal AS DECIMAL(18,2))::DOUBLE AS c_acctbal, c_mktsegment, TRUE AS made_once FROM customer""")
def q_layered_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create the layers and an empty table, load it behind the guards, project it to the declared types."""
    base = _new(spark, "layers")
    sinks.ensure_layers(spark, [f"{layer}_{base[-12:]}" for layer in ("bronze", "silver")], base)
    # Customer keys start at 0; the guard asks for positive ids.
    c = Tables(spark, sf_dir).customer.select((F.col("c_custkey") + 1).alias("id"), "c_acctbal", "c_mktsegment")
    made = [sinks.ensure_table(spark, f"{base}/bronze", c.schema) for _ in range(2)]
    sinks.validated_overwrite(c, f"{base}/bronze", "id")
    declared = T.StructType([T.StructField("id", T.LongType()), T.StructField("c_acctbal", T.DecimalType(18, 2)),
                             T.StructField("c_mktsegment", T.StringType())])
    for _ in range(2):  # a repeated load replaces, it does not add
        sinks.insert_select(spark.read.parquet(f"{base}/bronze"), f"{base}/silver", declared)
    s = spark.read.parquet(f"{base}/silver")
    return s.select((F.col("id") - 1).alias("c_custkey"), F.col("c_acctbal").cast("double").alias("c_acctbal"),
                    "c_mktsegment", F.lit(made == [True, False]).alias("made_once"))


# ------------------------------------------------------------- K04 D15 K11

@register("reload_by_source", "K04 D15", """
SELECT strftime(o_orderdate, '%Y') AS source_file, o_orderkey, o_orderstatus FROM orders""")
def q_reload_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load order years one period after the other, one of them twice; each load replaces its source's rows."""
    path = _new(spark, "by-source")
    o = materialise(Tables(spark, sf_dir).orders.select(
        F.date_format("o_orderdate", "yyyy").alias("source_file"), "o_orderkey", "o_orderstatus"), "orders-by-year")
    years = [r[0] for r in o.select("source_file").distinct().orderBy("source_file").collect()]  # calendar years
    for year in [*years, years[0]]:
        sinks.replace_by_source_file(o.where(F.col("source_file") == year), path)
    return spark.read.option("basePath", path).parquet(path).select(
        F.col("source_file").cast("string").alias("source_file"), "o_orderkey", "o_orderstatus")


@register("submission_check", "K11", """
WITH p AS (SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN c_custkey % 10 = 1 THEN -1.0 ELSE 1.0 END AS pred
           FROM customer WHERE c_custkey % 7 <> 0)
SELECT (SELECT COUNT(*) FROM customer WHERE c_custkey % 7 = 0) AS missing_ids,
       (SELECT COUNT(*) FROM p WHERE c_custkey % 3 = 0) AS extra_ids,
       (SELECT COUNT(*) FROM p WHERE pred IS NULL OR pred < 0) * 1
         + (SELECT COUNT(*) FROM p WHERE c_custkey % 3 = 0 AND (pred IS NULL OR pred < 0)) AS bad_values,
       0 AS duplicate_ids""")
def q_submission_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Tables(spark, sf_dir).customer.select("c_custkey")
    k = F.col("c_custkey")
    pred = (F.when(k % 10 == 0, F.lit(None).cast("double")).when(k % 10 == 1, F.lit(-1.0)).otherwise(F.lit(1.0)))
    p = c.where(k % 7 != 0).withColumn("pred", pred)
    extra = p.where(k % 3 == 0).withColumn("c_custkey", -1 - k)  # ids that no template has
    return sinks.check_submission(p.unionByName(extra), c, "c_custkey", ["pred"])


# ------------------------------------------------------------- J06 P13 D11

@register("coalesced_key_join", "J06", """
SELECT o.o_orderkey, c.c_custkey, c.c_mktsegment
FROM orders o LEFT JOIN customer c
  ON c.c_custkey = COALESCE(CASE WHEN o.o_orderstatus = 'F' THEN o.o_custkey END, o.o_orderkey % 50)""")
def q_coalesced_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    o = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") == "F", F.col("o_custkey")).alias("preferred"),
                        (F.col("o_orderkey") % 50).alias("fallback"))
    return (coalesced_key_join(o, t.customer.select("c_custkey", "c_mktsegment"), ["preferred", "fallback"], "c_custkey")
            .select("o_orderkey", "c_custkey", "c_mktsegment"))


_FLAG_FORMS_SQL = """CASE doc_id % 5 WHEN 0 THEN CAST({c} AS VARCHAR) WHEN 1 THEN ' ' || CAST({c} AS VARCHAR) || ' '
  WHEN 2 THEN CASE {c} WHEN 1 THEN 'TRUE' ELSE 'False' END WHEN 3 THEN 'unknown' END"""


@register("decoded_flags", "P13", f"""
WITH f AS (SELECT doc_id, {_FLAG_FORMS_SQL.format(c='quality')} AS quality, {_FLAG_FORMS_SQL.format(c='toxic')} AS toxic FROM labels)
SELECT doc_id, CASE lower(trim(quality)) WHEN '1' THEN TRUE WHEN 'true' THEN TRUE WHEN '0' THEN FALSE WHEN 'false' THEN FALSE END AS quality,
       CASE lower(trim(toxic)) WHEN '1' THEN TRUE WHEN 'true' THEN TRUE WHEN '0' THEN FALSE WHEN 'false' THEN FALSE END AS toxic
FROM f""")
def q_decoded_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels written in the forms that sources use for a flag, decoded again."""
    def forms(c):
        text, kind = F.col(c).cast("string"), F.col("doc_id") % 5
        return (F.when(kind == 0, text).when(kind == 1, F.concat(F.lit(" "), text, F.lit(" ")))
                .when(kind == 2, F.when(F.col(c) == 1, "TRUE").otherwise("False")).when(kind == 3, "unknown"))
    raw = Tables(spark, sf_dir).labels.select("doc_id", forms("quality").alias("quality"), forms("toxic").alias("toxic"))
    return raw.select("doc_id", decode_flag("quality").alias("quality"), decode_flag("toxic").alias("toxic"))


@register("scd1_customers", "D11", f"""
WITH {_snapshot_sql('s1', SNAPSHOT_1)}, {_snapshot_sql('s2', SNAPSHOT_2)}
SELECT COALESCE(s2.o_custkey, s1.o_custkey) AS o_custkey,
       CASE WHEN s2.o_custkey IS NULL THEN s1.last_status ELSE s2.last_status END AS last_status,
       CASE WHEN s2.o_custkey IS NULL THEN s1.last_priority ELSE s2.last_priority END AS last_priority
FROM s1 FULL JOIN s2 ON s1.o_custkey = s2.o_custkey""")
def q_scd1(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return scd.scd1_apply(customer_snapshot(t, SNAPSHOT_1), customer_snapshot(t, SNAPSHOT_2), "o_custkey", _SCD_ATTRS)


@register("surrogate_keys", "D12", """
SELECT o_orderstatus, COUNT(*) AS rows, COUNT(*) AS distinct_keys, TRUE AS repeatable FROM orders GROUP BY o_orderstatus""")
def q_surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys from business columns: one per order, and the same again from a second computation."""
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderstatus", surrogate_key("o_orderkey", "o_orderdate").alias("sk"))
    again = Tables(spark, sf_dir).orders.select(F.col("o_orderkey").alias("k"), surrogate_key("o_orderkey", "o_orderdate").alias("sk2"))
    per_key = (o.join(again, F.col("o_orderkey") == F.col("k")).groupBy("o_orderstatus", "sk")
               .agg(F.count(F.lit(1)).alias("n"), F.min((F.col("sk") == F.col("sk2")).cast("int")).alias("same")))
    return per_key.groupBy("o_orderstatus").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("distinct_keys"),
                                                (F.min("same") == 1).alias("repeatable"))


# ------------------------------------------------------------------ Q11 Q10

@register("rule_catalogue", "Q11", """
WITH l AS (SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
""" + "\nUNION ALL\n".join(
    f"SELECT '{rid}' AS rule_id, '{rid.lower()}_{name}' AS flag, '{dim}' AS dimension, "
    f"COUNT(*) FILTER (WHERE NOT coalesce({test}, FALSE)) AS failed FROM l" for rid, name, dim, test in _SQL_RULES))
def q_rule_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue table with each rule's failures in the present data."""
    rules = line_rules()
    card = Q.scorecard(flagged_lines(Tables(spark, sf_dir)), rules).select("rule_id", "failed")
    return Q.rule_catalogue(spark, rules).join(card, "rule_id").select("rule_id", "flag", "dimension", "failed")


@register("dimension_scorecard", "Q10", """
WITH l AS (SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
""" + "\nUNION ALL\n".join(
    f"SELECT '{dim}' AS dimension, COUNT(*) AS evaluated, COUNT(*) FILTER (WHERE "
    + " OR ".join(f"NOT coalesce({test}, FALSE)" for _, _, d, test in _SQL_RULES if d == dim) + ") AS failed_rows FROM l"
    for dim in dict.fromkeys(d for _, _, d, _ in _SQL_RULES)))
def q_dimension_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.dimension_scorecard(flagged_lines(Tables(spark, sf_dir)), line_rules()).select(
        "dimension", "evaluated", "failed_rows")


# ---------------------------------------------------------------------- Q13

@register("warehouse_assertions", "Q13", """
SELECT 'key_null' AS assertion, COUNT(*) FILTER (WHERE l_orderkey IS NULL OR l_linenumber IS NULL) AS violations FROM lineitem
UNION ALL SELECT 'key_duplicate', (SELECT COUNT(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1))
UNION ALL SELECT 'missing_order', (SELECT COUNT(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders))
UNION ALL SELECT 'missing_customer', (SELECT COUNT(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer))
UNION ALL SELECT 'missing_part', (SELECT COUNT(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part))
UNION ALL SELECT 'missing_supplier', (SELECT COUNT(*) FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier))
UNION ALL SELECT 'bad_measure', (SELECT COUNT(*) FROM lineitem WHERE NOT (l_quantity > 0 AND l_extendedprice >= 0))
UNION ALL SELECT 'date_order', (SELECT COUNT(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate)""")
def q_warehouse_assertions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per assertion with its number of violations (SCD2 assertions: ``scd2_assertions``)."""
    from tessera.operators.joins import orphans

    t = Tables(spark, sf_dir)
    li, o, one = t.lineitem, t.orders, F.count(F.lit(1))
    checks = {
        "key_null": li.where(F.col("l_orderkey").isNull() | F.col("l_linenumber").isNull()),
        "key_duplicate": Q.duplicate_keys(li, ["l_orderkey", "l_linenumber"]),
        "missing_order": orphans(li, o, "l_orderkey", "o_orderkey"),
        "missing_customer": orphans(o, t.customer, "o_custkey", "c_custkey"),
        "missing_part": orphans(li, t.part, "l_partkey", "p_partkey"),
        "missing_supplier": orphans(li, t.supplier, "l_suppkey", "s_suppkey"),
        "bad_measure": li.where(~((F.col("l_quantity") > 0) & (F.col("l_extendedprice") >= 0))),
        "date_order": li.join(o, li["l_orderkey"] == o["o_orderkey"]).where(F.col("l_shipdate") < F.col("o_orderdate")),
    }
    out = None
    for name, bad in checks.items():
        row = bad.agg(one.alias("violations")).select(F.lit(name).alias("assertion"), "violations")
        out = row if out is None else out.unionByName(row)
    return out
