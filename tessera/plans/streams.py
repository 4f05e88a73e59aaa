"""Streaming queries: run an availableNow stream over the driver table, then
read its sink.  The stream's result equals the batch SQL over the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.cleaning import round_to
from tessera import streaming as S
from tessera.plans.governed import event_rules
from tessera.plans.registry import register

_ERR = """concat_ws(',',
    CASE WHEN ts IS NULL THEN 'MISSING_TIMESTAMP' END,
    CASE WHEN user_id IS NULL THEN 'MISSING_USER' END,
    CASE WHEN event_id <= 0 THEN 'NONPOSITIVE_EVENT_ID' END,
    CASE WHEN isnan(value) OR abs(value) = 'inf'::DOUBLE THEN 'NONFINITE_VALUE' END)"""
_WARN = """concat_ws(',',
    CASE WHEN event_type NOT IN ('click', 'view', 'purchase', 'signup', 'error') THEN 'UNKNOWN_EVENT_TYPE' END,
    CASE WHEN value = 0 THEN 'ZERO_VALUE' END,
    CASE WHEN value > 100 THEN 'HIGH_VALUE' END,
    CASE WHEN json_extract(props, '$.k') IS NULL THEN 'PROPS_NOT_JSON' END,
    CASE WHEN dayofweek(ts) IN (0, 6) THEN 'WEEKEND_EVENT' END,
    CASE WHEN value < 0 THEN 'NEGATIVE_VALUE' END)"""


@register("stream_quality_split", "Q05 Q07 streaming", f"""
SELECT event_id, user_id, event_type, {_ERR} AS quality_errors, {_WARN} AS quality_warnings,
       {_ERR} = '' AS is_valid
FROM events QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ts) = 1""")
def q_stream_quality_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = S.run_available_now(S.silver_events(S.read_table_stream(spark, sf_dir, "events"), event_rules()),
                              "silver_events", sf_dir)
    s = spark.read.parquet(out)
    return s.select("event_id", "user_id", "event_type",
                    F.array_join("quality_errors", ",").alias("quality_errors"),
                    F.array_join("quality_warnings", ",").alias("quality_warnings"), "is_valid")


@register("stream_hourly_counts", "A01 streaming window watermark", """
WITH b AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS ws, event_type, COUNT(*) AS events,
             SUM(value) AS total_value FROM events GROUP BY 1, 2)
SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(ws + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end,
       event_type, events, ROUND(total_value, 4) AS total_value
FROM b""")
def q_stream_hourly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = S.run_latest_now(S.hourly_counts(S.read_table_stream(spark, sf_dir, "events")), "hourly_counts", sf_dir,
                         ["w", "event_type"])
    fmt = "yyyy-MM-dd HH:mm:ss"
    return h.select(F.date_format("w.start", fmt).alias("window_start"),
                    F.date_format("w.end", fmt).alias("window_end"), "event_type", "events",
                    round_to("total_value", 4).alias("total_value"))
