"""Dimensional-model builders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.dates import date_key, fiscal_parts, weekday_sunday0


def calendar(spark: SparkSession, start: str, end: str, name: str = "full_date") -> DataFrame:
    """One row per day, both ends inclusive."""
    return spark.range(1).select(F.explode(F.sequence(
        F.to_date(F.lit(start)), F.to_date(F.lit(end)), F.expr("INTERVAL 1 DAY"))).alias(name))


def calendar_spanning(df: DataFrame, start: Column, end: Column,
                      name: str = "full_date") -> DataFrame:
    """Calendar covering ``min(start)..max(end)`` of the data.

    One aggregate row, then a generator: the output size is the number of
    days in the span, independent of the input's row count.
    """
    bounds = df.agg(F.min(F.to_date(start)).alias("_lo"), F.max(F.to_date(end)).alias("_hi"))
    return bounds.select(F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 DAY"))).alias(name))


def date_dimension(days: DataFrame, d: str = "full_date") -> DataFrame:
    """date_key yyyymmdd, calendar parts, names, Sunday=0 weekday."""
    c = F.col(d)
    dow = weekday_sunday0(c)
    return days.select(
        date_key(c).alias("date_key"),
        c.alias("full_date"),
        F.year(c).alias("year"),
        F.quarter(c).alias("quarter"),
        F.month(c).alias("month"),
        F.dayofmonth(c).alias("day_of_month"),
        dow.alias("day_of_week"),
        F.date_format(c, "EEEE").alias("day_name"),
        F.date_format(c, "MMMM").alias("month_name"),
        F.date_format(c, "yyyy-MM").alias("year_month"),
        dow.isin(0, 6).alias("is_weekend"))


def fiscal_calendar(days: DataFrame, d: str = "full_date", start_month: int = 11) -> DataFrame:
    """Fiscal year/quarter/month for a year starting ``start_month``/1."""
    parts = fiscal_parts(F.col(d), start_month)
    return days.select(date_key(F.col(d)).alias("date_key"), F.col(d).alias("full_date"),
                       *[v.alias(k) for k, v in parts.items()])
