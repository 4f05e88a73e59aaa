"""Profiles that merge: one row of sketches per load and column (Q12).

A load is profiled once, when it arrives; its sketches are stored beside those of earlier loads.  The
profile of the whole table unites the stored rows and reads no data again: counts are added,
extremes compared, HyperLogLog sketches united for distinct values, KLL sketches merged for quantiles.
A row is a few KB however many rows its load has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

#: 2^12 registers: a relative standard error of 1.04 / sqrt(2^12), 1.6 %.
HLL_BITS = 12
DISTINCT_ERROR = 3 * 1.04 / 2 ** (HLL_BITS / 2)
#: KLL with k = 200: ranks are off by less than 1.65 % of the rows with 99 % confidence; twice that is allowed.
KLL_K = 200
RANK_ERROR = 2 * 0.0165


def _sketch(df: DataFrame, c: str) -> Column:
    x, numeric = F.col(f"`{c}`"), isinstance(df.schema[c].dataType, NumericType)
    # Non-finite numbers have no place in an order of quantiles; NULL leaves them out.
    number = F.when(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")), x.cast("double")) if numeric else F.lit(None).cast("double")
    text = F.lit(None).cast("string") if numeric else x.cast("string")
    return F.struct(F.lit(c).alias("column_name"), F.count(F.lit(1)).alias("rows"), F.count_if(x.isNull()).alias("nulls"),
                    F.min(number).alias("low"), F.max(number).alias("high"), F.min(text).alias("first_text"), F.max(text).alias("last_text"),
                    F.hll_sketch_agg(x.cast("string"), HLL_BITS).alias("distinct_sketch"),
                    F.kll_sketch_agg_double(number, KLL_K).alias("rank_sketch"))


def sketch_loads(df: DataFrame, cols: Sequence[str], load: Column) -> DataFrame:
    """One row per load and column, in one pass with partial aggregation.

    NULLs are counted and enter no sketch; NaN and infinity count as values but have no rank.  Dates, flags and
    texts are compared as text.  A NULL load is a load of its own; an empty table gives no rows.
    """
    wide = df.groupBy(load.alias("load_id")).agg(*[_sketch(df, c).alias(f"_{k}") for k, c in enumerate(cols)])
    return wide.select("load_id", F.inline(F.array(*[F.col(f"_{k}") for k in range(len(cols))])))


def store_loads(sketches: DataFrame, path: str) -> None:
    """Add loads to a stored profile; a load that is stored again replaces its earlier rows and no others."""
    sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load_id").parquet(path)


def united_profile(stored: DataFrame, quantiles: dict[str, float]) -> DataFrame:
    """One row per column over all stored loads, from their sketches alone.

    ``distinct_values`` has a relative error of ``DISTINCT_ERROR`` (three standard errors); each quantile (NULL
    without numbers) is a value of the column whose rank is off by less than ``RANK_ERROR`` of the rows.
    """
    one = stored.groupBy("column_name").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.min("first_text").alias("first_text"), F.max("last_text").alias("last_text"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct_values"), F.kll_merge_agg_double("rank_sketch").alias("_ranks"))
    # An empty sketch has no quantile to give.
    return one.select("*", *[F.when(F.col("low").isNotNull(), F.kll_sketch_get_quantile_double("_ranks", F.lit(q))).alias(name)
                             for name, q in quantiles.items()]).drop("_ranks")
