"""Aggregations and profiles.

Everything is a single (partial, map-side combined) aggregation or a
pivot/unpivot around one; exact quantiles look up ranks in running totals.
Nothing gathers the rows of a group in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.windows import exact_quantiles, join_null_safe


def group_summary(df: DataFrame, by: Sequence[str], value: str,
                  extra: Sequence[Column] = ()) -> DataFrame:
    """n, mean, exact (interpolated) median, min, max, sample sd per group.

    ``extra`` aggregates are computed in one pass, the median by rank lookup.
    """
    v = F.col(value)
    rest = df.groupBy(*by).agg(
        F.count(v).alias("n"), F.avg(v).alias("mean"),
        F.min(v).alias("min"), F.max(v).alias("max"), F.stddev_samp(v).alias("sd"), *extra)
    return join_null_safe(rest, exact_quantiles(df.select(*by, value), value, {"median": 0.5}, by), list(by))


def group_counts(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Row count per group, largest first."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), *by)


def multi_summary(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (),
                  fns: dict | None = None) -> DataFrame:
    """Every function over every column in one pass (A18): ``<col>_<fn>``."""
    fns = fns or {"mean": F.avg, "sd": F.stddev_samp}
    aggs = [fn(F.col(c)).alias(f"{c}_{name}") for c in cols for name, fn in fns.items()]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Null count per column, wide in one pass, then long."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], cols, "column_name", "null_count")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """rows, distinct rows, duplicate rows (A10)."""
    total = df.select(F.count(F.lit(1))).scalar()
    distinct = df.distinct().agg(F.count(F.lit(1)).alias("distinct_rows"))
    return distinct.select(total.alias("rows"), "distinct_rows",
                           (total - F.col("distinct_rows")).alias("duplicate_rows"))


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson r for every pair i < j in one aggregation, then long."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    wide = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    long = wide.unpivot([], [f"`{a}|{b}`" for a, b in pairs], "pair", "r")
    return long.select(F.split("pair", r"\|")[0].alias("var1"),
                       F.split("pair", r"\|")[1].alias("var2"), "r")


def contingency(df: DataFrame, row: str, col: str) -> DataFrame:
    """Counts for every level pair, zero cells included.

    One partial aggregation gives the filled cells; the grid is the list of
    row levels, each exploded over the array of column levels (the levels of
    a category, not rows of data).  NULL is a level and keeps its type.
    """
    cells = df.groupBy(row, col).agg(F.count(F.lit(1)).alias("n"))
    levels = cells.select(F.array_sort(F.collect_set(F.struct(F.col(col).alias("v"))))).scalar()
    grid = (cells.select(row).distinct().withColumn("_level", F.explode(levels))
            .select(row, F.col("_level.v").alias(col)))
    out = join_null_safe(grid, cells, [row, col], "left")
    return out.select(row, col, F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def proportions(df: DataFrame, group: str, category: str) -> DataFrame:
    """Count of each category within a group and its share of the group."""
    counts = df.groupBy(group, category).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(group).agg(F.sum("n").alias("_total"))
    return (join_null_safe(counts, totals, [group])
            .withColumn("share", F.col("n") / F.col("_total")).drop("_total"))


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width bins over [min, max]; the maximum falls in the last bin."""
    lo = df.select(F.min(value)).scalar()
    hi = df.select(F.max(value)).scalar()
    b = F.least(F.floor((F.col(value) - lo) * bins / (hi - lo)), F.lit(bins - 1)).cast("int")
    counts = df.select(b.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    # the bin grid is a parameter table of ``bins`` rows
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    out = grid.join(counts, "bin", "left").fillna(0, ["n"])
    return out.select("bin", (lo + F.col("bin") * (hi - lo) / bins).alias("lower"),
                      (lo + (F.col("bin") + 1) * (hi - lo) / bins).alias("upper"), "n")


def boxplot_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """Quartiles, 1.5 IQR whiskers and outlier counts per group."""
    v = F.col(value)
    q = exact_quantiles(df.select(group, value), value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, [group])
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    j = join_null_safe(df.select(group, value), q, [group])
    lo_fence = F.col("q1") - 1.5 * F.col("iqr")
    hi_fence = F.col("q3") + 1.5 * F.col("iqr")
    w = j.groupBy(group).agg(
        F.min(F.when(v >= lo_fence, v)).alias("lower_whisker"),
        F.max(F.when(v <= hi_fence, v)).alias("upper_whisker"),
        F.count_if((v < lo_fence) | (v > hi_fence)).alias("outliers"))
    return join_null_safe(q, w, [group])


def table_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows, nulls, distinct values, min and max (as text) per column (Q12).

    Each column is counted per value first (a partial aggregation over that
    column's scan alone), so rows are not expanded and no set of values is
    held in one task.
    """
    out = None
    for c in list(cols or df.columns):
        v, n = F.col("_v"), F.col("_n")
        per = df.groupBy(F.col(c).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
        row = per.agg(F.sum(n).alias("rows"), F.coalesce(F.sum(F.when(v.isNull(), n)), F.lit(0)).alias("nulls"),
                      F.count(v).alias("distinct_values"), F.min(v).cast("string").alias("min_value"),
                      F.max(v).cast("string").alias("max_value")).select(F.lit(c).alias("column_name"), "*")
        out = row if out is None else out.unionByName(row)
    return out
