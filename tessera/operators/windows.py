"""Window operators (W01-W12) and distributed running totals.

Global orderings (running totals, sequential ids, ntile) never use a window
without ``partitionBy``: the data is range-partitioned on the sort key and
written once with its range number, each range computes its local running
value, and a per-range offset is added.  A hot key is split by the range
partitioner as long as the order includes a unique tie-breaker.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions.dates import open_end
from tessera.session import materialise

_PID = "_range_id"
#: Distinct values (of all groups together) whose running totals one window may hold.
_WINDOW_ROWS = 1_000_000


def _num_ranges(df: DataFrame, num_ranges: int | None) -> int:
    if num_ranges:
        return num_ranges
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                   k: int = 1) -> DataFrame:
    """Top-``k`` preferred rows per key (W01/W06/P07 ``QUALIFY row_number``).

    ``order`` must end in a unique tie-breaker.  Catalyst plans the filter as
    a partial WindowGroupLimit before the shuffle, so a hot key contributes at
    most ``k`` rows per map task to the exchange.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") <= k).drop("_rn"))


def validity_from_starts(df: DataFrame, keys: Sequence[str], start: str,
                         end_name: str = "valid_to") -> DataFrame:
    """``valid_to = lead(start)``, open end 9999-12-31.

    Starts must be distinct per key (deduplicate first); then the number of
    versions per key is bounded by the number of distinct start values.
    """
    w = Window.partitionBy(*keys).orderBy(start)
    return df.withColumn(end_name, F.coalesce(F.lead(start).over(w), open_end()))


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where NULL equals NULL; the right side's keys are dropped."""
    other = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(other[f"_right_{k}"])
    return left.join(other, cond, how).drop(*[f"_right_{k}" for k in keys])


def group_size(df: DataFrame, keys: Sequence[str], name: str = "group_rows") -> DataFrame:
    """``count(*) over (partition by keys)`` (W03) via aggregate + join.

    The aggregate is partial (map-side), so a hot key never gathers in one
    task the way a window partition would.  NULL keys form a group.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return join_null_safe(df, counts, keys)


def running_totals(df: DataFrame, order: Sequence[Column], values: dict[str, Column | str],
                   num_ranges: int | None = None, totals: dict[str, str] | None = None,
                   keys: Sequence[str] = ()) -> DataFrame:
    """Inclusive running sums of several values in one ``order`` (per ``keys`` if given).

    ``order`` must be a total order within a key (end with a unique column).
    The rows are range-partitioned on ``keys + order`` and written with their
    range number, so that it names the same rows wherever it is read.  Each
    range computes its local running sums, and the sums of earlier ranges of
    the same key are added from a per-(range, key) table.  A key larger than
    one range is therefore split over several tasks.  NULL keys form a group.
    ``totals`` maps a value's name to a column for its per-key (or grand) total.
    """
    keys, totals = list(keys), totals or {}
    given = {f"_v_{n}": F.col(v) if isinstance(v, str) else v for n, v in values.items()}
    ranged = materialise(
        df.withColumns(given)
        .repartitionByRange(_num_ranges(df, num_ranges), *[F.col(k) for k in keys], *order)
        .withColumn(_PID, F.spark_partition_id()), "ranges")
    local_w = (Window.partitionBy(_PID, *keys).orderBy(*order)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = ranged.withColumns({f"_l_{n}": F.sum(f"_v_{n}").over(local_w) for n in values})
    sums = ranged.groupBy(_PID, *keys).agg(*[F.sum(f"_v_{n}").alias(f"_s_{n}") for n in values])
    # One row per (range, key); per key at most one row per range.
    per_key = Window.partitionBy(*keys).orderBy(_PID) if keys else Window.orderBy(_PID)
    before = per_key.rowsBetween(Window.unboundedPreceding, -1)
    whole = per_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = sums.select(
        _PID, *keys,
        *[F.coalesce(F.sum(f"_s_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in values],
        *[F.sum(f"_s_{n}").over(whole).alias(f"_g_{n}") for n in totals])
    out = join_null_safe(local, offsets, [_PID, *keys])
    return out.select(*[F.col(f"`{c}`") for c in df.columns],
                      *[(F.col(f"_l_{n}") + F.col(f"_o_{n}")).alias(n) for n in values],
                      *[F.col(f"_g_{n}").alias(t) for n, t in totals.items()])


def running_total(df: DataFrame, order: Sequence[Column], value: Column | str,
                  name: str, num_ranges: int | None = None,
                  total_name: str | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """One running sum (see :func:`running_totals`)."""
    return running_totals(df, order, {name: value}, num_ranges, {name: total_name} if total_name else None, keys)


def carried(df: DataFrame, order: Sequence[Column], last: dict[str, Column], following: dict[str, Column],
            keys: Sequence[str] = (), num_ranges: int | None = None) -> DataFrame:
    """The last known values up to each row, and values of the next row, in one ``order`` (per ``keys`` if given).

    ``last`` maps a name to an expression whose latest non-NULL value (this row's included) is
    carried forward; ``following`` maps a name to an expression of the next row (NULL at a key's last
    row).  As in :func:`running_totals` the rows are cut into ranges of ``keys + order``, written with their
    range number; each range carries its own values, and what a key brings from earlier ranges, or
    finds first in the next one, comes from a table with one row per (range, key).  So a key with most of
    the rows is swept by many tasks.  ``order`` must be total within a key; NULL keys form a group.
    """
    keys = list(keys)
    given = {f"_c_{n}": c for n, c in last.items()} | {f"_f_{n}": c for n, c in following.items()}
    ranged = materialise(df.withColumns(given).repartitionByRange(_num_ranges(df, num_ranges), *[F.col(k) for k in keys], *order)
                         .withColumn(_PID, F.spark_partition_id()), "ranges")
    w = Window.partitionBy(_PID, *keys).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.withColumns({f"_l_{n}": F.last(f"_c_{n}", ignorenulls=True).over(upto) for n in last}
                               | {f"_n_{n}": F.lead(f"_f_{n}").over(w) for n in following}
                               | {"_first": F.lag(F.lit(1)).over(w).isNull(), "_last": F.lead(F.lit(1)).over(w).isNull()})
    edges = local.where("_first or _last").groupBy(_PID, *keys).agg(
        F.lit(True).alias("_any"),
        *[F.first(F.when(F.col("_last"), F.col(f"_l_{n}")), ignorenulls=True).alias(f"_e_{n}") for n in last],
        *[F.first(F.when(F.col("_first"), F.struct(F.col(f"_f_{n}").alias("v"))), ignorenulls=True).alias(f"_b_{n}") for n in following])
    per_key = Window.partitionBy(*keys).orderBy(_PID) if keys else Window.orderBy(_PID)
    before = per_key.rowsBetween(Window.unboundedPreceding, -1)
    whole = per_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = edges.select(_PID, *keys, F.count(F.lit(1)).over(whole).alias("_ranges"),
                           *[F.last(f"_e_{n}", ignorenulls=True).over(before).alias(f"_o_{n}") for n in last],
                           *[F.lead(f"_b_{n}").over(per_key).alias(f"_a_{n}") for n in following]).where("_ranges > 1").drop("_ranges")
    # Only the first and the last key of a range can reach into another one: two rows per range at most.
    out = join_null_safe(local, F.broadcast(offsets), [_PID, *keys], "left")
    return out.select(*[F.col(f"`{c}`") for c in df.columns],
                      *[F.coalesce(f"_l_{n}", f"_o_{n}").alias(n) for n in last],
                      *[F.when(F.col("_last"), F.col(f"_a_{n}.v")).otherwise(F.col(f"_n_{n}")).alias(n) for n in following])


def global_row_number(df: DataFrame, order: Sequence[Column], name: str = "row_id",
                      num_ranges: int | None = None, total_name: str | None = None,
                      keys: Sequence[str] = ()) -> DataFrame:
    """1-based sequential id in a total order (W08), per ``keys`` if given,
    without a global window and without gathering a key in one task."""
    return running_total(df, order, F.lit(1).cast("long"), name, num_ranges, total_name, keys)


def exact_quantiles(df: DataFrame, value: str, probs: dict[str, float], by: Sequence[str] = (),
                    num_ranges: int | None = None) -> DataFrame:
    """Exact interpolated quantiles (``percentile`` semantics) per ``by`` (or of all rows).

    Rows are first counted per distinct value (a partial aggregation), the
    counts get running totals, and each quantile is the value at its rank.  The counts are
    written once, so ``df`` is computed once; up to ``_WINDOW_ROWS`` of them (read from the files' footers) are
    totalled by a window, more over ranges.  No state grows with a group, as that of an exact percentile does.
    NULL values are ignored; a group without any has NULL quantiles.
    """
    by = list(by)
    counts = materialise(df.groupBy(*by, F.col(value).alias("_value")).agg(F.count(F.col(value)).alias("_c")), "value-counts")
    if counts.count() <= _WINDOW_ROWS:
        w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
        upto = w.orderBy("_value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        r = counts.withColumns({"_cum": F.sum("_c").over(upto), "_n": F.sum("_c").over(w)})
    else:
        r = running_totals(counts, [F.col("_value")], {"_cum": "_c"}, num_ranges, {"_cum": "_n"}, by)
    aggs = []
    for name, p in probs.items():
        at = F.lit(float(p)) * (F.col("_n") - 1)
        for side, place in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            aggs.append(F.min(F.when(F.col("_cum") > place, F.col("_value"))).cast("double").alias(f"_{side}_{name}"))
    g = r.groupBy(*by, "_n").agg(*aggs)
    out = []
    for name, p in probs.items():
        at = F.lit(float(p)) * (F.col("_n") - 1)
        share = at - F.floor(at)
        out.append((F.col(f"_lo_{name}") + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}")) * share).alias(name))
    return g.select(*by, *out)


def ntile_from_rank(rank: Column, total: Column, buckets: int) -> Column:
    """``ntile(buckets)`` computed from a 1-based rank and the row count.

    First ``total % buckets`` tiles hold one extra row, as SQL ntile does.
    """
    q = F.floor(total / buckets)
    r = total % buckets
    big = r * (q + 1)
    return (F.when(rank <= big, F.floor((rank - 1) / (q + 1)) + 1)
            .otherwise(r + F.floor((rank - big - 1) / q) + 1)).cast("int")


def share_of_group(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """``value / sum(value) over (partition by keys)`` (A07/W07) via aggregate + join."""
    totals = df.groupBy(*keys).agg(F.sum(value).alias("_group_total"))
    return (join_null_safe(df, totals, keys)
            .withColumn(name, F.col(value) / F.col("_group_total"))
            .drop("_group_total"))


def pareto(df: DataFrame, entity: str, value: str, num_ranges: int | None = None) -> DataFrame:
    """Concentration curve (W10): entities by value desc with cumulative share.

    Output: entity, value, rank, cumulative value, cumulative share, rank share.
    Rank and cumulative value come from one pass over the ranges.
    """
    per_entity = df.groupBy(entity).agg(F.sum(value).alias(value))
    order = [F.col(value).desc(), F.col(entity).asc()]
    ranked = running_totals(per_entity, order, {"rank": F.lit(1).cast("long"), "cumulative_value": value},
                            num_ranges, {"rank": "_n", "cumulative_value": "_total"})
    return (ranked
            .withColumn("cumulative_share", F.col("cumulative_value").cast("double") / F.col("_total").cast("double"))
            .withColumn("entity_share", F.col("rank") / F.col("_n"))
            .drop("_total", "_n"))


def period_change(df: DataFrame, period: str, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Previous-period value, absolute and relative change.

    Runs on already aggregated period rows (one per period and key).
    """
    w = Window.partitionBy(*keys).orderBy(period) if keys else Window.orderBy(period)
    prev = F.lag(value).over(w)
    return (df.withColumn("previous_value", prev)
            .withColumn("change", F.col(value) - F.col("previous_value"))
            .withColumn("change_ratio", F.col("change") / F.nullif(F.col("previous_value"), F.lit(0))))


def running_selection(df: DataFrame, order: Sequence[Column], cost: str,
                      budget: float, max_rank: int) -> DataFrame:
    """Keep rows while the running cost is within budget and rank <= max.

    No backfill: after an unaffordable row the running sum stays high, so later
    rows are dropped too.  Runs on already aggregated decision rows.
    """
    ranked = running_totals(df, order, {"rank": F.lit(1).cast("long"), "cumulative_cost": cost})
    return ranked.where((F.col("cumulative_cost") <= budget) & (F.col("rank") <= max_rank))
