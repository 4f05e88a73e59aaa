"""Join operators.

The choice of a broadcast is left to the planner and to AQE, which know sizes
in bytes; only dimensions that are small by definition are broadcast directly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions.dates import UNKNOWN_MEMBER_KEY
from tessera.operators.windows import running_totals
from tessera.session import materialise


def coalesced_key_join(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_key: str,
                       how: str = "left") -> DataFrame:
    """Equi-join on the first non-NULL of several key columns.

    The key is one column before the join, so it is planned as a plain equi-join.
    """
    keyed = left.withColumn("_key", F.coalesce(*left_keys))
    return keyed.join(right, F.col("_key") == right[right_key], how).drop("_key")


def top1_lateral(outer: DataFrame, inner: DataFrame, outer_key: str, inner_key: str,
                 order: Sequence[Column], select: Sequence[str]) -> DataFrame:
    """``LEFT JOIN LATERAL (... ORDER BY ... LIMIT 1)``.

    Decorrelated as top-1 per key on the inner side (a row_number filter that
    Catalyst turns into a partial WindowGroupLimit before the shuffle, so a
    hot key sends only one row per map task), then one left join.
    """
    w = Window.partitionBy(inner_key).orderBy(*order)
    best = (inner.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") == 1)
            .select(F.col(inner_key).alias("_lk"), *select))
    return (outer.join(best, outer[outer_key] == best["_lk"], "left")
            .drop("_lk"))


def point_in_time_join(fact: DataFrame, history: DataFrame, key: str, at: str,
                       valid_from: str = "valid_from", valid_to: str = "valid_to",
                       how: str = "left") -> DataFrame:
    """Version of ``history`` valid at ``fact[at]``: ``from <= t < to``.

    ``history`` must not overlap per key (see ``scd.assert_no_overlap``), so
    each fact row matches at most one version.
    """
    h = history.withColumnRenamed(key, "_hk")
    cond = [(fact[key] == h["_hk"]), (h[valid_from] <= fact[at]), (fact[at] < h[valid_to])]
    return fact.join(h, cond, how).drop("_hk")


def resolve_unknown(df: DataFrame, key_col: str, unknown: int = UNKNOWN_MEMBER_KEY) -> DataFrame:
    """Unmatched facts map to the reserved unknown member."""
    return df.withColumn(key_col, F.coalesce(F.col(key_col), F.lit(unknown).cast("long")))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key has no parent (J11): a left-anti join."""
    p = parent.select(F.col(parent_key).alias("_pk")).distinct()
    return child.join(p, child[child_key] == p["_pk"], "left_anti")


def grain_safe_join(parent: DataFrame, key: str,
                    children: Sequence[tuple[DataFrame, str, Sequence[Column]]]) -> DataFrame:
    """Pre-aggregate each child to the parent grain before joining.

    ``children`` holds ``(child_df, child_key, aggregate_columns)``; every
    child is reduced by a partial (map-side) aggregation first, so joining
    two children never multiplies their rows.
    """
    out = parent
    for child, child_key, aggs in children:
        rolled = child.groupBy(F.col(child_key).alias(key)).agg(*aggs)
        out = out.join(rolled, key, "left")
    return out


def role_playing(fact: DataFrame, dim: DataFrame, dim_key: str,
                 roles: dict[str, str], columns: Sequence[str]) -> DataFrame:
    """Join one dimension several times under role prefixes.

    ``roles`` maps a prefix to the fact's foreign-key column, e.g.
    ``{"pickup": "pu_location_id", "dropoff": "do_location_id"}``.
    """
    out = fact
    for prefix, fk in roles.items():
        d = dim.select(F.col(dim_key).alias(f"_{prefix}_k"),
                       *[F.col(c).alias(f"{prefix}_{c}") for c in columns])
        out = out.join(d, out[fk] == d[f"_{prefix}_k"], "left").drop(f"_{prefix}_k")
    return out


def as_of_lookup(fact: DataFrame, history: DataFrame, key: str, at: str,
                 valid_from: str, valid_to: str, carry: Sequence[str]) -> DataFrame:
    """Left point-in-time lookup that never forms fact x version pairs.

    1. The distinct ``(key, at)`` lookup points are taken from the facts (a
       partial aggregation: a hot key shrinks to its distinct instants).
    2. Points and version starts are swept in one ordered stream per key; the
       last version started at or before each point is carried forward and
       kept when the point lies before that version's end.
    3. The resolved points are equi-joined back to the facts on
       ``(key, at)``, a join AQE can split when one key is hot.

    Facts without a valid version get NULLs in ``carry`` (see
    :func:`resolve_unknown`).
    """
    points = fact.select(F.col(key).alias("_k"), F.col(at).alias("_t")).distinct()
    ver = history.select(F.col(key).alias("_k"), F.col(valid_from).alias("_t"),
                         F.lit(0).alias("_kind"),
                         F.struct(F.col(valid_to).alias("_to"), *[F.col(c) for c in carry])
                         .alias("_v"))
    pts = points.select("_k", "_t", F.lit(1).alias("_kind"),
                        F.lit(None).cast(ver.schema["_v"].dataType).alias("_v"))
    w = (Window.partitionBy("_k").orderBy("_t", "_kind")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    swept = (ver.unionByName(pts)
             .withColumn("_cur", F.last("_v", ignorenulls=True).over(w))
             .where((F.col("_kind") == 1) & (F.col("_t") < F.col("_cur._to"))))
    resolved = swept.select(F.col("_k"), F.col("_t"),
                            *[F.col(f"_cur.{c}").alias(c) for c in carry])
    cond = (fact[key] == resolved["_k"]) & (fact[at] == resolved["_t"])
    return fact.join(resolved, cond, "left").drop("_k", "_t")


def interval_join(a: DataFrame, b: DataFrame, key: str, a_from: str, a_to: str, b_from: str, b_to: str,
                  cell: int = 10_000, num_ranges: int | None = None) -> DataFrame:
    """All pairs of one ``key`` whose half-open intervals overlap (J03), for histories that may overlap themselves.

    All starts of a key, of both sides, are numbered in order, and each interval gets two numbers: ``r``,
    that of its own start, and ``e``, that of the last start before its end.  Two intervals overlap if and only if the
    later start lies in the earlier interval: ``r < r' <= e``.  Numbers are cut into cells of ``cell`` starts.  An
    interval stands in the cell of its start once, and as a possible earlier partner in all cells from ``r`` to ``e``,
    so a pair meets in one cell only, that of the later start.  A key with few starts is one cell; a
    key with most of the rows is many, and an interval is copied only to cells that it reaches.

    Returns the columns of ``a``, those of ``b`` without the key, ``overlap_from`` and ``overlap_to``.  Other columns that
    both sides have must be renamed before.  Empty intervals and NULL keys, starts or ends overlap nothing; repeated
    rows are rows of their own.
    """
    def events(df, start, end, side):
        rows = df.where(F.col(key).isNotNull() & (F.col(start) < F.col(end)))
        rows = rows.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), F.monotonically_increasing_id().alias("_id"))
        both = F.array(F.struct(F.col(f"_row.{start}").alias("_t"), F.lit(1).alias("_kind")), F.struct(F.col(f"_row.{end}").alias("_t"), F.lit(0).alias("_kind")))
        out = rows.select(F.col(f"_row.{key}").alias("_k"), "_id", F.explode(both).alias("_e"), "_row")
        return out.select("_k", "_id", "_e._t", "_e._kind", F.lit(side).alias("_side"), F.when(F.col("_e._kind") == 1, F.col("_row")).alias(f"_{side}"))

    # At one instant ends come before starts, so a start at an interval's end is none of its own.
    order = [F.col(c).asc() for c in ("_t", "_kind", "_side", "_id")]
    numbered = running_totals(events(a, a_from, a_to, "a").unionByName(events(b, b_from, b_to, "b"), allowMissingColumns=True),
                              order, {"_n": F.col("_kind").cast("long")}, num_ranges, keys=["_k"])
    spans = materialise(numbered.groupBy("_k", "_side", "_id").agg(
        F.max(F.when(F.col("_kind") == 1, F.col("_n"))).alias("r"), F.max(F.when(F.col("_kind") == 0, F.col("_n"))).alias("e"),
        F.first("_a", ignorenulls=True).alias("_a"), F.first("_b", ignorenulls=True).alias("_b")), "interval-spans")

    def cell_of(name):
        return F.floor((F.col(name) - 1) / cell)

    def met(early, late):
        reach = spans.where(F.col("_side") == early).select("_k", F.explode(F.sequence(cell_of("r"), cell_of("e"))).alias("_cell"),
                                                            F.col("r").alias("_r"), F.col("e").alias("_e"), f"_{early}")
        begin = spans.where(F.col("_side") == late).select("_k", cell_of("r").alias("_cell"), "r", f"_{late}")
        return reach.join(begin, ["_k", "_cell"]).where((F.col("_r") < F.col("r")) & (F.col("r") <= F.col("_e"))).select("_a", "_b")

    pairs = met("a", "b").unionByName(met("b", "a"))
    return pairs.select(*[F.col(f"_a.`{c}`").alias(c) for c in a.columns], *[F.col(f"_b.`{c}`").alias(c) for c in b.columns if c != key],
                        F.greatest(f"_a.{a_from}", f"_b.{b_from}").alias("overlap_from"), F.least(f"_a.{a_to}", f"_b.{b_to}").alias("overlap_to"))
