"""Interval histories: timeline merge, SCD1/SCD2 apply, assertions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions.dates import OPEN_END, open_end
from tessera.functions.hashing import change_hash, surrogate_key
from tessera.operators.windows import carried


def timeline_merge(a: DataFrame, b: DataFrame, key: str,
                   a_from: str, a_to: str, b_from: str, b_to: str,
                   a_cols: Sequence[str], b_cols: Sequence[str], num_ranges: int | None = None) -> DataFrame:
    """Merge two per-key histories into one timeline.

    Result rows are the non-empty intersections of an ``a`` version and a
    ``b`` version: ``valid_from = greatest(from)``, ``valid_to = least(to)``,
    ``is_current`` when the end is open.  Same result as the half-open overlap
    join, but computed as a sweep over the union of boundaries: each boundary
    carries the active version of both histories forward, so the work is
    linear in the number of versions (no version pairs are formed even for a
    key with many versions), and a key is cut over ranges (:func:`windows.carried`).  Each
    history must not overlap itself per key (:func:`self_overlaps` finds where one does;
    :func:`joins.interval_join` joins such histories).  Rows of a NULL key have no match.
    """
    a_struct = F.struct(*[F.col(c) for c in [a_from, a_to, *a_cols]])
    b_struct = F.struct(*[F.col(c) for c in [b_from, b_to, *b_cols]])

    def events(df, start, end, own, side):
        # kind 0 = end, kind 1 = start: at equal time an end is applied first.
        # Both events of a version come from one row (a generator, one pass).
        both = F.array(
            F.struct(F.col(start).alias("_t"), F.lit(1).alias("_kind"), F.lit(True).alias("on")),
            F.struct(F.col(end).alias("_t"), F.lit(0).alias("_kind"), F.lit(False).alias("on")))
        x = df.select(F.col(key).alias("_k"), own.alias("_own"), F.explode(both).alias("_e"))
        return x.select("_k", "_e._t", "_e._kind", F.lit(side).alias("_side"),
                        F.struct(F.col("_e.on").alias("on"), F.col("_own").alias("v")).alias(f"_{side}"))

    a, b = a.where(F.col(key).isNotNull()), b.where(F.col(key).isNotNull())
    ea = events(a, a_from, a_to, a_struct, "a")
    eb = events(b, b_from, b_to, b_struct, "b")
    ev = ea.unionByName(eb, allowMissingColumns=True)

    # The order is total: a tie is only between equal rows of one history, which must not overlap itself.
    order = [F.col("_t").asc(), F.col("_kind").asc(), F.col("_side").asc()]
    state = carried(ev, order, {"_sa": F.col("_a"), "_sb": F.col("_b")}, {"_next": F.col("_t")}, ["_k"], num_ranges)
    # The state after all events at one instant is on the last event row of it.
    seg = state.where(F.col("_next").isNull() | (F.col("_next") != F.col("_t")))
    live = seg.where(F.col("_sa.on") & F.col("_sb.on") & F.col("_next").isNotNull()
                     & (F.col("_t") < F.col("_next")))
    out = live.select(
        F.col("_k").alias(key),
        *[F.col(f"_sa.v.{c}").alias(c) for c in [a_from, a_to, *a_cols]],
        *[F.col(f"_sb.v.{c}").alias(c) for c in [b_from, b_to, *b_cols]],
        F.col("_t").alias("valid_from"),
        F.col("_next").alias("valid_to"))
    return out.withColumn("is_current", F.col("valid_to") == open_end())


def self_overlaps(history: DataFrame, key: str, start: str, end: str, num_ranges: int | None = None) -> DataFrame:
    """Versions that go on after the next one of their key has begun, with ``next_start`` (half-open intervals).

    A history overlaps itself if and only if two neighbours in the order of starts do, so the next
    start is all that a row needs, also where a key is cut over ranges.  Empty versions are left out.
    """
    rows = history.where(F.col(start) < F.col(end))
    order = [F.col(c).asc() for c in (start, end, *[c for c in history.columns if c not in (key, start, end)])]
    return carried(rows, order, {}, {"next_start": F.col(start)}, [key], num_ranges).where(F.col("next_start") < F.col(end))


# ------------------------------------------------------------------ SCD apply

def scd2_init(snapshot: DataFrame, key: str, attrs: Sequence[str], as_of) -> DataFrame:
    """First load of an SCD2 history from a snapshot."""
    return (snapshot.select(key, *attrs)
            .withColumn("row_hash", change_hash({c: F.col(c) for c in attrs}))
            .withColumn("valid_from", F.to_date(F.lit(as_of) if isinstance(as_of, str) else as_of))
            .withColumn("valid_to", open_end())
            .withColumn("is_current", F.lit(True))
            .withColumn("version_key", surrogate_key(key, "valid_from")))


def scd2_apply(history: DataFrame, snapshot: DataFrame, key: str, attrs: Sequence[str],
               as_of, close_missing: bool = True) -> DataFrame:
    """Apply a full snapshot to an SCD2 history.

    Unchanged current rows stay; changed rows are closed at ``as_of`` and a
    new version opens there; new keys open a version; keys missing from the
    snapshot are closed when ``close_missing``.  Closed history passes through
    untouched, so applying the same snapshot twice is a no-op.  One full outer
    join of two key-unique inputs; no MERGE needed.
    """
    as_of_col = F.to_date(F.lit(as_of)) if isinstance(as_of, str) else F.to_date(as_of)
    cols = [key, *attrs, "row_hash", "valid_from", "valid_to", "is_current", "version_key"]
    closed = history.where(~F.col("is_current")).select(*cols)
    cur = history.where(F.col("is_current")).select(*cols)
    snap = (snapshot.select(key, *attrs)
            .withColumn("row_hash", change_hash({c: F.col(c) for c in attrs})))
    c = cur.alias("c")
    s = snap.alias("s")
    j = c.join(s, F.col(f"c.{key}") == F.col(f"s.{key}"), "full_outer")
    in_c = F.col(f"c.{key}").isNotNull()
    in_s = F.col(f"s.{key}").isNotNull()
    stays = F.when(in_s, F.col("c.row_hash") == F.col("s.row_hash")).otherwise(F.lit(not close_missing))
    # Each key gives at most two rows: its present version, kept or closed, and a newly opened one.
    present = F.struct(*[F.col(f"c.{x}").alias(x) for x in [key, *attrs, "row_hash", "valid_from"]],
                       F.when(stays, F.col("c.valid_to")).otherwise(as_of_col).alias("valid_to"),
                       stays.alias("is_current"))
    opened = F.struct(*[F.col(f"s.{x}").alias(x) for x in [key, *attrs, "row_hash"]],
                      as_of_col.alias("valid_from"), open_end().alias("valid_to"), F.lit(True).alias("is_current"))
    versions = F.array_compact(F.array(F.when(in_c, present), F.when(in_s & ~(in_c & stays), opened)))
    # A version's key follows from its business key and start, so it need not be carried along.
    now = (j.select(F.explode(versions).alias("v")).select("v.*")
           .withColumn("version_key", surrogate_key(key, "valid_from")))
    return closed.unionByName(now.select(*cols))


def scd1_apply(dim: DataFrame, snapshot: DataFrame, key: str, attrs: Sequence[str]) -> DataFrame:
    """Overwrite attributes in place; new keys are inserted."""
    d = dim.alias("d")
    s = snapshot.select(key, *attrs).alias("s")
    j = d.join(s, F.col(f"d.{key}") == F.col(f"s.{key}"), "full_outer")
    has_s = F.col(f"s.{key}").isNotNull()
    return j.select(F.coalesce(F.col(f"s.{key}"), F.col(f"d.{key}")).alias(key),
                    *[F.when(has_s, F.col(f"s.{a}")).otherwise(F.col(f"d.{a}")).alias(a)
                      for a in attrs])


# ----------------------------------------------------------- assertions

def overlap_violations(history: DataFrame, key: str, valid_from: str = "valid_from",
                       valid_to: str = "valid_to") -> DataFrame:
    """Versions whose successor starts before they end."""
    w = Window.partitionBy(key).orderBy(valid_from)
    return (history.withColumn("_next_from", F.lead(valid_from).over(w))
            .where(F.col("_next_from") < F.col(valid_to)))


def current_row_violations(history: DataFrame, key: str) -> DataFrame:
    """Keys without exactly one current version."""
    return (history.groupBy(key)
            .agg(F.count_if(F.col("is_current")).alias("current_rows"))
            .where(F.col("current_rows") != 1))


__all__ = ["OPEN_END", "timeline_merge", "self_overlaps", "scd2_init", "scd2_apply",
           "scd1_apply", "overlap_violations", "current_row_violations"]
