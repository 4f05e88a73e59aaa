"""Exact top-k search by inner product with a pivot-distance index (operator 4).

Every vector is keyed by its nearest pivot and its distance to it; around each pivot the
distances are cut into rings (annuli).  For a query at distance d of a pivot, a vector of the
ring [lo, hi] is at least max(lo - d, d - hi, 0) away, so its inner product with the query is at
most (|q|^2 + |x|^2 - that^2) / 2, and never above |q| |x|.  A query first visits the rings with
the highest bounds until they hold enough candidates; the k-th score found there is
a floor, and a second visit goes to all other rings whose bound reaches it.  Inside a ring
vectors are sorted by distance, and blocks of them are skipped by the same bound.

Scores are whole numbers, and a bound must be below the floor to skip: ties lose nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import mix, written

#: Vectors of a cell (a ring, or a salted part of a large one), rings a pivot has at most, pivots at most.
CELL, MAX_RINGS, MAX_PIVOTS = 4096, 64, 64
#: Vectors that pivots and ring borders are fitted on, and vectors that are skipped or scored together.
SAMPLE, BLOCK = 4096, 512
SCALE = 1024


def _matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """floor(1024 x) of every usable vector, zero-padded to the batch's longest, and the rows used."""
    column = column.cast(pa.list_(pa.float64()))
    lists = column.is_valid().to_numpy(zero_copy_only=False)
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values
    bad = ~values.is_valid().to_numpy(zero_copy_only=False)
    flat = values.fill_null(0.0).to_numpy(zero_copy_only=False)
    bad |= ~np.isfinite(flat)
    wrong = np.concatenate(([0], np.cumsum(bad)))
    used = np.flatnonzero(lists & (wrong[offsets[1:]] == wrong[offsets[:-1]]))
    size = np.diff(offsets)[used]
    out = np.zeros((len(used), int(size.max()) if len(used) else 0), np.int64)
    if out.size:
        row = np.repeat(np.arange(len(used)), size)
        place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        with np.errstate(over="ignore"):
            whole = np.floor(flat[np.repeat(offsets[:-1][used], size) + place] * SCALE)
        out[row, place] = np.clip(whole, -(2.0 ** 62), 2.0 ** 62).astype(np.int64)
    return out, used


def _padded(rows: list[bytes] | pa.Array, dim: int) -> np.ndarray:
    raw = rows if isinstance(rows, list) else rows.to_pylist()
    out = np.zeros((len(raw), dim), np.int64)
    if all(len(r) == 8 * dim for r in raw):
        return np.frombuffer(b"".join(raw), "<i8").reshape(len(raw), dim).copy()
    for i, r in enumerate(raw):
        out[i, : len(r) // 8] = np.frombuffer(r, "<i8")
    return out


def scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows; beyond the range of a long they stop at its ends."""
    if not q.size or not x.size:
        return np.zeros((len(q), len(x)), np.int64)
    if float(np.abs(q).max()) * float(np.abs(x).max()) * q.shape[1] < 2.0 ** 53:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    exact = q.astype(object) @ x.astype(object).T
    return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def vectors(embeddings: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, v): usable vectors as little-endian int64, trailing zeros cut off."""
    def run(batches):
        for batch in batches:
            x, used = _matrix(batch.column(1))
            ids = batch.column(0).take(pa.array(used))
            long = [r[: int(np.flatnonzero(r)[-1]) + 1 if r.any() else 0].astype("<i8").tobytes() for r in x]
            yield pa.RecordBatch.from_arrays([ids, pa.array(long, pa.binary())], names=["vec_id", "v"])

    rows = embeddings.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding)).where(F.col("vec_id").isNotNull())
    return rows.mapInArrow(run, "vec_id long, v binary")


def choose_pivots(sample: np.ndarray, count: int, rounds: int = 5) -> np.ndarray:
    """Centres of the sample: farthest-first, then some rounds of means."""
    x = sample.astype(np.float64)
    centres = [x[0]]
    near = ((x - x[0]) ** 2).sum(axis=1)
    while len(centres) < min(count, len(x)):
        centres.append(x[int(near.argmax())])
        near = np.minimum(near, ((x - centres[-1]) ** 2).sum(axis=1))
    out = np.array(centres)
    for _ in range(rounds):
        owner = _distances(x, out).argmin(axis=1)
        for p in range(len(out)):
            if (owner == p).any():
                out[p] = x[owner == p].mean(axis=0)
    return out


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows to pivots, by direct differences (no cancellation)."""
    x = x.astype(np.float64)
    return np.stack([np.sqrt(((x - p) ** 2).sum(axis=1)) for p in pivots], axis=1)


def _bounds(q: np.ndarray, d: np.ndarray, rings: dict) -> np.ndarray:
    """Highest inner product that each query can have in each ring, rounded up a little."""
    own = d[:, rings["pivot"]]
    gap = np.maximum(np.maximum(rings["lo"] - own, own - rings["hi"]), 0) * (1 - 1e-9)
    norm = (q.astype(np.float64) ** 2).sum(axis=1)[:, None]
    best = np.minimum((norm + rings["norm"] - gap ** 2) / 2, np.sqrt(norm * rings["norm"]))
    return best + np.abs(best) * 1e-9 + norm * 1e-9 + rings["norm"] * 1e-9 + 1


def top_k(embeddings: DataFrame, k: int = 10, every: int = 100, vec_id: str = "vec_id", embedding: str = "embedding",
          cell: int = CELL) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` highest scores for each row whose id is divisible by ``every``.

    Candidates are all rows but those with the query's id.  Ties go to the smaller vec_id.
    Vectors that are null or hold null or non-finite components, and rows without id, take no
    part; shorter vectors count as ended by zeros.  Rows equal in id and vector count once;
    one id with several vectors is several candidates, and as a query has several answers.
    Fewer candidates give fewer ranks; an empty table gives no row.  Other columns are not read.
    Components of 2**52 or more in size, and scores beyond a long, stop at the range's ends.

    Pivots and ring borders are fitted on ``SAMPLE`` rows; every row is indexed.
    """
    spark = embeddings.sparkSession
    rows = written(vectors(embeddings, vec_id, embedding), "vectors")
    size = rows.agg(F.count(F.lit(1)), F.max(F.length("v"))).first()
    result = "query_id long, rank int, vec_id long, score long"
    if not size[0]:
        return spark.createDataFrame([], result)
    total, dim = size[0], max(size[1] // 8, 1)
    sample = _padded([r[0] for r in rows.orderBy(F.xxhash64("vec_id", "v"), "vec_id", "v").limit(SAMPLE).select("v").collect()], dim)
    cells = -(-total // cell)
    count = int(min(MAX_PIVOTS, max(1, round(cells ** 0.5))))
    pivots = choose_pivots(sample, count)
    parts = int(min(MAX_RINGS, -(-cells // len(pivots))))
    spread = _distances(sample, pivots)
    owner = spread.argmin(axis=1)
    borders = [np.unique(np.quantile(spread[owner == p, p], np.arange(1, parts) / parts)) if (owner == p).any() else np.zeros(0)
               for p in range(len(pivots))]

    def key(batches):
        for batch in batches:
            x = _padded(batch.column(1), dim)
            d = _distances(x, pivots)
            p = d.argmin(axis=1)
            own = d[np.arange(len(x)), p]
            ring = np.zeros(len(x), np.int32)
            for i in np.unique(p):
                ring[p == i] = np.searchsorted(borders[i], own[p == i], "right")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(p.astype(np.int32)), pa.array(ring), pa.array(own), pa.array((x.astype(np.float64) ** 2).sum(axis=1))],
                names=["vec_id", "v", "pivot", "ring", "dist", "norm"])

    index = written(rows.mapInArrow(key, "vec_id long, v binary, pivot int, ring int, dist double, norm double"), "vector-index")
    # At most MAX_PIVOTS x MAX_RINGS rows, whatever the number of vectors.
    stats = index.groupBy("pivot", "ring").agg(F.count(F.lit(1)).alias("n"), F.min("dist").alias("lo"), F.max("dist").alias("hi"),
                                               F.max("norm").alias("norm")).orderBy("pivot", "ring").collect()
    rings = {c: np.array([r[c] for r in stats]) for c in ("pivot", "ring", "n", "lo", "hi", "norm")}
    salts = np.maximum(1, -(-rings["n"] // cell)).astype(np.int64)
    first = np.concatenate(([0], np.cumsum(salts)))[:-1]
    number = {(int(p), int(r)): i for i, (p, r) in enumerate(zip(rings["pivot"], rings["ring"], strict=True))}

    @F.pandas_udf("long")
    def cell_of(pivot, ring, vec):
        import pandas as pd
        at = np.array([number[x] for x in zip(pivot, ring, strict=True)], np.int64)
        salt = (mix(vec.to_numpy(np.int64).astype(np.uint64)) % salts[at].astype(np.uint64)).astype(np.int64)
        return pd.Series(first[at] + salt)

    places = index.select(cell_of("pivot", "ring", "vec_id").alias("cell"), F.lit(0).alias("kind"), "vec_id", "v", "dist",
                          F.lit(None).cast("long").alias("floor"))
    queries = written(rows.where(F.col("vec_id") % every == 0).distinct(), "queries")

    def visits(asked: DataFrame, second: bool) -> DataFrame:
        """(cell, query): the rings of the first visit, or all others that can reach the floor."""
        def run(batches):
            for batch in batches:
                q = _padded(batch.column(1), dim)
                d = _distances(q, pivots)
                bound = _bounds(q, d, rings)
                order = np.argsort(-bound, axis=1, kind="stable")
                held = np.cumsum(rings["n"][order], axis=1)
                # The fewest best rings that hold k candidates beside the query itself.
                need = np.minimum((held < k + 1).sum(axis=1) + 1, len(stats))
                chosen = np.zeros(bound.shape, bool)
                np.put_along_axis(chosen, order, np.arange(len(stats))[None, :] < need[:, None], axis=1)
                if second:
                    floor = batch.column(2)
                    low = np.where(floor.is_valid().to_numpy(zero_copy_only=False),
                                   floor.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64), -np.inf)
                    chosen = ~chosen & (bound >= low[:, None])
                i, j = np.nonzero(chosen)
                times = salts[j]
                i, cells_ = np.repeat(i, times), np.repeat(first[j], times) + np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
                at = pa.array(i)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cells_, pa.int64()), pa.array(np.ones(len(i), np.int32)), batch.column(0).take(at), batch.column(1).take(at),
                     pa.array(np.zeros(len(i))), batch.column(2).take(at)], names=["cell", "kind", "vec_id", "v", "dist", "floor"])
        return asked.mapInArrow(run, "cell long, kind int, vec_id long, v binary, dist double, floor long")

    cell_pivot = np.repeat(rings["pivot"], salts)

    def search(batches):
        """Cells come one after the other: their vectors by distance, then the queries that visit them."""
        at, held = None, []
        x = ids = dist = norms = None
        for batch in batches:
            cell_col, kind = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            change = np.flatnonzero((cell_col[1:] != cell_col[:-1]) | (kind[1:] != kind[:-1])) + 1
            for lo, hi in zip(np.concatenate(([0], change)), np.append(change, len(cell_col)), strict=True):
                if lo == hi:
                    continue
                part = batch.slice(lo, hi - lo)
                if cell_col[lo] != at:
                    at, held, x = cell_col[lo], [], None
                if kind[lo] == 0:
                    held.append(part)
                    continue
                if x is None:
                    if not held:
                        continue
                    x = np.concatenate([_padded(h.column(3), dim) for h in held])
                    ids = np.concatenate([h.column(2).to_numpy() for h in held])
                    dist = np.concatenate([h.column(4).to_numpy() for h in held])
                    same = np.zeros(len(x), bool)
                    order = np.lexsort((*x.T, ids))
                    same[order[1:]] = (ids[order[1:]] == ids[order[:-1]]) & (x[order[1:]] == x[order[:-1]]).all(axis=1)
                    x, ids, dist = x[~same], ids[~same], dist[~same]
                    norms = (x.astype(np.float64) ** 2).sum(axis=1)
                    held = []
                yield found(part, x, ids, dist, norms, int(cell_pivot[at]))

    def found(part, x, ids, dist, norms, pivot):
        q, asked = _padded(part.column(3), dim), part.column(2).to_numpy()
        floor = part.column(5)
        low = np.where(floor.is_valid().to_numpy(zero_copy_only=False), floor.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64), -np.inf)
        d = _distances(q, pivots[pivot: pivot + 1])
        best_s = np.full((len(q), 0), 0, np.int64)
        best_i = np.full((len(q), 0), 0, np.int64)
        use = np.zeros((len(q), 0), bool)
        # Blocks from the ring's nearest distance on; each is skipped by the queries it cannot help.
        for b in range(0, len(x), BLOCK):
            s = slice(b, min(b + BLOCK, len(x)))
            ring = {"pivot": np.zeros(1, np.int64), "lo": dist[s].min(), "hi": dist[s].max(), "norm": norms[s].max()}
            live = np.flatnonzero(_bounds(q, d, ring)[:, 0] >= low)
            if not len(live):
                continue
            got = np.zeros((len(q), s.stop - s.start), np.int64)
            ok = np.zeros(got.shape, bool)
            got[live] = scores(q[live], x[s])
            ok[live] = (ids[s][None, :] != asked[live][:, None]) & (got[live] >= low[live][:, None])
            both_s = np.concatenate((best_s, got), axis=1)
            both_i = np.concatenate((best_i, np.broadcast_to(ids[s], got.shape)), axis=1)
            both_u = np.concatenate((use, ok), axis=1)
            order = np.lexsort((both_i, -both_s.astype(np.float64), ~both_u), axis=1) if both_s.size and np.abs(both_s).max() < 2 ** 53 \
                else np.array([sorted(range(both_s.shape[1]), key=lambda c, r=r: (not both_u[r, c], -int(both_s[r, c]), both_i[r, c]))
                               for r in range(len(q))])
            order = order[:, :k]
            best_s, best_i, use = (np.take_along_axis(y, order, axis=1) for y in (both_s, both_i, both_u))
            full = use.sum(axis=1) >= k
            if best_s.shape[1] >= k:
                low = np.where(full, np.maximum(low, best_s[:, k - 1].astype(np.float64)), low)
        i, j = np.nonzero(use)
        return pa.RecordBatch.from_arrays(
            [pa.array(asked[i]), part.column(3).take(pa.array(i)), pa.array(best_i[i, j]), pa.array(best_s[i, j])],
            names=["query_id", "q", "vec_id", "score"])

    def answers(asked: DataFrame, second: bool) -> DataFrame:
        rows_ = places.unionByName(visits(asked, second))
        spread_ = rows_.repartition("cell").sortWithinPartitions("cell", "kind", "dist", "vec_id")
        hits = spread_.mapInArrow(search, "query_id long, q binary, vec_id long, score long")
        return hits.withColumn("q", F.xxhash64("q"))

    order = Window.partitionBy("query_id", "q").orderBy(F.col("score").desc(), "vec_id")
    early = written(answers(queries.withColumn("floor", F.lit(None).cast("long")), False), "first-visit")
    floors = (early.withColumn("_n", F.row_number().over(order)).where(F.col("_n") == k)
              .select(F.col("query_id").alias("_id"), F.col("q").alias("_q"), F.col("score").alias("floor")))
    again = queries.join(floors, (F.col("vec_id") == F.col("_id")) & (F.xxhash64("v") == F.col("_q")), "left").select("vec_id", "v", "floor")
    late = answers(again, True)
    ranked = early.unionByName(late).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
