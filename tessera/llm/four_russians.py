"""Hard-negative mining (operator 11) by Four-Russians scoring.

Vectors become whole numbers (``floor(scale * x)``).  A row's components are kept as bit planes in
two's complement: for each group of eight dimensions and each bit, one byte with that bit of the
eight components.  For a block of anchors a task computes the 256 subset sums of each group of
eight anchor components; a byte of a plane then names the sum of the anchor components
whose bit is set, and the score is the sum of these look-ups, shifted by the bit (the highest
plane counts negatively).  No product of components is formed, and every score is exact.

The anchors are a stated query set, scored against all rows in blocks: anchors are dealt into
blocks of ``ANCHORS`` and rows into parts of ``PART`` by hashes; a task holds the tables of one anchor
block, streams the rows of one part, and keeps what can still be among the first ``k`` of
each anchor.  No pair leaves a task but those.  A first pass over the scores finds the
positives, a second one the negatives of each positive's window of scores.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import written

#: Anchors of a block (dealt by hash, so about that many), rows of a part, anchors and rows scored in one step.
ANCHORS, PART, STEP, ROWS = 2048, 16384, 64, 4096
_LONG = (1 << 63) - 1
_CELL = "block long, part long, kind int, id long, label string, groups int, v binary, row long, lows array<long>, highs array<long>"


def whole_numbers(values: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)``, as int64 where all fit into 62 bits, else as Python integers."""
    scaled = values.astype(np.float64) * scale
    if not len(scaled) or np.abs(scaled).max() < 2.0 ** 62:
        return np.floor(scaled).astype(np.int64)
    return np.array([math.floor(x * scale) if abs(x) < 2.0 ** 52 else int(x) * scale for x in values.astype(np.float64).tolist()], object)


def planes(numbers: np.ndarray) -> np.ndarray:
    """Bit planes of the rows of a (rows, dimensions) matrix: bytes (rows, planes, groups), lowest bit first."""
    rows, dims = numbers.shape
    groups = -(-dims // 8)
    padded = np.zeros((rows, groups * 8), numbers.dtype)
    padded[:, :dims] = numbers
    if not padded.size:
        return np.zeros((rows, 1, groups), np.uint8)
    bits = max(int(padded.max()).bit_length(), int(~padded.min()).bit_length() if padded.min() < 0 else 0) + 1
    out = np.empty((rows, bits, groups), np.uint8)
    for b in range(bits):
        out[:, b] = np.packbits(((padded >> b) & 1).astype(np.uint8), axis=1, bitorder="little")
    return out


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """(groups, 256, anchors): the sums of all subsets of each eight components."""
    count, dims = anchors.shape
    groups = -(-dims // 8)
    padded = np.zeros((count, groups * 8), anchors.dtype)
    padded[:, :dims] = anchors
    sums = np.zeros((groups, 1, count), anchors.dtype)
    for d in range(8):
        part = padded[:, d::8].T[:, None, :]
        sums = np.concatenate((sums, sums + part), axis=1)
    return sums


def scores(bits: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Inner products (rows, anchors) from planes and subset sums; groups that one side lacks count as zero."""
    rows, n, groups = bits.shape
    out = np.zeros((rows, sums.shape[2]), sums.dtype)
    for b in range(n):
        plane = np.zeros_like(out)
        for g in range(min(groups, len(sums))):
            plane += sums[g][bits[:, b, g]]
        out += -(plane << b) if b == n - 1 else plane << b
    return out


def _numbers(column, at: int, dtype=np.int64) -> np.ndarray:
    return column.column(at).to_numpy(zero_copy_only=False).astype(dtype)


def _unpacked(batch) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, planes) of an Arrow batch's packed rows, one entry per shape."""
    packed, groups = batch.column(6), _numbers(batch, 5)
    sizes = pc.binary_length(packed).to_numpy(zero_copy_only=False)
    out = []
    for g, size in {(int(a), int(b)) for a, b in zip(groups, sizes, strict=True)}:
        rows = np.flatnonzero((groups == g) & (sizes == size))
        data = np.frombuffer(b"".join(packed.take(pa.array(rows)).to_pylist()), np.uint8)
        out.append((rows, data.reshape(len(rows), -1, g) if g else np.zeros((len(rows), 1, 0), np.uint8)))
    return out


class _Best:
    """The first ``k`` (highest score, then smallest id) of each slot; ``floor`` is the score to reach once there are ``k``."""

    def __init__(self, slots: int, k: int):
        self.k, self.floor = k, [None] * slots
        self.slot, self.score, self.id = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, slot, score, ids):
        slot, ids = np.concatenate((self.slot, slot)), np.concatenate((self.id, ids))
        score = np.concatenate((self.score, score))
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        new = np.flatnonzero(np.concatenate(([True], slot[1:] != slot[:-1]))) if len(slot) else np.zeros(0, np.int64)
        place = np.arange(len(slot)) - np.repeat(new, np.diff(np.append(new, len(slot))))
        keep = place < self.k
        self.slot, self.score, self.id = slot[keep], score[keep], ids[keep]
        for s, v in zip(slot[place == self.k - 1].tolist(), score[place == self.k - 1].tolist(), strict=True):
            self.floor[s] = v


class _Block:
    """The anchors of one cell, their tables, and the best rows found so far."""

    def __init__(self, batches, k: int):
        whole = pa.Table.from_batches(batches)
        self.id, self.row = (whole.column(i).to_numpy().astype(np.int64) for i in (3, 7))
        self.label = np.array(whole.column(4).to_pylist(), object)
        self.lows, self.highs = whole.column(8).to_pylist(), whole.column(9).to_pylist()
        self.windows = max((len(x) for x in self.lows if x is not None), default=0)
        vectors = [np.frombuffer(x, np.float64) for x in whole.column(6).to_pylist()]
        scale = whole.column(5)[0].as_py()
        dims = max(len(x) for x in vectors)
        padded = np.zeros((len(vectors), dims))
        for i, x in enumerate(vectors):
            padded[i, : len(x)] = x
        numbers = whole_numbers(padded.ravel(), scale).reshape(padded.shape) if dims else np.zeros(padded.shape, np.int64)
        self.numbers = numbers
        per = max(self.windows, 1)
        self.best = [_Best(len(vectors[lo: lo + STEP]) * per, k) for lo in range(0, len(vectors), STEP)]

    def sums(self, lo: int, bits: np.ndarray):
        """Tables of a step's anchors, in 32 or 64 bits or Python integers, as no sum of look-ups can overflow."""
        part = self.numbers[lo: lo + STEP]
        reach = (int(abs(part).sum(axis=1).max()) if part.size else 0) << bits.shape[1]
        kind = np.int32 if reach < 1 << 31 else np.int64 if reach < 1 << 62 else object
        return subset_sums(part.astype(kind))

    def visit(self, batch):
        """Score a batch of rows against all anchors."""
        ids, labels = _numbers(batch, 3), np.array(batch.column(4).to_pylist(), object)
        _, codes = np.unique(np.concatenate((self.label, labels)).astype(str), return_inverse=True)
        own, other = codes[: len(self.label)], codes[len(self.label):]
        for rows, bits in _unpacked(batch):
            for lo in range(0, len(self.id), STEP):
                sums = self.sums(lo, bits)
                for r in range(0, len(rows), ROWS):
                    at = rows[r: r + ROWS]
                    found = scores(bits[r: r + ROWS], sums)
                    if found.dtype == object:
                        found = np.clip(found, -_LONG, _LONG).astype(np.int64)
                    self._keep(found, lo, ids[at], other[at][:, None] == own[lo: lo + STEP][None, :])

    def _keep(self, found, lo, ids, same):
        count, best = found.shape[1], self.best[lo // STEP]
        if not self.windows:
            floor = np.array([-_LONG - 1 if f is None else f for f in best.floor], np.int64)
            i, j = np.nonzero(same & (found >= floor) & (ids[:, None] != self.id[lo: lo + count][None, :]))
            best.add(j, found[i, j].astype(np.int64), ids[i])
            return
        apart = ~same & (ids[:, None] != self.id[lo: lo + count][None, :])
        for w in range(self.windows):
            low, high = np.full(count, 1, np.int64), np.zeros(count, np.int64)
            for a in range(count):
                if len(self.lows[lo + a]) > w:
                    floor = best.floor[a * self.windows + w]
                    low[a] = self.lows[lo + a][w] if floor is None else max(floor, self.lows[lo + a][w])
                    high[a] = self.highs[lo + a][w]
            i, j = np.nonzero(apart & (found >= low) & (found <= high))
            if len(i):
                best.add(j * self.windows + w, found[i, j].astype(np.int64), ids[i])

    def result(self):
        per = max(self.windows, 1)
        slot, ids, score = (np.concatenate(x) for x in zip(*[(b.slot + i * STEP * per, b.id, b.score) for i, b in enumerate(self.best)], strict=True))
        return pa.RecordBatch.from_arrays([pa.array(self.row[slot // per]), pa.array((slot % per).astype(np.int32)), pa.array(ids),
                                           pa.array(score)], names=["row", "window", "id", "score"])


def _search(batches, k: int):
    """Cells come one after the other: a cell's anchors, then its rows."""
    at, held, block = None, [], None
    for batch in batches:
        key = np.stack([_numbers(batch, i) for i in range(3)], axis=1)
        change = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
        for lo, hi in zip(np.concatenate(([0], change)), np.append(change, len(key)), strict=True):
            if lo == hi:
                continue
            if tuple(key[lo, :2]) != at:
                if block is not None:
                    yield block.result()
                at, held, block = tuple(key[lo, :2]), [], None
            part = batch.slice(lo, hi - lo)
            if key[lo, 2] == 0:
                held.append(part)
                continue
            if block is None and held:
                block, held = _Block(held, k), []
            if block is not None:
                block.visit(part)
    if block is not None:
        yield block.result()


def _packed(rows: DataFrame, scale: int) -> DataFrame:
    """(id, label, groups, planes) of every row."""
    def run(batches):
        for batch in batches:
            vectors = batch.column(2)
            sizes = np.array([len(v) for v in vectors], np.int64)
            groups, out = -(-sizes // 8), [b""] * len(sizes)
            for size in set(sizes.tolist()) - {0}:
                at = np.flatnonzero(sizes == size)
                values = vectors.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
                found = planes(whole_numbers(values, scale).reshape(len(at), size))
                for i, bits in zip(at.tolist(), found, strict=True):
                    out[i] = bits.tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(groups, pa.int32()), pa.array(out, pa.binary())],
                                             names=["id", "label", "groups", "v"])
    return (rows.select("id", "label", "vector").mapInArrow(run, "id long, label string, groups int, v binary")
            .withColumn("row", F.monotonically_increasing_id()))


def _as_bytes(anchors: DataFrame) -> DataFrame:
    """Anchor vectors as the bytes of doubles, which travel in the column of the planes."""
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1),
                                              pa.array([np.array(v, np.float64).tobytes() for v in batch.column(2).to_pylist()], pa.binary()),
                                              *[batch.column(i) for i in range(3, batch.num_columns)]],
                                             names=["id", "label", "v", *batch.schema.names[3:]])
    return anchors.mapInArrow(run, "id long, label string, v binary, row long, lows array<long>, highs array<long>")


def _nearest(rows: DataFrame, anchors: DataFrame, scale: int, k: int, blocks: int, parts: int) -> DataFrame:
    """(row, window, id, score): the first ``k`` of each anchor row's windows (of its own label, without windows)."""
    spread = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    cells = (_as_bytes(anchors).select(F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block"), spread(parts).alias("part"), F.lit(0).alias("kind"),
                                       "id", "label", F.lit(scale).alias("groups"), "v", "row", "lows", "highs")
             .unionByName(rows.select(spread(blocks).alias("block"), F.pmod(F.xxhash64("row"), F.lit(parts)).alias("part"), F.lit(1).alias("kind"),
                                      "id", "label", "groups", "v", "row",
                                      F.lit(None).cast("array<long>").alias("lows"), F.lit(None).cast("array<long>").alias("highs"))))
    cells = cells.select([c.split()[0] for c in _CELL.split(", ")])
    found = (cells.repartition("block", "part").sortWithinPartitions("block", "part", "kind", "id")
             .mapInArrow(lambda b: _search(b, k), "row long, window int, id long, score long"))
    best = Window.partitionBy("row", "window").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def mine(rows: DataFrame, is_anchor: Column, vec_id: str = "vec_id", label: str = "label", vector: str = "embedding", scale: int = 256,
         positives: int = 5, negatives: int = 5, low_percent: int = 80, high_percent: int = 100) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` (an expression over ``rows``) picks the anchors.  An anchor's positives are the first
    ``positives`` rows of its label by (score descending, id); the negatives of each positive are the first
    ``negatives`` rows of other labels whose score is from ``low_percent`` to ``high_percent`` of the
    positive's.  A negative positive score leaves no window, so no negatives.

    Rows with a null id, label or vector, or a null or non-finite component take no part; an anchor's
    own id is never its partner.  Vectors of different lengths count as filled up with zeros (an empty one
    scores zero).  Rows that repeat an id are rows of their own, as anchors too; equal ones stand in any
    order.  Scores beyond 64 bits are held at the highest or lowest long.  Columns go by their
    place, so other columns of any name are left out.  No rows or no anchors give an empty result.
    """
    given = rows.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{label}`").cast("string").alias("label"),
                        F.col(f"`{vector}`").cast("array<double>").alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    usable = given.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & ~bad)
    packed = written(_packed(usable, scale), "bit-planes")
    anchors = written(usable.where("anchor").select("id", "label", "vector").withColumn("row", F.monotonically_increasing_id()), "anchors")
    blocks, parts = max(1, -(-anchors.count() // ANCHORS)), max(1, -(-packed.count() // PART))
    none = F.lit(None).cast("array<long>")
    first = written(_nearest(packed, anchors.withColumn("lows", none).withColumn("highs", none), scale, positives, blocks, parts), "positives")
    # Whole-number windows: low * score <= 100 * x <= high * score, by floor division of exact decimals.
    exact = F.col("score").cast("decimal(20,0)")
    held = (first.withColumn("low", F.ceil(exact * low_percent / 100).cast("decimal(38,0)"))
            .withColumn("high", F.floor(exact * high_percent / 100).cast("decimal(38,0)"))
            .where((F.col("low") <= F.col("high")) & (F.col("high") <= F.lit(_LONG))))
    windows = (held.select("row", F.struct("rank", F.col("low").cast("long").alias("low"), F.col("high").cast("long").alias("high"),
                                           F.col("id").alias("positive"), "score").alias("w"))
               .groupBy("row").agg(F.array_sort(F.collect_list("w")).alias("ws")))
    asked = written(anchors.join(windows, "row").select("id", "label", "vector", "row", F.col("ws.low").alias("lows"), F.col("ws.high").alias("highs"), "ws"),
                    "windows")
    found = _nearest(packed, asked.drop("ws"), scale, negatives, blocks, parts)
    named = asked.select("row", F.col("id").alias("anchor_id"), F.posexplode("ws").alias("window", "w"))
    return (found.join(named, ["row", "window"])
            .select("anchor_id", F.col("w.positive").alias("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                    F.col("w.score").alias("positive_score"), F.col("score").alias("negative_score")))
