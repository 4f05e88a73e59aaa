"""Average silhouette width over pairwise distances (M19), block by block."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import materialise

#: Fewest and most points of a group, and bytes of a group's vectors and sums at most; two groups meet in a task.
BLOCK, PART, HELD = 256, 1 << 16, 64 << 20
#: Groups wanted at least, so that all cores have some pairs of them.
GROUPS = 12
#: Points whose distances to each other are summed in one step; how many of them are compared with the others
#: at a time, and distances taken then (they stay in a core's cache), at most.
STRIP, HIGH, CELLS = 512, 64, 1 << 18
#: Dimensions from which distances come from products; squares below this share of the lengths are taken from differences instead.
LONG, NEAR = 8, 1e-3
#: Partitions of cells or points at most.
MOST = 4096


def _matrix(column, kind=np.float64):
    return column.flatten().fill_null(-1).to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), -1)


def _packed(values):
    """A row's numbers as its bytes."""
    size = values.itemsize * values.shape[1]
    ends = np.arange(len(values) + 1, dtype=np.int32) * np.int32(size)
    return pa.Array.from_buffers(pa.binary(), len(values), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values))])


def _unpacked(column, kind):
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


class _Distances:
    """Distances of all pairs of ``left`` and ``right``, tile by tile, by subset of the dimensions; subsets of one dimension come last."""

    def __init__(self, left, right, subsets: list[list[int]]):
        self.high = max(8, min(HIGH, CELLS // (STRIP * len(subsets))))
        self.roots, self.count = sum(len(dims) > 1 for dims in subsets), len(subsets)
        short = {tuple(dims): s for s, dims in enumerate(subsets) if len(dims) < LONG}
        # Squares of a subset are those of the subset without its last dimension and one more; those nobody asked for get a place behind.
        places = dict(short)
        for dims in short:
            for end in range(2, len(dims)):
                places.setdefault(dims[:end], len(subsets) + len(places) - len(short))
        # Column by column, as differences read them.
        self.left, self.right = (np.asfortranarray(x) for x in (left, right)) if short else (None, None)
        self.adds = [(s, places.get(dims[:-1]), dims) for dims, s in sorted(places.items(), key=lambda x: len(x[0])) if len(dims) > 1]
        self.single = [(d, places.get((d,))) for d in sorted({d for dims in places for d in dims})]
        self.copies = [(s, short[tuple(dims)]) for s, dims in enumerate(subsets) if len(dims) < LONG and short[tuple(dims)] != s]
        self.found = np.empty((len(subsets) + len(places) - len(short)) * self.high * STRIP)
        self.kept = np.empty(len(self.single) * self.high * STRIP)
        self.products = []
        # Far points, too, keep their digits if products are taken around a point amid them.
        centre = left.mean(axis=0) if len(left) and np.isfinite(left).all() else np.zeros(left.shape[1])
        for s, dims in enumerate(subsets):
            if len(dims) >= LONG:
                # One product of these gives x.x + y.y - 2 x.y.
                x, y = (np.ones((len(points), len(dims) + 2)) for points in (left, right))
                np.subtract(left[:, dims], centre[dims], out=x[:, :-2])
                np.subtract(right[:, dims], centre[dims], out=y[:, :-2])
                x[:, -2], y[:, -1] = (np.einsum("ij,ij->i", z[:, :-2], z[:, :-2]) for z in (x, y))
                x[:, :-2] *= -2
                self.products.append((s, x, y))

    def tile(self, rows: slice, others: slice):
        """Distances of these points to those, by subset; the next tile overwrites them."""
        high, wide = rows.stop - rows.start, others.stop - others.start
        found = self.found[: len(self.found) // (self.high * STRIP) * high * wide].reshape(-1, high, wide)
        squares = dict(zip((d for d, _ in self.single), self.kept[: len(self.single) * high * wide].reshape(-1, high, wide), strict=True))
        for d, s in self.single:
            square = np.subtract(self.left[rows, d, None], self.right[None, others, d], out=squares[d])
            if s is not None:
                np.abs(square, out=found[s])
            np.multiply(square, square, out=square)
        for s, before, dims in self.adds:
            np.add(squares[dims[0]] if len(dims) == 2 else found[before], squares[dims[-1]], out=found[s])
        for s, x, y in self.products:
            x, y = x[rows], y[others]
            square, xx, yy = np.matmul(x, y.T, out=found[s]), x[:, -2], y[:, -1]
            # Products lose the digits of small distances: those are taken from differences, so equal points have distance zero exactly.
            if not square.min() > NEAR * (xx.max() + yy.max()):
                near = np.flatnonzero(~(square.min(axis=1) > NEAR * (xx + yy.max())))
                i, j = np.nonzero(~(square[near] > NEAR * (xx[near, None] + yy)))
                i = near[i]
                for at in range(0, len(i), 4096):
                    some = slice(at, at + 4096)
                    square[i[some], j[some]] = ((x[i[some], :-2] / -2 - y[j[some], :-2]) ** 2).sum(axis=1)
        for s, other in self.copies:
            found[s] = found[other]
        np.sqrt(found[: self.roots], out=found[: self.roots])
        return found[: self.count]


class _Group:
    """Points of a group, those of the same clusters beside each other, and their sums by column and subset.

    ``columns`` gives, for a point's clusters in all labellings, the columns that distances to it count in.
    """

    def __init__(self, rows, points, own, subsets: int, columns, width: int):
        kinds, kind = np.unique(own, axis=0, return_inverse=True)
        order = np.argsort(kind.reshape(-1), kind="stable")
        self.rows, self.points, self.own, self.kind = rows[order], points[order], own[order], kind.reshape(-1)[order]
        self.columns, self.width = [columns(x) for x in kinds], width
        self.sums = np.zeros((width, subsets, len(rows)))
        self.strips = [slice(at, min(at + STRIP, len(rows))) for at in range(0, len(rows), STRIP)]

    def members(self, strip: slice):
        """Which points are of which kind, and the kinds' columns; or of which column, if those are fewer."""
        first, last = self.kind[strip.start], self.kind[strip.stop - 1] + 1
        if last - first < self.width:
            return (self.kind[strip, None] == np.arange(first, last)).astype(np.float64), self.columns[first:last]
        member = np.zeros((strip.stop - strip.start, self.width))
        for i, kind in enumerate(self.kind[strip]):
            member[i, self.columns[kind]] = 1
        return member, [[x] for x in range(self.width)]

    def add(self, strip: slice, found, columns):
        """``found`` has sums by subset, point and one of ``columns``."""
        for i, some in enumerate(columns):
            for column in some:
                self.sums[column, :, strip] += found[:, :, i]

    def batches(self):
        step = max(1, min(512, (4 << 20) // (8 * self.sums.shape[0] * self.sums.shape[1])))
        for at in range(0, len(self.rows), step):
            some = slice(at, at + step)
            sums = self.sums[:, :, some].transpose(2, 1, 0)
            yield pa.RecordBatch.from_arrays([pa.array(self.rows[some]), _packed(self.own[some]), _packed(sums.reshape(len(sums), -1))], names=["row", "c", "sums"])


def _compare(left: _Group, right: _Group, subsets: list[list[int]]):
    """Add the distances of all pairs to the sums of both points; of a group with itself, each pair once."""
    same = left is right
    distances = _Distances(left.points, right.points, subsets)
    known = [right.members(strip) for strip in right.strips]
    for i, strip in enumerate(left.strips):
        mine, my_columns = known[i] if same else left.members(strip)
        for j in range(i if same else 0, len(right.strips)):
            others, (theirs, their_columns) = right.strips[j], known[j]
            twice = not (same and i == j)
            there = np.empty((len(subsets), len(mine), theirs.shape[1]))
            back = np.zeros((len(subsets), mine.shape[1], len(theirs)))
            for at in range(strip.start, strip.stop, distances.high):
                rows = slice(at, min(at + distances.high, strip.stop))
                within = slice(rows.start - strip.start, rows.stop - strip.start)
                tile = distances.tile(rows, others)
                there[:, within] = (tile.reshape(-1, len(theirs)) @ theirs).reshape(len(subsets), -1, theirs.shape[1])
                if twice:
                    back += mine[within].T @ tile
            left.add(strip, there, their_columns)
            if twice:
                right.add(others, back.transpose(0, 2, 1), my_columns)


def _sums(batches, subsets: list[list[int]], columns, width: int):
    """Per point of a cell's groups: its clusters and summed distances to the other group's points, by subset and column."""
    at, held = None, ([], [])

    def groups():
        """The cell's groups; what was read of them is given up."""
        for side in held:
            if side:
                read = [np.concatenate(x) for x in zip(*side, strict=True)]
                side.clear()
                group = _Group(*read, len(subsets), columns, width)
                del read
                yield group

    def result(cell):
        both = [*groups()]
        # A group's own cell has one side; so has a cell whose other group is empty.
        if cell[1]:
            _compare(both[0], both[0], subsets)
        elif len(both) == 2:
            _compare(*both, subsets)
        for group in both:
            yield from group.batches()
    for batch in batches:
        cell, side, alone = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3))
        change = np.flatnonzero((cell[1:] != cell[:-1]) | (side[1:] != side[:-1])) + 1
        for lo, hi in zip(np.concatenate(([0], change)), np.append(change, len(cell)), strict=True):
            if lo == hi:
                continue
            if at is not None and cell[lo] != at[0]:
                yield from result(at)
            at = cell[lo], alone[lo]
            some = batch.slice(lo, hi - lo)
            held[side[lo]].append((some.column(3).to_numpy(), _matrix(some.column(4)), _matrix(some.column(5), np.int32)))
    if at is not None:
        yield from result(at)


def _widths(batches, subsets: int, sizes: list[int], counts: np.ndarray, to_cluster):
    """Sums and numbers of the widths of whole points, by subset and labelling; a point's rows follow each other, one of each cell."""
    edges = np.concatenate(([0], np.cumsum(sizes)))
    total, number, members = np.zeros((subsets, len(sizes))), np.zeros((subsets, len(sizes)), np.int64), np.zeros(len(sizes), np.int64)

    def add(own, sums):
        for k, size in enumerate(sizes):
            mine, d = own[:, k], sums[:, :, edges[k]: edges[k + 1]]
            d, mine = d[mine >= 0], mine[mine >= 0]
            n, places = counts[edges[k]: edges[k + 1]], np.arange(len(mine))
            members[k] += len(mine)
            if len(mine) == 0 or (n > 0).sum() < 2:
                continue
            mean = d / np.where(n > 0, n, 1)
            mean[:, :, n == 0] = np.inf
            mean[places, :, mine] = np.inf
            b = mean.min(axis=2)
            alone = n[mine] == 1
            a = d[places, :, mine] / np.maximum(n[mine] - 1, 1)[:, None]
            top = np.maximum(a, b)
            flat = alone[:, None] | (top == 0)
            total[:, k] += np.where(flat, 0.0, (b - a) / np.where(flat, 1.0, top)).sum(axis=0)
            number[:, k] += len(mine)
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        rows, own = batch.column(0).to_numpy(), _unpacked(batch.column(1), np.int32)
        sums = _unpacked(batch.column(2), np.float64).reshape(len(rows), subsets, -1)
        first = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
        rows, own, sums = rows[first], own[first], np.add.reduceat(sums, first, axis=0)
        if to_cluster is not None:
            sums = sums @ to_cluster
        if last is not None:
            if last[0] == rows[0]:
                sums[0] += last[2][0]
            else:
                add(last[1], last[2])
        add(own[:-1], sums[:-1])
        last = rows[-1], own[-1:], sums[-1:]
    if last is not None:
        add(last[1], last[2])
    met = [(s, k) for s in range(subsets) for k in range(len(sizes)) if members[k]]
    yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in met], pa.int32()), pa.array([k for _, k in met], pa.int32()),
                                      pa.array([total[x] for x in met], pa.float64()), pa.array([number[x] for x in met], pa.int64())],
                                     names=["subset", "labelling", "total", "n"])


def silhouette_widths(points: DataFrame, vector: str, labels: Sequence[str], subsets: dict[str, Sequence[int]],
                      block: int = BLOCK, part: int = PART) -> DataFrame:
    """subset, labelling, silhouette: the mean silhouette width of every labelling on every subset of dimensions.

    ``vector`` is an array of numbers, ``labels`` are columns with cluster numbers from 0 (NULL: the point is no
    member in that labelling), ``subsets`` names places in the vector.  A point's width compares its mean
    Euclidean distance to the others of its cluster, ``a``, with the smallest mean distance to another cluster, ``b``: ``(b - a) / max(a, b)``,
    and 0 where it is alone in its cluster.  A labelling with one cluster has no width (NULL).

    The distances are those of all pairs, as the statistic asks for, but no pair is a row: points are dealt to
    groups, a task holds two groups (or one), takes each distance between them once for both points, and keeps one sum per point
    and cluster.  A point's sums over the groups and its width are formed in tasks, too, and one
    row of each task, subset and labelling goes on.  Work stays quadratic in the points, memory does not grow.
    A group has ``block`` to ``part`` points.  Points with a NULL vector or component take no part.
    """
    names = sorted(subsets, key=lambda x: len(subsets[x]) == 1)
    dims = [list(subsets[x]) for x in names]
    width = max(max(p) for p in dims) + 1
    usable = points.where(F.col(vector).isNotNull() & (F.size(vector) >= width) & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x)))
    rows = materialise(usable.select(F.monotonically_increasing_id().alias("row"), F.slice(F.transform(vector, lambda x: x.cast("double")), 1, width).alias("v"),
                                     F.array(*[F.col(c).cast("int") for c in labels]).alias("c")), "points")
    found = rows.agg(F.count(F.lit(1)).alias("n"), *[F.max(F.col("c")[k]).alias(f"m{k}") for k in range(len(labels))]).first()
    sizes = [(found[f"m{k}"] if found[f"m{k}"] is not None else 0) + 1 for k in range(len(labels))]
    n = found["n"]
    per_cluster = rows.select(F.posexplode("c").alias("k", "cluster")).where("cluster is not null").groupBy("k", "cluster").agg(F.count(F.lit(1)).alias("n")).collect()
    edges, counts = np.concatenate(([0], np.cumsum(sizes))), np.zeros(sum(sizes), np.int64)
    for r in per_cluster:
        counts[edges[r["k"]] + r["cluster"]] = r["n"]
    # Points with the same clusters in all labellings are summed together, if those are fewer sums.
    joint = sorted(tuple(-1 if x is None else x for x in r["c"]) for r in rows.select("c").distinct().limit(sum(sizes)).collect())

    def clusters(own):
        return [edges[k] + x for k, x in enumerate(own) if x >= 0]
    if len(joint) < sum(sizes):
        place = {x: i for i, x in enumerate(joint)}
        to_cluster = np.zeros((len(joint), sum(sizes)))
        for i, x in enumerate(joint):
            to_cluster[i, clusters(x)] = 1
        kept, columns = len(joint), lambda own: [place[tuple(own.tolist())]]
    else:
        kept, columns, to_cluster = sum(sizes), clusters, None
    # Vectors are held as read, in order and as factors of the products.
    most = max(1, min(part, HELD // (8 * (3 * width + len(dims) * kept))))
    groups = max(1, -(-n // most), min(GROUPS, n // block))
    cells = groups * (groups + 1) // 2
    # Pairs of groups first, then the groups by themselves, which take half as long.
    pair = F.least("g", "h") * (2 * groups - 1 - F.least("g", "h")) / 2 + F.abs(F.col("g") - F.col("h")) - 1
    alone = F.col("g") == F.col("h")
    both = (rows.select(F.pmod(F.xxhash64("row"), F.lit(groups)).alias("g"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("h"), "row", "v", "c")
            .select(F.when(alone, F.col("g") + (cells - groups)).otherwise(pair).cast("int").alias("cell"), (F.col("g") > F.col("h")).cast("int").alias("side"),
                    alone.cast("int").alias("alone"), "row", "v", "c"))
    both = both.repartitionById(min(cells, MOST), "cell").sortWithinPartitions("cell", "side")
    sums = both.mapInArrow(lambda b: _sums(b, dims, columns, kept), "row long, c binary, sums binary")
    # Each cell gave a row per point; with one group the points are whole.
    if groups > 1:
        sums = sums.repartition(min(cells, MOST), "row").sortWithinPartitions("row")
    per = sums.mapInArrow(lambda b: _widths(b, len(dims), sizes, counts, to_cluster), "subset int, labelling int, total double, n long")
    value = F.when(F.sum("n") > 0, F.sum("total") / F.sum("n"))
    return (per.groupBy("subset", "labelling").agg(value.alias("silhouette"))
            .select(F.array(*[F.lit(x) for x in names])[F.col("subset")].alias("subset"), F.array(*[F.lit(c) for c in labels])[F.col("labelling")].alias("labelling"),
                    "silhouette"))
