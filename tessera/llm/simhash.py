"""SimHash near-duplicates (operator 9), found with pivot distance tables.

Each fingerprint gets its Hamming distances to 16 reference fingerprints.  By the triangle
inequality two fingerprints that link differ by at most ``max_bits`` in every coordinate, so
pairs with a larger difference are discarded without being compared, and the rest is verified.

Pairs meet in buckets: the 64 bits are cut into ``max_bits + 2`` blocks, and fingerprints that
link agree in two blocks at least, so each is put under every pair of blocks.  Equal
fingerprints are one class before that.  A bucket gives the edges of a spanning forest, never
all its pairs; a large bucket is cut into chunks, and each pair of chunks is a cell of its own.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import LOWER, carried, map_texts, split_by_keys, text_slices, word_spans, written
from tessera.llm.components import connected_components

PIVOTS = 16
#: Fingerprints of a bucket that form one chunk; cells hold two chunks at most.
CHUNK = 4096
#: Runs up to this size are compared in one numpy step for all runs of a batch.
SMALL = 8


def pivots() -> list[int]:
    """Reference fingerprints, as signed longs."""
    return np.random.default_rng(20_240_501).integers(-(1 << 63), (1 << 63) - 1, PIVOTS).tolist()


def fingerprints(data: np.ndarray, offsets: np.ndarray, shingle: int = 4) -> np.ndarray:
    """64-bit fingerprint of each text: majority of its shingles' XXH64 (seed 42), bit by bit.

    ASCII capitals are lower-cased; words are joined by one space; texts of fewer words than
    ``shingle`` are one shingle, texts without a word have fingerprint 0.
    """
    from xxhash import xxh64_intdigest

    n = len(offsets) - 1
    out = np.zeros(n, np.uint64)
    starts, ends, rows = word_spans(data, offsets)
    if not len(starts):
        return out
    # All words with one space behind each, so that a shingle is one stretch of bytes.
    size = ends - starts + 1
    at = np.cumsum(size) - size
    take = np.repeat(starts - at, size) + np.arange(int(size.sum()))
    joined = LOWER[data[np.minimum(take, len(data) - 1)]]
    joined[at + size - 1] = 0x20
    stop = at + size - 1
    words = np.bincount(rows, minlength=n)
    first = np.cumsum(words) - words
    place = np.arange(len(rows)) - first[rows]
    heads = np.flatnonzero((place <= words[rows] - shingle) | ((place == 0) & (words[rows] < shingle)))
    tails = np.minimum(heads + shingle, (first + words)[rows[heads]]) - 1
    text, owner = joined.tobytes(), rows[heads]
    for lo in range(0, len(heads), 1 << 17):
        part = slice(lo, lo + (1 << 17))
        hashes = np.array([xxh64_intdigest(text[a:b], 42) for a, b in zip(at[heads[part]].tolist(), stop[tails[part]].tolist(), strict=True)],
                          "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        own, begin = np.unique(owner[part], return_index=True)
        sums = np.add.reduceat(bits, begin, axis=0, dtype=np.int32)
        if lo == 0:
            totals, known = np.zeros((n, 64), np.int32), np.zeros(n, np.int64)
        totals[own] += sums
        known[own] += np.diff(np.append(begin, len(hashes)))
    found = np.packbits(2 * totals > known[:, None], axis=1, bitorder="little")
    return np.ascontiguousarray(found).view("<u8").ravel().astype(np.uint64)


def fingerprint_table(docs: DataFrame, text: str = "text", shingle: int = 4, carry: list[str] | None = None) -> DataFrame:
    """The carried columns (default: all) with ``_fp`` and a number ``_row`` per row, written once.

    Writing fixes the row numbers and spares a second reading of the texts.
    """
    kept = [c for c in (docs.columns if carry is None else carry) if c not in ("_fp", "_row")]
    rows, places, whole = carried(docs, kept, text)
    schema = rows.select(*places).withColumn("_fp", F.lit(0).cast("long")).schema

    def run(batches):
        for batch in batches:
            found = np.zeros(batch.num_rows, np.uint64)
            for first, end, data, offsets in text_slices(batch.column(whole)):
                found[first:end] = fingerprints(data, offsets, shingle)
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(kept))] + [pa.array(found.view(np.int64))],
                                             names=places + ["_fp"])

    return written(map_texts(rows, run, schema).toDF(*kept, "_fp").withColumn("_row", F.monotonically_increasing_id()), "fingerprints", "zstd")


def _near(fps: np.ndarray, table: np.ndarray, i: np.ndarray, j: np.ndarray, max_bits: int) -> np.ndarray:
    """Which pairs link: first by the largest coordinate difference, then by comparison."""
    left = np.ones(len(i), bool)
    for c in range(0, PIVOTS, 4):
        k = np.flatnonzero(left)
        left[k] = (np.abs(table[i[k], c: c + 4] - table[j[k], c: c + 4]) <= max_bits).all(axis=1)
    k = np.flatnonzero(left)
    left[k] = np.bitwise_count(fps[i[k]] ^ fps[j[k]]) <= max_bits
    return left


def spanning_edges(fps: np.ndarray, table: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join all linked fingerprints of one cell: at most one per fingerprint.

    A search takes a fingerprint, finds its links among those not yet reached, and goes on
    from them; what is reached is never compared with each other again.
    """
    rest, a, b = np.arange(len(fps)), [], []
    while len(rest):
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            x = frontier.pop()
            hit = _near(fps, table, np.full(len(rest), x), rest, max_bits)
            if hit.any():
                reached = rest[hit]
                a.append(np.full(len(reached), x))
                b.append(reached)
                frontier += reached.tolist()
                rest = rest[~hit]
    none = np.zeros(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def _cell_edges(batches, max_bits: int):
    """Edges of all cells of a partition that is sorted by cell; only one cell is kept in memory."""
    def edges(cell, fps, table):
        change = np.flatnonzero((cell[1:] != cell[:-1]).any(axis=1)) + 1
        starts, stops = np.concatenate(([0], change)), np.append(change, len(fps))
        size = np.repeat(stops - starts, stops - starts)
        run = np.repeat(np.arange(len(starts)), stops - starts)
        a, b = [], []
        for d in range(1, SMALL):
            i = np.flatnonzero((run[d:] == run[:-d]) & (size[d:] <= SMALL)) if len(run) > d else np.zeros(0, np.int64)
            hit = i[_near(fps, table, i, i + d, max_bits)]
            a.append(hit)
            b.append(hit + d)
        for k in np.flatnonzero(stops - starts > SMALL):
            s = slice(starts[k], stops[k])
            x, y = spanning_edges(fps[s], table[s], max_bits)
            a.append(x + starts[k])
            b.append(y + starts[k])
        i, j = np.concatenate(a), np.concatenate(b)
        return pa.RecordBatch.from_arrays([pa.array(fps[i].view(np.int64)), pa.array(fps[j].view(np.int64))], names=["a", "b"])

    held = None
    for batch in batches:
        cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
        cell = np.stack([cols[0], cols[1]], axis=1)
        fps = cols[2].view(np.uint64)
        table = np.ascontiguousarray(np.stack(cols[3:5], axis=1)).view(np.uint8).astype(np.int16)
        if held is not None:
            cell, fps, table = (np.concatenate(x) for x in zip(held, (cell, fps, table), strict=True))
        # The last cell may go on in the next batch.
        cut = int(np.flatnonzero((cell != cell[-1]).any(axis=1))[-1]) + 1 if len(cell) and (cell != cell[-1]).any() else 0
        held = (cell[cut:], fps[cut:], table[cut:])
        if cut:
            yield edges(cell[:cut], fps[:cut], table[:cut])
    if held is not None and len(held[1]) > 1:
        yield edges(*held)


def link(distinct: DataFrame, max_bits: int = 4) -> DataFrame:
    """Edges (a, b) between the distinct fingerprints ``_fp`` that connect all linked ones."""
    blocks, at, masks = max_bits + 2, 0, []
    for i in range(blocks):
        width = 64 // blocks + (i < 64 % blocks)
        masks.append(((1 << width) - 1) << at)
        at += width
    signed = [m - (1 << 64) if m >> 63 else m for m in (x | y for x, y in combinations(masks, 2))]
    fp = F.col("_fp")
    tables = [sum((F.shiftleft(F.bit_count(fp.bitwiseXOR(F.lit(p))).cast("long"), 8 * i)
                   for i, p in enumerate(pivots()[half: half + 8])), F.lit(0).cast("long")) for half in (0, 8)]
    keyed = (distinct.select("_fp", tables[0].alias("d0"), tables[1].alias("d1"))
             .select("_fp", "d0", "d1", F.posexplode(F.array(*[fp.bitwiseAND(F.lit(m)) for m in signed])).alias("p", "v"))
             .select(F.xxhash64("p", "v").alias("key"), "_fp", "d0", "d1"))
    # Keys are hashed to one long: two block pairs that collide only share a bucket, the check decides.
    counts = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    chunks = F.ceil(F.col("n") / CHUNK)
    cells = (keyed.join(counts, "key").withColumn("chunks", chunks)
             .withColumn("chunk", F.pmod(F.xxhash64("_fp"), F.col("chunks")))
             .select("key", "_fp", "d0", "d1", "chunks", "chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("other"))
             .select("key", (F.least("chunk", "other") * F.col("chunks") + F.greatest("chunk", "other")).alias("cell"), "_fp", "d0", "d1"))
    return (cells.repartition("key", "cell").sortWithinPartitions("key", "cell", "_fp")
            .mapInArrow(lambda batches: _cell_edges(batches, max_bits), "a long, b long").distinct())


def components(table: DataFrame, doc_id: str = "doc_id", max_bits: int = 4) -> DataFrame:
    """(_fp, component_id, _winner, _rows) of each distinct fingerprint of a ``fingerprint_table``.

    ``component_id`` is the smallest id of the component (null if all are null),
    ``_winner`` the number of a row with that id and ``_rows`` the component's number of rows.
    """
    best = F.min(F.struct(F.col(doc_id).isNull().alias("n"), F.col(doc_id).alias("id"), F.col("_row").alias("row")))
    distinct = written(table.groupBy("_fp").agg(best.alias("best"), F.count(F.lit(1)).alias("n")), "classes")
    roots = connected_components(link(distinct.select("_fp"), max_bits))
    classes = (distinct.join(roots, distinct["_fp"] == roots["node"], "left")
               .select("_fp", "best", "n", F.coalesce("root", "_fp").alias("root")))
    least = classes.groupBy("root").agg(F.min("best").alias("least"), F.sum("n").alias("_rows"))
    return classes.join(least, "root").select("_fp", F.col("least.id").alias("component_id"), F.col("least.row").alias("_winner"), "_rows")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4,
                    max_bits: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest id reachable), one row per row.

    Texts without a word (null, empty, white space) share fingerprint 0 and link like any other.
    Null ids never name a component that has another id.  Repeated rows stay.  An empty
    table gives an empty one.
    """
    table = fingerprint_table(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), shingle=shingle, carry=["doc_id"])
    found = components(table, max_bits=max_bits)
    return (table.join(found, "_fp")
            .select(F.col("doc_id").alias(doc_id), F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` with one row of each component: a row of its smallest id, all columns as they were.

    Texts without a word are one component.  Components whose ids are all null keep one row.
    Columns go by their place inside, so no name can clash.  An empty table stays empty.
    """
    places = [f"c{i}" for i in range(len(docs.columns))]
    own = places[docs.columns.index(doc_id)]
    table = fingerprint_table(docs.toDF(*places), places[docs.columns.index(text)], shingle)
    found = components(table, own, max_bits)
    # Rows that are alone in their component pass by without a shuffle.
    several = written(found.where(F.col("_rows") > 1).select("_fp", "_winner"), "groups")
    near, far = split_by_keys(table, F.xxhash64("_fp"), several.select(F.xxhash64("_fp").alias("key")))
    met = near.join(several, "_fp", "left").where(F.coalesce(F.col("_row") == F.col("_winner"), F.lit(True)))
    return met.select(*places).unionByName(far.select(*places)).toDF(*docs.columns)
