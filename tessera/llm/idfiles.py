"""Token-id files with a minimal perfect hash index (operator 6).

A shard is three raw files: ``.ids`` (ids one after the other, 2 or 4 bytes each,
little-endian), ``.key`` (document keys in file order) and ``.mph`` (the index).  The index
maps a key to its slot by hash and displacement; the slot holds a 32-bit fingerprint of the
key, the offset of its first id and the number of ids.  A lookup reads one displacement, one
slot and one slice of the payload, whatever the shard's size.

Shards cover ascending ranges of keys.  A shard's files are named after the task attempt
that wrote them, and only finished attempts reach the manifest, so a repeated task does
no harm.  The folder is read and written through ``pyarrow.fs``, from its URI.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.bpe import encoded_rows, encoder
from tessera.llm.common import mix, shared_path, written

#: Ids of one shard after which a task begins the next.
SHARD_IDS = 16 << 20
#: Keys in a bucket of the hash, on average; displacements that are tried at a time.
BUCKET_KEYS, TRIES = 3, 512
#: Index slot: fingerprint, offset in ids, number of ids.
SLOT = np.dtype([("print", "<u4"), ("start", "<u8"), ("n", "<u4")])
#: Key: document id (0 where it is null), null flag, count of earlier rows of that id in the shard.
KEY = np.dtype([("id", "<i8"), ("null", "u1"), ("copy", "<u4")])
MANIFEST = ("part int, seq int, path string, width int, n_docs long, n_ids long, "
            "first_id long, last_id long, seed int")


def _hashes(keys: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = mix(keys["id"].astype(np.uint64) ^ np.uint64(0x9E3779B97F4A7C15 * (seed + 1) & (1 << 64) - 1))
        return mix(h + keys["null"].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
                   + keys["copy"].astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


def _parts(h: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket, second hash and fingerprint of a key's hash."""
    return ((h >> np.uint64(32)) % np.uint64(buckets), mix(h ^ np.uint64(0xC2B2AE3D27D4EB4F)),
            (h & np.uint64(0xFFFFFFFF)).astype(np.uint32))


def _moved(second: np.ndarray, displacement: np.ndarray, n: int) -> np.ndarray:
    """Slot of a key under its bucket's displacement."""
    return (mix(second + displacement * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(n)).astype(np.int64)


class PerfectHash:
    """Minimal perfect hash of distinct keys: n keys to slots 0 to n - 1."""

    def __init__(self, seed: int, displace: np.ndarray, n: int):
        self.seed, self.displace, self.n = seed, displace, n

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """Largest buckets first; single keys take the free slots that are left, directly."""
        n = len(keys)
        for seed in range(64):
            if (displace := cls._try(keys, n, seed)) is not None:
                return cls(seed, displace, n)
        raise ValueError("no perfect hash found: keys are not distinct")

    @staticmethod
    def _try(keys, n, seed):
        buckets = max(1, -(-n // BUCKET_KEYS))
        if not n:
            return np.zeros(1, np.int64)
        bucket, second, _ = _parts(_hashes(keys, seed), buckets)
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
        sizes = np.diff(edges)
        displace, free = np.zeros(buckets, np.int64), np.ones(n, bool)
        for b in np.argsort(-sizes, kind="stable"):
            if sizes[b] <= 1:
                break
            own = order[edges[b]: edges[b + 1]]
            d = np.uint64(0)
            while True:
                tries = d + np.arange(TRIES, dtype=np.uint64)
                slots = _moved(second[own][:, None], tries, n)
                rows = np.sort(slots, axis=0)
                good = free[slots].all(axis=0) & (rows[1:] != rows[:-1]).all(axis=0)
                if good.any():
                    k = int(good.argmax())
                    displace[b], free[slots[:, k]] = int(tries[k]), False
                    break
                d += np.uint64(TRIES)
                if d > 1 << 20:
                    return None
        ones = np.flatnonzero(sizes == 1)
        displace[ones] = -1 - np.flatnonzero(free)[: len(ones)]
        return displace

    def slots(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slot and fingerprint of each key, in constant time each."""
        bucket, second, mark = _parts(_hashes(keys, self.seed), len(self.displace))
        d = self.displace[bucket.astype(np.int64)]
        return np.where(d < 0, -1 - d, _moved(second, np.maximum(d, 0).astype(np.uint64), self.n)), mark


def _copies(ids: np.ndarray, null: np.ndarray) -> np.ndarray:
    """How many rows of the same id come directly before, in rows sorted by id."""
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (null[1:] != null[:-1])
    at = np.arange(len(ids))
    return (at - np.maximum.accumulate(np.where(new, at, 0))).astype(np.uint32)


def _write_shard(store, path: str, keys: np.ndarray, counts: np.ndarray, payload: list[bytes]) -> int:
    """Write the three files; returns the seed of the hash."""
    starts = np.concatenate(([0], np.cumsum(counts)))[:-1]
    mph = PerfectHash.build(keys)
    slots = np.zeros(len(keys), SLOT)
    where, mark = mph.slots(keys)
    slots["print"][where], slots["start"][where], slots["n"][where] = mark, starts, counts
    for suffix, chunks in ((".ids", payload), (".key", [keys.tobytes()]),
                           (".mph", [mph.displace.astype("<i8").tobytes(), slots.tobytes()])):
        with store.open_output_stream(path + suffix) as out:
            for c in chunks:
                out.write(c)
    return mph.seed


class Shard:
    """Keyed reading of one shard; the payload is only read in the slices asked for."""

    def __init__(self, path: str, width: int, n_docs: int, seed: int):
        self.store, self.path = fs.FileSystem.from_uri(path)
        self.kind = np.dtype("<u2" if width == 2 else "<u4")
        with self.store.open_input_file(self.path + ".mph") as f:
            raw = f.read()
        cut = len(raw) - n_docs * SLOT.itemsize
        self.mph = PerfectHash(seed, np.frombuffer(raw[:cut], "<i8"), n_docs)
        self.index = np.frombuffer(raw[cut:], SLOT)

    def keys(self) -> np.ndarray:
        with self.store.open_input_file(self.path + ".key") as f:
            return np.frombuffer(f.read(), KEY)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(found, start, n) of each key; a key that is not in the shard fails its fingerprint
        but for one in 2**32, and callers with foreign keys compare ``keys()`` for certainty."""
        if not len(self.index):
            return (np.zeros(len(keys), bool), *(np.zeros(len(keys), np.int64) for _ in range(2)))
        where, mark = self.mph.slots(keys)
        row = self.index[where]
        return row["print"] == mark, row["start"].astype(np.int64), row["n"].astype(np.int64)

    def read(self, spans) -> list[np.ndarray]:
        """Ids of (start, n) spans."""
        with self.store.open_input_file(self.path + ".ids") as f:
            out = []
            for start, n in spans:
                out.append(np.frombuffer(f.read_at(int(n) * self.kind.itemsize, int(start) * self.kind.itemsize), self.kind))
            return out


def write_id_files(docs: DataFrame, path: str, end_id: int, folder: str | None = None, doc_id: str = "doc_id",
                   text: str = "text", shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encode whole texts, append ``end_id`` to each, write shards; returns the manifest.

    Manifest, one row per shard: part, seq (shards ascend by both), path, width, n_docs,
    n_ids, first_id, last_id, seed, base (ids in all shards before).

    Rows are dealt out by ranges of (id, hash of the text, place), so that neither a hot id nor
    repeated rows make a large range; null ids come first.  Null texts are empty.  Repeated ids
    are kept, each as a record of its own.  An empty table writes no shard.
    """
    spark = docs.sparkSession
    folder = folder or shared_path(spark, "id-files")
    uri = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    rows = docs.select(F.col(doc_id).cast("long").alias("_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_t"))
    ranged = (rows.withColumn("_h", F.xxhash64("_t")).withColumn("_at", F.monotonically_increasing_id())
              .repartitionByRange(F.col("_id").asc_nulls_first(), "_h", "_at")
              .sortWithinPartitions(F.col("_id").asc_nulls_first(), "_h").select("_id", "_t"))

    def write(batches):
        e = encoder(path)
        width = 2 if max(len(e.lengths) - 1, end_id) < 1 << 16 else 4
        kind = "<u2" if width == 2 else "<u4"
        end = np.array([end_id], kind).tobytes()
        task = TaskContext.get()
        part, tag = task.partitionId(), f"{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        store, root = fs.FileSystem.from_uri(uri)
        store.create_dir(root, recursive=True)
        seq, ids, null, counts, payload = 0, [], [], [], []

        def flush():
            nonlocal seq, ids, null, counts, payload
            key = np.zeros(len(ids), KEY)
            key["id"], key["null"] = ids, null
            key["copy"] = _copies(key["id"], key["null"])
            name = f"shard-{part:06d}-{seq:04d}-{tag}"
            n = np.array(counts, np.int64)
            seed = _write_shard(store, f"{root}/{name}", key, n, payload)
            known = key["id"][key["null"] == 0]
            row = [part, seq, f"{uri}/{name}", width, len(key), int(n.sum()),
                   int(known[0]) if len(known) else None, int(known[-1]) if len(known) else None, seed]
            seq, ids, null, counts, payload = seq + 1, [], [], [], []
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, [pa.int32(), pa.int32(), pa.string(), pa.int32(), *[pa.int64()] * 4, pa.int32()], strict=True)],
                names=[c.split()[0] for c in MANIFEST.split(", ")])

        size = 0
        for batch in batches:
            for key, found in zip(batch.column(0).to_pylist(), encoded_rows(e, batch.column(1)), strict=True):
                ids.append(key or 0)
                null.append(key is None)
                counts.append(len(found) + 1)
                payload.append(found.astype(kind).tobytes() + end)
                size += counts[-1]
                if size >= shard_ids:
                    yield flush()
                    size = 0
        if ids:
            yield flush()

    manifest = written(ranged.mapInArrow(write, MANIFEST), "id-manifest")
    # One row per shard of some 16 million ids: a million rows at 100 TB, in one small window.
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_id_files(manifest: DataFrame) -> DataFrame:
    """Every record, found through the index: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it.  The checksum is that of the ids as
    little-endian uint32.  A fingerprint that does not fit raises an error.
    """
    def read(batches):
        for batch in batches:
            for m in batch.to_pylist():
                shard = Shard(m["path"], m["width"], m["n_docs"], m["seed"])
                keys = shard.keys()
                found, start, n = shard.find(keys)
                if not found.all():
                    raise ValueError(f"index and keys of {m['path']} do not fit")
                sums = [zlib.crc32(x.astype("<u4").tobytes()) for x in shard.read(zip(start, n, strict=True))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys["id"], pa.int64(), mask=keys["null"] == 1), pa.array(start + m["base"], pa.int64()),
                     pa.array(n, pa.int64()), pa.array(sums, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    # A task per shard: their rows are tiny, so the planner would put all of them into one task.
    spread = manifest.select("path", "width", "n_docs", "seed", "base").repartition(max(1, manifest.count()))
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def lookup(manifest: DataFrame, keys: DataFrame, doc_id: str = "doc_id", max_shards: int = 4_000_000) -> DataFrame:
    """Ids of the asked document keys: doc_id, ids (one row per stored record of the key).

    Keys are sent to their shards by the shards' key ranges (one number per shard and end is
    broadcast, at most ``max_shards``, else an error).  Unknown and null keys give no row;
    repeated asked keys are asked once.
    """
    ranges = manifest.where(F.col("first_id").isNotNull()).select("first_id", "last_id", "path", "width", "n_docs", "seed") \
        .orderBy("part", "seq").limit(max_shards + 1).collect()
    if len(ranges) > max_shards:
        raise ValueError("more shards than max_shards")
    lows, highs = (np.array([r[i] for r in ranges], np.int64) for i in (0, 1))

    @F.pandas_udf("array<int>")
    def shards_of(column):
        # The ranges ascend, neighbours may share an end.
        value = column.to_numpy(np.int64)
        lo, hi = np.searchsorted(highs, value, "left"), np.searchsorted(lows, value, "right")
        import pandas as pd
        return pd.Series([list(range(a, b)) for a, b in zip(lo, hi, strict=True)])

    asked = (keys.select(F.col(doc_id).cast("long").alias("doc_id")).where(F.col("doc_id").isNotNull()).distinct()
             .withColumn("_s", F.explode(shards_of("doc_id"))))

    def fetch(key, group):
        import pandas as pd

        r = ranges[int(key[0])]
        shard = Shard(r["path"], r["width"], r["n_docs"], r["seed"])
        want, out = group["doc_id"].to_numpy(np.int64), []
        stored = shard.keys()
        copy = 0
        while len(want):
            k = np.zeros(len(want), KEY)
            k["id"], k["copy"] = want, copy
            found, start, n = shard.find(k)
            found &= np.isin(k, stored)
            out += list(zip(want[found].tolist(), shard.read(zip(start[found], n[found], strict=True)), strict=True))
            want, copy = want[found], copy + 1
        return pd.DataFrame({"doc_id": [a for a, _ in out], "ids": [b.astype(np.int64).tolist() for _, b in out]})

    return asked.groupBy("_s").applyInPandas(fetch, "doc_id long, ids array<long>")


def round_trip(spark: SparkSession, docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """Write the files into the shared folder and read every record back."""
    return read_id_files(write_id_files(docs, path, end_id))
