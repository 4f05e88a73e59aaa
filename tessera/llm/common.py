"""Helpers shared by the training-data operators: tables, the shared folder, Arrow text."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import Window

from tessera.session import checkpoint_dir
from tessera.tables import load

#: Bytes of text that a task turns into numpy arrays at a time (one longer text goes alone); the arrays of n-grams take some hundred times that.
SLICE_BYTES = 1 << 18
#: Bytes of rows that Spark sends to a Python worker at a time (one longer row goes alone).
BATCH_BYTES = 1 << 22
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The ``documents`` table, only the named columns."""
    return load(spark, sf_dir, "documents").select(*columns)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder of ``spark.checkpoint.dir``."""
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Cut the lineage: write ``df`` into the shared folder and read it again."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_written(spark: SparkSession, path: str) -> None:
    """Delete a folder made by :func:`shared_path` whose readers have all been written."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


#: Bits of a key filter: 64 in each of its words, whose number is fixed (4 MB), whatever the keys.
FILTER_WORDS = 1 << 18


def split_by_keys(rows: DataFrame, key, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` that may have one of the ``keys`` (a written table of one long), and those that surely have none.

    A filter of fixed size is broadcast, so no row is shuffled.  It is exact in what it lets go: with many
    keys it lets fewer rows go, and no result changes.  ``key`` is the hash of a row, never null.
    """
    def bits(column):
        at = F.pmod(column, F.lit(64 * FILTER_WORDS))
        return F.shiftright(at, 6).cast("int"), at.bitwiseAND(F.lit(63)).cast("int")
    word, bit = bits(F.col(keys.columns[0]))
    words = (keys.select(word.alias("_word"), bit.alias("_bit")).groupBy("_word")
             .agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_bits")))
    word, bit = bits(key)
    met = rows.withColumn("_word", word).withColumn("_bit", bit).join(F.broadcast(words), "_word", "left")
    hit = F.coalesce(F.expr("shiftrightunsigned(_bits, _bit)").bitwiseAND(F.lit(1)) == 1, F.lit(False))
    flagged = met.withColumn("_maybe", hit).drop("_word", "_bit", "_bits")
    return flagged.where("_maybe").drop("_maybe"), flagged.where(~F.col("_maybe")).drop("_maybe")


def fold(doc_id: str, modulus: int):
    """crc32 of the id as text, modulo ``modulus`` (null ids: null)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus


def bounded_sample(rows: DataFrame, key: str, label: str, per_class: int) -> list[tuple]:
    """At most ``per_class`` keys of each label, the first by hash of the key.

    The choice depends on the keys alone, not on partitioning.  Keys or labels that
    are null take no part.  Keys are thinned out by hash before a label's keys meet, to some
    times the number wanted, so a label with most of the rows makes no large task.
    """
    distinct = written(rows.where(F.col(key).isNotNull() & F.col(label).isNotNull()).select(key, label).distinct(), "sample-keys")
    counts = distinct.groupBy(F.col(label).alias("_l")).agg(F.count(F.lit(1)).alias("_c"))
    # The hash as a number from 0 to 1: the smallest hashes are those below the share.
    place = F.xxhash64(key) / F.lit(2.0 ** 64) + 0.5
    # One row per label (the classes of a model), broadcast so that no label is shuffled whole.
    near = distinct.join(F.broadcast(counts), F.col(label) == F.col("_l")).where(place <= F.lit(8.0 * per_class + 64) / F.col("_c"))
    w = Window.partitionBy(label).orderBy(F.xxhash64(key), key)
    chosen = near.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= per_class)
    return sorted((r[0], r[1]) for r in chosen.select(key, label).collect())


def sampled_rows(df: DataFrame, key: str, sample: list[tuple], label_type: str) -> DataFrame:
    """Rows of ``df`` whose key is in a bounded sample, with its label as ``_label``.

    The sample's size is a parameter of the caller, so it may be broadcast.
    """
    kind = dict(df.dtypes)[key]
    small = df.sparkSession.createDataFrame(sample, f"_key {kind}, _label {label_type}")
    return df.join(F.broadcast(small), df[key] == small["_key"]).drop("_key")


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Whole texts of an Arrow string column, some at a time, as UTF-8 bytes.

    Yields (first row, end row, bytes, offsets): row ``first + i`` holds
    ``bytes[offsets[i]:offsets[i + 1]]``.  Null texts are empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        end = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        end = min(max(end, first + 1), len(column))
        yield first, end, data[offsets[first]: offsets[end]], offsets[first: end + 1] - offsets[first]
        first = end


# ASCII white space that separates words (space and 0x09 to 0x0D).
SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
IS_WORD_BYTE = np.ones(256, bool)
IS_WORD_BYTE[list(SEPARATORS)] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def fold_case(data: np.ndarray) -> np.ndarray:
    """Lower-cases ASCII and the two-byte Latin-1 capitals (À to Þ)."""
    out = LOWER[data]
    if len(out) > 1:
        capital = (out[:-1] == 0xC3) & (out[1:] >= 0x80) & (out[1:] <= 0x9E) & (out[1:] != 0x97)
        out[1:][capital] += 0x20
    return out


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every word; words never cross a row's end."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    word = IS_WORD_BYTE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(data), bool)
    before[0], before[1:] = False, word[:-1]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = False, word[1:]
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, SLICE_BYTES)
        _POWERS[:] = [np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size, b, np.uint64))))
                      for b in (_BASE, pow(_BASE, -1, 1 << 64))]
    return _POWERS[0][:n], _POWERS[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit values."""
    h = h.astype(np.uint64)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: Spans over this many bytes are hashed one by one.
LONG_SPAN = 64
_TAIL = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def byte_windows(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on (zeros beyond the end), as little-endian numbers, without a copy of each."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span: eight bytes at a time, mixed after each; XXH64 of spans over ``LONG_SPAN`` bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    windows, size = byte_windows(data), ends - starts
    out = mix(size.astype(np.uint64) * np.uint64(_BASE))
    live = np.arange(len(starts))
    for at in range(0, LONG_SPAN, 8):
        live = live[size[live] > at]
        if not len(live):
            break
        word = windows[starts[live] + at] & _TAIL[np.minimum(size[live] - at, 8)]
        out[live] = mix((out[live] ^ word) * np.uint64(_BASE) + np.uint64(at + 1))
    long = np.flatnonzero(size > LONG_SPAN)
    if len(long):
        from xxhash import xxh64_intdigest

        out[long] = np.array([xxh64_intdigest(data[a:b].tobytes()) for a, b in zip(starts[long], ends[long], strict=True)], np.uint64)
    return out


def equal_spans(a: np.ndarray, at_a: np.ndarray, b: np.ndarray, at_b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether spans of ``size`` bytes (``LONG_SPAN`` at most) from places in two ``byte_windows`` are equal, byte by byte."""
    same, live = np.ones(len(size), bool), np.arange(len(size))
    for at in range(0, LONG_SPAN, 8):
        live = live[size[live] > at]
        if not len(live):
            break
        differ = ((a[at_a[live] + at] ^ b[at_b[live] + at]) & _TAIL[np.minimum(size[live] - at, 8)]) != 0
        same[live[differ]] = False
    return same


def map_texts(rows: DataFrame, run, schema) -> DataFrame:
    """``rows.mapInArrow``, for rows that hold whole texts: a worker gets ``BATCH_BYTES`` of them at a time.

    By itself Spark counts rows (10,000), whatever their texts take, and holds such a batch several times.  The
    session's setting is lowered, never raised, and stays, as the frame is computed later.
    """
    spark = rows.sparkSession
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_BATCH)) > BATCH_BYTES:
        spark.conf.set(_BATCH, BATCH_BYTES)

    def freed(batches):
        yield from run(batches)
        # The worker goes on to other stages: what this one held goes back.
        pa.default_memory_pool().release_unused()

    return rows.mapInArrow(freed, schema)


def carried(docs: DataFrame, kept: list[str], text: str) -> tuple[DataFrame, list[str], int]:
    """The ``kept`` columns of ``docs`` with the whole text as a string, their names inside, and the text's place.

    Inside, columns go by their place, so no name can clash.  A text that is kept is there once.
    """
    places = [f"c{i}" for i in range(len(kept))]
    rows = [F.col(f"`{c}`").alias(p) for c, p in zip(kept, places, strict=True)]
    if text in kept and docs.select(F.col(f"`{text}`")).schema[0].dataType == StringType():
        return docs.select(*rows), places, kept.index(text)
    return docs.select(*rows, F.col(f"`{text}`").cast("string").alias("text")), places, len(kept)


def add_columns(docs: DataFrame, text: str, fields: list[tuple[str, str]], compute, carry: list[str] | None = None) -> DataFrame:
    """``docs`` (only the columns ``carry``, if given) with columns computed from whole texts.

    ``compute`` gets an Arrow string column and returns one Arrow or numpy array per field.
    A carried column that has the name of a new field is replaced.  Empty tables stay empty.
    """
    new = [name for name, _ in fields]
    kept = [c for c in (docs.columns if carry is None else carry) if c not in new]
    rows, places, whole = carried(docs, kept, text)
    made = [f"n{i}" for i in range(len(new))]
    schema = rows.select(*places, *[F.lit(None).cast(kind).alias(p) for p, (_, kind) in zip(made, fields, strict=True)]).schema
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string()}

    def run(batches):
        for batch in batches:
            found = compute(batch.column(whole))
            found = [pa.array(x, kinds[kind]) for x, (_, kind) in zip(found, fields, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(kept))] + found, names=places + made)

    return map_texts(rows, run, schema).toDF(*kept, *new)
