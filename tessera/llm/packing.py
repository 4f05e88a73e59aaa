"""Length-bucket packing (operator 3): optimal boundaries, token-budget batches.

The lengths of all sequences are counted into one histogram (at most ``max_len`` rows, by
construction).  Dynamic programming over it chooses the bucket boundaries that minimise
the padding, each sequence being padded to its bucket's upper length.  Within a bucket,
sequences are numbered in an order that is set by their keys alone, and every
``budget // boundary`` of them make one batch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.bpe import encoded_rows, encoder
from tessera.llm.common import map_texts, written

#: Sequences that one numbering task sorts, about.
RUN_ROWS = 100_000


def optimal_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper lengths of at most ``buckets`` buckets with the least padding in total.

    ``lengths`` ascending and distinct, ``counts`` positive.  cost(i, j) of one bucket for
    lengths i to j is ``lengths[j] * rows - tokens``; only the first part depends on the
    choice.  Ties go to the smaller index.  No lengths give no boundaries.
    """
    n = len(lengths)
    if not n:
        return []
    # Python integers could not overflow, int64 is far from it (2**20 tokens x 2**40 rows).
    rows = np.concatenate(([0], np.cumsum(counts.astype(np.int64))))
    upper = lengths.astype(np.int64)
    best = upper * rows[1:]
    choice = []
    for _ in range(1, min(buckets, n)):
        total, back = best.copy(), np.full(n, -1)
        for j in range(1, n):
            # The last bucket holds lengths i + 1 to j; the others end at length i.
            cost = best[:j] + upper[j] * (rows[j + 1] - rows[1: j + 1])
            i = int(cost.argmin())
            if cost[i] < total[j]:
                total[j], back[j] = cost[i], i
        best = total
        choice.append(back)
    out, j = [int(upper[-1])], n - 1
    for back in reversed(choice):
        if back[j] >= 0:
            j = int(back[j])
            out.append(int(upper[j]))
    return out[::-1]


def token_counts(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens) of every whole text (null: 0), by the byte-level BPE file ``path``."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def count(batches):
        e = encoder(path)
        for batch in batches:
            n = [len(x) for x in encoded_rows(e, batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], names=[doc_id, "n_tokens"])

    return map_texts(docs.select(doc_id, F.col(text).cast("string").alias("_t")), count, f"{doc_id} {kind}, n_tokens long")


def length_buckets(lengths: DataFrame, doc_id: str = "doc_id", length: str = "n_tokens", max_len: int = 2048,
                   buckets: int = 16, budget: int = 65_536) -> DataFrame:
    """One row per sequence: doc_id, piece, start, n_tokens, bucket, batch, slot, padding.

    A document of more than ``max_len`` tokens is cut into pieces of that length and a rest;
    ``start`` is a piece's first token.  ``bucket`` is the length the piece is padded to,
    ``batch`` numbers the bucket's batches from 0, ``slot`` the places in a batch;
    a batch has ``budget // bucket`` places (one at least), only a bucket's last batch may
    have fewer rows.

    Documents of no token (or null length) make no sequence.  Null ids are kept.  Repeated
    rows are sequences of their own.  An empty table gives an empty one.  No other column
    is read, so names cannot clash.
    """
    spark = lengths.sparkSession
    n = F.col("_n")
    pieces = (lengths.select(F.col(doc_id).alias("_id"), F.col(length).cast("long").alias("_n")).where(n > 0)
              .groupBy("_id", "_n").agg(F.count(F.lit(1)).alias("_copies"))
              .select("_id", "_copies", "_n", F.explode(F.sequence(F.lit(0), F.ceil(n / max_len) - 1)).alias("piece"))
              .select("_id", "_copies", F.col("piece").cast("int").alias("piece"), (F.col("piece") * max_len).alias("start"),
                      F.least(n - F.col("piece") * max_len, F.lit(max_len)).alias("_len")))
    pieces = written(pieces, "packing-pieces")
    histogram = pieces.groupBy("_len").agg(F.sum("_copies").alias("rows")).orderBy("_len").collect()
    bounds = optimal_boundaries(np.array([r[0] for r in histogram], np.int64),
                                np.array([r[1] for r in histogram], np.int64), buckets)
    total = sum(r[1] for r in histogram)
    runs = max(1, -(-total // RUN_ROWS))
    bucket = F.lit(None).cast("long")
    for b in reversed(bounds):
        bucket = F.when(F.col("_len") <= b, F.lit(b)).otherwise(bucket)
    # Numbers inside short runs of a hash order, then the runs' offsets: no task orders a whole bucket.
    keyed = (pieces.withColumn("bucket", bucket.cast("int"))
             .withColumn("_h", F.xxhash64("_id", "piece", "_len"))
             .withColumn("_run", F.pmod("_h", F.lit(runs)).cast("int")))
    sizes = keyed.groupBy("bucket", "_run").agg(F.sum("_copies").alias("_rows"))
    before = Window.partitionBy("bucket").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col("bucket").alias("_b"), F.col("_run").alias("_r"),
                           F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    inside = (Window.partitionBy("bucket", "_run").orderBy("_h", "_id", "piece", "_len")
              .rowsBetween(Window.unboundedPreceding, -1))
    numbered = (keyed.withColumn("_before", F.coalesce(F.sum("_copies").over(inside), F.lit(0)))
                .join(offsets, (F.col("bucket") == F.col("_b")) & (F.col("_run") == F.col("_r")))
                .select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)).alias("_copy"))
                .withColumn("_number", F.col("_offset") + F.col("_before") + F.col("_copy")))
    places = F.greatest(F.floor(F.lit(budget) / F.col("bucket")), F.lit(1))
    return numbered.select(
        F.col("_id").alias(doc_id), "piece", "start", F.col("_len").alias("n_tokens"), "bucket",
        F.floor(F.col("_number") / places).cast("long").alias("batch"),
        (F.col("_number") % places).cast("int").alias("slot"),
        (F.col("bucket") - F.col("_len")).cast("int").alias("padding"))
