"""Dense network on flat vectors: ReLU hidden units, softmax output, cross-entropy, Adam.

The training rows are written once, dealt into mini-batches by a hash of their key.  A step reads
one batch: every task sums the gradient over its part of the rows, the sums are added by
place in a shuffle, and the mean gradient moves the weights.  So a step depends on the
batch and not on how the rows lie in partitions.  The driver holds the weights and one gradient, whose size
is that of the layers, whatever the number of rows; the weights reach the tasks as a broadcast of that size.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tessera.functions.cleaning import ColumnOrName, _col
from tessera.session import scratch_path

#: Labels are listed on the driver; a column with more levels is no class label.
MAX_CLASSES = 10_000
#: The usual decay rates and guard of Adam.
BETA_1, BETA_2, GUARD = 0.9, 0.999, 1e-7

Layers = list[tuple[np.ndarray, np.ndarray]]


def start_weights(sizes: Sequence[int], seed: int) -> Layers:
    """Uniform weights whose limits follow the number of inputs and outputs of each layer; zero offsets."""
    rng = np.random.default_rng(seed)
    return [(rng.uniform(-1, 1, (a, b)) * np.sqrt(6 / (a + b)), np.zeros(b)) for a, b in zip(sizes, sizes[1:])]


def probabilities(x: np.ndarray, layers: Layers) -> tuple[np.ndarray, list[np.ndarray]]:
    """Class probabilities of each row, and the input of every layer."""
    inputs = [x]
    for w, b in layers[:-1]:
        inputs.append(np.maximum(inputs[-1] @ w + b, 0.0))
    z = inputs[-1] @ layers[-1][0] + layers[-1][1]
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True), inputs


def loss_and_gradient(x: np.ndarray, y: np.ndarray, layers: Layers) -> np.ndarray:
    """Sums over the rows, flat: number of rows, cross-entropy, then each layer's weights and offsets."""
    p, inputs = probabilities(x, layers)
    at = np.arange(len(y))
    loss = -np.log(np.maximum(p[at, y], 1e-300)).sum()
    delta, parts = p, []
    delta[at, y] -= 1.0
    for k in range(len(layers) - 1, -1, -1):
        parts.append((inputs[k].T @ delta, delta.sum(axis=0)))
        if k:
            delta = (delta @ layers[k][0].T) * (inputs[k] > 0)
    return np.concatenate([[len(y), loss], *[v.ravel() for pair in reversed(parts) for v in pair]])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def batch_sums(rows: DataFrame, layers: Layers) -> np.ndarray:
    """``loss_and_gradient`` of all ``rows`` (class number, vector), summed over their partitions."""
    shared = rows.sparkSession.sparkContext.broadcast(layers)
    width, size = layers[0][0].shape[0], 2 + sum(w.size + b.size for w, b in layers)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += loss_and_gradient(_matrix(batch.column(1), width), batch.column(0).to_numpy(), shared.value)
        if total[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], names=["place", "value"])

    found = rows.mapInArrow(partial, "place int, value double").groupBy("place").agg(F.sum("value").alias("value")).toArrow()
    shared.destroy()
    out = np.zeros(size)
    out[found["place"].to_numpy()] = found["value"].to_numpy()
    return out


def _flat(layers: Layers) -> np.ndarray:
    return np.concatenate([v.ravel() for pair in layers for v in pair])


def _shaped(flat: np.ndarray, like: Layers) -> Layers:
    out, at = [], 0
    for w, b in like:
        out.append((flat[at: at + w.size].reshape(w.shape), flat[at + w.size: at + w.size + b.size]))
        at += w.size + b.size
    return out


@dataclass(frozen=True)
class Network:
    """Weights, the label of each output, and the mean training loss of each epoch."""

    layers: Layers
    classes: list
    losses: list[float]

    def scores(self, vector: ColumnOrName) -> Column:
        """Class probabilities in the order of ``classes``; NULL for a vector that is NULL, holds NULL,
        NaN or infinity, or has another length."""
        layers, width = self.layers, self.layers[0][0].shape[0]

        @F.pandas_udf("array<double>")
        def forward(v: pd.Series) -> pd.Series:
            if v.empty:
                return pd.Series([], dtype=object)
            return pd.Series(list(probabilities(np.stack(v.to_numpy()), layers)[0]), dtype=object)

        good = usable(vector, width)
        # Unusable vectors pass as zeros: the function then meets one shape only.
        return F.when(good, forward(F.when(good, _col(vector)).otherwise(F.array_repeat(F.lit(0.0), width))))

    def predict(self, df: DataFrame, vector: str, out: str = "prediction") -> DataFrame:
        """``df`` with the likeliest label as ``out``, ties to the smaller label; NULL where ``scores`` is."""
        s = self.scores(vector)
        labels = F.array(*[F.lit(c) for c in self.classes])
        return df.withColumn(out, s).withColumn(out, F.get(labels, (F.array_position(out, F.array_max(out)) - 1).cast("int")))


def usable(vector: ColumnOrName, width: int) -> Column:
    """Whether a vector has ``width`` finite components."""
    ok = F.forall(_col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(_col(vector)) == width) & ok, F.lit(False))


def dense_network(train: DataFrame, label: str, vector: str, key: str, hidden: Sequence[int] = (128,), epochs: int = 5,
                  batches: int = 16, rate: float = 0.001, seed: int = 123) -> Network:
    """Fit on ``train``: a label, an array of numbers and a key that tells rows apart.

    ``batches`` is the number of steps per epoch; more rows give larger batches, not more steps.
    Rows with a NULL label or an unusable vector (``usable``; the width is the commonest length, ties to the
    smaller) are left out; without any row, or with one class only, an error is raised.  Repeated rows count each.
    """
    clean = train.select(F.col(label).alias("label"), F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v")).where(
        F.col("label").isNotNull())
    width = clean.where(F.size("v") > 0).groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if width is None:
        raise ValueError("no training row has a label and a vector")
    clean = clean.where(usable("v", width["n"]))
    classes = sorted(r["label"] for r in clean.select("label").distinct().limit(MAX_CLASSES + 1).collect())
    if not 2 <= len(classes) <= MAX_CLASSES:
        raise ValueError(f"a label needs 2 to {MAX_CLASSES} classes")

    spark = train.sparkSession
    path = scratch_path(spark, f"batches-{uuid.uuid4().hex[:12]}")
    numbers = spark.createDataFrame(list(zip(classes, range(len(classes)))), StructType([clean.schema["label"], StructField("class", IntegerType())]))
    dealt = clean.join(F.broadcast(numbers), "label").select("class", "v", F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(batches)).cast("int").alias("batch"))
    dealt.write.partitionBy("batch").parquet(path)
    rows = spark.read.schema(dealt.schema).parquet(path)

    layers = start_weights([width["n"], *hidden, len(classes)], seed)
    flat, step, losses = _flat(layers), 0, []
    mean, square = np.zeros_like(flat), np.zeros_like(flat)
    for _ in range(epochs):
        seen, loss = 0.0, 0.0
        for b in range(batches):
            sums = batch_sums(rows.where(F.col("batch") == b).select("class", "v"), _shaped(flat, layers))
            if not sums[0]:
                continue
            seen, loss, step = seen + sums[0], loss + sums[1], step + 1
            g = sums[2:] / sums[0]
            mean = BETA_1 * mean + (1 - BETA_1) * g
            square = BETA_2 * square + (1 - BETA_2) * g * g
            flat = flat - rate * (mean / (1 - BETA_1 ** step)) / (np.sqrt(square / (1 - BETA_2 ** step)) + GUARD)
        losses.append(float(loss / seen))
    return Network(_shaped(flat, layers), classes, losses)
