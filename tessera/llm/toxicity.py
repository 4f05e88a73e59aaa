"""Toxicity scores (operator 5): FTRL-proximal logistic regression over hashed word n-grams.

Features of a text are its distinct words, neighbouring pairs and skip-grams (pairs with one
word between them), hashed into 2**20 coordinates.  Follow-the-regularised-leader gives
each coordinate its own learning rate, and its L1 term leaves most weights at exactly zero,
so the model is a short list of (coordinate, weight) that is cheap to broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import add_columns, bounded_sample, fold, fold_case, mix, sampled_rows, span_hashes, text_slices, word_spans

BITS = 20
#: Distance between the two words of a pair.
DISTANCES = (1, 2)
_TO_SPACE = np.arange(256, dtype=np.uint8)
_TO_SPACE[[b for b in range(128) if not chr(b).isalnum()]] = 32


@dataclass
class Model:
    """Nonzero weights by ascending coordinate; ``slope`` and ``shift`` calibrate the sum."""

    index: np.ndarray
    weight: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def probability(self, total: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * (self.bias + total) + self.shift, -40, 40)))


def features(data: np.ndarray, offsets: np.ndarray):
    """(coordinates, rows) of words, then of pairs at each distance, inside rows."""
    clean = _TO_SPACE[fold_case(data)]
    starts, ends, rows = word_spans(clean, offsets)
    words = span_hashes(clean, starts, ends)
    down = np.uint64(64 - BITS)
    yield words >> down, rows
    for d in DISTANCES:
        if len(words) > d:
            same = rows[d:] == rows[:-d]
            pair = mix(words[:-d][same] * np.uint64(3) + words[d:][same] + np.uint64(d))
            yield pair >> down, rows[d:][same]


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
          per_class: int = 3000, epochs: int = 5, seed: int = 7) -> Model | None:
    """Fit on at most ``per_class`` labelled documents of each class (the bound on the sample).

    ``labels`` holds the rows that may be learned from; an id that is labelled more than once
    counts as 1 if any row says so; null labels take no part.  Without both classes there is no
    model.  The class shares of all usable labels set the intercept.
    """
    marks = (labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(doc_id)
             .agg(F.max(F.col(label).cast("int")).alias("_mark")))
    shares = {r[0]: r[1] for r in marks.groupBy("_mark").count().collect()}
    sample = bounded_sample(marks, doc_id, "_mark", per_class)
    if len(shares) < 2:
        return None

    def rows(batches):
        for batch in batches:
            ids, marked, keys = batch.column(0), batch.column(1), [b""] * batch.num_rows
            for first, end, data, offsets in text_slices(batch.column(2)):
                found = list(features(data, offsets))
                index, row = (np.concatenate([f[i] for f in found]) for i in (0, 1))
                for r in range(end - first):
                    keys[first + r] = np.unique(index[row == r]).astype(np.int32).tobytes() if end - first < 3 else None
                if end - first >= 3:
                    both = np.unique(row.astype(np.uint64) << np.uint64(BITS) | index)
                    cut = np.searchsorted(both, np.arange(end - first + 1, dtype=np.uint64) << np.uint64(BITS))
                    low = (both & np.uint64((1 << BITS) - 1)).astype(np.int32)
                    for r in range(end - first):
                        keys[first + r] = low[cut[r]: cut[r + 1]].tobytes()
            yield pa.RecordBatch.from_arrays([ids, marked, pa.array(keys, pa.binary())], names=["_id", "_label", "_keys"])

    kind = docs.schema[doc_id].dataType.simpleString()
    chosen = sampled_rows(docs.select(doc_id, text), doc_id, sample, "int").select(doc_id, "_label", F.col(text).cast("string"))
    found = chosen.mapInArrow(rows, f"_id {kind}, _label int, _keys binary").dropDuplicates(["_id"]).collect()
    found.sort(key=lambda r: r["_id"])
    return fit([np.frombuffer(r["_keys"], np.int32) for r in found], np.array([r["_label"] for r in found]),
               shares.get(1, 0) / max(sum(shares.values()), 1), epochs, seed)


def fit(rows: list[np.ndarray], marks: np.ndarray, share: float, epochs: int = 5, seed: int = 7, alpha: float = 1.0,
        beta: float = 1.0, l1: float = 6.0, l2: float = 0.1) -> Model | None:
    """FTRL-proximal over rows of distinct coordinates; every fifth row is kept for calibration.

    ``share`` is the share of label 1 among all labels, which the sample need not follow.
    """
    if len(set(marks.tolist())) < 2:
        return None
    rng = np.random.default_rng(seed)
    size = 1 << BITS
    z, n = np.zeros(size + 1), np.zeros(size + 1)  # the last coordinate is the intercept
    held = np.zeros(len(rows), bool)
    held[::5] = len(rows) >= 50
    weigh = {1: 0.5 / marks.mean(), 0: 0.5 / (1 - marks.mean())}

    def weights(i):
        zi = z[i]
        w = -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2)
        return np.where(np.abs(zi) <= l1, 0.0, w)

    fitted = np.flatnonzero(~held)
    for _ in range(epochs):
        for k in rng.permutation(fitted):
            i = np.append(rows[k], size)
            w = weights(i)
            p = 1 / (1 + np.exp(-np.clip(w.sum(), -40, 40)))
            g = (p - marks[k]) * weigh[int(marks[k])]
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha * w
            n[i] += g * g
    every = weights(np.arange(size + 1))
    used = np.flatnonzero(every[:-1])
    model = Model(used, every[used].astype(np.float32), float(every[-1]))
    # Platt scaling on the rows kept aside, weighted to the true class shares.
    checked = np.flatnonzero(held) if held.any() else fitted
    dense = np.zeros(size)
    dense[used] = model.weight
    total = model.bias + np.array([dense[rows[k]].sum() for k in checked])
    y = marks[checked].astype(float)
    if 0 < y.mean() < 1:
        weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean())) / len(y)
        # Few rows hardly move it from slope 1 and the shift that the class shares alone ask for.
        prior, ridge = float(np.log(share / (1 - share))), 1 / len(y)
        a, c = 1.0, prior
        for _ in range(200):
            p = 1 / (1 + np.exp(-np.clip(a * total + c, -40, 40)))
            r, s = weight * (p - y), weight * p * (1 - p)
            grad = np.array([(r * total).sum() + ridge * (a - 1), r.sum() + ridge * (c - prior)])
            hess = np.array([[(s * total * total).sum() + ridge, (s * total).sum()], [(s * total).sum(), s.sum() + ridge]])
            move = np.linalg.solve(hess, grad)
            a, c = a - float(np.clip(move[0], -1, 1)), c - float(np.clip(move[1], -1, 1))
            if np.abs(move).max() < 1e-9:
                break
        model.slope, model.shift = max(a, 1e-3), c
    return model


def score_column(model: Model | None, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(score, predicted) of every whole text; without a model the score is 0."""
    scores = np.zeros(len(column))
    if model is None:
        return scores, np.zeros(len(column), np.int32)
    dense = np.zeros(1 << BITS, np.float32)
    dense[model.index] = model.weight
    for first, end, data, offsets in text_slices(column):
        hits = []
        for index, rows in features(data, offsets):
            hit = dense[index] != 0
            hits.append(rows[hit].astype(np.uint64) << np.uint64(BITS) | index[hit])
        hits = np.unique(np.concatenate(hits))
        total = np.bincount((hits >> np.uint64(BITS)).astype(np.int64), dense[(hits & np.uint64((1 << BITS) - 1)).astype(np.int64)],
                            minlength=end - first)
        scores[first:end] = model.probability(total)
    return scores, (scores >= 0.5).astype(np.int32)


def predict(docs: DataFrame, model: Model | None, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (score >= 0.5) for each whole text.

    Null and empty texts have no feature, so their score is that of the intercept; without a
    model every score is 0.  Rows, null ids and repeated rows are kept as they are; an empty table
    stays empty; columns of the two names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # nonzero weights: at most 2**20
    return add_columns(docs, text, [("score", "double"), ("predicted", "int")],
                       lambda column: score_column(shared.value, column), carry)


def learnable(labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Labels outside the held-out fold: crc32 of the id modulo 5 is not 0."""
    return labels.where(fold(doc_id, 5) != 0)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for ``documents`` and ``labels`` tables."""
    model = train(docs.select("doc_id", "text"), learnable(labels))
    return (predict(docs, model, carry=["doc_id"])
            .select("doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted"))
