"""Language identification (operator 2): averaged hashed subword embeddings, linear softmax.

A text is its byte n-grams of 2 to 4 letters (case folded, everything that is no letter
counts as one space).  Each n-gram has an embedding, found by hash; the mean of the
embeddings goes through a linear layer and a softmax.  Both layers are trained together by
stochastic gradient descent in numpy on a bounded sample of labelled rows.  As the layers
are linear, prediction needs one table: n-gram -> contribution to each language's logit.

Rejection is calibrated on part of the sample that the training has not seen: a temperature
makes scores probabilities, and two thresholds (score; share of n-grams that training had
met) are set so that they reject a stated share of the sample's texts at most.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import add_columns, bounded_sample, fold, fold_case, sampled_rows, text_slices

UNKNOWN = "und"
ORDERS = (2, 3, 4)
BITS = 17
#: Short stretches of each sampled text that are learned beside the whole text: number and bytes.
WINDOWS, WINDOW_BYTES = 4, 40
# Bytes that count as letters: ASCII letters and all of other scripts; the rest is a space.
_CLEAN = np.full(256, 32, np.uint8)
_CLEAN[97:123] = np.arange(97, 123)
_CLEAN[128:] = np.arange(128, 256)
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True


@dataclass
class Model:
    """``table`` has a row per n-gram hash: logits of each language, then 1 if training met it."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    min_score: float
    min_seen: float


def letters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes with non-letters as single spaces, and the rows' new offsets."""
    clean = _CLEAN[fold_case(data)]
    keep = np.ones(len(clean), bool)
    keep[1:] = (clean[1:] != 32) | (clean[:-1] != 32)
    keep[offsets[:-1][offsets[:-1] < len(clean)]] = True
    return clean[keep], np.concatenate(([0], np.cumsum(keep)))[offsets]


def ngrams(clean: np.ndarray, offsets: np.ndarray):
    """For each order: (hashes of all n-grams inside rows, rows' offsets among them)."""
    b = clean.astype(np.uint32)
    code = b
    for n in range(2, ORDERS[-1] + 1):
        code = (code[:-1] << np.uint32(8)) | b[n - 1:] if len(code) > 1 else code[:0]
        if n in ORDERS:
            inside = np.ones(len(code), bool)
            for back in range(1, n):
                at = offsets[1:-1] - back
                inside[at[(at >= 0) & (at < len(code))]] = False
            where = np.minimum(offsets, len(code))
            counts = np.concatenate(([0], np.cumsum(inside)))
            hashed = (code[inside] * np.uint32(2654435761) + np.uint32(n * 40503 << 8)) * np.uint32(2246822519)
            yield hashed >> np.uint32(32 - BITS), counts[where]


def _row_sums(values: np.ndarray, offsets: np.ndarray, rows: int) -> np.ndarray:
    out = np.zeros((rows, values.shape[1]))
    full = np.flatnonzero(offsets[1:] > offsets[:-1])
    if len(full):
        out[full] = np.add.reduceat(values, offsets[:-1][full], axis=0, dtype=np.float64)
    return out


def _has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    counts = np.concatenate(([0], np.cumsum(_ASCII_LETTER[data])))
    found = counts[offsets[1:]] > counts[offsets[:-1]]
    for i in np.flatnonzero(~found):
        found[i] = any(c.isalpha() for c in data[offsets[i]: offsets[i + 1]].tobytes().decode())
    return found


def _examples(text: bytes):
    """Hashes with weights that add up to 1, of the whole text and of some short stretches."""
    data = np.frombuffer(text, np.uint8)
    clean, _ = letters(data, np.array([0, len(data)]))
    spans = [(0, len(clean))]
    if len(clean) > 2 * WINDOW_BYTES:
        spans += [(s, s + WINDOW_BYTES) for s in np.linspace(0, len(clean) - WINDOW_BYTES, WINDOWS).astype(int).tolist()]
    for s, e in spans:
        part = clean[s:e]
        grams = np.concatenate([h for h, _ in ngrams(part, np.array([0, len(part)]))]) if len(part) else []
        if len(grams):
            keys, counts = np.unique(grams, return_counts=True)
            yield keys.astype(np.int32), (counts / counts.sum()).astype(np.float32)


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = 300,
          dim: int = 16, epochs: int = 4, reject_share: float = 0.001, seed: int = 7) -> Model | None:
    """Fit on at most ``per_language`` documents of each language (the bound on the sample).

    ``docs`` holds the rows that may be learned from.  Rows without id, text or language take
    no part; of repeated ids one row is used.  Without any labelled text there is no model.
    """
    usable = docs.where(F.col(text).isNotNull())
    sample = bounded_sample(usable, doc_id, lang, per_language)
    if not sample:
        return None

    def features(batches):
        for batch in batches:
            ids, labels, rows = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()
            out = []
            for i, label, t in zip(ids, labels, rows, strict=True):
                out += [(i, label, k, keys.tobytes(), w.tobytes()) for k, (keys, w) in enumerate(_examples(t.encode()))]
            cols = list(zip(*out, strict=True)) or [()] * 5
            kinds = [batch.column(0).type, pa.string(), pa.int32(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                             names=["_id", "_label", "_k", "_keys", "_weights"])

    kind = docs.schema[doc_id].dataType.simpleString()
    chosen = sampled_rows(usable.select(doc_id, text, lang), doc_id, sample, "string")
    chosen = chosen.where(F.col(lang) == F.col("_label")).select(doc_id, "_label", F.col(text).cast("string"))
    found = (chosen.mapInArrow(features, f"_id {kind}, _label string, _k int, _keys binary, _weights binary")
             .dropDuplicates(["_id", "_label", "_k"]).collect())
    found.sort(key=lambda r: (r["_label"], r["_id"], r["_k"]))
    # Every fifth document, by a hash of its id, is held out whole; the first example is its whole text.
    held = [zlib.crc32(f"held out {r['_id']}".encode()) % 5 == 0 for r in found]
    return fit([(r["_label"], np.frombuffer(r["_keys"], np.int32), np.frombuffer(r["_weights"], np.float32)) for r in found],
               dim, epochs, reject_share, seed, held=held, whole=[r["_k"] == 0 for r in found])


def fit(examples: list[tuple[str, np.ndarray, np.ndarray]], dim: int = 16, epochs: int = 4, reject_share: float = 0.001,
        seed: int = 7, rate: float = 1.0, held: list[bool] | None = None, whole: list[bool] | None = None) -> Model | None:
    """Train on (label, hashes, weights) by SGD.

    ``held`` examples are kept from training, and those of them that are ``whole`` texts calibrate the model;
    without any, or with fewer than 50 examples, all are trained on and calibrate.
    """
    if not examples:
        return None
    languages = sorted({e[0] for e in examples})
    index = {name: i for i, name in enumerate(languages)}
    rng = np.random.default_rng(seed)
    held = np.array(held if held is not None and len(examples) >= 50 else [False] * len(examples), bool)
    if held.all():
        held[:] = False
    fitted = np.flatnonzero(~held)
    size = 1 << BITS
    embedding = rng.normal(0, 0.3, (size, dim)).astype(np.float32)
    seen = np.zeros(size, bool)
    head, bias = np.zeros((dim, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    for k in fitted:
        seen[examples[k][1]] = True
    for epoch in range(epochs):
        step = rate / (1 + epoch)
        for k in rng.permutation(fitted):
            label, keys, weights = examples[k]
            rows = embedding[keys]
            mean = weights @ rows
            logits = mean @ head + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[index[label]] -= 1
            back = head @ p
            head -= step * np.outer(mean, p)
            bias -= 0.01 * step * p
            # The mean spreads the gradient thinly: its scale is given back to rare n-grams.
            embedding[keys] = rows - step * np.sqrt(weights / weights.max())[:, None] * back[None, :] * 0.1
    # An n-gram that training has not met says nothing.
    table = (embedding @ head) * seen[:, None]
    model = Model(languages, np.concatenate((table, seen[:, None]), axis=1).astype(np.float32), bias, 1.0, 0.0, 0.0)
    checked = np.flatnonzero(held & np.array(whole, bool)) if whole is not None else np.flatnonzero(held)
    checked = checked if len(checked) else fitted
    truth = np.array([index[examples[k][0]] for k in checked])
    sums = np.stack([examples[k][2] @ model.table[examples[k][1]] for k in checked]).astype(np.float64)
    scale = np.geomspace(0.05, 20, 60)
    loss = [-np.log(np.maximum(_softmax((sums[:, :-1] + bias) / t)[np.arange(len(truth)), truth], 1e-12)).mean() for t in scale]
    model.temperature = float(scale[int(np.argmin(loss))])
    score = _softmax((sums[:, :-1] + bias) / model.temperature).max(axis=1)
    # Half the share for each threshold; neither ever rejects a text that is clearly known.
    model.min_score = float(min(0.5, np.quantile(score, reject_share / 2)))
    model.min_seen = float(min(0.5, np.quantile(sums[:, -1], reject_share / 2)))
    return model


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def score_column(model: Model | None, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(language, score, rejected) of every whole text of an Arrow column."""
    n = len(column)
    names, scores, rejected = np.full(n, UNKNOWN, object), np.zeros(n), np.ones(n, bool)
    if model is None:
        return names, scores, rejected
    languages = np.array(model.languages, object)
    for first, end, data, offsets in text_slices(column):
        rows = end - first
        clean, own = letters(data, offsets)
        sums, counts = np.zeros((rows, model.table.shape[1])), np.zeros(rows)
        for hashes, where in ngrams(clean, own):
            sums += _row_sums(model.table[hashes], where, rows)
            counts += np.diff(where)
        mean = sums / np.maximum(counts, 1)[:, None]
        p = _softmax((mean[:, :-1] + model.bias) / model.temperature)
        known = _has_letter(data, offsets)
        names[first:end] = np.where(known, languages[p.argmax(axis=1)], UNKNOWN)
        scores[first:end] = np.where(known, p.max(axis=1), 0.0)
        rejected[first:end] = ~known | (p.max(axis=1) < model.min_score) | (mean[:, -1] < model.min_seen)
    return names, scores, rejected


def predict(docs: DataFrame, model: Model | None, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``docs`` with lang_pred, score and rejected for each whole text.

    ``lang_pred`` is a learned language, or ``und`` with score 0 where the text is null or has
    no letter; those rows are rejected, as are those below a calibrated threshold.  Without a
    model every text is ``und``.  Rows, ids and repeated rows are kept as they are; an empty
    table stays empty; columns of the three names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**17 rows x languages: bounded by BITS
    return add_columns(docs, text, [("lang_pred", "string"), ("score", "double"), ("rejected", "boolean")],
                       lambda column: score_column(shared.value, column), carry)


def learnable(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Rows outside the held-out fold: crc32 of the id modulo 3 is not 1."""
    return docs.where(fold(doc_id, 3) != 1)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected for a ``documents`` table."""
    model = train(learnable(docs.select("doc_id", "text", "lang")))
    return (predict(docs, model, carry=["doc_id"])
            .select("doc_id", F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected"))
