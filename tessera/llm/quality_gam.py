"""Quality scores (operator 10): generalised additive model with pairwise interactions.

Each whole text becomes a few statistics.  Every statistic is cut into bins; cyclic boosting
fits one shallow tree after the other to the remaining error, always on a single statistic,
and adds it to that statistic's lookup table.  Then the pairs with the most error left get
two-dimensional tables in the same way.  A score is a sum of table cells, found by bin.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import (LOWER, add_columns, bounded_sample, fold, sampled_rows, span_hashes, text_slices, word_spans)

FEATURES = ("words", "word_length", "word_spread", "long_words", "letters", "capitals", "digits", "symbols", "stops", "bars",
            "lines", "line_words", "repeated_lines", "repeated_words", "repeated_pairs", "capital_words", "marked_words", "sentence_words")
BINS = 64


def _mask(chars: str) -> np.ndarray:
    out = np.zeros(256, np.int64)
    out[[ord(c) for c in chars]] = 1
    return out


_LETTER = _mask("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER[0xC0:] = 1  # first bytes of letters in other scripts
_CAPITAL, _DIGIT = _mask("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _mask("0123456789")
_SYMBOL, _STOP, _BAR = _mask("#*$%&<>@^~{}[]\\=+_"), _mask(".!?"), _mask("|")
_NEWLINE = 10


def _repeats(rows: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """How many items of each row equal another, earlier item of the row."""
    if not len(rows):
        return np.zeros(n)
    order = np.lexsort((hashes, rows))
    r, h = rows[order], hashes[order]
    again = (r[1:] == r[:-1]) & (h[1:] == h[:-1])
    return np.bincount(r[1:][again], minlength=n).astype(float)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of ``FEATURES`` for each text; rates are per word, line or character, smoothed for short texts."""
    n = len(offsets) - 1

    def count(mask):
        total = np.concatenate(([0], np.cumsum(mask[data])))
        return (total[offsets[1:]] - total[offsets[:-1]]).astype(float)

    starts, ends, rows = word_spans(data, offsets)
    size = (ends - starts).astype(float)
    words = np.bincount(rows, minlength=n).astype(float)
    chars, squares = np.bincount(rows, size, n), np.bincount(rows, size * size, n)
    hashes = span_hashes(LOWER[data], starts, ends)
    mean = chars / np.maximum(words, 1)
    pairs = hashes[:-1] * np.uint64(3) + hashes[1:] if len(hashes) > 1 else hashes[:0]
    same = rows[1:] == rows[:-1] if len(rows) > 1 else np.zeros(0, bool)
    # Lines with at least one word, as spans from their first to their last word.
    breaks = np.concatenate(([0], np.cumsum(data == _NEWLINE)))
    first = np.ones(len(starts), bool)
    first[1:] = (breaks[starts[1:]] != breaks[starts[:-1]]) | ~same
    heads = np.flatnonzero(first)
    line_ends = ends[np.append(heads[1:], len(starts)) - 1] if len(heads) else ends[:0]
    line_rows = rows[heads]
    lines = np.bincount(line_rows, minlength=n).astype(float)
    caps = np.concatenate(([0], np.cumsum(_CAPITAL[data])))
    marks = np.concatenate(([0], np.cumsum((_SYMBOL | _BAR | _mask("!"))[data])))
    capital_words = (caps[ends] - caps[starts] >= 2).astype(float)
    marked = ((marks[ends] - marks[starts]) > 0).astype(float)
    letters, stops = count(_LETTER), count(_STOP)
    per = np.maximum(chars, 1)
    return np.stack([
        np.log1p(words), mean, np.sqrt(np.maximum(squares / np.maximum(words, 1) - mean * mean, 0)),
        np.bincount(rows, size > 20, n) / np.maximum(words, 1),
        letters / per, count(_CAPITAL) / per, count(_DIGIT) / per, count(_SYMBOL) / per, stops / per, count(_BAR) / per,
        np.log1p(lines), words / np.maximum(lines, 1),
        _repeats(line_rows, span_hashes(data, starts[heads], line_ends), n) / (lines + 1),
        _repeats(rows, hashes, n) / np.maximum(words, 1),
        _repeats(rows[1:][same], pairs[same], n) / np.maximum(words, 1),
        np.bincount(rows, capital_words, n) / np.maximum(words, 1), np.bincount(rows, marked, n) / np.maximum(words, 1),
        words / (stops + 1)], axis=1)


@dataclass
class Model:
    """``edges[f]`` cut statistic f into bins; tables hold what a bin, or a pair of bins, adds."""

    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]
    bias: float

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], "right") for f, e in enumerate(self.edges)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        total = np.full(len(x), self.bias)
        for f, t in enumerate(self.tables):
            total += t[b[:, f]]
        for (f, g), t in zip(self.pairs, self.pair_tables, strict=True):
            total += t[b[:, f], b[:, g]]
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def _steps(grad: np.ndarray, hess: np.ndarray, leaves: int, ridge: float = 1.0) -> np.ndarray:
    """A regression tree with ``leaves`` leaves over ordered bins: the value of each bin."""
    cuts = [0, len(grad)]
    cg, ch = np.concatenate(([0], np.cumsum(grad))), np.concatenate(([0], np.cumsum(hess)))
    for _ in range(leaves - 1):
        best = (1e-9, None)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b - a < 2:
                continue
            m = np.arange(a + 1, b)
            lg, lh, g, h = cg[m] - cg[a], ch[m] - ch[a], cg[b] - cg[a], ch[b] - ch[a]
            gain = lg ** 2 / (lh + ridge) + (g - lg) ** 2 / (h - lh + ridge) - g ** 2 / (h + ridge)
            if gain.max() > best[0]:
                best = (gain.max(), int(m[gain.argmax()]))
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.empty(len(grad))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        out[a:b] = -(cg[b] - cg[a]) / (ch[b] - ch[a] + ridge)
    return out


def _quadrants(grad: np.ndarray, hess: np.ndarray, ridge: float = 1.0) -> tuple[float, np.ndarray]:
    """The best cut of a two-dimensional table into four cells: (gain, value of each bin pair)."""
    cg, ch = (np.zeros((grad.shape[0] + 1, grad.shape[1] + 1)) for _ in range(2))
    cg[1:, 1:], ch[1:, 1:] = grad.cumsum(0).cumsum(1), hess.cumsum(0).cumsum(1)
    g, h = cg[-1, -1], ch[-1, -1]
    parts = []
    for c in (cg, ch):
        a, top, left = c[1:-1, 1:-1], c[1:-1, -1:], c[-1:, 1:-1]
        parts.append((a, top - a, left - a, c[-1, -1] - top - left + a))
    if not parts[0][0].size:
        return 0.0, np.zeros_like(grad)
    gain = sum(x * x / (y + ridge) for x, y in zip(*parts, strict=True)) - g * g / (h + ridge)
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    v = [-x[i, j] / (y[i, j] + ridge) for x, y in zip(*parts, strict=True)]
    out = np.empty_like(grad)
    out[: i + 1, : j + 1], out[: i + 1, j + 1:], out[i + 1:, : j + 1], out[i + 1:, j + 1:] = v
    return float(gain[i, j]), out


def fit(x: np.ndarray, marks: np.ndarray, share: float, rounds: int = 120, pairs: int = 6, pair_rounds: int = 40,
        leaves: int = 3, rate: float = 0.15) -> Model | None:
    """Cyclic boosting of logistic loss; ``share`` is the share of label 1 among all labels."""
    if len(set(marks.tolist())) < 2:
        return None
    y = marks.astype(float)
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    model = Model(edges, [np.zeros(len(e) + 1) for e in edges], [], [], float(np.log(share / (1 - share))))
    b = model.bins(x)
    total = np.full(len(x), model.bias)

    def slopes():
        p = 1 / (1 + np.exp(-total))
        return weight * (p - y), weight * p * (1 - p)

    for _ in range(rounds):
        for f, table in enumerate(model.tables):
            g, h = slopes()
            step = rate * _steps(np.bincount(b[:, f], g, len(table)), np.bincount(b[:, f], h, len(table)), leaves)
            table += step
            total += step[b[:, f]]

    def grid(f, k, values):
        shape = (len(model.tables[f]), len(model.tables[k]))
        return np.bincount(b[:, f] * shape[1] + b[:, k], values, shape[0] * shape[1]).reshape(shape)

    g, h = slopes()
    gains = [(_quadrants(grid(f, k, g), grid(f, k, h))[0], f, k) for f, k in combinations(range(x.shape[1]), 2)]
    model.pairs = [(f, k) for gain, f, k in sorted(gains, key=lambda t: (-t[0], t[1:]))[:pairs] if gain > 0]
    model.pair_tables = [np.zeros((len(model.tables[f]), len(model.tables[k]))) for f, k in model.pairs]
    for _ in range(pair_rounds):
        for (f, k), table in zip(model.pairs, model.pair_tables, strict=True):
            g, h = slopes()
            step = rate * _quadrants(grid(f, k, g), grid(f, k, h))[1]
            table += step
            total += step[b[:, f], b[:, k]]
    return model


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
          per_class: int = 3000) -> Model | None:
    """Fit on at most ``per_class`` labelled documents of each class (the bound on the sample).

    ``labels`` holds the rows that may be learned from; an id that is labelled more than once
    counts as 0 if any row says so; null labels take no part.  Without both classes there is no
    model.  Only the statistics of sampled texts come to the driver.
    """
    marks = (labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(doc_id)
             .agg(F.min(F.col(label).cast("int")).alias("_mark")))
    shares = {r[0]: r[1] for r in marks.groupBy("_mark").count().collect()}
    sample = bounded_sample(marks, doc_id, "_mark", per_class)
    if len(shares) < 2:
        return None

    def rows(batches):
        for batch in batches:
            out = np.zeros((batch.num_rows, len(FEATURES)))
            for first, end, data, offsets in text_slices(batch.column(2)):
                out[first:end] = statistics(data, offsets)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(out), pa.list_(pa.float64()))],
                                             names=["_id", "_label", "_x"])

    kind = docs.schema[doc_id].dataType.simpleString()
    chosen = sampled_rows(docs.select(doc_id, text), doc_id, sample, "int").select(doc_id, "_label", F.col(text).cast("string"))
    found = chosen.mapInArrow(rows, f"_id {kind}, _label int, _x array<double>").dropDuplicates(["_id"]).collect()
    found.sort(key=lambda r: r["_id"])
    if not found:
        return None
    return fit(np.array([r["_x"] for r in found]), np.array([r["_label"] for r in found]), shares.get(1, 0) / sum(shares.values()))


def score_column(model: Model | None, column: pa.Array, threshold: float = 0.7) -> tuple[np.ndarray, np.ndarray]:
    """(score, predicted) of every whole text; without a model the score is 0."""
    scores = np.zeros(len(column))
    if model is not None:
        for first, end, data, offsets in text_slices(column):
            scores[first:end] = model.score(statistics(data, offsets))
    return scores, (scores >= threshold).astype(np.int32)


def predict(docs: DataFrame, model: Model | None, text: str = "text", carry: list[str] | None = None,
            threshold: float = 0.7) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (score >= threshold) for each whole text.

    Null and empty texts have statistics of zero and are scored by them; without a model every
    score is 0.  Rows, null ids and repeated rows are kept as they are; an empty table stays
    empty; columns of the two names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # tables of BINS cells: bounded
    return add_columns(docs, text, [("score", "double"), ("predicted", "int")],
                       lambda column: score_column(shared.value, column, threshold), carry)


def learnable(labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Labels outside the held-out fold: crc32 of the id modulo 4 is not 2."""
    return labels.where(fold(doc_id, 4) != 2)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for ``documents`` and ``labels`` tables."""
    model = train(docs.select("doc_id", "text"), learnable(labels))
    return (predict(docs, model, carry=["doc_id"])
            .select("doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score", "predicted"))
