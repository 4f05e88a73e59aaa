"""Scores of operators 2, 5 and 10 against plain Python that follows one text at a time."""

import math
from bisect import bisect_right

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import langid, quality_gam, toxicity
from tessera.llm.common import mix, span_hashes
from tests.llm.conftest import ODD_TEXTS, docs_frame, prose

MORE = ["ÀÉÎ Öl straße ×÷ ÞÐ", "Line one.\nline one.\n\n Line one. \nLine one.", "AB ab Ab!! |x| #tag $5 a.b?c", "ab\n" * 40, "été ÉTÉ Été 中文 中文 中"]


def texts(rng):
    return [t for t in ODD_TEXTS if t is None or len(t) < 30_000] + MORE + [prose(rng, int(rng.integers(1, 120))) for _ in range(25)]


def folded(text):
    """Bytes with A-Z and the Latin-1 capitals (À to Þ but ×) in lower case."""
    out = "".join(c.lower() if "A" <= c <= "Z" or ("À" <= c <= "Þ" and c != "×") else c for c in text or "")
    return out.encode()


def word_hash(word):
    return int(span_hashes(np.frombuffer(word, np.uint8), np.array([0]), np.array([len(word)]))[0])


def brute_language(model, text):
    clean = bytearray()
    for b in folded(text):
        b = b if 97 <= b < 123 or b >= 128 else 32
        if b != 32 or clean[-1:] != b" ":
            clean.append(b)
    if not any(c.isalpha() for c in text or ""):
        return langid.UNKNOWN, 0.0, True
    sums, n_grams = np.zeros(model.table.shape[1]), 0
    for n in langid.ORDERS:
        for i in range(len(clean) - n + 1):
            code = int.from_bytes(clean[i: i + n], "big")
            place = (code * 2654435761 + (n * 40503 << 8)) % 2 ** 32 * 2246822519 % 2 ** 32 >> 32 - langid.BITS
            sums += model.table[place].astype(float)
            n_grams += 1
    mean = sums / max(n_grams, 1)
    logits = [(x + b) / model.temperature for x, b in zip(mean[:-1], model.bias.astype(float), strict=True)]
    parts = [math.exp(x - max(logits)) for x in logits]
    score = max(parts) / sum(parts)
    return model.languages[parts.index(max(parts))], score, score < model.min_score or mean[-1] < model.min_seen


def test_language_scores(spark, rng):
    docs = docs_frame(spark, [(i, prose(rng, 30, "abcdefghé" if i % 2 else "efghmnopqrst"), "aa" if i % 2 else "mm") for i in range(120)])
    model = langid.train(docs, per_language=50)
    given = texts(rng)
    names, scores, rejected = langid.score_column(model, pa.array(given, pa.string()))
    for text, name, score, out in zip(given, names, scores, rejected, strict=True):
        want = brute_language(model, text)
        assert (name, bool(out)) == (want[0], want[2]) and score == pytest.approx(want[1], abs=1e-6), text


def brute_toxicity(model, text):
    clean = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in folded(text))
    words = [word_hash(w) for w in clean.split()]
    found = {w >> 64 - toxicity.BITS for w in words}
    for d in toxicity.DISTANCES:
        for a, b in zip(words, words[d:]):
            found.add(int(mix(np.array([(a * 3 + b + d) % 2 ** 64], np.uint64))[0]) >> 64 - toxicity.BITS)
    weight = dict(zip(model.index.tolist(), model.weight.tolist(), strict=True))
    total = model.bias + sum(weight.get(i, 0.0) for i in found)
    return 1 / (1 + math.exp(-max(-40, min(40, model.slope * total + model.shift))))


def test_toxicity_scores(spark, rng):
    rows = [(i, prose(rng, 30) + (" bad Word here" if i % 2 else " bad thing word")) for i in range(120)]
    model = toxicity.train(docs_frame(spark, rows), spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id long, toxic int"))
    given = texts(rng) + [t for _, t in rows[:20]] + ["bad word", "BAD word here, bad word here", "word bad"]
    scores, predicted = toxicity.score_column(model, pa.array(given, pa.string()))
    assert len(model.index) and len(set(scores.round(6))) > 3
    for text, score, one in zip(given, scores, predicted, strict=True):
        assert score == pytest.approx(brute_toxicity(model, text), abs=1e-6) and one == (score >= 0.5), text


def brute_statistics(text):
    raw = (text or "").encode()
    lines = [x for x in raw.split(b"\n") if x.split()]
    words = [w for x in lines for w in x.split()]
    n, sizes = max(len(words), 1), [len(w) for w in words]
    mean, per = sum(sizes) / n, max(sum(sizes), 1)

    def count(chars, where=raw):
        return sum(where.count(c.encode()) for c in chars)
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    letters, symbols = sum(chr(b).isalpha() if b < 128 else b >= 0xC0 for b in raw), "#*$%&<>@^~{}[]\\=+_"

    def repeats(items):
        return len(items) - len(set(items))
    low = [w.lower() for w in words]  # of bytes: A to Z alone
    return [math.log1p(len(words)), mean, math.sqrt(max(sum(s * s for s in sizes) / n - mean * mean, 0)), sum(s > 20 for s in sizes) / n,
            letters / per, count(capitals) / per, count("0123456789") / per, count(symbols) / per, count(".!?") / per, count("|") / per,
            math.log1p(len(lines)), len(words) / max(len(lines), 1), repeats([x.strip() for x in lines]) / (len(lines) + 1), repeats(low) / n,
            repeats(list(zip(low, low[1:]))) / n, sum(count(capitals, w) >= 2 for w in words) / n,
            sum(count(symbols + "|!", w) > 0 for w in words) / n, len(words) / (count(".!?") + 1)]


def test_quality_scores(spark, rng):
    rows = [(i, prose(rng, int(rng.integers(5, 90))) + (" ### || $$$" * int(rng.integers(1, 9)) if i % 2 else "")) for i in range(200)]
    model = quality_gam.train(docs_frame(spark, rows), spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int"))
    given = texts(rng) + [t for _, t in rows[:40]]
    raw = [(t or "").encode() for t in given]
    x = quality_gam.statistics(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    assert np.allclose(x, [brute_statistics(t) for t in given], rtol=1e-9, atol=1e-6)
    scores, predicted = quality_gam.score_column(model, pa.array(given, pa.string()))
    for row, score, one in zip(x, scores, predicted, strict=True):
        bins = [bisect_right(e.tolist(), v) for e, v in zip(model.edges, row, strict=True)]
        total = model.bias + sum(t[b] for t, b in zip(model.tables, bins, strict=True))
        total += sum(t[bins[f], bins[g]] for (f, g), t in zip(model.pairs, model.pair_tables, strict=True))
        assert score == pytest.approx(1 / (1 + math.exp(-max(-40, min(40, total)))), abs=1e-12) and one == (score >= 0.7)
