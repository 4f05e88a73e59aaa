"""Retrieval for question tables against direct computation."""

import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tessera.operators import retrieve


def best(scored, k):
    """scored: question -> [(score, key)]."""
    return {q: [(key, s) for s, key in sorted(rows, key=lambda r: (-r[0], r[1]))[:k]] for q, rows in scored.items()}


def answers(frame):
    out = {}
    for r in frame.orderBy("question", "rank").collect():
        out.setdefault(r.question, []).append((r.key, r.score))
    return out


def test_vectors_in_blocks_equal_all_pairs(spark):
    """Several blocks and parts; repeated vectors tie; null, partly null and zero vectors take no part."""
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(0, 1, (300, 6)), 1)
    x[100:130] = x[5]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (901, [1.0, None] + [0.0] * 4), (902, [0.0] * 6)]
    frame = spark.createDataFrame(rows, "key long, vector array<double>").repartition(3)
    got = answers(retrieve.top_k(frame.where("key % 7 = 0 or key > 800"), frame, 4, block=13, part=70))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = best({i: [(round(float(unit[i] @ unit[j]), 9), j) for j in range(300)] for i in range(0, 300, 7)}, 4)
    assert {q: [k for k, _ in a] for q, a in got.items()} == {q: [k for k, _ in a] for q, a in want.items()}
    assert all(math.isclose(a[1], b[1], abs_tol=2e-9) for q in want for a, b in zip(got[q], want[q], strict=True))
    assert answers(retrieve.top_k(frame.limit(0), frame, 4)) == {} and answers(retrieve.top_k(frame, frame.limit(0), 4)) == {}


def test_ten_thousand_questions(spark):
    """Questions are rows, not parts of the plan."""
    rows = spark.range(10_000).select(F.col("id").alias("key"), F.array(F.cos("id"), F.sin("id")).alias("vector"))
    found = retrieve.top_k(rows, rows.where("key < 50"), 1)
    assert found.count() == 10_000 and found.where("question < 50 and question <> key").count() == 0


def test_sparse_vectors_equal_a_direct_tfidf(spark):
    rng = np.random.default_rng(9)
    words = ["the"] * 20 + [f"w{chr(97 + i)}" for i in range(15)]
    texts = [" ".join(rng.choice(words, int(rng.integers(1, 30)))) for _ in range(120)] + ["", None, "42 !", "Élan vital, the ÉLAN"]
    asked = ["wa wb the", "élan", "nothing known", "", None, "wc wc wd"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(3)
    questions = spark.createDataFrame(list(enumerate(asked)), "id long, text string")
    counts = retrieve.term_counts(docs, F.struct(F.col("id").alias("d"), F.lit(1).alias("c")), "text")
    df = retrieve.document_frequencies(counts)
    vectors = retrieve.tfidf(counts, df, len(texts))
    got = answers(retrieve.top_k(retrieve.tfidf(retrieve.term_counts(questions, F.col("id"), "text"), df, len(texts)), vectors, 5, block=2, part=40))

    def terms(t):
        return Counter("".join(c if c.isalpha() else " " for c in (t or "").lower()).split())
    frequency = Counter(w for t in texts for w in terms(t))

    def vector(t):
        v = {w: n * (math.log((1 + len(texts)) / (1 + frequency[w])) + 1) for w, n in terms(t).items() if w in frequency}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / size for w, x in v.items()}
    corpus = [vector(t) for t in texts]
    scored = {}
    for q, t in enumerate(asked):
        v = vector(t)
        rows = [(round(sum(v[w] * c[w] for w in v if w in c), 9), i) for i, c in enumerate(corpus) if v.keys() & c.keys()]
        if rows:
            scored[q] = rows
    want = best(scored, 5)
    assert {q: [k.d for k, _ in a] for q, a in got.items()} == {q: [k for k, _ in a] for q, a in want.items()} and set(want) == {0, 1, 5}
    assert all(math.isclose(a[1], b[1], abs_tol=2e-9) for q in want for a, b in zip(got[q], want[q], strict=True))


def test_vector_length_is_taken_once_per_text(spark):
    """Texts over several Arrow batches, null keys and null parts of keys; no aggregate over a text's terms inside a transform of them."""
    rows = [((d, c), f"t{i:05d}", 1 + i % 3) for d, c, n in [(1, 1, 25_000), (1, None, 3), (None, 1, 2), (None, None, 1), (2, 1, 1)] for i in range(n)] + [(None, "t00000", 2)]
    counts = spark.createDataFrame(rows, "key struct<d:long,c:long>, term string, tf long").repartition(3)
    df = retrieve.document_frequencies(counts)
    found = retrieve.tfidf(counts, df, 6)
    assert "aggregate(" not in found._jdf.queryExecution().optimizedPlan().toString()
    frequency, want = Counter(t for _, t, _ in rows), {}
    for key, term, tf in rows:
        want.setdefault(key, {})[term] = tf * (math.log(7 / (1 + frequency[term])) + 1)
    got = {tuple(r.key) if r.key else None: dict(zip(r.terms, r.weights, strict=True)) for r in found.collect()}
    assert got.keys() == want.keys()
    for key, vector in want.items():
        size = math.sqrt(sum(w * w for w in vector.values()))
        assert got[key].keys() == vector.keys() and all(math.isclose(got[key][t], w / size, rel_tol=1e-12) for t, w in vector.items())
