from itertools import combinations

import numpy as np
import pytest

from tessera.llm import packing
from tessera.llm.queries import tokenizer_path
from tests.llm.conftest import ODD_TEXTS, docs_frame


def padding(lengths, counts, bounds):
    return sum(c * (min(b for b in bounds if b >= n) - n) for n, c in zip(lengths, counts, strict=True))


def test_boundaries_are_optimal(rng):
    for _ in range(60):
        lengths = np.sort(rng.choice(40, rng.integers(1, 9), replace=False) + 1)
        counts = rng.integers(1, 50, len(lengths))
        for k in (1, 2, 3, 5):
            got = packing.optimal_boundaries(lengths, counts, k)
            assert len(got) <= k and got[-1] == lengths[-1]
            best = min(padding(lengths, counts, [*c, lengths[-1]]) for m in range(k) for c in combinations(lengths[:-1].tolist(), m))
            assert padding(lengths, counts, got) == best
    assert packing.optimal_boundaries(np.zeros(0, np.int64), np.zeros(0, np.int64), 3) == []


@pytest.mark.parametrize("runs", [100_000, 7])
def test_plan_keeps_every_token_once(spark, rng, monkeypatch, runs):
    monkeypatch.setattr(packing, "RUN_ROWS", runs)
    rows = [(i, int(n)) for i, n in enumerate(rng.integers(0, 90, 200))] + [(5, 20)] * 40 + [(None, 12)] * 30 + [(7, None), (900, 0)]
    frame = spark.createDataFrame(rows, "doc_id long, n_tokens long")
    plan = packing.length_buckets(frame, max_len=32, buckets=4, budget=128).collect()
    got = sorted((str(r.doc_id), r.start, r.n_tokens) for r in plan)
    want = sorted((str(d), s, min(32, n - s)) for d, n in rows if n for s in range(0, n, 32))
    assert got == want
    places = {}
    for r in plan:
        assert r.n_tokens <= r.bucket and r.padding == r.bucket - r.n_tokens and r.start == 32 * r.piece
        places.setdefault((r.bucket, r.batch), []).append(r.slot)
    for bucket in {r.bucket for r in plan}:
        batches = sorted(b for k, b in places if k == bucket)
        assert batches == list(range(len(batches)))
        for b in batches:
            full = max(128 // bucket, 1)
            size = len(places[bucket, b])
            assert sorted(places[bucket, b]) == list(range(size)) and (size == full or b == batches[-1] and size < full)
    lengths, counts = np.unique([x[2] for x in want], return_counts=True)
    assert sorted({r.bucket for r in plan}) == packing.optimal_boundaries(lengths, counts, 4)


def test_token_counts_of_odd_texts(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "a b")]
    got = packing.token_counts(docs_frame(spark, rows), tokenizer_path())
    want = sorted(str((d, len(tok.encode(t or "", add_special_tokens=False).ids))) for d, t in rows)
    assert sorted(str(tuple(r)) for r in got.collect()) == want
    assert packing.length_buckets(got.where("false")).count() == 0
