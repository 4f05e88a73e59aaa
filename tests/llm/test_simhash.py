import re

import numpy as np
import pandas as pd
import xxhash

from tessera.llm import simhash
from tessera.llm.components import connected_components
from tests.llm.conftest import ODD_TEXTS, docs_frame, prose


def brute_fingerprint(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i: i + k]) for i in range(max(len(words) - k + 1, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, bits=4):
    fps = [brute_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [(d, f"{fps[i]:016x}", low.get(find(i))) for i, (d, _) in enumerate(rows)]


def make_rows(rng):
    rows, base = [], [prose(rng, n) for n in (3, 30, 80, 200, 400)]
    for i, text in enumerate(base * 4):
        words = text.split(" ")
        for _ in range(i // 5):
            words[rng.integers(len(words))] = "changed" + str(i)
        rows.append((100 - i, " ".join(words)))
    rows += [(200 + i, t) for i, t in enumerate(ODD_TEXTS)]
    return rows + [(None, base[1]), (None, "alone here"), (99, base[1]), (99, base[1]), (300, prose(rng, 60).upper())]


def as_set(df):
    return sorted(map(str, df.itertuples(index=False, name=None)))


def test_components_match_brute_force(spark, rng):
    rows = make_rows(rng)
    got = simhash.near_duplicates(docs_frame(spark, rows).withColumnRenamed("lang", "_fp")).toPandas().astype(object)
    want = pd.DataFrame(brute_components(rows), columns=got.columns, dtype=object)
    clean = lambda d: sorted((str(a), b, str(c)) for a, b, c in d.replace({np.nan: None}).itertuples(index=False, name=None))
    assert [x[1] for x in clean(got)] == [x[1] for x in clean(want)]
    norm = lambda rows: sorted((str(None if pd.isna(a) else int(a)), b, str(None if pd.isna(c) else int(c))) for a, b, c in rows)
    assert norm(got.itertuples(index=False, name=None)) == norm(want.itertuples(index=False, name=None))


def test_random_fingerprints_lose_no_link(spark, rng):
    centre = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    fps = set()
    for c in centre:
        for _ in range(12):
            x = int(c)
            for b in rng.integers(0, 64, rng.integers(0, 7)):
                x ^= 1 << int(b)
            fps.add(x)
    fps = sorted(fps)
    frame = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "_fp long")
    got = {r.node: r.root for r in connected_components(simhash.link(frame)).collect()}
    root = {x: x for x in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, x in enumerate(fps):
        for y in fps[:i]:
            if (x ^ y).bit_count() <= 4:
                root[find(x)] = find(y)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    for i, x in enumerate(fps):
        for y in fps[:i]:
            a, b = signed(x), signed(y)
            assert (find(x) == find(y)) == (got.get(a, a) == got.get(b, b))


def test_large_cells_are_cut_and_joined(spark, rng, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 7)
    frame = spark.createDataFrame([(1 << b | 1 << c,) for b in range(40) for c in range(b)], "_fp long")
    roots = {r.root for r in connected_components(simhash.link(frame)).collect()}
    assert len(roots) == 1


def test_spanning_edges_join_what_brute_force_joins(rng):
    fps = rng.integers(0, 1 << 12, 200, dtype=np.uint64)
    fps = np.unique(fps)
    table = np.stack([np.bitwise_count(fps ^ np.uint64(p & (1 << 64) - 1)) for p in simhash.pivots()], axis=1).astype(np.int16)
    a, b = simhash.spanning_edges(fps, table, 2)
    assert len(a) <= len(fps) - 1
    label = np.arange(len(fps))
    for _ in range(len(fps)):
        np.minimum.at(label, a, label[b])
        np.minimum.at(label, b, label[a])
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 2
    want = np.arange(len(fps))
    for _ in range(len(fps)):
        want = np.where(near, want[None, :], len(fps)).min(axis=1)
    assert (label == want).all()


def test_keep_one_keeps_a_row_of_the_smallest_id(spark, rng):
    rows = make_rows(rng)
    docs = docs_frame(spark, rows).withColumnsRenamed({"lang": "_fp", "source": "_row", "n_chars": "c1"})
    kept = simhash.keep_one(docs)
    assert {(r["_fp"], r["_row"]) for r in kept.collect()} == {("en", "src0")}
    assert kept.columns == docs.columns
    found = brute_components(rows)
    groups = {c for _, _, c in found if c is not None}
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(groups)
    assert ids.count(None) == 1  # "alone here", whose group has no id


def test_empty_table(spark):
    empty = docs_frame(spark, [])
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.keep_one(empty).count() == 0
