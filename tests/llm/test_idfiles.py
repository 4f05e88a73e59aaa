import zlib

import numpy as np
from tokenizers import Tokenizer

from tessera.llm import idfiles
from tessera.llm.queries import tokenizer_path
from tests.llm.conftest import ODD_TEXTS, docs_frame, prose

PATH = tokenizer_path()


def keys(ids, copies=None):
    k = np.zeros(len(ids), idfiles.KEY)
    k["id"] = ids
    if copies is not None:
        k["copy"] = copies
    return k


def test_perfect_hash_is_minimal(rng):
    for n in (1, 2, 3, 7, 50, 2_000):
        k = keys(rng.choice(10**9, n, replace=False))
        slots, _ = idfiles.PerfectHash.build(k).slots(k)
        assert sorted(slots) == list(range(n))


def want_rows(rows):
    tok = Tokenizer.from_file(PATH)
    out, at = [], 0
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_records_in_order_of_id(spark, rng):
    rows = [(int(d), prose(rng, int(rng.integers(1, 40)))) for d in rng.choice(1_000, 150, replace=False)]
    rows += [(2_000 + i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "null id")]
    docs = docs_frame(spark, rows).withColumnRenamed("lang", "start").repartition(3)
    manifest = idfiles.write_id_files(docs, PATH, 2, shard_ids=1_000)
    assert manifest.count() > 3
    got = sorted((tuple(r) for r in idfiles.read_id_files(manifest).collect()), key=lambda r: r[1])
    assert got == want_rows(rows)


def test_repeated_ids_are_records_of_their_own(spark):
    rows = [(5, "same")] * 30 + [(5, "other"), (6, "x"), (None, "n"), (None, "n")]
    manifest = idfiles.write_id_files(docs_frame(spark, rows), PATH, 2, shard_ids=20)
    got = [tuple(r) for r in idfiles.read_id_files(manifest).collect()]
    assert sorted((str(a), n, c) for a, _, n, c in got) == sorted((str(a), n, c) for a, _, n, c in want_rows(rows))
    spans = sorted((s, n) for _, s, n, _ in got)
    assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:], strict=False))


def test_lookup_by_key(spark, rng):
    rows = [(3 * i, prose(rng, 12)) for i in range(120)] + [(30, "again")]
    manifest = idfiles.write_id_files(docs_frame(spark, rows), PATH, 2, shard_ids=500)
    asked = spark.createDataFrame([(0,), (30,), (31,), (357,), (5_000,), (-1,), (None,), (0,)], "doc_id long")
    tok = Tokenizer.from_file(PATH)
    want = sorted((d, [*tok.encode(t, add_special_tokens=False).ids, 2]) for d, t in rows if d in (0, 30, 357))
    assert sorted((r.doc_id, r.ids) for r in idfiles.lookup(manifest, asked).collect()) == want


def test_empty_table(spark):
    manifest = idfiles.write_id_files(docs_frame(spark, []), PATH, 2)
    assert idfiles.read_id_files(manifest).count() == 0
