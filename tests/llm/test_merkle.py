import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tessera.llm import merkle
from tests.llm.conftest import ODD_TEXTS, docs_frame


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(nodes):
    """Levels from the leaves up."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i: i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def climb(levels, at, node):
    """Siblings on the way up, and the root that ``node`` in place ``at`` gives."""
    found = []
    for level in levels[:-1]:
        run = level[at - at % 3: at - at % 3 + 3]
        found += run[: at % 3] + run[at % 3 + 1:]
        node = sha(*run[: at % 3], node, *run[at % 3 + 1:])
        at //= 3
    return found, node


def brute(rows, tampered):
    """rows of (doc_id, source, lang, n_chars, text) with distinct ids."""
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        own = sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0]))
        trees[s] = own, tree([leaf(r) for r in own])
    top = tree([trees[s][1][-1][0] for s in sources])
    root, out = top[-1][0], {}
    for k, s in enumerate(sources):
        own, levels = trees[s]
        for i, r in enumerate(own):
            bent = leaf((*r[:4], r[4].replace("\n", ""))) if tampered(r[0]) and r[4] is not None else leaf(r)
            low, node = climb(levels, i, bent)
            high, node = climb(top, k, node)
            out[r[0]] = (leaf(r), levels[-1][0], root, sha(*low, *high), node, node == root)
    return out


def is_even(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0


def manifest(spark, rows, **options):
    docs = docs_frame(spark, [(r[0], r[4], r[2], r[1]) for r in rows]).drop("n_chars")
    docs = docs.withColumn("n_chars", F.length("text").cast("long")).withColumn("tree", F.lit("x")).withColumn("pos", F.lit(1)).withColumn("digest", F.lit(2))
    return merkle.manifest(docs.repartition(3), tampered=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, **options)


def make_rows(sizes):
    rows, n = [], 0
    for source, size in sizes.items():
        for _ in range(size):
            text = ODD_TEXTS[n % len(ODD_TEXTS)] if n % 5 == 0 else f"line {n}\nand another\n"
            rows.append((n, source, None if n % 7 == 0 else "en", None if text is None else len(text), text))
            n += 1
    return rows


@pytest.mark.parametrize("levels", [1, 2, 5])
def test_matches_brute_force(spark, levels):
    """Hot and single groups, every size around full runs and full subtrees."""
    rows = make_rows({"b": 300, None: 28, "é": 1, "a": 2, "Z": 3, "": 4, "c": 9, "d": 10, "e": 27, "f": 1, "g": 82})
    found = manifest(spark, rows, every=levels).collect()
    assert {r.doc_id: tuple(r)[1:] for r in found} == brute(rows, is_even) and len(found) == len(rows)


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 3}, {None: 1, "a": 1}, {str(i): 1 for i in range(10)}])
def test_small_trees(spark, sizes):
    rows = make_rows(sizes)
    assert {r.doc_id: tuple(r)[1:] for r in manifest(spark, rows).collect()} == brute(rows, is_even)


def test_proofs_lead_to_the_root_and_no_other_leaf_does(spark):
    rows = make_rows({"a": 250, "b": 5})
    for r in manifest(spark, rows, proofs=True).collect():
        assert merkle.fold(r.leaf, r.proof) == r.root and merkle.proof_hash(r.proof) == r.proof_sha256
        assert merkle.fold(sha("x"), r.proof) != r.root
        changed = is_even(r.doc_id) and "\n" in (dict((x[0], x[4]) for x in rows)[r.doc_id] or "")
        assert r.verified is (not changed)


def test_null_and_repeated_ids_and_empty_table(spark):
    rows = [(None, "a", "en", 1, "x"), (3, "a", "en", 1, "y"), (3, "a", "en", 1, "y"), (3, "a", "en", 1, "z"), (None, None, None, None, None)]
    got = manifest(spark, rows).collect()
    first, last = sorted([leaf((3, "a", "en", 1, "y")), leaf((3, "a", "en", 1, "z"))])
    counts = [2, 1] if first == leaf((3, "a", "en", 1, "y")) else [1, 2]
    own = tree([leaf(rows[0]), *[first] * counts[0], *[last] * counts[1]])
    assert len(got) == 5 and {r.root for r in got} == {tree([leaf(rows[4]), own[-1][0]])[-1][0]} and all(r.verified for r in got)
    assert manifest(spark, []).count() == 0
