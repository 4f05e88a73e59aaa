"""Merkle manifest of a dataset (operator 13): checkpoint and recompute.

Each row is a leaf; the leaves of a group, in order, are hashed in runs of ``ARITY`` level by level up to the
group's subroot, and the subroots up to the root.  Only every ``LEVELS``-th level is persisted: a
task takes the stored nodes of one aligned subtree (``ARITY ** LEVELS`` at most), folds it up and hands on
its top alone.  Proofs go down from the root: each aligned subtree is folded again from its
stored nodes, the siblings on each node's way are emitted, followed by the way of the
subtree's top, and the interior nodes are discarded.

A large group is many subtrees: positions come from running totals over ranges, and no
task holds more than one subtree.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written
from tessera.operators.windows import global_row_number, join_null_safe

#: Nodes of a run, and levels between persisted ones (an aligned subtree has ``ARITY ** LEVELS`` stored nodes).
ARITY, LEVELS = 3, 5


def node_hash(parts: list[str]) -> str:
    """Lowercase hex SHA-256 of the parts, one after the other."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _folded(nodes: list[str], alone: bool, every: int) -> list[list[str]]:
    """The levels of a subtree from its stored nodes up; ``alone``: it is the whole tree, and ends at one node."""
    levels = [nodes]
    while len(levels) <= every and not (alone and len(levels[-1]) == 1):
        below = levels[-1]
        levels.append([node_hash(below[i: i + ARITY]) for i in range(0, len(below), ARITY)])
    return levels


def _way(levels: list[list[str]], at: int) -> list[str]:
    """Steps from a stored node to the top of its subtree: own place in the run, then the siblings' digests."""
    steps = []
    for level in levels[:-1]:
        first, place = at - at % ARITY, at % ARITY
        run = level[first: first + ARITY]
        steps.append(str(place) + "".join(run[:place] + run[place + 1:]))
        at //= ARITY
    return steps


def fold(node: str, steps: list[str]) -> str:
    """The root that a node and the steps of its proof lead to."""
    for step in steps:
        place, siblings = int(step[0]), [step[i: i + 64] for i in range(1, len(step), 64)]
        node = node_hash([*siblings[:place], node, *siblings[place:]])
    return node


def proof_hash(steps: list[str]) -> str:
    """Hash of all siblings of a proof, level by level, left to right."""
    return node_hash([step[1:] for step in steps])


def stored_levels(nodes: DataFrame, every: int = LEVELS) -> list[DataFrame]:
    """The persisted levels (tree, pos, n, digest), from the leaves up; ``n`` counts the tree's nodes of the level.

    ``nodes`` is the lowest level, written.  The list is as long as the largest tree is high, over ``every``.
    """
    levels, size = [nodes.select("tree", "pos", "n", "digest")], ARITY ** every

    def tops(batches):
        for batch in batches:
            found = [_folded([x["digest"] for x in members], n <= size, every)[-1][0]
                     for members, n in zip(batch.column(3).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(4), pa.array(found, pa.string())],
                                             names=["tree", "pos", "n", "digest"])
    while True:
        open_ = levels[-1].where(F.col("n") > 1)
        if open_.isEmpty():
            return levels
        kind = dict(open_.dtypes)["tree"]
        groups = (open_.groupBy("tree", F.floor(F.col("pos") / size).alias("pos"), "n")
                  .agg(F.array_sort(F.collect_list(F.struct(F.col("pos").alias("at"), "digest"))).alias("members"))
                  .withColumn("up", F.ceil(F.col("n") / size).cast("long")))
        levels.append(written(groups.mapInArrow(tops, f"tree {kind}, pos long, n long, digest string"), "merkle-level"))


def roots(levels: list[DataFrame]) -> DataFrame:
    """(tree, root) of every tree: the nodes that are alone on a stored level."""
    out = levels[0].where(F.col("n") == 1)
    for level in levels[1:]:
        out = out.unionByName(level.where(F.col("n") == 1))
    return out.select("tree", F.col("digest").alias("root"))


def _subtrees(nodes: DataFrame, ways: DataFrame, size: int) -> DataFrame:
    """Stored nodes and, before them, the way of their subtree's top, subtree by subtree."""
    own = [c for c in nodes.columns if c not in ("tree", "pos", "n", "digest")]
    kinds = dict(nodes.dtypes)
    rows = nodes.select("tree", F.floor(F.col("pos") / size).alias("up"), "pos", "n", "digest", *own, F.lit(None).cast("array<string>").alias("way"))
    heads = ways.select("tree", F.col("pos").alias("up"), F.lit(-1).cast("long").alias("pos"), F.lit(0).cast("long").alias("n"),
                        F.lit("").alias("digest"), *[F.lit(None).cast(kinds[c]).alias(c) for c in own], "way")
    return heads.unionByName(rows).repartition("tree", "up").sortWithinPartitions(F.col("tree").asc_nulls_first(), "up", "pos")


def regenerate(nodes: DataFrame, ways: DataFrame, emit, schema: str, every: int = LEVELS) -> DataFrame:
    """Fold every subtree of a level again and emit one row per node.

    ``ways`` has (tree, pos, way) of each subtree's top.  ``emit(row, way)`` gets a node's row, as a
    dict, and the steps to the root, and returns a tuple for ``schema``.
    """
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string())}
    types, size = [kinds.get(c.split()[1]) for c in schema.split(", ")], ARITY ** every

    def run(batches):
        at, way, held = None, [], []

        def out():
            levels = _folded([r["digest"] for r in held], held[0]["n"] <= size, every)
            found = [emit(r, _way(levels, i) + way) for i, r in enumerate(held)]
            return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], t) for k, t in enumerate(types)], names=names)
        for batch in batches:
            for row in batch.to_pylist():
                if (row["tree"], row["up"]) != at:
                    if held:
                        yield out()
                    at, way, held = (row["tree"], row["up"]), [], []
                if row["pos"] < 0:
                    way = row["way"]
                else:
                    held.append(row)
        if held:
            yield out()
    return _subtrees(nodes, ways, size).mapInArrow(run, schema)


def tops_of(levels: list[DataFrame], above: DataFrame, every: int = LEVELS) -> DataFrame:
    """(tree, pos, way) of the tops of the lowest level's subtrees, where ``above`` has (tree, way) of each tree's root.

    Goes down level by level; each is written, so only one level's interior nodes ever exist, and only in tasks.
    """
    def finished(level: DataFrame, lowest: bool) -> DataFrame:
        last = level.where((F.col("n") <= ARITY ** every) & (F.col("pos") == 0) & (F.lit(lowest) | (F.col("n") > 1)))
        return join_null_safe(last.select("tree", "pos"), above, ["tree"])
    kind, ways = dict(levels[0].dtypes)["tree"], None
    for k in reversed(range(len(levels))):
        level = levels[k]
        done = finished(level, k == 0)
        here = done if ways is None else done.unionByName(ways)
        if k == 0:
            return here
        ways = written(regenerate(level.where(F.col("n") > 1), here, lambda r, way: (r["tree"], r["pos"], way), f"tree {kind}, pos long, way array<string>",
                                  every), "merkle-ways")


def leaf_rows(docs: DataFrame, tampered: Column, doc_id: str = "doc_id", source: str = "source", lang: str = "lang", n_chars: str = "n_chars",
              text: str = "text") -> DataFrame:
    """doc_id, tree (the source), digest and, for tampered rows, ``bent``: the digest with the text's line feeds deleted."""
    def field(value):
        return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))

    def digest(whole):
        return F.sha2(F.concat(*[field(c) for c in (*given, whole)]).cast("binary"), 256)
    given = [F.col(f"`{c}`").cast("string") for c in (doc_id, source, lang, n_chars)]
    whole = F.col(f"`{text}`").cast("string")
    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), given[1].alias("tree"), digest(whole).alias("digest"),
                       F.when(F.coalesce(tampered, F.lit(False)), digest(F.replace(whole, F.lit("\n"), F.lit("")))).alias("bent"))


def manifest(docs: DataFrame, tampered: Column | None = None, doc_id: str = "doc_id", source: str = "source", lang: str = "lang",
             n_chars: str = "n_chars", text: str = "text", proofs: bool = False, every: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row; with ``proofs`` also ``proof``.

    ``proof`` lists the steps from the leaf to the root (place in the run, then the siblings' digests).  Rows for
    which ``tampered`` holds are folded from the leaf that they have without line feeds in the text.  ``every`` is
    the number of levels between persisted ones; it changes no result.

    Null values have a mark of their own in the leaf; rows of a null source are a group, the first one.  Null ids come
    first in their group; repeated ids are leaves of their own, in the order of their digests.  Empty and very long texts are
    hashed whole.  Columns of any other name are left out.  An empty table gives an empty manifest.
    """
    rows = leaf_rows(docs, F.lit(False) if tampered is None else tampered, doc_id, source, lang, n_chars, text)
    order = [F.col("doc_id").asc_nulls_first(), F.col("digest").asc()]
    leaves = global_row_number(rows, order, "pos", total_name="n", keys=["tree"]).withColumn("pos", F.col("pos") - 1)
    leaves = written(leaves, "merkle-leaves")
    levels = stored_levels(leaves, every)
    subroots = written(roots(levels), "merkle-subroots")
    # The groups are the leaves of one more tree, in the order of their names.
    named = global_row_number(subroots, [F.col("tree").asc_nulls_first()], "pos", total_name="n")
    named = written(named.select(F.lit(0).cast("long").alias("tree"), (F.col("pos") - 1).alias("pos"), "n", F.col("root").alias("digest"),
                                 F.col("tree").alias("name")), "merkle-groups")
    top = stored_levels(named, every)
    root = roots(top).first()
    root = root["root"] if root else None
    start = top[0].select("tree").distinct().withColumn("way", F.array().cast("array<string>"))
    above = written(regenerate(named, tops_of(top, start, every), lambda r, way: (r["name"], r["digest"], way),
                               "tree string, subroot string, way array<string>", every), "merkle-above")

    def proven(row, way):
        folded = fold(row["bent"] or row["digest"], way)
        found = (row["doc_id"], row["tree"], row["digest"], root, proof_hash(way), folded, folded == root)
        return (*found, way) if proofs else found
    schema = "doc_id long, tree string, leaf string, root string, proof_sha256 string, folded_root string, verified boolean"
    ways = tops_of(levels, above.select("tree", "way"), every)
    out = regenerate(leaves, ways, proven, schema + (", proof array<string>" if proofs else ""), every)
    # One row per group; as many as there are sources, so the planner decides how to join.
    out = join_null_safe(out, above.select("tree", "subroot"), ["tree"])
    return out.select(F.col("doc_id").alias(doc_id), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", *(["proof"] if proofs else []))


def oracle_sql(table: str = "documents") -> str:
    """DuckDB SQL of the manifest, tampered where 2 divides the CRC-32 of the id."""
    def field(c, kind="VARCHAR"):
        return f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"

    def leaf(text):
        return "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    # CRC-32 bit by bit: one step per byte, eight shifts each (reflected polynomial 0xEDB88320).
    crc = ("xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))), "
           "lambda s, b: list_reduce(list_prepend(xor(s, b), list_transform(range(8), lambda i: CAST(i AS BIGINT))), "
           "lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)")

    def tree(name, base):
        return f"""{name}(grp, level, pos, n, digest) AS ({base}
  UNION ALL SELECT grp, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM {name} WHERE n > 1 GROUP BY grp, level, pos // 3, n)"""

    def siblings(name, base):
        return f"""{name} AS (SELECT a.grp, a.level, a.pos, a.n, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS before,
    coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS after
  FROM {base} a LEFT JOIN {base} b ON a.grp IS NOT DISTINCT FROM b.grp AND a.level = b.level AND a.pos // 3 = b.pos // 3 AND a.pos <> b.pos
  WHERE a.n > 1 GROUP BY a.grp, a.level, a.pos, a.n)"""

    return f"""WITH RECURSIVE leaves AS (SELECT doc_id, source, {leaf('text')} AS leaf,
    CASE WHEN ({crc}) % 2 = 0 THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf('text')} END AS bent,
    row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM {table}),
{tree('nodes', 'SELECT source, 0, pos, n, leaf FROM leaves')},
subroots AS (SELECT grp AS source, digest AS subroot, row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
{tree('groups_', 'SELECT 0, 0, pos, n, subroot FROM subroots')},
{siblings('low', 'nodes')},
{siblings('high', 'groups_')},
walk(doc_id, source, step, level, pos, n, own, other, proof) AS (
  SELECT doc_id, source, 0, 0, pos, n, leaf, bent, '' FROM leaves
  UNION ALL SELECT w.doc_id, w.source, 0, w.level + 1, w.pos // 3, (w.n + 2) // 3, sha256(s.before || w.own || s.after), sha256(s.before || w.other || s.after),
    w.proof || s.before || s.after
  FROM walk w JOIN low s ON w.step = 0 AND w.n > 1 AND s.grp IS NOT DISTINCT FROM w.source AND s.level = w.level AND s.pos = w.pos),
climb(doc_id, level, pos, n, subroot, own, other, proof) AS (
  SELECT w.doc_id, 0, r.pos, r.n, r.subroot, w.own, w.other, w.proof FROM walk w JOIN subroots r ON w.n = 1 AND r.source IS NOT DISTINCT FROM w.source
  UNION ALL SELECT c.doc_id, c.level + 1, c.pos // 3, (c.n + 2) // 3, c.subroot, sha256(s.before || c.own || s.after), sha256(s.before || c.other || s.after),
    c.proof || s.before || s.after
  FROM climb c JOIN high s ON c.n > 1 AND s.level = c.level AND s.pos = c.pos)
SELECT l.doc_id, l.leaf, c.subroot, r.digest AS root, sha256(c.proof) AS proof_sha256, c.other AS folded_root, c.other = r.digest AS verified
FROM climb c JOIN leaves l ON l.doc_id = c.doc_id, (SELECT digest FROM groups_ WHERE n = 1) r WHERE c.n = 1
"""
