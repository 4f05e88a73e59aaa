"""Decision trees pruned by cost and complexity.

A fitted tree becomes a table of nodes with class counts, two children and a split.  Its subtree costs
the training rows that it misclassifies plus a penalty for each leaf.  As the penalty grows, the
branch whose removal costs least per leaf saved goes first (the weakest link), which gives a nested sequence
of trees with ascending penalties.  Trees fitted without one fold each are pruned by the
same penalties, and one pass over the rows counts the errors of every fold and penalty.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Tree:
    """Nodes in the order parent, left branch, right branch; children of a leaf are -1."""

    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    counts: np.ndarray

    @property
    def risk(self) -> np.ndarray:
        """Rows of each node that its majority class gets wrong."""
        return self.counts.sum(axis=1) - self.counts.max(axis=1)

    @property
    def vote(self) -> np.ndarray:
        return self.counts.argmax(axis=1)


def tree_of(model) -> Tree:
    """The node table of a fitted Spark tree with numeric splits (bounded by its depth)."""
    rows = []

    def walk(node) -> int:
        at = len(rows)
        rows.append([-1, -1, -1, 0.0, list(node.impurityStats().stats())])
        if node.subtreeDepth() > 0:
            split = node.split()
            rows[at][2:4] = split.featureIndex(), split.threshold()
            rows[at][0] = walk(node.leftChild())
            rows[at][1] = walk(node.rightChild())
        return at
    walk(model._call_java("rootNode"))
    left, right, feature, threshold, counts = zip(*rows, strict=True)
    return Tree(np.array(left), np.array(right), np.array(feature), np.array(threshold, float), np.array(counts, float))


def weakest_links(tree: Tree) -> tuple[np.ndarray, list[dict]]:
    """The penalty from which each node is a leaf (or gone), and the sequence of trees.

    ``collapse[t]`` is the smallest penalty at which node ``t`` has no branch any more (0 for leaves,
    infinite for none).  The sequence has, from the largest tree to the root alone, the ``penalty`` from which the tree is
    the best one, its ``leaves`` and its ``errors`` on the training rows.
    """
    n, risk = len(tree.left), tree.risk
    collapse = np.where(tree.left < 0, 0.0, np.inf)

    def branches():
        """Errors and leaves of what is left of each node's branch (children have larger numbers)."""
        errors, leaves = risk.copy(), np.ones(n)
        for t in range(n - 1, -1, -1):
            if np.isinf(collapse[t]):
                errors[t] = errors[tree.left[t]] + errors[tree.right[t]]
                leaves[t] = leaves[tree.left[t]] + leaves[tree.right[t]]
        return errors, leaves
    penalty, sequence = 0.0, []
    while True:
        errors, leaves = branches()
        alive = np.zeros(n, bool)  # nodes that the present tree still reaches
        alive[0] = True
        for t in range(n):
            if alive[t] and np.isinf(collapse[t]):
                alive[[tree.left[t], tree.right[t]]] = True
        inner = np.flatnonzero(alive & np.isinf(collapse))
        gain = (risk[inner] - errors[inner]) / (leaves[inner] - 1) if len(inner) else np.zeros(0)
        # Branches that save no error go at penalty 0, before the first tree is noted.
        if len(inner) and gain.min() <= penalty + 1e-12:
            collapse[inner[gain <= penalty + 1e-12]] = penalty
            continue
        sequence.append({"penalty": penalty, "leaves": int(leaves[0]), "errors": float(errors[0])})
        if not len(inner):
            return collapse, sequence
        penalty = float(gain.min())


def importances(tree: Tree, collapse: np.ndarray, penalty: float, n_features: int) -> np.ndarray:
    """Entropy that the splits of the pruned tree take away, by feature, weighted by rows."""
    total = np.zeros(n_features)
    size = tree.counts.sum(axis=1)
    share = tree.counts / np.maximum(size, 1)[:, None]
    entropy = -(share * np.log2(np.where(share > 0, share, 1))).sum(axis=1)
    stack = [0]
    while stack:
        t = stack.pop()
        if collapse[t] > penalty:
            a, b = tree.left[t], tree.right[t]
            total[tree.feature[t]] += size[t] * entropy[t] - size[a] * entropy[a] - size[b] * entropy[b]
            stack += [a, b]
    return total


def _errors(batches, trees: list[tuple[Tree, np.ndarray]], penalties: np.ndarray):
    """Errors of each fold and penalty in a partition: one walk down each row's own tree serves all penalties."""
    wrong, seen = np.zeros((len(trees), len(penalties))), np.zeros(len(trees))
    for batch in batches:
        if not batch.num_rows:
            continue
        fold, label = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
        x = np.array(batch.column(2).to_pylist(), np.float64).reshape(batch.num_rows, -1)
        for f, (tree, collapse) in enumerate(trees):
            own = np.flatnonzero(fold == f)
            seen[f] += len(own)
            node, vote = np.zeros(len(own), np.int64), np.full((len(own), len(penalties)), -1)
            while len(own):
                # Where a penalty stops at this node for the first time, the node votes.
                stop = (collapse[node][:, None] <= penalties[None, :]) & (vote < 0)
                vote = np.where(stop, tree.vote[node][:, None], vote)
                inner = tree.left[node] >= 0
                if not inner.any():
                    break
                low = x[own, np.maximum(tree.feature[node], 0)] <= tree.threshold[node]
                node = np.where(inner, np.where(low, tree.left[node], tree.right[node]), node)
            wrong[f] += (vote != label[own][:, None]).sum(axis=0)
    k = len(penalties)
    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(trees), dtype=np.int32), k)), pa.array(np.tile(np.arange(k, dtype=np.int32), len(trees))),
                                      pa.array(wrong.ravel()), pa.array(np.repeat(seen, k))], names=["fold", "step", "wrong", "seen"])


@dataclass
class Pruned:
    """A tree, when its nodes collapse, the steps of its sequence with cross-validated errors, and the chosen step."""

    tree: Tree
    collapse: np.ndarray
    steps: list[dict]
    chosen: int


def pruned_tree(rows: DataFrame, label: str, folds: int = 10, depth: int = 8, least: int = 7, seed: int = 123) -> Pruned:
    """Entropy tree with the penalty of least cross-validated error; of equal errors the smaller tree.

    ``rows`` is a written table of a label from 0 and ``features`` (a vector).  Folds go by a hash of the row's values, so
    equal rows share a fold.  A step is judged at the geometric mean of its penalty and the next, as the penalties of a fold's
    tree differ a little.
    """
    dealt = rows.select(F.pmod(F.xxhash64(F.lit(seed), vector_to_array("features").cast("string"), F.col(label)), F.lit(folds)).cast("int").alias("_fold"),
                        F.col(label).cast("double").alias(label), "features")

    def fit(part):
        return tree_of(DecisionTreeClassifier(featuresCol="features", labelCol=label, impurity="entropy", maxDepth=depth,
                                              minInstancesPerNode=least, seed=seed).fit(part))
    with ThreadPool(4) as pool:
        whole, *others = pool.map(fit, [dealt, *[dealt.where(F.col("_fold") != f) for f in range(folds)]])
    collapse, steps = weakest_links(whole)
    starts = np.array([s["penalty"] for s in steps])
    # The last tree, the root, is judged at any higher penalty.
    middle = np.append(np.sqrt(starts[:-1] * starts[1:]), np.inf)
    total = rows.count()
    # A fold's tree has fewer rows, so its penalties are smaller by that share.
    trees = [(t, weakest_links(t)[0] * (total / max(t.counts[0].sum(), 1))) for t in others]
    found = (dealt.select("_fold", F.col(label).cast("long"), vector_to_array("features"))
             .mapInArrow(lambda b: _errors(b, trees, middle), "fold int, step int, wrong double, seen double")
             .groupBy("step").agg(F.sum("wrong").alias("wrong"), F.sum("seen").alias("seen")).collect())  # one row per step
    for r in found:
        steps[r["step"]]["cv_error"] = r["wrong"] / r["seen"] if r["seen"] else 0.0
    chosen = max(range(len(steps)), key=lambda k: (-steps[k].get("cv_error", 0.0), k))
    return Pruned(whole, collapse, [{**s, "errors": s["errors"] / max(total, 1), "penalty": s["penalty"] / max(total, 1)} for s in steps], chosen)


def importance_table(found: Pruned, names: Sequence[str]) -> list[tuple[str, float]]:
    """Normalised importances of the chosen tree, largest first."""
    raw = importances(found.tree, found.collapse, _penalty(found), len(names))
    total = raw.sum() or 1.0
    return sorted(((n, float(v / total)) for n, v in zip(names, raw, strict=True)), key=lambda r: -r[1])


def _penalty(found: Pruned) -> float:
    return found.steps[found.chosen]["penalty"] * found.tree.counts[0].sum()
