"""Weakest-link pruning against the enumeration of all subtrees."""

import itertools

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tessera.operators import pruning
from tessera.session import materialise


def random_tree(rng, depth):
    left, right, counts = [], [], []

    def grow(level, size):
        at = len(left)
        left.append(-1)
        right.append(-1)
        counts.append(None)
        if level == 0 or size < 4 or rng.random() < 0.15:
            ones = int(rng.integers(0, size + 1))
            counts[at] = [size - ones, ones]
            return at
        part = int(rng.integers(1, size))
        left[at] = grow(level - 1, part)
        right[at] = grow(level - 1, size - part)
        counts[at] = [a + b for a, b in zip(counts[left[at]], counts[right[at]], strict=True)]
        return at
    grow(depth, 200)
    n = len(left)
    return pruning.Tree(np.array(left), np.array(right), np.zeros(n, int), np.zeros(n), np.array(counts, float))


def subtrees(tree, t=0):
    """(errors, leaves) of every way to prune below node ``t``."""
    out = [(float(tree.risk[t]), 1)]
    if tree.left[t] >= 0:
        out += [(a + c, b + d) for (a, b), (c, d) in itertools.product(subtrees(tree, tree.left[t]), subtrees(tree, tree.right[t]))]
    return out


@pytest.mark.parametrize("seed", range(8))
def test_sequence_equals_enumeration_of_all_subtrees(seed):
    tree = random_tree(np.random.default_rng(seed), 4)
    collapse, sequence = pruning.weakest_links(tree)
    every = subtrees(tree)
    starts = [s["penalty"] for s in sequence]
    assert starts == sorted(set(starts)) and sequence[-1]["leaves"] == 1
    for k, s in enumerate(sequence):
        after = starts[k + 1] if k + 1 < len(starts) else s["penalty"] + 10
        for penalty in (s["penalty"], (s["penalty"] + after) / 2):
            # The smallest of the cheapest subtrees.
            cheapest = min(e + penalty * n for e, n in every)
            leaves = min(n for e, n in every if e + penalty * n <= cheapest + 1e-9)
            errors = min(e for e, n in every if n == leaves)
            assert (s["leaves"], s["errors"]) == (leaves, errors)
            stack, found = [0], 0
            while stack:
                t = stack.pop()
                stack += [tree.left[t], tree.right[t]] if collapse[t] > penalty + 1e-12 else []
                found += collapse[t] <= penalty + 1e-12
            assert found == leaves


def test_noise_is_pruned_away_and_fold_errors_come_from_one_pass(spark):
    """One feature decides, two are noise; each fold's error equals that of a walk by hand."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 3))
    y = ((x[:, 0] > 0.3) ^ (rng.random(600) < 0.1)).astype(int)
    frame = spark.createDataFrame([(float(a), b.tolist()) for a, b in zip(y, x, strict=True)], "label double, x array<double>").repartition(3)
    rows = materialise(frame.select("label", array_to_vector("x").alias("features")), "test-tree")
    found = pruning.pruned_tree(rows, "label", folds=5, depth=6)
    assert found.steps[found.chosen]["leaves"] == 2 < found.steps[0]["leaves"]
    assert pruning.importance_table(found, ["a", "b", "c"])[0] == ("a", 1.0)
    assert [s["errors"] for s in found.steps] == sorted(s["errors"] for s in found.steps)
    assert abs(found.steps[found.chosen]["cv_error"] - 0.1) < 0.04 and found.steps[-1]["cv_error"] > 0.3
    tree, collapse = found.tree, found.collapse

    def vote(row, penalty):
        t = 0
        while collapse[t] > penalty:
            t = tree.left[t] if row[tree.feature[t]] <= tree.threshold[t] else tree.right[t]
        return tree.vote[t]
    penalties = np.array([0.0, 5.0, np.inf])
    part = spark.createDataFrame([(0, int(a), b.tolist()) for a, b in zip(y, x, strict=True)], "fold int, label long, x array<double>")
    sums = (part.mapInArrow(lambda b: pruning._errors(b, [(tree, collapse)], penalties), "fold int, step int, wrong double, seen double")
            .groupBy("step").agg(F.sum("wrong").alias("w"), F.sum("seen").alias("n")).orderBy("step").collect())
    assert [(r.w, r.n) for r in sums] == [(float(sum(vote(b, p) != a for a, b in zip(y, x, strict=True))), 600.0) for p in penalties]
