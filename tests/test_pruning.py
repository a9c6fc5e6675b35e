from itertools import product

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from lakerisk.operators import models, pruning
from lakerisk.operators.pruning import Node


def _leaf(cost, rows=10, positive=1.0):
    return Node(positive, float(rows), rows, cost)


@pytest.fixture()
def hand():
    """Links: left 0.02 for one leaf, right 0.10 for one leaf, root (0.5 - 0.21) / 3."""
    left = Node(2, 20, 20, 0.10, 0, 1.0, 0.1, _leaf(0.05), _leaf(0.03))
    right = Node(8, 20, 20, 0.23, 1, 1.0, 0.1, _leaf(0.06), _leaf(0.07))
    return Node(10, 40, 40, 0.50, 2, 1.0, 0.1, left, right)


def _subtrees(node):
    """Every pruned form of a tree."""
    yield node.cut()
    if node.left is not None:
        for a, b in product(list(_subtrees(node.left)), list(_subtrees(node.right))):
            yield Node(node.positive, node.weight, node.rows, node.cost, node.feature, node.threshold, node.gain, a, b)


def _measure(tree, alpha):
    leaves = list(tree.leaves())
    return sum(n.cost for n in leaves) + alpha * len(leaves), len(leaves)


def test_path_of_a_hand_tree(hand):
    path = pruning.pruning_path(hand)
    assert [(round(a, 6), sum(1 for _ in t.leaves())) for a, t in path] == [(0.0, 4), (0.02, 3), (0.1, 2), (0.17, 1)]


def test_pruned_trees_are_the_cheapest(hand):
    for alpha in (0.001, 0.019, 0.021, 0.05, 0.099, 0.101, 0.169, 0.171, 1.0):
        want = min((round(c, 12), n) for c, n in (_measure(t, alpha) for t in _subtrees(hand)))
        cost, leaves = _measure(pruning.pruned(hand, alpha), alpha)
        assert (round(cost, 12), leaves) == want
    assert pruning.pruned(hand, 0.0) is hand and pruning.pruned(_leaf(0.1), 5.0) == _leaf(0.1)


@pytest.fixture(scope="module")
def features(spark):
    draw = np.random.default_rng(3)
    x = draw.integers(0, 40, (500, 3)).astype(float)
    y = (draw.random(500) < 0.15 + 0.5 * (x[:, 0] > 20) * (x[:, 1] < 15)).astype(int)
    df = spark.createDataFrame([(int(b), 1.0 + i % 2, [float(v) for v in a]) for i, (a, b) in enumerate(zip(x, y))], "label int, weight double, x array<double>")
    return df.select("label", "weight", array_to_vector("x").alias("features"))


def _tree():
    return DecisionTreeClassifier(labelCol="label", weightCol="weight", maxDepth=6, minInstancesPerNode=5)


def _scores(model, rows):
    return model.transform(rows).select("features", vector_to_array("probability")[1].alias("p")).collect()


def test_nothing_cut_scores_as_spark(features):
    full, same = _tree().fit(features), pruning.PruningTree(_tree()).fit(features)
    assert [r["p"] for r in _scores(full, features)] == pytest.approx([r["p"] for r in _scores(same, features)])
    assert same.featureImportances.toArray() == pytest.approx(full.featureImportances.toArray())


@pytest.mark.parametrize("alpha, split", [(0.002, 2), (0.0, 120), (0.004, 60), (9.0, 2)])
def test_pruned_scores_follow_the_kept_nodes(features, alpha, split):
    model = pruning.PruningTree(_tree(), alpha, split).fit(features)
    kept = model.kept
    assert all(n.rows >= split and (alpha == 0 or pruning.link_strength(n) > alpha) for n in kept.inner())
    assert sum(1 for _ in kept.leaves()) < sum(1 for _ in model.whole.leaves())
    for r in _scores(model, features):
        n = kept
        while n.left is not None:
            n = n.left if r["features"][n.feature] <= n.threshold else n.right
        assert r["p"] == pytest.approx(n.positive / n.weight)


def test_learner_prunes(features):
    grid = {row[0]: models.settings(row[-1]) for row in models.EXPERIMENTS}
    assert len(grid["E11"]) == 12 and len(grid["E12"]) == 12
    made = models.classifier("DT", grid["E12"][0], 1.0)
    assert isinstance(made, pruning.PruningTree) and made.least_split == 100
    assert isinstance(models.classifier("DT", {"depth": 3}, 1.0), DecisionTreeClassifier)
    assert "feature 0" in pruning.PruningTree(_tree(), 0.002).fit(features).toDebugString
