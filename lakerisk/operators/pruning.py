"""Cost-complexity pruning and a least split size for Spark's decision trees.

The nodes of a fitted tree carry the class weights, rows and impurity of training, so both rules need no further look
at the data: only the nodes are read, and a tree has at most 2 ** depth leaves.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakerisk.session import drop_staged, scratch_path


@dataclass(frozen=True)
class Node:
    """A node with its share of the training weight times its impurity as `cost`; children are None in a leaf."""

    positive: float
    weight: float
    rows: int
    cost: float
    feature: int = -1
    threshold: float = 0.0
    gain: float = 0.0
    left: Node | None = None
    right: Node | None = None

    def cut(self) -> Node:
        return Node(self.positive, self.weight, self.rows, self.cost)

    def leaves(self) -> Iterator[Node]:
        if self.left is None:
            yield self
        else:
            yield from self.left.leaves()
            yield from self.right.leaves()

    def inner(self) -> Iterator[Node]:
        if self.left is not None:
            yield self
            yield from self.left.inner()
            yield from self.right.inner()


def tree_nodes(spark: SparkSession, model: DecisionTreeClassificationModel) -> Node:
    """The root of a fitted tree, from its saved form."""
    path = scratch_path(spark, "tree")
    model.save(path)
    saved = spark.read.parquet(f"{path}/data")
    rows = {r["id"]: r for r in saved.collect()}
    saved._staged_path = path
    drop_staged(saved)
    total = sum(rows[0]["impurityStats"]) or 1.0

    def build(at: int) -> Node:
        r = rows[at]
        weight = sum(r["impurityStats"])
        known = (r["impurityStats"][1], weight, r["rawCount"], weight / total * r["impurity"])
        if r["leftChild"] < 0:
            return Node(*known)
        split = r["split"]
        return Node(*known, split["featureIndex"], split["leftCategoriesOrThreshold"][0], r["gain"], build(r["leftChild"]), build(r["rightChild"]))

    return build(0)


def _replaced(node: Node, stops) -> Node:
    """The tree with every topmost node that `stops` accepts made a leaf."""
    if node.left is None or stops(node):
        return node.cut()
    return Node(
        node.positive, node.weight, node.rows, node.cost, node.feature, node.threshold, node.gain, _replaced(node.left, stops), _replaced(node.right, stops)
    )


def with_least_split(root: Node, rows: int) -> Node:
    """The tree that never splits a node of fewer than `rows` rows: a split does not depend on what lies below it."""
    return _replaced(root, lambda n: n.rows < rows)


def link_strength(node: Node) -> float:
    """Cost added per leaf saved when the node becomes a leaf."""
    leaves = list(node.leaves())
    return (node.cost - sum(n.cost for n in leaves)) / (len(leaves) - 1)


def pruning_path(root: Node) -> list[tuple[float, Node]]:
    """(alpha, tree) from the tree itself at 0 to its root alone: the weakest links are cut in turn, equal ones together."""
    path, at = [(0.0, root)], 0.0
    while root.left is not None:
        at = max(at, min(link_strength(n) for n in root.inner()))
        while root.left is not None and min(link_strength(n) for n in root.inner()) <= at + 1e-15:
            root = _replaced(root, lambda n: link_strength(n) <= at + 1e-15)
        path.append((at, root))
    return path


def pruned(root: Node, alpha: float) -> Node:
    """The smallest tree on the path whose links are all stronger than `alpha`; 0 prunes nothing."""
    if alpha <= 0:
        return root
    return [tree for at, tree in pruning_path(root) if at <= alpha][-1]


@dataclass
class PrunedTree:
    """A fitted tree whose leaves answer for the pruned node above them."""

    full: DecisionTreeClassificationModel
    whole: Node
    kept: Node
    width: int

    def chances(self) -> list[float]:
        """Per leaf of the full tree, in order from left to right, the positive share of its node in the pruned one."""
        found: list[float] = []

        def walk(full: Node, kept: Node) -> None:
            if kept.left is None:
                found.extend([kept.positive / kept.weight if kept.weight else 0.0] * sum(1 for _ in full.leaves()))
            else:
                walk(full.left, kept.left)
                walk(full.right, kept.right)

        walk(self.whole, self.kept)
        return found

    def transform(self, rows: DataFrame) -> DataFrame:
        """`rows` with `probability`, as the vector of both classes."""
        table = F.array(*map(F.lit, self.chances()))
        placed = self.full.copy().setLeafCol("_leaf").transform(rows).select(*rows.columns, "_leaf")
        hit = F.get(table, F.col("_leaf").cast("int"))
        return placed.withColumn("probability", array_to_vector(F.array(1 - hit, hit))).drop("_leaf")

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802, named as in the other tree models
        """Impurity gained per feature by the splits that stay, as shares of all."""
        found = [0.0] * self.width
        for n in self.kept.inner():
            found[n.feature] += n.gain * n.weight
        total = sum(found)
        return DenseVector([x / total for x in found] if total else found)

    @property
    def toDebugString(self) -> str:  # noqa: N802, named as in the other tree models
        lines: list[str] = []

        def tell(n: Node, depth: int) -> None:
            lead = "  " * depth
            if n.left is None:
                lines.append(f"{lead}Share of positives: {n.positive / n.weight if n.weight else 0.0:.6f}")
                return
            for side, child in (("<=", n.left), (">", n.right)):
                lines.append(f"{lead}If (feature {n.feature} {side} {n.threshold})")
                tell(child, depth + 1)

        tell(self.kept, 0)
        return "\n".join(lines)


@dataclass
class PruningTree:
    """A decision tree fitted by Spark and then cut back; `fit` as the estimators have it."""

    tree: DecisionTreeClassifier
    alpha: float = 0.0
    least_split: int = 2

    def fit(self, features: DataFrame) -> PrunedTree:
        full = self.tree.fit(features)
        whole = tree_nodes(features.sparkSession, full)
        return PrunedTree(full, whole, pruned(with_least_split(whole, self.least_split), self.alpha), full.numFeatures)
