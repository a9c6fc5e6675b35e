"""Gradient boosting of trees that grow leaf by leaf, on histograms that Spark sums.

Features are coded into at most `BINS` bins once. A tree is grown best-first: the leaf whose best split gains most is
split next, until the leaf limit. One pass over the rows builds the histograms of all leaves that may still be split, so
a tree takes about as many passes as it is deep and not one per split. Gradients are summed as whole numbers, so the
model does not depend on how rows lie in partitions, and a re-run task agrees with its first run.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakerisk.session import drop_staged, stage_table

BINS = 255
# Rank error of the bin borders is at most rows / SKETCH.
SKETCH = 10_000
# Gradients are counted in units of 2**-24, so 10**11 rows of mean weight one stay inside 63 bits.
UNIT = float(1 << 24)
# A second derivative below this is no ground for a split.
LEAST_HESSIAN = 1e-3
# Histogram cells one task may hold, at 24 bytes each; it bounds how many leaves are measured ahead of their turn.
MOST_CELLS = 1 << 21
# Trees after which the summed scores are stored again, so a pass evaluates few trees.
TREES_PER_STORE = 10


@dataclass
class Tree:
    """Nodes in order of creation: a node with `left` < 0 is a leaf; rows with code <= cut go left."""

    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)

    def add(self, value: float) -> int:
        for column, start in ((self.feature, -1), (self.cut, -1), (self.left, -1), (self.right, -1), (self.value, value), (self.gain, 0.0)):
            column.append(start)
        return len(self.left) - 1

    def leaves(self) -> int:
        return sum(c < 0 for c in self.left)

    def place(self, codes: np.ndarray) -> np.ndarray:
        """The leaf of every row."""
        feature, cut, left, right = (np.asarray(c) for c in (self.feature, self.cut, self.left, self.right))
        at, rows = np.zeros(len(codes), dtype=np.int64), np.arange(len(codes))
        while True:
            inner = left[at] >= 0
            if not inner.any():
                return at
            down = codes[rows, np.maximum(feature[at], 0)] <= cut[at]
            at = np.where(inner, np.where(down, left[at], right[at]), at)

    def score(self, codes: np.ndarray) -> np.ndarray:
        return np.asarray(self.value)[self.place(codes)]


def _chance(raw: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(raw, -500, 500)))


def bin_borders(features: DataFrame, width: int, bins: int = BINS) -> list[np.ndarray]:
    """Rising borders per feature: the least value and the values at even shares of the rows, from mergeable sketches.

    A value up to the first border has code 0, one above the last border the highest code; a feature of few values gets
    a code for each common one, and a rare value shares a code with its neighbour.
    """
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    cell = lambda i: F.col("x")[i]
    asked = [F.struct(F.min(cell(i)).alias("least"), F.percentile_approx(cell(i), shares, SKETCH).alias("at")) for i in range(width)]
    seen = features.select(vector_to_array("features").alias("x")).agg(F.array(*asked).alias("found")).first()["found"]
    return [np.unique(np.array([f["least"], *(f["at"] or [])], dtype=float)) if f["least"] is not None else np.zeros(1) for f in seen]


def _codes(values: np.ndarray, borders: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(b, values[:, i], side="left") for i, b in enumerate(borders)], axis=1).astype(np.uint8)


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _coded(features: DataFrame, borders: list[np.ndarray], start: float) -> DataFrame:
    """label, weight, the codes as bytes and the first raw score of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (b for b in batches if b.num_rows):
            codes = _codes(_matrix(b.column("x"), b.num_rows), borders)
            packed = pa.array([row.tobytes() for row in codes], pa.binary())
            yield pa.RecordBatch.from_pydict({"label": b.column("label"), "weight": b.column("weight"), "codes": packed, "raw": np.full(b.num_rows, start)})

    plain = features.select(F.col("label").cast("double").alias("label"), F.col("weight").cast("double").alias("weight"), vector_to_array("features").alias("x"))
    return plain.mapInArrow(run, "label double, weight double, codes binary, raw double")


def _unpacked(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("codes").to_pylist()), dtype=np.uint8).reshape(-1, width)


def _with_scores(rows: DataFrame, trees: list[Tree], width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes = _unpacked(b, width)
            raw = b.column("raw").to_numpy() + sum(t.score(codes) for t in trees)
            yield pa.RecordBatch.from_pydict({**{c: b.column(c) for c in ("label", "weight", "codes")}, "raw": raw})

    return rows.mapInArrow(run, rows.schema)


def _histograms(rows: DataFrame, trees: list[Tree], tree: Tree, wanted: list[int], width: int) -> DataFrame:
    """(node, feature, bin, g, h, n) of the wanted leaves: sums per task first, then over all tasks."""
    slot = np.full(len(tree.left), -1)
    slot[wanted] = np.arange(len(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros((3, width, len(wanted) * 256), dtype=np.int64)
        for b in batches:
            codes = _unpacked(b, width)
            at = slot[tree.place(codes)]
            raw = b.column("raw").to_numpy() + sum(t.score(codes) for t in trees)
            weight, chance = b.column("weight").to_numpy(), _chance(raw)
            held = at >= 0
            codes, base = codes[held], at[held] * 256
            g = np.rint(weight * (chance - b.column("label").to_numpy()) * UNIT)[held]
            h = np.rint(weight * chance * (1 - chance) * UNIT)[held]
            for i in range(width):
                spot = base + codes[:, i]
                for k, mass in enumerate((g, h, None)):
                    cells[k, i] += np.bincount(spot, mass, minlength=cells.shape[2]).astype(np.int64)
        for i in range(width):
            full = np.flatnonzero(cells[2, i])
            if len(full):
                yield pa.RecordBatch.from_pydict({
                    "node": np.asarray(wanted, dtype=np.int32)[full // 256], "feature": np.full(len(full), i, dtype=np.int32),
                    "bin": (full % 256).astype(np.int32), "g": cells[0, i][full], "h": cells[1, i][full], "n": cells[2, i][full],
                })

    parts = rows.mapInArrow(run, "node int, feature int, bin int, g long, h long, n long")
    # A task sends a cell once, so nothing is left to combine before the exchange; this one also serves the sums over bins.
    return parts.repartition("node", "feature").groupBy("node", "feature", "bin").agg(*[F.sum(c).alias(c) for c in ("g", "h", "n")])


def best_splits(cells: DataFrame, least_rows: int, l2: float = 0.0) -> DataFrame:
    """The best split per node: (node, feature, cut, gain, and g, h of both sides); nodes without one are left out.

    Ties go to the lowest feature, then to the lowest cut. Sums run over the bins of one node and feature, 256 at most.
    """
    whole = Window.partitionBy("node", "feature")
    upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = cells.select(
        "node", "feature", "bin",
        *[F.sum(c).over(upto).alias(f"left_{c}") for c in ("g", "h", "n")],
        *[(F.sum(c).over(whole) - F.sum(c).over(upto)).alias(f"right_{c}") for c in ("g", "h", "n")],
    )

    def worth(g, h):
        real = g.cast("double") / UNIT
        return real * real / (h.cast("double") / UNIT + l2)

    sides = [(F.col(f"{s}_g"), F.col(f"{s}_h")) for s in ("left", "right")]
    gain = worth(*sides[0]) + worth(*sides[1]) - worth(sides[0][0] + sides[1][0], sides[0][1] + sides[1][1])
    enough = [F.col(f"{s}_n") >= least_rows for s in ("left", "right")] + [F.col(f"{s}_h") >= int(LEAST_HESSIAN * UNIT) for s in ("left", "right")]
    tried = sums.filter(enough[0] & enough[1] & enough[2] & enough[3]).withColumn("gain", gain).filter(F.col("gain") > 0)
    found = F.struct("gain", (-F.col("feature")).alias("feature"), (-F.col("bin")).alias("cut"), "left_g", "left_h", "right_g", "right_h")
    best = tried.groupBy("node").agg(F.max(found).alias("m"))
    return best.select("node", (-F.col("m.feature")).alias("feature"), (-F.col("m.cut")).alias("cut"), "m.gain", "m.left_g", "m.left_h", "m.right_g", "m.right_h")


def grow(rows: DataFrame, trees: list[Tree], width: int, leaves: int, least_rows: int, rate: float, l2: float = 0.0) -> Tree:
    """The best-first tree of at most `leaves` leaves for the gradients that `trees` leave in `rows`.

    The split of a leaf is looked for ahead of its turn: with r splits to go only the r best known leaves can have a
    turn, so the children of these are measured together. The result is the tree that one pass per split would give.
    Only one row per measured node reaches the driver.
    """
    ahead, splits = Tree(), {}  # the tree with every split tried ahead, and what is known of its nodes
    final, turns = Tree(), {}
    ahead.add(0.0)
    final.add(0.0)
    measured: set[int] = set()
    open_leaves = {0: 0}  # node in `ahead` -> node in `final`
    to_measure = [0]
    while True:
        if to_measure:
            for s in best_splits(_histograms(rows, trees, ahead, to_measure, width), least_rows, l2).collect():
                splits[s["node"]] = s
            measured.update(to_measure)
        while final.leaves() < leaves and all(n in measured for n in open_leaves):
            ready = [n for n in open_leaves if n in splits]
            if not ready:
                break
            node = max(ready, key=lambda n: (splits[n]["gain"], -turns.get(n, 0)))
            s, into = splits[node], open_leaves.pop(node)
            if ahead.left[node] < 0:
                _split(ahead, node, s, rate, l2)
            kids = _split(final, into, s, rate, l2)
            for child, copy in zip((ahead.left[node], ahead.right[node]), kids):
                open_leaves[child] = copy
                turns[child] = copy
        togo = leaves - final.leaves()
        unknown = [n for n in open_leaves if n not in measured]
        if togo <= 0 or not unknown:
            return final
        # The unknown leaves, and ahead of time the children of the best known ones.
        best = sorted((n for n in open_leaves if n in splits), key=lambda n: -splits[n]["gain"])[: togo - 1]
        for n in best:
            if ahead.left[n] < 0 and (len(unknown) + 2) * width * 256 <= MOST_CELLS:
                _split(ahead, n, splits[n], rate, l2)
                unknown += [ahead.left[n], ahead.right[n]]
        to_measure = unknown


def _split(tree: Tree, node: int, s, rate: float, l2: float) -> tuple[int, int]:
    weight = lambda g, h: -rate * (g / UNIT) / (h / UNIT + l2)
    kids = tree.add(weight(s["left_g"], s["left_h"])), tree.add(weight(s["right_g"], s["right_h"]))
    tree.feature[node], tree.cut[node], tree.gain[node] = s["feature"], s["cut"], s["gain"]
    tree.left[node], tree.right[node] = kids
    return kids


@dataclass
class LeafwiseModel:
    """Borders, first score and trees; scores rows that have a `features` vector."""

    borders: list[np.ndarray]
    start: float
    trees: list[Tree]

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802, named as in the other tree models
        """Gains summed per feature, as shares of all gains."""
        found = np.zeros(len(self.borders))
        for t in self.trees:
            for i, gain in zip(t.feature, t.gain):
                if i >= 0:
                    found[i] += gain
        return DenseVector(found / found.sum() if found.sum() else found)

    def transform(self, rows: DataFrame) -> DataFrame:
        """`rows` with `probability`, as the vector of both classes."""
        borders, start, trees = self.borders, self.start, self.trees

        @F.pandas_udf("double")
        def chance(x):
            values = np.stack(x.to_numpy()) if len(x) else np.zeros((0, len(borders)))
            codes = _codes(values, borders)
            return pd.Series(_chance(start + sum((t.score(codes) for t in trees), np.zeros(len(x)))))

        hit = chance(vector_to_array("features"))
        scored = rows.withColumn("_hit", hit)
        return scored.withColumn("probability", array_to_vector(F.array(1 - F.col("_hit"), F.col("_hit")))).drop("_hit")


@dataclass
class LeafwiseBoosting:
    """Settings of the boosting; `fit` takes rows with label, weight and a `features` vector."""

    rounds: int = 200
    rate: float = 0.1
    leaves: int = 31
    leaf: int = 20
    l2: float = 0.0

    def fit(self, features: DataFrame) -> LeafwiseModel:
        """Fit on all rows. Rows of one class, or none, give a model without trees that scores their share."""
        seen = features.agg(
            F.sum("weight").alias("w"), F.sum(F.col("weight") * F.col("label")).alias("p"), F.first(F.size(vector_to_array("features"))).alias("width")
        ).first()
        if not seen["w"] or not 0 < seen["p"] < seen["w"]:
            # With one class the share is 0 or 1: a score as certain as a double of this size can say.
            start = 0.0 if not seen["w"] else (35.0 if seen["p"] else -35.0)
            return LeafwiseModel([np.zeros(1)] * (seen["width"] or 0), start, [])
        width, share = seen["width"], seen["p"] / seen["w"]
        model = LeafwiseModel(bin_borders(features, width), float(np.log(share / (1 - share))), [])
        rows, recent = stage_table(_coded(features, model.borders, model.start), "coded"), []
        for _ in range(self.rounds):
            tree = grow(rows, recent, width, self.leaves, self.leaf, self.rate, self.l2)
            if tree.leaves() == 1:
                break
            model.trees.append(tree)
            recent.append(tree)
            if len(recent) == TREES_PER_STORE:
                older, rows = rows, stage_table(_with_scores(rows, recent, width), "coded")
                drop_staged(older)
                recent = []
        drop_staged(rows)
        return model
