import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from lakerisk.operators import boosting, models
from lakerisk.operators.evaluation import rank_areas


def _rows(spark, values, label, weight=None, parts=5):
    weight = np.ones(len(label)) if weight is None else weight
    data = [(int(y), float(w), [float(v) for v in x]) for x, y, w in zip(values, label, weight)]
    df = spark.createDataFrame(data, "label int, weight double, x array<double>").repartition(parts)
    return df.select("label", "weight", array_to_vector("x").alias("features"))


@pytest.fixture(scope="module")
def made():
    draw = np.random.default_rng(7)
    values = np.round(draw.normal(size=(600, 4)), 1)
    values[:, 3] = draw.integers(0, 2, 600)
    raw = 2 * (values[:, 0] > 0.3) * (values[:, 1] < 0) + values[:, 3] - 1.5
    return values, (draw.random(600) < 1 / (1 + np.exp(-raw))).astype(int), draw.choice([0.5, 1.0, 2.0], 600)


def _plain_tree(codes, g, h, leaves, least, rate):
    """Best-first growth with one search per leaf and split: the rule itself, on plain arrays."""

    def search(at):
        best = None
        for f in range(codes.shape[1]):
            for cut in range(256):
                low = at & (codes[:, f] <= cut)
                high = at & ~low
                if low.sum() < least or high.sum() < least:
                    continue
                (gl, hl), (gr, hr) = (g[low].sum(), h[low].sum()), (g[high].sum(), h[high].sum())
                gain = gl * gl / hl + gr * gr / hr - (gl + gr) ** 2 / (hl + hr)
                if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                    best = (gain, f, cut, low, high)
        return best

    open_leaves = [(np.ones(len(g), bool), search(np.ones(len(g), bool)))]
    while len(open_leaves) < leaves and any(s for _, s in open_leaves):
        i = max((i for i, (_, s) in enumerate(open_leaves) if s), key=lambda i: open_leaves[i][1][0])
        _, (_, _, _, low, high) = open_leaves.pop(i)
        open_leaves += [(low, search(low)), (high, search(high))]
    out = np.zeros(len(g))
    for at, _ in open_leaves:
        out[at] = -rate * g[at].sum() / h[at].sum()
    return out


@pytest.mark.parametrize("leaves", [2, 5, 9])
def test_trees_equal_best_first_growth(spark, made, leaves):
    values, label, weight = made
    model = boosting.LeafwiseBoosting(rounds=3, rate=0.3, leaves=leaves, leaf=10).fit(_rows(spark, values, label, weight))
    codes = boosting._codes(values, model.borders)
    raw = np.full(len(label), model.start)
    assert model.start == pytest.approx(np.log((weight * label).sum() / (weight * (1 - label)).sum()))
    for tree in model.trees:
        chance = 1 / (1 + np.exp(-raw))
        want = _plain_tree(codes, weight * (chance - label), weight * chance * (1 - chance), leaves, 10, 0.3)
        assert tree.leaves() == leaves and tree.score(codes) == pytest.approx(want, abs=1e-5)
        raw += want


def test_layout_does_not_matter(spark, made):
    fit = boosting.LeafwiseBoosting(rounds=4, leaves=6, leaf=5).fit
    one, other = fit(_rows(spark, *made, parts=1)), fit(_rows(spark, *made, parts=7))
    assert one.trees == other.trees
    # Scores stored again after every tree: the same model.
    before, boosting.TREES_PER_STORE = boosting.TREES_PER_STORE, 1
    try:
        again = fit(_rows(spark, *made))
    finally:
        boosting.TREES_PER_STORE = before
    assert again.trees == one.trees


def test_fewer_nodes_ahead_give_the_same_tree(spark, made, monkeypatch):
    fit = boosting.LeafwiseBoosting(rounds=1, leaves=8, leaf=5).fit
    wide = fit(_rows(spark, *made)).trees
    monkeypatch.setattr(boosting, "MOST_CELLS", 0)
    assert fit(_rows(spark, *made)).trees == wide


def test_odd_inputs(spark):
    one_class = boosting.LeafwiseBoosting(rounds=2).fit(_rows(spark, np.ones((5, 2)), [1] * 5))
    assert one_class.trees == []
    flat = _rows(spark, np.ones((60, 2)), [0, 1] * 30)
    constant = boosting.LeafwiseBoosting(rounds=2).fit(flat)
    assert constant.trees == [] and {round(r[0][1], 6) for r in constant.transform(flat).select("probability").collect()} == {0.5}
    assert boosting.LeafwiseBoosting().fit(flat.limit(0)).trees == []


def test_rare_values_keep_their_code(spark):
    """One row in 500 differs from the rest, below or above them."""
    values = np.ones((1000, 2))
    values[:2, 0], values[2:4, 1] = 0, 2
    borders = boosting.bin_borders(_rows(spark, values, [0] * 1000), 2)
    codes = boosting._codes(values, borders)
    assert (codes[:2, 0] < codes[5, 0]).all() and (codes[2:4, 1] > codes[5, 1]).all()


def test_leafwise_learner(spark):
    i = F.col("id")
    rows = spark.range(600).select(
        F.format_string("2%010d", i).alias("id"), (i % 8 == 0).cast("int").alias("label"),
        F.when(i % 10 < 7, "train").otherwise("test").alias("split"), (i % 5).cast("int").alias("fold"),
        ((i % 8 == 0).cast("int") * 500 + F.abs(F.hash(i)) % 400).cast("double").alias("total_amount"), F.lit("LIMA").alias("region"),
    )
    fitted = models.Learner("HGB").fit_all(rows.filter("split = 'train'"), [{"rounds": 5, "leaves": 4, "leaf": 5}])[0]
    scored = models.score_population(rows, fitted, "risk-run-E13")
    area = rank_areas(scored.filter("split = 'test'")).first()
    assert area["pr_auc"] > 3 * area["n_positives"] / area["n"]
    assert models.importances(spark, fitted).first()["feature"] == "num_total_amount"
    assert {r[1] for r in models.EXPERIMENTS if r[0] in ("E13", "E14")} == {"HGB"}
