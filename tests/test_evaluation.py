import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakerisk.operators import baselines, curves, evaluation, ranking, runs
from lakerisk.plans import views

DDL = "id string, label int, score double, split string, region string, run_id string, has_contracts int"


def preds(spark, labels, scores, region="LIMA", contracts=0):
    rows = [(f"{i:011d}", y, float(s), "test", region if isinstance(region, str) else region[i], "r", contracts) for i, (y, s) in enumerate(zip(labels, scores))]
    return spark.createDataFrame(rows, DDL)


def one(df):
    return df.first().asDict()


def test_ten_rows_by_hand(spark):
    labels = [1, 0, 1, 0, 0, 0, 0, 0, 0, 0]
    got = one(evaluation.ranking_metrics(preds(spark, labels, [0.9 - 0.1 * i for i in range(10)]), ks=[2]))
    assert (got["precision_2"], got["recall_2"], got["lift_2"]) == (0.5, 0.5, 2.5)
    assert got["pr_auc"] == pytest.approx((1 + 2 / 3) / 2) and got["n"] == 10 and got["prevalence"] == 0.2
    assert (got["tp_5pct"], got["fp_5pct"], got["fn_5pct"], got["tn_5pct"]) == (1, 0, 1, 8)


def test_perfect_inverted_and_tied(spark):
    labels = [1] * 10 + [0] * 90
    perfect = one(evaluation.ranking_metrics(preds(spark, labels, [1 - i / 100 for i in range(100)]), ks=[10]))
    assert perfect["pr_auc"] == pytest.approx(1.0) and perfect["roc_auc"] == pytest.approx(1.0) and perfect["recall_10"] == 1.0
    inverted = one(evaluation.ranking_metrics(preds(spark, labels, [i / 100 for i in range(100)]), ks=[10]))
    assert inverted["roc_auc"] == pytest.approx(0.0) and inverted["recall_10"] == 0.0
    tied = one(evaluation.ranking_metrics(preds(spark, labels, [0.5] * 100), ks=[10]))
    assert tied["pr_auc"] == pytest.approx(0.1) and tied["roc_auc"] == pytest.approx(0.5) and tied["brier"] == pytest.approx(0.25)
    # Ties go by id, so the first ten ids are the top ten.
    assert tied["recall_10"] == 1.0


def test_one_class_only(spark):
    none = one(evaluation.ranking_metrics(preds(spark, [0] * 20, range(20)), ks=[5]))
    assert (none["pr_auc"], none["roc_auc"], none["recall_5"], none["lift_5"]) == (0.0, None, 0.0, 1.0)
    every = one(evaluation.ranking_metrics(preds(spark, [1] * 20, range(20)), ks=[5]))
    assert every["pr_auc"] == pytest.approx(1.0) and every["roc_auc"] is None


def test_recall_at_one_percent_shares_ties(spark):
    labels = [0] * 200
    for i in (0, 50, 100, 150):
        labels[i] = 1
    plain = one(evaluation.rank_areas(preds(spark, labels, [1 - i / 200 for i in range(200)])))
    assert plain["expected_recall_1pct"] == 0.25
    for order in (labels, labels[::-1]):
        assert one(evaluation.rank_areas(preds(spark, order, [0.3] * 200)))["expected_recall_1pct"] == pytest.approx(0.01)


def test_guards(spark):
    good = preds(spark, [1, 0], [0.5, 0.1])
    assert evaluation.check_predictions(good, ks=[2]).count() == 2
    for bad, ks, reason in (
        (good.filter("false"), [], "no predictions"), (good.drop("score"), [], "score"), (good, [3], "exceed"),
        (good.withColumn("split", F.lit("train")), [], "train rows"), (good.withColumn("split", F.lit("other")), [], "no test rows"),
    ):
        with pytest.raises(ValueError, match=reason):
            evaluation.check_predictions(bad, ks)
    assert evaluation.check_predictions(good.withColumn("split", F.lit("Train")), [], diagnostic=True).count() == 2


def test_segments(spark):
    regions = ["LIMA", "CALLAO", "CUSCO", "PUNO"] * 5
    labels = [1 if i % 4 == 2 else 0 for i in range(20)]
    got = {r["segment"]: r for r in evaluation.segment_metrics(preds(spark, labels, range(20), regions, 1)).collect()}
    assert set(got) == {"LIMA", "RESTO", "CALLAO", "CUSCO", "PUNO", "CONTRATISTAS"}
    assert (got["LIMA"]["n"], got["RESTO"]["n"], got["CALLAO"]["n"]) == (10, 10, 5)
    assert got["LIMA"]["pr_auc"] is None and got["CUSCO"]["pr_auc"] == pytest.approx(1.0)
    assert got["CONTRATISTAS"]["few_positives"] is True and got["CUSCO"]["recall_1pct"] is None


def test_flat_row(spark):
    got = one(evaluation.flat_metrics(preds(spark, [1, 0] * 10, range(20)), ks=[5]))
    assert got["pr_auc_baseline"] == got["prevalence"] == 0.5 and got["pr_auc_low"] == got["pr_auc"]
    assert got["recall_rest"] is None and got["n_contractors"] is None and got["instance"] is None


def test_bootstrap(spark):
    labels = [1 if i % 7 == 0 or i < 6 else 0 for i in range(200)]
    df = preds(spark, labels, [1 - i / 200 for i in range(200)])
    area = one(evaluation.rank_areas(df))["pr_auc"]
    first, second = (one(evaluation.bootstrap_interval(df, replicates=200)) for _ in range(2))
    assert first == second and first["pr_auc_low"] < area < first["pr_auc_high"]
    assert one(evaluation.bootstrap_interval(preds(spark, [0] * 20, range(20)), replicates=20))["pr_auc_high"] == 0.0
    sure = one(evaluation.bootstrap_interval(preds(spark, [1] * 20, range(20)), replicates=20))
    assert sure["pr_auc_low"] == sure["pr_auc_high"] == 1.0


def test_poisson_weights_have_the_right_mean_and_repeat():
    draw = evaluation._weights(4000)
    seeds = np.array([1, -5, 2**62, 7], dtype=np.int64)
    means = np.array([1, 40, 500, 0], dtype=np.int64)
    one, two = ([np.vstack(x) for x in zip(*draw(seeds, means, means[::-1].copy()))] for _ in range(2))
    assert (one[0] == two[0]).all() and (one[1] == two[1]).all()
    for got, mean in zip(one[0], means):
        assert got.mean() == pytest.approx(mean, rel=0.05) and got.var() == pytest.approx(mean, rel=0.1)


def test_bootstrap_equals_a_walk_over_all_steps(spark):
    """Runs of any length give what one walk over the steps gives, for each group and replicate."""
    labels = [1 if i * i % 7 in (1, 2) else 0 for i in range(150)]
    df = preds(spark, labels, [(i * 37 % 60) / 60 for i in range(150)])
    both = df.unionByName(df.withColumn("run_id", F.lit("other")).filter("label = 0 OR score > 0.5"))
    whole = sorted(map(tuple, evaluation.bootstrap_interval(both, replicates=100).collect()))
    assert len(whole) == 2 and sorted(map(tuple, evaluation.bootstrap_interval(both, replicates=100, most=5).collect())) == [
        (*r[:2], pytest.approx(r[2]), pytest.approx(r[3]), r[4]) for r in whole
    ]
    ladder = evaluation.score_ladder(df)
    steps = ladder.groupBy(*evaluation.RUN, (F.col("p_upto") - F.col("p")).alias("step")).agg(F.sum("p").alias("p"), F.sum(F.col("n") - F.col("p")).alias("q"))
    rows = steps.withColumn("seed", F.xxhash64(*evaluation.RUN, "step", F.lit(42))).orderBy("step").toPandas()
    p, q = (np.vstack(x) for x in zip(*evaluation._weights(100)(*(rows[c].to_numpy() for c in ("seed", "p", "q")))))
    upto, n = p.cumsum(axis=0), (p + q).cumsum(axis=0)
    area = (p * upto / np.maximum(n, 1)).sum(axis=0) / p.sum(axis=0)
    got = next(r for r in whole if r[0] == rows["run_id"][0])
    assert got[2:4] == (pytest.approx(np.percentile(area, 2.5)), pytest.approx(np.percentile(area, 97.5)))


def test_curves(spark):
    df = preds(spark, [1, 0, 1, 0], [0.9, 0.8, 0.8, 0.1])
    pr = {(r["threshold"], round(r["precision"], 4), r["recall"]) for r in curves.precision_recall_points(df).collect()}
    assert pr == {(0.9, 1.0, 0.5), (0.8, 0.6667, 1.0), (0.1, 0.5, 1.0), (None, 1.0, 0.0)}
    roc = {(r["threshold"], r["false_rate"], r["true_rate"]) for r in curves.roc_points(df).collect()}
    assert roc == {(None, 0.0, 0.0), (0.9, 0.0, 0.5), (0.8, 0.5, 1.0), (0.1, 1.0, 1.0)}
    gain = sorted((r["rank"], r["captured_pct"], round(r["lift"], 4)) for r in curves.gain_lift_points(df).collect())
    assert gain == [(1, 50.0, 2.0), (2, 50.0, 1.0), (3, 100.0, 1.3333), (4, 100.0, 1.0)]


def test_calibration_and_histograms(spark):
    df = preds(spark, [1, 0, 1, 0], [0.1, 0.11, 1.0, 0.0])
    assert {(r["bin"], r["n"]) for r in curves.calibration_points(df).collect()} == {(0, 2), (1, 1), (9, 1)}
    clamped = {r["bin"] for r in curves.score_histogram(df).collect()}
    assert 19 in clamped and 20 in {r["bin"] for r in curves.score_histogram(df, clamp=False).collect()}
    area = sum(r["density"] * 0.9 / 40 for r in curves.density_points(df).filter("label = 1").collect())
    assert area == pytest.approx(1.0)
    assert curves.density_points(preds(spark, [1], [0.5])).first()["bin"] == 20


def test_rankings(spark, plan_of):
    df = preds(spark, [0] * 6, [0.5, 0.5, 0.9, 0.1, 0.2, 0.3], ["A", "A", "A", "B", "B", None])
    ranked = {r["id"][-1]: r["rank_global"] for r in ranking.rank_population(df).collect()}
    assert ranked == {"2": 1, "0": 2, "1": 3, "5": 4, "4": 5, "3": 6}
    top = ranking.top_per_region(df, 2)
    assert sorted((r["region"], r["id"][-1]) for r in top.collect()) == [("A", "0"), ("A", "2"), ("B", "3"), ("B", "4")]
    assert "WindowGroupLimit" in plan_of(top) and "WindowGroupLimit" in plan_of(ranking.top_per_split(df, 1000))
    inside = {r["id"][-1]: r["rank_percentile"] for r in ranking.rank_in_split(df).collect()}
    assert inside["2"] == pytest.approx(1 / 6)


RUNS = "run_id string, model_name string, variant string, dataset_version string, run_date string"


def test_latest_run(spark):
    rows = [("risk-run-E1-a", "LR", "V2", "v1", "2026-01-01"), ("risk-run-E1-b", "LR", "V2", "v1", "2026-02-01"), ("odd", "LR", "V2", "v1", "2026-01-01")]
    got = {r["run_id"]: (r["experiment"], r["is_latest"]) for r in ranking.flag_latest_runs(spark.createDataFrame(rows, RUNS)).collect()}
    assert got == {"risk-run-E1-a": ("E1", 0), "risk-run-E1-b": ("E1", 1), "odd": (None, 1)}


RESULT = "run_id string, model_name string, variant string, status string, cv_scheme string, cv_pr_auc_mean double, cv_recall_1pct_mean double"


def champion(spark, *rows):
    got = {r["role"]: r["run_id"] for r in runs.choose_champion(spark.createDataFrame(list(rows), RESULT)).collect()}
    return got.get("champion"), got.get("challenger")


def test_champion(spark):
    a = ("a", "DT", "V2", "SUCCESS", "bloques", 0.2, 0.5)
    b = ("b", "LR", "V2", "SUCCESS", None, 0.9, 0.4)
    leaky = ("c", "LR", "V1", "SUCCESS", "bloques", 1.0, 1.0)
    forward = ("d", "LR", "V2", "SUCCESS", "temporal", 1.0, 1.0)
    failed = ("e", "LR", "V2", "FAILED", "bloques", 1.0, 1.0)
    old = ("f", "DT", "V2", "SUCCESS", "bloques", 0.5, None)
    assert champion(spark, a, b, leaky, forward, failed) == ("a", "b")
    assert champion(spark, a, b, old) == ("b", "f")
    assert champion(spark, ("x", "DT", "V2", "SUCCESS", None, 0.5, 0.5), ("y", "LR", "V2", "SUCCESS", None, 0.5, 0.5)) == ("y", "x")
    assert champion(spark, leaky) == (None, None)


def test_baselines(spark):
    rows = [("NO HABIDO", None, 1), (" no hallado", "3", 0), ("HABIDO", "1", 1), ("HABIDO", "0", 0), (None, "9", 1)]
    df = spark.createDataFrame(rows, "condition string, workers string, has_contracts int")
    assert [round(r["score"] * 3) for r in baselines.rule_score(df).collect()] == [3, 1, 1, 1, 0]
    assert {r["score"] for r in baselines.constant_score(df).collect()} == {0.0}
    ids = spark.range(50).select(F.col("id").cast("string").alias("id"))
    one_way = {r["id"]: r["score"] for r in baselines.random_score(ids).collect()}
    other_way = {r["id"]: r["score"] for r in baselines.random_score(ids.repartition(7)).collect()}
    assert one_way == other_way and len(set(one_way.values())) == 50


def test_run_summary_and_gaps(spark):
    ddl = "run_id string, metricas_cv struct<cv_pr_auc_mean: double, train_pr_auc: double, cv_pr_auc_folds: array<double>, cv_recall_1pct_mean: double, cv_recall_1pct_std: double>"
    df = spark.createDataFrame([("risk-run-E1-x", (0.4, 0.5, [0.2, 0.4, None], None, None)), ("e3", (None, None, None, None, None))], ddl)
    got = {r["run_id"]: r for r in runs.run_summary(df).collect()}
    assert got["risk-run-E1-x"]["cv_pr_auc_std"] == pytest.approx(0.1) and got["risk-run-E1-x"]["overfit_gap"] == 0.1
    assert got["e3"]["cv_pr_auc_std"] == 0.0 and got["e3"]["cv_recall_1pct_mean"] is None
    gaps = {r["experiment"]: r["found"] for r in runs.matrix_gaps(df).collect()}
    assert gaps == {"E1": True, "E2": False, "E3": True, "E4": False, "E5": False, "E6": False}
    assert not math.isnan(got["e3"]["train_pr_auc"])


def test_quadrants(spark):
    rows = [("A", 10, 80.0), ("B", 10, 20.0), ("C", 1, 80.0), ("D", 1, 20.0)]
    df = spark.createDataFrame(rows, "region string, active_entities bigint, informal_pct double")
    got = {r["region"]: r["quadrant"] for r in views.quadrants(df).collect()}
    assert got == {"A": "Alto RUC / Alta Informalidad", "B": "Alto RUC / Alta Informalidad", "C": "Alto RUC / Alta Informalidad", "D": "Alto RUC / Alta Informalidad"}


def test_cut_off_above_the_rows_gives_null(spark):
    got = one(evaluation.ranking_metrics(preds(spark, [1, 0, 0], [0.9, 0.5, 0.1]), ks=[3, 4]))
    assert (got["precision_3"], got["recall_3"], got["lift_3"]) == (pytest.approx(1 / 3), 1.0, 1.0)
    assert (got["precision_4"], got["recall_4"], got["lift_4"]) == (None, None, None)
    none = one(evaluation.ranking_metrics(preds(spark, [0, 0, 0], [0.9, 0.5, 0.1]), ks=[3, 4]))
    assert (none["recall_3"], none["lift_3"], none["recall_4"], none["lift_4"]) == (0.0, 1.0, None, None)


def test_top_of_a_split_with_ties_over_all_parts(spark):
    df = preds(spark, [0] * 900, [i % 3 for i in range(900)]).repartition(7)
    got = [(r["id"], r["rank_in_split"]) for r in ranking.top_per_split(df, 305).orderBy("rank_in_split").collect()]
    wanted = [i for i in range(900) if i % 3 == 2] + [i for i in range(900) if i % 3 == 1][:5]
    assert got == [(f"{i:011d}", k + 1) for k, i in enumerate(wanted)]


def test_interval_of_a_group_whose_positives_lead(spark):
    got = one(evaluation.bootstrap_interval(preds(spark, [1] * 20 + [0] * 80, [1 - i / 100 for i in range(100)])))
    assert (got["pr_auc_low"], got["pr_auc_high"]) == (pytest.approx(1.0), pytest.approx(1.0)) and got["replicates"] == 1000


@pytest.mark.parametrize("window", [1_000_000, 3])
def test_cut_offs_that_part_ties(spark, monkeypatch, window):
    """Cut-offs inside large ties of both labels, by a window and in slices, equal counting rows in order."""
    monkeypatch.setattr(evaluation, "WINDOW_ROWS", window)
    rows = [("r", "test" if i % 4 else "train", i * 7919 % 2000, [0.9, 0.5, 0.5, None][i % 4 if i % 9 else 3], i % 3 % 2) for i in range(2000)]
    preds = spark.createDataFrame(rows, "run_id string, split string, id long, score double, label int")
    for r in evaluation.ranking_metrics(preds, ks=(100, 5000)).collect():
        ordered = sorted((x for x in rows if x[1] == r["split"]), key=lambda x: (-x[3] if x[3] is not None else 1, x[2]))
        hits = lambda k, ordered=ordered: sum(x[4] for x in ordered[:k])
        assert r["n"] == len(ordered) and r["n_positives"] == hits(len(ordered))
        assert r["precision_100"] == hits(100) / 100 and r["precision_5000"] is None
        assert (r["tp_1pct"], r["tp_5pct"]) == (hits(-(-len(ordered) // 100)), hits(-(-len(ordered) // 20)))
